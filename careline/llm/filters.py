"""Filter interaction audit: what each filter removes alone, in every order, and on average.

Each document has a mask with one bit for each filter that it fails.  A coalition is a set of filters;
its removals are the documents that fail at least one of them.  All figures follow from the removals of
the 32 coalitions of five filters:

- what a step of an order removes is the difference of two coalitions, that before it and that with it,
- a filter's mean share over all orders (its Shapley value) is the least squares fit of a sum of shares to
  the coalitions' removals, weighted by the Shapley kernel and bound to give the whole coalition's
  removals exactly; its normal equations are solved in rationals, so the values are exact.
"""

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from careline.llm.common import cut

FILTERS = "ABCDE"
#: What is counted for each coalition: documents, those with a quality label, those with a toxic label.
KINDS = ("removed", "good", "toxic")
_UPPER, _MARKS = bytes(range(65, 91)), frozenset(b"#$%&*|")
_KEYS = ["_part", "_h1", "_h2", "_id", "_mask"]


def text_failures(text: bytes | None) -> int:
    """Bits 0 to 3: filters A to D of one text."""
    text = text or b""
    words = text.split()  # of bytes: at \x20 and \x09-\x0D alone
    chars = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * chars, not _MARKS.isdisjoint(text))
    return sum(f << i for i, f in enumerate(fails))


@F.arrow_udf(IntegerType())
def _text_mask(texts: pa.Array) -> pa.Array:
    return pa.array((text_failures(t.as_py()) for t in texts), pa.int32())


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Rows (_part, _id, _mask, _n): how many rows of an id have a mask.

    Bit 4, filter E, is set where a smaller id has the same text (told by 128 bits of hash).  Rows without
    id never fail E and are no earlier copy.  Null texts are empty, a null part is the empty string.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.xxhash64(body).alias("_h1"),
        F.xxhash64(F.lit(1), body).alias("_h2"), F.col(key).alias("_id"), _text_mask(body.cast("binary")).alias("_mask"))
    # rows that agree in all of this are one from here on; a copy's first id is found with one row per task and text
    rows = cut(rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_n")))
    first = rows.groupBy("_h1", "_h2").agg(F.min("_id").alias("_id")).withColumn("_is_first", F.lit(True))
    # joined by text and id, so that the copies of a text do not meet in one task
    marked = rows.join(first, ["_h1", "_h2", "_id"], "left")
    late = F.col("_id").isNotNull() & F.col("_is_first").isNull()
    mask = F.col("_mask") + F.when(late, 16).otherwise(0)
    # nor do an id's texts when labels are joined
    return marked.groupBy("_part", "_id", mask.alias("_mask")).agg(F.sum("_n").alias("_n"))


def coalition_removals(failed: DataFrame, labels: DataFrame, key: str = "doc_id", n_filters: int = len(FILTERS)) -> DataFrame:
    """Per part the table of all coalitions: (part, coalition, and one count for each of KINDS), and the part's ``total``.

    A document is good (toxic) if any of its label rows says so; labels of other ids, or without id, do not matter.
    """
    good, toxic = (F.max(F.coalesce(F.col(c) == 1, F.lit(False))) for c in ("quality", "toxic"))
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(good.alias("_good"), toxic.alias("_toxic"))
    marks = marks.where("_good OR _toxic")
    n = F.col("_n")
    # 2^5 masks in a part at most
    masks = failed.join(marks, "_id", "left").groupBy("_part", "_mask").agg(
        F.sum(n).alias("removed"), F.sum(F.when(F.col("_good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic"), n).otherwise(0)).alias("toxic"))
    coalition = F.explode(F.sequence(F.lit(0), F.lit(2**n_filters - 1))).alias("coalition")
    hit = F.col("_mask").bitwiseAND(F.col("coalition")) != 0
    return masks.select("*", coalition).groupBy(F.col("_part").alias("part"), "coalition").agg(
        *[F.sum(F.when(hit, F.col(k)).otherwise(0)).cast("bigint").alias(k) for k in KINDS], F.sum("removed").cast("bigint").alias("total"))


def kernel_weight(n: int, size: int) -> Fraction:
    """The Shapley kernel's weight of a coalition that is neither empty nor whole."""
    return Fraction(n - 1, comb(n, size) * size * (n - size))


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """A square system in rationals, by elimination."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                factor = rows[k][i]
                rows[k] = [x - factor * y for x, y in zip(rows[k], rows[i])]
    return [row[-1] for row in rows]


def shapley(removed: list[int], n: int) -> list[Fraction]:
    """Shapley values from the removals of all 2^n coalitions (index: the coalition's bits).

    Minimises the kernel-weighted squares of (removals - sum of the members' values) under the condition
    that all values sum to the whole coalition's removals: the normal equations with one multiplier.
    """
    whole = (1 << n) - 1
    if n == 1:
        return [Fraction(removed[1])]
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * n + [Fraction(removed[whole])]
    for s in range(1, whole):
        weight = kernel_weight(n, s.bit_count())
        members = [i for i in range(n) if s >> i & 1]
        for i in members:
            right[i] += weight * removed[s]
            for j in members:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    return solve(matrix, right)[:n]


_STEPS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint,"
          " good_lost bigint, toxic_lost bigint, shapley bigint")


def step_counts(part: str, table: dict[str, np.ndarray], total: int, names: str = FILTERS) -> pa.RecordBatch:
    """All orders' steps of one part, as differences of coalitions; ``shapley`` is the value times the number of orders."""
    n, removed = len(names), table["removed"]
    whole = 2**n - 1
    value = [int(v * factorial(n)) for v in shapley(removed.tolist(), n)]
    out = {c: [] for c in ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            gone = removed[after] - removed[before]
            row = ("".join(names[k] for k in order), step, total - removed[after], gone, removed[1 << i] - gone,
                   removed[whole] - removed[whole ^ 1 << i], table["good"][after] - table["good"][before],
                   table["toxic"][after] - table["toxic"][before], value[i])
            for column, cell in zip(out.values(), row):
                column.append(cell)
            before = after
    types = {"filter_order": pa.string(), "step": pa.int32()}
    n_rows = len(out["step"])
    return pa.RecordBatch.from_arrays([pa.array([part] * n_rows, pa.string()), *[pa.array(v, types.get(c, pa.int64())) for c, v in out.items()]],
                                      ["part", *out])


def _audit_part(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("coalition")
    table = {k: rows.column(k).to_numpy() for k in KINDS}
    return pa.Table.from_batches([step_counts(rows.column("part")[0].as_py(), table, rows.column("total")[0].as_py())])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters (words are maximal runs of ``[^\\x20\\x09-\\x0D]``): A fewer than 200 words; B fewer than half of
    the words distinct; C over 3 % ASCII capitals; D any of ``#$%&*|``; E the text of a smaller id.  Null and
    empty texts have no words and fail A alone (and E).  Every row is a document: repeated rows count each
    time, and none of them is an earlier copy of the other.  An empty table gives no rows.  Only the named
    columns are read; others may have any name.

    The text is scanned once and gives an id, two hashes and a mask; these are what is shuffled.  A part comes
    to one task as 32 rows.
    """
    table = coalition_removals(failures(docs, key, text, part), labels, key)
    return table.groupBy("part").applyInArrow(_audit_part, _STEPS)
