"""Language ID by hierarchical discrimination: the language family first, then the language within it.

Features are hashed counts of one to three adjacent bytes of the lower-cased text in which every
ASCII character other than a letter is a blank, as square roots of shares (so each text has length
one).  A linear support vector machine for each family tells it from the others; within a family
one machine for each pair of languages separates the two, and the language that wins most of its
duels is taken.
"""

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm.common import cut

#: Closely related languages; a language that is not listed is a family of its own.
FAMILIES = {
    "af": "germanic", "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic", "nl": "germanic",
    "no": "germanic", "sv": "germanic", "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance",
    "it": "romance", "pt": "romance", "ro": "romance", "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic",
    "pl": "slavic", "ru": "slavic", "sk": "slavic", "sl": "slavic", "sr": "slavic", "uk": "slavic",
}
UNDETERMINED = "und"
DIMENSIONS = 4096
#: Most labelled texts that are used for training, and most for one language.
SAMPLE, PER_LANGUAGE = 2000, 500

_LETTER = regex.compile(r"\p{L}")
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_CHUNK = 1 << 20


def features(text: str) -> np.ndarray:
    """The vector of a whole text."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace").translate(_TABLE), np.uint8)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data), _CHUNK):
        one = data[at:at + _CHUNK + 2].astype(np.uint32)
        new = len(one) if at + _CHUNK + 2 >= len(data) else _CHUNK
        two = one[:-1] << 8 | one[1:]
        three = two[:-1] << 8 | one[2:]
        for size, gram in ((1, one), (2, two), (3, three)):
            slot = ((gram[:new] * np.uint32(4) + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(slot, minlength=DIMENSIONS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 300, penalty: float = 1e-4) -> np.ndarray:
    """A linear support vector machine (weights, bias last): subgradient steps on the hinge loss, both
    sides weighing the same, averaged over the second half."""
    side = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, mean = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        # products in the vectors' own 32 bits, so that no wider copy of them is made
        wrong = y * (x @ w[:-1].astype(np.float32) + w[-1]) < 1
        pull = side * y * wrong
        w -= 20 / np.sqrt(t) * (penalty * w - np.append(pull.astype(np.float32) @ x, pull.sum()))
        if 2 * t > steps:
            mean += w
    return (mean / (steps - steps // 2)).astype(np.float32)


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -10, 10)))


class Model:
    """Machines for families and for pairs of languages."""

    def __init__(self, langs: list[str], x: np.ndarray, families: dict[str, str]):
        self.langs = sorted(set(langs))
        own = np.array(langs)
        kin = np.array([families.get(a, a) for a in langs])
        self.families = {f: [a for a in self.langs if families.get(a, a) == f] for f in sorted(set(kin))}
        many = len(self.families) > 1
        self.family = np.array([_machine(x, np.where(kin == f, 1, -1)) for f in self.families]) if many else None
        self.pairs = {}
        for members in self.families.values():
            for a, b in combinations(members, 2):
                rows = np.flatnonzero((own == a) | (own == b))
                self.pairs[a, b] = _machine(x[rows] if len(rows) < len(x) else x, np.where(own[rows] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row: the chance that the best family's machine gives times the mean
        chance of the winner's duels.  The number of families does not enter, so a floor means the same for any."""
        one, n = np.hstack([x, np.ones((len(x), 1), np.float32)]), len(x)
        by_family = np.ones((n, 1)) if self.family is None else _chance(one @ self.family.T)
        best = by_family.argmax(axis=1)
        out, score = np.empty(n, object), np.zeros(n)
        for k, members in enumerate(self.families.values()):
            rows = np.flatnonzero(best == k)
            wins, chance = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                p = _chance(one[rows] @ self.pairs[a, b])
                wins[:, i] += p >= 0.5
                wins[:, j] += p < 0.5
                chance[:, i] += p
                chance[:, j] += 1 - p
            top = np.lexsort((chance, wins), axis=1)[:, -1] if len(members) > 1 else np.zeros(len(rows), int)
            duels = chance[np.arange(len(rows)), top] / (len(members) - 1) if len(members) > 1 else 1.0
            out[rows] = np.array(members, object)[top]
            score[rows] = by_family[rows, k] * duels
        return out, score


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", *,
          families: dict[str, str] = FAMILIES, sample: int = SAMPLE, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from rows with text and language; None if there is no row to learn from.

    The machines are fitted on a bounded sample: of each language the rows with the smallest hash of
    ``key``, ``per_language`` at most, and ``sample`` (or one for each language) in all.  Texts are
    turned into vectors on the executors; the driver gets these alone.  Rows without language, or
    whose text has no letter, are passed over, and repeated rows count once.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Rows by language and the ten leading bits of their key's hash: tells below which hash a language's sample lies.
    bits = F.shiftright(F.xxhash64("k"), 54)
    counted = cut(rows.groupBy("lang", bits.alias("bits")).agg(F.count(F.lit(1)).alias("n")))
    n_langs = counted.select("lang").distinct().count()
    if not n_langs:
        return None
    most = max(1, min(per_language, sample // n_langs))
    upto = Window.partitionBy("lang").orderBy("bits").rowsBetween(Window.unboundedPreceding, -1)
    last = counted.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("before") < most)
    last = last.groupBy("lang").agg(F.max("bits").alias("last"))
    # what is ranked is the sample and the rows of one value of the bits, whatever the corpus
    near = rows.withColumn("bits", bits).join(F.broadcast(last), "lang").where(F.col("bits") <= F.col("last"))
    near = near.select("lang", "k", F.xxhash64("text").alias("h")).distinct()
    # a key may have any number of texts: these are ranked in groups first
    order = [F.xxhash64("k"), "k", "h"]
    for part in (("lang", F.pmod("h", F.lit(256))), ("lang",)):
        near = near.withColumn("n", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("n") <= most).drop("n")
    chosen = F.broadcast(cut(near).select(*[F.col(c).alias(f"{c}2") for c in ("lang", "k", "h")]))

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("k"), pa.array(x, pa.binary())], ["lang", "k", "x"])

    kind = rows.schema["k"].dataType.simpleString()
    sampled = rows.withColumn("h", F.xxhash64("text")).join(chosen, F.col("k").eqNullSafe(F.col("k2")) & (F.col("lang") == F.col("lang2")) & (F.col("h") == F.col("h2")))
    made = sampled.select("lang", "k", "text").mapInArrow(vectors, f"lang string, k {kind}, x binary").dropDuplicates(["lang", "k", "x"])
    got = made.toArrow().sort_by([(c, "ascending") for c in ("lang", "k", "x")])
    langs, x = got.column("lang").to_pylist(), np.empty((got.num_rows, DIMENSIONS), np.float32)
    for i, row in enumerate(got.column("x")):
        x[i] = np.frombuffer(row.as_buffer(), np.float32)
    del got  # the driver holds the vectors once
    return Model(langs, x, families)


def predict(docs: DataFrame, model: Model | None, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with ``into``: struct of ``lang_pred`` and ``score`` (0 to 1) of the whole text.

    Only the text is looked at.  Null texts, texts without a letter, and all texts if there is no
    model, get ``und`` and 0.  Rows are judged one by one, so repeats and ties do not matter; a column
    named like ``into`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def judge(texts: pa.Array) -> pa.Array:
        known = shared.value
        langs, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        for at in range(0, len(texts) if known else 0, 256):
            block = texts[at:at + 256].to_pylist()
            rows = [i for i, t in enumerate(block) if t and _LETTER.search(t)]
            if rows:
                where = at + np.array(rows)
                langs[where], scores[where] = known.predict(np.array([features(block[i]) for i in rows]))
        return pa.StructArray.from_arrays([pa.array(langs.tolist(), pa.string()), pa.array(np.clip(scores, 0, 1))], ["lang_pred", "score"])

    return docs.withColumn(into, judge(F.col(text)))
