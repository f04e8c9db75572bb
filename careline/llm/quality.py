"""Quality rules with risk-controlled thresholds.

Rules compare a measure of the text with a cutoff.  Cutoffs come from a labelled holdout: for each
stratum and rule the strictest one of a fixed ladder for which an exact binomial test shows that it
rejects at most a given share of good documents.  The ladder is walked from its laxest step and left
at the first test that fails, so a ladder as a whole errs with its own level (fixed-sequence
testing), and the level is divided among all strata and rules (Bonferroni).  With probability
``1 - delta`` no stratum loses more than ``alpha`` of its good documents, all its rules together.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.llm.common import BLANKS, cut, let, words

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
ALPHA, DELTA = 0.05, 0.05
#: Measures (whole numbers) and their ladders, lax to strict; a document is rejected above the cutoff.
LADDERS = {
    "symbols": [1000, 700, 500, 400, 300, 250, 200, 160, 130, 100, 80, 60, 50, 40, 30, 25, 20, 15, 10],
    "dup_lines": [900, 800, 700, 600, 500, 450, 400, 350, 300, 250, 200, 150, 120, 100, 80, 60, 50, 40, 30],
    "repeats": [290, 280, 270, 260, 250, 240, 230, 220, 200, 180, 160, 140, 120, 100, 80, 60, 50, 40, 30],
    "long_words": [2000, 1500, 1200, 1000, 900, 800, 700, 650, 600, 550, 500, 480, 460, 440, 420, 400, 380, 360, 340],
}


def _repeated(hashes: Column) -> Column:
    """Words in windows whose hash comes twice or more: windows in order of hash have an equal neighbour."""
    def positions(rows: Column) -> Column:
        equal = F.filter(rows, lambda r, i: (F.get(rows, i - 1)["h"] == r["h"]) | (F.get(rows, i + 1)["h"] == r["h"]))
        return F.sort_array(F.transform(equal, lambda r: r["i"]))

    rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    state = F.aggregate(let(rows, positions), F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("last")), lambda s, i: F.struct(
        (s["n"] + F.least(F.lit(REPEAT_WINDOW), i - s["last"])).alias("n"), i.alias("last")))
    return state["n"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base counts (bigint): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, word_chars their code points, n_symbols the
    characters of ``#*$%&|<>``.  Of the lines (cut at line feeds) that have a word, n_lines is the
    number, and n_dup_lines the number of those equal to an earlier one.  n_repeat_words counts the
    words in windows of eight that come twice or more in the text, the first time included; windows
    are told apart by 64 bits of hash.  Null and empty texts have 0 everywhere.  Columns of these
    names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    found = docs.withColumns({"__words": words(F.col(text)), "__lines": lines}).withColumns({
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.char_length(F.translate(body, BLANKS, "")).cast("bigint"),
        "n_symbols": (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size("__lines").cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "__hashes": F.when(F.size("__words") >= REPEAT_WINDOW, let(F.col("__words"), lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w) - REPEAT_WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, REPEAT_WINDOW))))),
    })
    some = F.size("__hashes") > F.size(F.array_distinct("__hashes"))
    return found.withColumn("n_repeat_words", F.when(some, _repeated(F.col("__hashes"))).otherwise(0).cast("bigint")).drop(
        "__words", "__lines", "__hashes")


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _per_mille(part: str, whole: str, times: int = 1000) -> Column:
    return F.when(F.col(whole) > 0, F.floor(times * F.col(part) / F.col(whole))).otherwise(0).cast("bigint")


def measures() -> dict[str, Column]:
    """Measures of the ladders, rounded down: per mille, and hundredths of a character for word length."""
    return {"symbols": _per_mille("n_symbols", "word_chars"), "dup_lines": _per_mille("n_dup_lines", "n_lines"),
            "repeats": _per_mille("n_repeat_words", "n_words"), "long_words": _per_mille("word_chars", "n_words", 100)}


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of n draws with chance p, term by term; 1 where k > n * p (it is 1/2 at least there)."""
    odds = math.log(p / (1 - p))
    first = n * math.log1p(-p)

    def add(s: Column, i: Column) -> Column:
        term = s["t"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("t"), (s["p"] + F.exp(term)).alias("p"))

    start = F.struct(first.alias("t"), F.exp(first).alias("p"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.aggregate(terms, start, add)["p"])


def cutoffs(holdout: DataFrame, stratum: str, good: str, *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) from labelled rows with base counts; the cutoff is null if no step passes.

    Good rows that the base rules keep are what a cutoff may wrongly reject.  The holdout is summed up
    in one pass, with partial sums before the shuffle; what follows has a row for each stratum, rule
    and step.
    """
    counts = {(rule, i): F.count(F.when(value > step, 1)) for (rule, value) in measures().items() for i, step in enumerate(LADDERS[rule])}
    ladder = lambda rule: F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(step).cast("bigint").alias("cutoff"), F.col(f"__{rule}_{i}").alias("k")) for i, step in enumerate(LADDERS[rule])])
    summed = holdout.where(F.col(good) & ~base_failed()).groupBy(F.col(stratum).alias("stratum")).agg(
        F.count("*").alias("n"), *[c.alias(f"__{rule}_{i}") for (rule, i), c in counts.items()])
    summed = cut(summed.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), ladder(rule).alias("steps")) for rule in LADDERS])).alias("r")).select("stratum", "n", "r.*"))
    level = delta / max(1, summed.count())  # as many tests as strata times rules
    passes = F.transform("steps", lambda s: binomial_tail(s["k"], F.col("n"), alpha / len(LADDERS)) <= level)
    lead = let(passes, lambda p: F.coalesce(F.nullif(F.array_position(p, False), F.lit(0)) - 1, F.size(p).cast("bigint")))
    return summed.select("stratum", "rule", F.get("steps", lead.cast("int") - 1)["cutoff"].alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
          label: str = "quality", *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """For each row of ``docs``: id, base counts, ``base_failed``, ``kept`` and the measures.

    ``labels`` has ids and ``label`` (1: good).  A document with several labels is good if one of them
    is 1; labels without id, null labels and labels of unknown documents are passed over.  Strata are
    the values of ``stratum``, null being one; a stratum without enough good labels has no cutoffs and
    loses no document but by the base rules.  Repeated rows are judged alike, other columns left out.

    The text is read once; what is joined afterwards are counts.  Cutoffs are summed to one row for
    each stratum, which Spark broadcasts if that table is small and joins by sorting if not.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__stratum"),
                       F.col(text).alias("__text"))
    counted = cut(measure(rows, "__text").drop("__text"))
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__lid")).agg(F.max(label).alias("__label"))
    holdout = counted.join(good, F.col("__id") == F.col("__lid")).withColumn("__good", F.coalesce(F.col("__label") == 1, F.lit(False)))
    found = cutoffs(holdout, "__stratum", "__good", alpha=alpha, delta=delta)
    wide = found.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__cut_{r}") for r in LADDERS])
    named = counted.withColumns(measures()).withColumn("base_failed", base_failed())
    rejected = [F.coalesce(F.col(r) > F.col(f"__cut_{r}"), F.lit(False)) for r in LADDERS]
    verdict = ~F.col("base_failed")
    for r in rejected:
        verdict = verdict & ~r
    return named.join(wide, F.col("__stratum") == F.col("stratum"), "left").withColumn("kept", verdict).select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *LADDERS)
