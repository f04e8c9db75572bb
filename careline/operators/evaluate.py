"""Field-by-field comparison of two extractions and its summaries.

A field ``x`` is compared with ``heu_x`` and gives the flag ``acertou_x``.  All
summaries are one aggregate over the table followed by an unpivot of one row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from careline import fixed_values as V
from careline.functions.answers import number_or_zero, sorted_set
from careline.functions.markers import (
    has_percent_range,
    mention_scan,
    scanned_context,
    scanned_count,
)
from careline.functions.pathology import LOWERED, with_lowered

HIT = "acertou_"
GOLD = "heu_"


def compare_numeric(a: Column, b: Column) -> Column:
    """Two texts equal as numbers, unreadable ones counting as 0.0."""
    return number_or_zero(a) == number_or_zero(b)


def _compare(df: DataFrame, field: str, rule: str) -> Column:
    model, gold = F.col(field), F.col(GOLD + field)
    kind, gold_kind = df.schema[field].dataType, df.schema[GOLD + field].dataType
    if isinstance(kind, ArrayType):
        if rule == "strict":
            return sorted_set(F.array_distinct(model)) == sorted_set(F.array_distinct(gold))
        return sorted_set(model) == sorted_set(gold)
    numeric = isinstance(kind, NumericType)
    if numeric != isinstance(gold_kind, NumericType):
        return F.lit(False)
    if rule == "strict":
        if numeric:
            return model.eqNullSafe(gold)
        stated = F.lit(V.NOT_STATED)
        return F.coalesce(model, stated) == F.coalesce(gold, stated)
    if rule == "null_hit":
        return (model == gold) | (model.isNull() & gold.isNull()) if numeric else model == gold
    if rule == "null_miss":
        missing = model.isNull() | gold.isNull()
        if not numeric:
            missing = missing | (model == V.NOT_STATED)
        return F.when(missing, False).otherwise(model == gold)
    if rule == "sentinel":
        return model == gold
    raise ValueError(f"unknown comparison rule: {rule}")


def _as_number(df: DataFrame, name: str) -> Column:
    """A column as a double with 0.0 for what is none."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return number_or_zero(F.col(name))


def compare(df: DataFrame, fields: Sequence[str], rule: str = "strict",
            numeric: Sequence[str] = ()) -> DataFrame:
    """Add one flag per field.

    strict: equal values of equal type, missing text counts as the sentinel, lists
    are sets.  null_hit: both NULL is a hit for numbers; one NULL gives NULL, as
    does any NULL text.  null_miss: any NULL, or a sentinel text, is a miss.
    sentinel: plain equality of sentinel-filled text.  ``numeric`` fields are
    compared as numbers under every rule.
    """
    return df.withColumns({
        HIT + f: _as_number(df, f) == _as_number(df, GOLD + f) if f in numeric
        else _compare(df, f, rule)
        for f in fields
    })


def _fields(df: DataFrame, fields: Sequence[str] | None) -> list[str]:
    """Given fields, or every field that has a flag."""
    if fields is not None:
        return list(fields)
    return [c[len(HIT):] for c in df.columns if c.startswith(HIT)]


def _unpivot(row: DataFrame, names: Sequence[str], columns: Sequence[str],
             label: str = "campo") -> DataFrame:
    """One row with ``<i>_<column>`` cells to one row per name."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias(label), *[F.col(f"{i}_{c}").alias(c) for c in columns])
        for i, name in enumerate(names)
    ])).alias("r")).select("r.*")


def accuracy(df: DataFrame, fields: Sequence[str] | None = None,
             rate: str = "share") -> DataFrame:
    """Hits, total and rate per field; a rate over no rows is 0.0.

    ``share`` is hits over all rows; ``mean`` averages the flag and so leaves rows
    with a NULL flag out of the rate.
    """
    names = _fields(df, fields)
    aggs = []
    for i, name in enumerate(names):
        flag = F.col(HIT + name).cast("int")
        hits = F.coalesce(F.sum(flag), F.lit(0)).cast("long")
        total = F.count(F.lit(1))
        base = total if rate == "share" else F.count(flag)
        aggs += [
            hits.alias(f"{i}_acertos"), total.alias(f"{i}_total"),
            F.when(base > 0, hits / base).otherwise(F.lit(0.0)).alias(f"{i}_taxa_acerto"),
        ]
    return _unpivot(df.agg(*aggs), names, ("acertos", "total", "taxa_acerto"))


def verdict(acc: DataFrame, threshold: float = V.ACCEPTANCE_RATE) -> DataFrame:
    """Add 1 for fields at or above the accepted rate, else 0."""
    return acc.withColumn(
        "passou_threshold", F.when(F.col("taxa_acerto") >= threshold, 1).otherwise(0)
    )


def error_summary(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Misses per field, their percentage of all rows, and a total of both."""
    names = _fields(df, fields)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(~F.col(HIT + name)).alias(f"{i}_erros") for i, name in enumerate(names)
    ])
    row = row.withColumns({
        f"{i}_percentual": F.when(F.col("n") > 0, F.col(f"{i}_erros") / F.col("n") * 100)
        .otherwise(F.lit(0.0)) for i in range(len(names))
    })
    last = len(names)
    row = row.withColumns({
        f"{last}_{c}": sum((F.col(f"{i}_{c}") for i in range(last)), F.lit(0))
        for c in ("erros", "percentual")
    })
    return _unpivot(row, [*names, "Total"], ("erros", "percentual"))


#: Size of a quantile sketch; a quartile's rank is then off by about 1 % of the rows.
SKETCH_K, RANK_ERROR = 400, 0.02
QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


def describe_state(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What ``describe_from`` needs, per group of ``by`` (a day, say) and column, in one aggregate.

    Count, sum, sum of squares about the group's mean, ends, and a quantile sketch of a few
    kilobytes whatever the number of rows.  States are merged in any order.
    """
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(c).cast("double")
        aggs += [F.count(value).alias(f"{i}_n"), F.sum(value).alias(f"{i}_soma"), (F.var_pop(value) * F.count(value)).alias(f"{i}_desvios"),
                 F.min(value).alias(f"{i}_minimo"), F.max(value).alias(f"{i}_maximo"),
                 # a sketch of no value stays out
                 F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, F.lit(SKETCH_K))).alias(f"{i}_esboco")]
    cells = ("n", "soma", "desvios", "minimo", "maximo", "esboco")
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("coluna"), *[F.col(f"{i}_{c}").alias(c) for c in cells]) for i, name in enumerate(cols)]))
    return df.groupBy(*by).agg(*aggs).select(*by, rows.alias("r")).select(*by, "r.*")


def describe_from(states: DataFrame) -> DataFrame:
    """Count, mean, deviation, ends and quartiles per column, from states of ``describe_state``.

    Quartiles are values of the data whose rank is within ``RANK_ERROR`` of the number of rows; up to
    ``SKETCH_K`` rows they are exact.  A column without values has NULLs.
    """
    whole = states.groupBy("coluna").agg((F.sum("soma") / F.nullif(F.sum("n"), F.lit(0))).alias("media"))
    n = F.sum("n")
    # squares about a state's mean, and of its mean about the mean of all
    squares = F.sum(F.when(F.col("n") > 0, F.col("desvios") + F.col("n") * F.pow(F.col("soma") / F.col("n") - F.col("media"), 2)))
    merged = states.join(whole, "coluna").groupBy("coluna").agg(
        n.alias("n"), F.first("media").alias("media"), F.when(n > 1, F.sqrt(squares / (n - 1))).alias("desvio"),
        F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"),
        F.when(n > 0, F.kll_merge_agg_double("esboco", F.lit(SKETCH_K))).alias("_esboco"))
    quartiles = {name: F.when(F.col("_esboco").isNotNull(), F.kll_sketch_get_quantile_double("_esboco", F.lit(rank))) for name, rank in QUARTILES.items()}
    return merged.withColumns(quartiles).drop("_esboco")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column."""
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(c).cast("double")
        aggs += [F.count(value).alias(f"{i}_n"), F.avg(value).alias(f"{i}_media"),
                 F.stddev(value).alias(f"{i}_desvio"), F.min(value).alias(f"{i}_minimo"),
                 F.max(value).alias(f"{i}_maximo")]
    return _unpivot(df.agg(*aggs), cols, ("n", "media", "desvio", "minimo", "maximo"), "coluna")


def any_error(df: DataFrame, fields: Sequence[str] | None = None, out: str = "erro") -> DataFrame:
    """Add the OR of "not hit"; a missing flag or flag column counts as an error."""
    flag = F.lit(False)
    for name in _fields(df, fields):
        hit = F.coalesce(F.col(HIT + name), F.lit(False)) if HIT + name in df.columns else F.lit(False)
        flag = flag | ~hit
    return df.withColumn(out, flag)


SCAN = "_mencoes"


def with_scan(df: DataFrame, text: str = "laudo_tratado", patterns=V.MARKERS) -> DataFrame:
    """Add the report's mentions; they are exploded from a one-element array, which keeps what
    uses them above the search: it runs once per report.  What is exploded shares nothing, so the
    lower-cased text is a column below it."""
    added = [c for c in LOWERED if c not in df.columns]
    df, low = with_lowered(df, text)
    return df.withColumn(SCAN, F.explode(F.array(mention_scan(F.col(text), patterns, low=low)))).drop(*added)


def marker_counts(df: DataFrame, text: str = "laudo_tratado", patterns=V.MARKERS_LOOSE,
                  prefix: str = "ctg_") -> DataFrame:
    """Add one mention count per marker."""
    scanned = with_scan(df, text, patterns)
    return scanned.withColumns({prefix + m: scanned_count(F.col(SCAN), m) for m in patterns}).drop(SCAN)


def with_mentions(df: DataFrame, markers: Sequence[str] = tuple(V.MARKERS),
                  text: str = "laudo_tratado") -> DataFrame:
    """Add a mention count and the first mention's context per marker, from one search of the report."""
    scan, scanned = F.col(SCAN), with_scan(df, text, {m: V.MARKERS[m] for m in markers})
    counts = {f"ctg_{m}": scanned_count(scan, m) for m in markers}
    return scanned.withColumns(counts | {f"txt_{m}": scanned_context(scan, m) for m in markers}).drop(SCAN)


def validation_sheet(df: DataFrame, markers: Sequence[str] = tuple(V.MARKERS),
                     fields: Sequence[str] = V.IHC_FIELDS, text: str = "laudo_tratado") -> DataFrame:
    """Compared rows plus mention counts, mention contexts and the error flag.

    Mentions that the rows already carry (``with_mentions`` on the reports) are used.
    """
    missing = [m for m in markers if f"ctg_{m}" not in df.columns]
    return any_error(with_mentions(df, missing, text) if missing else df, fields)


# Marker and the status words a validator looks for near it.
_PHRASE = {"estrogenio": "positivo|negativo", "progesterona": "positivo|negativo",
           "ck5_6": "positivo|negativo"}


def inconsistencies(df: DataFrame, text: str = "laudo_tratado") -> DataFrame:
    """Add one flag per class of wording that misleads an extraction, from one search of the report."""
    scan = F.col(SCAN)
    # Counts and contexts are columns of their own, so each is taken from the scan once.
    found = {f"_n_{m}": scanned_count(scan, m) for m in V.MARKERS}
    found |= {f"_txt_{m}": scanned_context(scan, m) for m in V.MARKERS}
    flags = {f"varios_{m}": F.col(f"_n_{m}") > 1 for m in V.MARKERS}
    for m in ("estrogenio", "progesterona"):
        phrase = F.lower(F.regexp_extract(F.col(f"_txt_{m}"), r"^[^.\n]*", 0))
        flags[f"ambos_{m}"] = F.contains(phrase, F.lit("positivo")) & F.contains(phrase, F.lit("negativo"))
    for m in _PHRASE:
        flags[f"sem_status_{m}"] = (F.col(f"_n_{m}") > 0) & ~F.lower(F.col(f"_txt_{m}")).rlike(_PHRASE[m])
    flags["faixa_ki67"] = has_percent_range(F.col("_txt_ki67"))
    scanned = with_scan(df, text).withColumns(found)
    return scanned.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}).drop(SCAN, *found)


def inconsistency_profile(df: DataFrame, text: str = "laudo_tratado") -> DataFrame:
    """Reports per class of misleading wording, and their share."""
    flagged = inconsistencies(df, text)
    names = [c for c in flagged.columns if c not in df.columns]
    row = flagged.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col(name)).alias(f"{i}_laudos") for i, name in enumerate(names)
    ]).withColumns({
        f"{i}_fracao": F.when(F.col("n") > 0, F.col(f"{i}_laudos") / F.col("n")).otherwise(F.lit(0.0))
        for i in range(len(names))
    })
    return _unpivot(row, names, ("laudos", "fracao"), "classe")
