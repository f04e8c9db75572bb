"""Comparison rules, rates, summaries and validation sheets."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators import evaluate as E
from careline.plans.ihc import ihc_comparison, ihc_gold, ihc_subtypes
from careline.operators import typed as T
from careline.plans.pathology import pathology_labels, pathology_typed
from workloads import fixtures as X
from workloads import sqlanswers as Q
from workloads import sqltext as S
from workloads.registry import register

FLAGS = [f"acertou_{f}" for f in V.PATHOLOGY_FIELDS]
IHC_FLAGS = [f"acertou_{f}" for f in V.IHC_FIELDS]


def _pathology(spark, sf, rule):
    return pathology_labels(X.reports(spark, sf, brand=False), X.answers(spark, sf, "pathology"), rule)


def _ihc(spark, sf, sheet=False):
    gold = ihc_gold(X.reports(spark, sf, brand=False), sheet=sheet)
    labelled = ihc_subtypes(gold, X.answers(spark, sf, "ihc"))
    return ihc_comparison(labelled)


for _rule in ("strict", "null_hit", "null_miss", "sentinel"):
    @register(f"compare_{_rule}", f"SELECT ficha, id_item, {', '.join(FLAGS)} FROM {Q.pathology_compared(_rule)}")
    def compare_rule(spark, sf, rule=_rule):
        return _pathology(spark, sf, rule).select("ficha", "id_item", *FLAGS)

    @register(f"accuracy_{_rule}", Q.accuracy(Q.pathology_compared(_rule), V.PATHOLOGY_FIELDS))
    def accuracy_rule(spark, sf, rule=_rule):
        return E.accuracy(_pathology(spark, sf, rule), V.PATHOLOGY_FIELDS)


@register("accuracy_by_mean", Q.accuracy(Q.pathology_compared("null_hit"), V.PATHOLOGY_FIELDS, mean=True))
def accuracy_by_mean(spark, sf):
    return E.accuracy(_pathology(spark, sf, "null_hit"), V.PATHOLOGY_FIELDS, rate="mean")


def _typed(spark, sf):
    text = F.expr(Q.NUMBERED.format(c="resposta_llm", one="$1", all=""))
    return X.answers(spark, sf, "pathology").withColumn("resposta_llm", text)


@register("compare_typed", f"SELECT ficha, id_item, {', '.join(FLAGS)} FROM {Q.typed_compared()}")
def compare_typed(spark, sf):
    """A number is not its text, and null is not missing."""
    return pathology_typed(X.reports(spark, sf, brand=False), _typed(spark, sf)).select("ficha", "id_item", *FLAGS)


@register("accuracy_typed", Q.accuracy(Q.typed_compared(), V.PATHOLOGY_FIELDS))
def accuracy_typed(spark, sf):
    return E.accuracy(pathology_typed(X.reports(spark, sf, brand=False), _typed(spark, sf)), V.PATHOLOGY_FIELDS)


@register("answer_type_profile", "SELECT campo, tipo, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS campo, {Q.json_kind(f)} AS tipo FROM {Q.numbered()}" for f in V.PATHOLOGY_FIELDS) + ") GROUP BY ALL")
def answer_type_profile(spark, sf):
    return T.answer_type_profile(T.with_variant(_typed(spark, sf)), V.PATHOLOGY_FIELDS)


@register("compare_ihc", f"SELECT ficha, id_item, {', '.join(IHC_FLAGS)} FROM {Q.ihc_compared()}")
def compare_ihc(spark, sf):
    return _ihc(spark, sf).select("ficha", "id_item", *IHC_FLAGS)


@register("accuracy_any_fields", Q.accuracy(Q.ihc_compared(), V.IHC_FIELDS))
def accuracy_any_fields(spark, sf):
    """Fields are taken from the flags present."""
    return E.accuracy(_ihc(spark, sf))


@register("accuracy_verdict", "SELECT *, CASE WHEN taxa_acerto >= 0.8 THEN 1 ELSE 0 END AS passou_threshold FROM ("
          + Q.accuracy(Q.ihc_compared(), V.IHC_FIELDS) + ")")
def accuracy_verdict(spark, sf):
    return E.verdict(E.accuracy(_ihc(spark, sf), V.IHC_FIELDS))


def _summary_sql(table, fields):
    counts = ", ".join(f"count(*) FILTER (WHERE NOT acertou_{f}) AS e{i}" for i, f in enumerate(fields))
    rows = [f"SELECT '{f}' AS campo, e{i} AS erros, round(e{i} / n * 100, 6) AS percentual FROM s"
            for i, f in enumerate(fields)]
    total = " + ".join(f"e{i}" for i in range(len(fields)))
    rows.append(f"SELECT 'Total', {total}, round(({total}) / n * 100, 6) FROM s")
    return f"WITH s AS (SELECT count(*) AS n, {counts} FROM {table}) " + " UNION ALL ".join(rows)


@register("error_summary", _summary_sql(Q.ihc_compared(), V.IHC_FIELDS))
def error_summary(spark, sf):
    return E.error_summary(_ihc(spark, sf), V.IHC_FIELDS).withColumn("percentual", F.round("percentual", 6))


@register("any_error", "SELECT ficha, id_item, NOT (" + " AND ".join(
    f"coalesce({f}, false)" for f in IHC_FLAGS) + f") AS erro FROM {Q.ihc_compared()}")
def any_error(spark, sf):
    return E.any_error(_ihc(spark, sf), V.IHC_FIELDS).select("ficha", "id_item", "erro")


@register("validation_sheet", "SELECT ficha, id_item, " + ", ".join(
    [*IHC_FLAGS, *[f"{S.count(p)} AS ctg_{m}" for m, p in V.MARKERS.items()],
     *[f"{S.context(m)} AS txt_{m}" for m in V.MARKERS],
     "NOT (" + " AND ".join(f"coalesce({f}, false)" for f in IHC_FLAGS) + ") AS erro"])
    + f" FROM {Q.ihc_compared()}")
def validation_sheet(spark, sf):
    df = E.validation_sheet(_ihc(spark, sf, sheet=True))
    added = [f"{p}_{m}" for p in ("ctg", "txt") for m in V.MARKERS]
    return df.select("ficha", "id_item", *IHC_FLAGS, *added, "erro")


# -- two raters over the labelled documents -----------------------------------

def _raters(spark, sf):
    df = X.table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("nota"), F.col("toxic").alias("heu_nota"))
    return E.compare(df, ["nota"], "null_hit")


_RATERS = "(SELECT doc_id, (quality = toxic) OR (quality IS NULL AND toxic IS NULL) AS acertou_nota FROM labels)"


@register("rater_agreement", Q.accuracy(_RATERS, ["nota"]))
def rater_agreement(spark, sf):
    return E.accuracy(_raters(spark, sf), ["nota"])


@register("rater_errors", _summary_sql(_RATERS, ["nota"]))
def rater_errors(spark, sf):
    return E.error_summary(_raters(spark, sf)).withColumn("percentual", F.round("percentual", 6))


@register("compare_numeric", """
    SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)
      = coalesce(TRY_CAST(CASE WHEN event_type = 'click' THEN 'NÃO INFORMADO' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE), 0.0) AS igual
    FROM events""")
def compare_numeric(spark, sf):
    k = F.get_json_object("props", "$.k")
    other = F.when(F.col("event_type") == "click", V.NOT_STATED).otherwise(F.col("user_id").cast("string"))
    return X.table(spark, sf, "events").select("event_id", E.compare_numeric(k, other).alias("igual"))


# -- wording that misleads an extraction ---------------------------------------

def _profile_flags():
    flags = {f"varios_{m}": f"{S.count(p)} > 1" for m, p in V.MARKERS.items()}
    for m in ("estrogenio", "progesterona"):
        phrase = rf"lower(regexp_extract({S.context(m)}, '^[^.\n]*'))"
        flags[f"ambos_{m}"] = f"contains({phrase}, 'positivo') AND contains({phrase}, 'negativo')"
    for m in ("estrogenio", "progesterona", "ck5_6"):
        flags[f"sem_status_{m}"] = (f"{S.count(V.MARKERS[m])} > 0 AND NOT regexp_matches(lower({S.context(m)}), "
                                    "'positivo|negativo')")
    flags["faixa_ki67"] = (r"coalesce(regexp_extract(" + S.context("ki67")
                           + r", '(?i)(\d{1,3}(?:[.,]\d+)?)(?:\s*(?:-|–|a|até)\s*(\d{1,3}(?:[.,]\d+)?))?\s*%', 2) <> '', false)")
    return flags


@register("inconsistency_profile", "WITH f AS (SELECT " + ", ".join(
    f"{s} AS {k}" for k, s in _profile_flags().items()) + " FROM reports) " + " UNION ALL ".join(
    f"SELECT '{k}' AS classe, count(*) FILTER (WHERE {k}) AS laudos, count(*) FILTER (WHERE {k}) / count(*) AS fracao FROM f"
    for k in _profile_flags()))
def inconsistency_profile(spark, sf):
    return E.inconsistency_profile(X.reports(spark, sf, brand=False))


@register("inconsistency_flags", "SELECT ficha, id_item, " + ", ".join(
    f"{s} AS {k}" for k, s in _profile_flags().items()) + " FROM reports")
def inconsistency_flags(spark, sf):
    df = E.inconsistencies(X.reports(spark, sf, brand=False))
    return df.select("ficha", "id_item", *_profile_flags())
