"""Whole stages for both groups."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators.evaluate import validation_sheet
from careline.operators.tables import read_table, save
from careline.plans.biopsy import biopsy_flags
from careline.plans.ihc import ihc_comparison, ihc_gold, ihc_reports, ihc_subtypes
from careline.plans.imaging import activation_list, history
from careline.plans.pathology import pathology_labels, pathology_reports
from careline.session import scratch_path
from careline.sources import read_returns
from workloads import fixtures as X
from workloads import sqlanswers as Q
from workloads import sqltext as S
from workloads.q_cohort import AGE, AS_OF, BRANDS, as_of
from workloads.q_scan import text
from workloads.registry import register

P4 = V.REPORT_KEYS["P"]
_DUE = "CASE WHEN BIRADS IN (1, 2) THEN r.dth_pedido + 360 WHEN BIRADS = 3 THEN r.dth_pedido + 180 END"
_JOIN = """LEFT JOIN returns e ON e.ficha_origem = r.ficha AND e.id_cliente = r.id_cliente
    AND e.linha_cuidado = r.linha_cuidado"""
_CODES = {g: "r.sigla_exame IN (" + ", ".join(f"'{c}'" for c in V.EXAM_CODES["mammogram"][g]) + ")"
          for g in "FP"}
_PLAN_COLUMNS = ("MIN_BIRADS", "MAX_BIRADS", "BIRADS", "retorno_cliente")


def _rows(group, section="reference"):
    """Reports with categories, the return visit and the plan columns."""
    cats = S.categories(group=group, section=section)
    female = "AND upper(sexo_cliente) = 'F'" if group == "P" else ""
    return f"""SELECT r.*, e.ficha AS ficha_retorno_elegivel, CAST(CAST(e.dth_pedido AS TIMESTAMP) AS VARCHAR) AS
      dth_pedido_retorno_elegivel, e.dias_entre_ficha AS dias_entre_ficha_elegivel,
      CASE WHEN BIRADS IN (1, 2) THEN 12 WHEN BIRADS = 3 THEN 6 ELSE 0 END AS retorno_cliente,
      CAST(CAST({_DUE} AS TIMESTAMP) AS VARCHAR) AS dth_previsao_retorno,
      CAST(CAST({_DUE} AS DATE) - r.dth_pedido AS INT) AS dias_ate_retorno
      FROM (SELECT *, list_min({cats}) AS MIN_BIRADS, list_max({cats}) AS MAX_BIRADS, ({cats})[-1] AS BIRADS
        FROM reports) r {_JOIN} WHERE r.linha_cuidado = 'mama' AND {_CODES[group]} {female}"""


_OUT = ("MIN_BIRADS, MAX_BIRADS, BIRADS, ficha_retorno_elegivel, dth_pedido_retorno_elegivel, "
        "dias_entre_ficha_elegivel, retorno_cliente, dth_previsao_retorno, dias_ate_retorno")


def _out(df, *keys):
    return df.select(*keys, *_PLAN_COLUMNS, "ficha_retorno_elegivel", *text("dth_pedido_retorno_elegivel"),
                     "dias_entre_ficha_elegivel", *text("dth_previsao_retorno"), "dias_ate_retorno")


def _returns(spark, sf):
    return read_returns(spark, X.raw_returns(spark, sf))


@register("birads_followup", f"SELECT ficha, id_item, id_cliente, {_OUT} FROM ({_rows('F')})")
def birads_followup(spark, sf):
    """Category history with return plan, first group."""
    return _out(history(X.reports(spark, sf, brand=False), _returns(spark, sf)), "ficha", "id_item", "id_cliente")


@register("birads_followup_group_p", f"SELECT ficha, sigla_exame, sequencial, {_OUT} FROM ({_rows('P')})", "P")
def birads_followup_group_p(spark, sf):
    df = history(X.reports(spark, sf, "P", brand=False), _returns(spark, sf), "P")
    return _out(df, "ficha", "sigla_exame", "sequencial")


@register("birads_followup_all_lines", f"SELECT ficha, id_item, id_cliente, {_OUT} FROM ({_rows('F', 'all')})")
def birads_followup_all_lines(spark, sf):
    """Categories of every line of a report, not of the first alone."""
    df = history(X.reports(spark, sf, brand=False), _returns(spark, sf), section="all")
    return _out(df, "ficha", "id_item", "id_cliente")


_CUT = "DATE '2000-06-30'"


def _loaded(spark, sf, group):
    return X.reports(spark, sf, group, brand=False).filter(f"_datestamp <= {_CUT}")


@register("birads_increment", f"""SELECT ficha, id_item, id_cliente, {_OUT} FROM ({_rows('F')})
    WHERE _datestamp >= (SELECT max(_datestamp) FROM reports WHERE _datestamp <= {_CUT})""")
def birads_increment(spark, sf):
    """The first group re-reads the last day it has loaded."""
    df = history(X.reports(spark, sf, brand=False), _returns(spark, sf), target=_loaded(spark, sf, "F"))
    return _out(df, "ficha", "id_item", "id_cliente")


@register("birads_increment_group_p", f"""SELECT ficha, sigla_exame, sequencial, {_OUT} FROM ({_rows('P')})
    WHERE _datestamp > (SELECT max(_datestamp) FROM reports WHERE _datestamp <= {_CUT})""", "P")
def birads_increment_group_p(spark, sf):
    df = history(X.reports(spark, sf, "P", brand=False), _returns(spark, sf), "P", _loaded(spark, sf, "P"))
    return _out(df, "ficha", "sigla_exame", "sequencial")


@register("birads_saved_twice", f"""SELECT BIRADS, retorno_cliente, count(*) AS n, CAST(sum(ficha) AS BIGINT) AS chaves
    FROM ({_rows('F')}) GROUP BY ALL""")
def birads_saved_twice(spark, sf):
    """Full load, then the increment of the last day, upserted into the history table."""
    path = scratch_path(spark, "birads")
    reports, returns = X.reports(spark, sf, brand=False), _returns(spark, sf)
    save(history(reports, returns), path, V.MERGE_KEYS["F"], by=["_datestamp"])
    save(history(reports, returns, target=read_table(spark, path)), path, V.MERGE_KEYS["F"])
    return read_table(spark, path).groupBy("BIRADS", "retorno_cliente").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ficha").alias("chaves"))


def _activation(group, brand, order):
    return f"""SELECT ficha, {order}, {_OUT} FROM ({_rows(group)}) WHERE ficha_retorno_elegivel IS NULL
      AND BIRADS IN (1, 2, 3) AND upper(sexo_cliente) = 'F' AND {AGE} >= 40 AND {AGE} < 76 AND {brand}
      QUALIFY row_number() OVER (PARTITION BY ficha ORDER BY {order}) = 1"""


@register("activation_list", _activation(
    "F", "upper(marca) IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD')", "id_item, id_subitem"))
def activation(spark, sf):
    df = activation_list(X.reports(spark, sf), _returns(spark, sf), as_of(), brands=BRANDS)
    return _out(df, "ficha", "id_item", "id_subitem")


@register("activation_list_group_p", _activation("P", "marca = 'BUILDING'", "sigla_exame, id_marca, sequencial"), "P")
def activation_group_p(spark, sf):
    df = activation_list(X.reports(spark, sf, "P"), _returns(spark, sf), as_of(), "P", brands=("BUILDING",))
    return _out(df, "ficha", "sigla_exame", "id_marca", "sequencial")


_TERM = V.CARCINOMA_LINE
for _g, _name in (("F", "biopsy_flag"), ("P", "biopsy_flag_group_p")):
    _list = ", ".join(f"'{c}'" for c in V.EXAM_CODES["biopsy"][_g])

    @register(_name, f"""SELECT ficha, id_item, regexp_extract(laudo_tratado, '{_TERM}', 1) AS RAW_CARCINOMA,
        CASE WHEN regexp_extract(laudo_tratado, '{_TERM}', 1) = '' THEN false ELSE true END AS HAS_CARCINOMA
        FROM reports WHERE linha_cuidado = 'mama' AND sigla_exame IN ({_list}) AND upper(sexo_cliente) = 'F'
        AND {AGE} >= 40 AND {AGE} < 76""", _g)
    def biopsy(spark, sf, group=_g):
        df = biopsy_flags(X.reports(spark, sf, group, brand=False), as_of(), group)
        return df.select("ficha", "id_item", "RAW_CARCINOMA", "HAS_CARCINOMA")


@register("pathology_selection", """SELECT ficha, id_item, sigla_exame FROM reports WHERE linha_cuidado = 'mama'
    AND upper(sexo_cliente) = 'F' AND sigla_exame IN ('ANATPATP', 'CTPUNC', 'FISHHER')
    AND regexp_matches(laudo_tratado, '(?i)Topografia: mama')""")
def pathology_selection(spark, sf):
    return pathology_reports(X.reports(spark, sf, brand=False)).select("ficha", "id_item", "sigla_exame")


@register("pathology_selection_group_p", """SELECT ficha, id_item, lower(laudo_tratado) AS laudo_tratado FROM reports
    WHERE linha_cuidado = 'mama' AND sigla_exame IN ('MICROH', 'FPAH')
    AND regexp_matches(laudo_tratado, '(?i)Topografia: mama')""", "P")
def pathology_selection_group_p(spark, sf):
    df = pathology_reports(X.reports(spark, sf, "P", brand=False), "P")
    return df.select("ficha", "id_item", "laudo_tratado")


_PATHOLOGY_WHERE = """linha_cuidado = 'mama' AND upper(sexo_cliente) = 'F'
    AND sigla_exame IN ('ANATPATP', 'CTPUNC', 'FISHHER') AND regexp_matches(laudo_tratado, '(?i)Topografia: mama')"""


@register("pathology_stage", f"""SELECT tipo_histologico, heu_tipo_histologico AS tipo_padrao, count(*) AS n, {", ".join(
    f"count(*) FILTER (WHERE acertou_{f}) AS acertos_{f}" for f in V.PATHOLOGY_FIELDS)}
    FROM {Q.pathology_compared('sentinel', _PATHOLOGY_WHERE)} GROUP BY ALL""")
def pathology_stage(spark, sf):
    """Selection, answers, pattern labels and comparison, counted by histologic type."""
    reports = pathology_reports(X.reports(spark, sf, brand=False))
    df = pathology_labels(reports, X.answers(spark, sf, "pathology"))
    return df.groupBy("tipo_histologico", F.col("heu_tipo_histologico").alias("tipo_padrao")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"acertou_{f}").alias(f"acertos_{f}") for f in V.PATHOLOGY_FIELDS])


@register("pathology_stage_group_p", f"""SELECT heu_tipo_histologico AS tipo_padrao, count(*) AS n, {", ".join(
    f"count(*) FILTER (WHERE acertou_{f}) AS acertos_{f}" for f in V.PATHOLOGY_FIELDS)}
    FROM {Q.pathology_compared('strict', """linha_cuidado = 'mama' AND sigla_exame IN ('MICROH', 'FPAH')
    AND regexp_matches(laudo_tratado, '(?i)Topografia: mama')""", 'lower(laudo_tratado)', 1)} GROUP BY ALL""", "P")
def pathology_stage_group_p(spark, sf):
    """The second group's patterns over lower-cased reports."""
    reports = pathology_reports(X.reports(spark, sf, "P", brand=False), "P")
    df = pathology_labels(reports, X.answers(spark, sf, "pathology", "P", P4), "strict", "P")
    return df.groupBy(F.col("heu_tipo_histologico").alias("tipo_padrao")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"acertou_{f}").alias(f"acertos_{f}") for f in V.PATHOLOGY_FIELDS])


_IHC_WHERE = """linha_cuidado = 'mama' AND upper(sexo_cliente) = 'F' AND sigla_exame IN (%s)
    AND regexp_matches(laudo_tratado, '(?i)mama') AND regexp_matches(laudo_tratado, '(?i)carcinoma')"""


@register("ihc_selection", "SELECT ficha, id_item FROM reports WHERE " + _IHC_WHERE % "'IH-NEO', 'IHMAMA'")
def ihc_selection(spark, sf):
    return ihc_reports(X.reports(spark, sf, brand=False)).select("ficha", "id_item")


@register("ihc_subtype", f"""SELECT ficha, id_item, er AS receptor_estrogeno, pr AS receptor_progesterona, her2 AS status_her2,
    ki AS ki67_float, categoria_final FROM ({Q.subtypes(Q.parsed('ihc'))}) WHERE """ + _IHC_WHERE % "'IH-NEO', 'IHMAMA'")
def ihc_subtype(spark, sf):
    df = ihc_subtypes(ihc_reports(X.reports(spark, sf, brand=False)), X.answers(spark, sf, "ihc"))
    return df.select("ficha", "id_item", "receptor_estrogeno", "receptor_progesterona", "status_her2",
                     "ki67_float", "categoria_final")


@register("ihc_subtype_group_p", f"""SELECT ficha, sequencial, categoria_final FROM ({Q.subtypes(Q.parsed('ihc'))})
    WHERE """ + _IHC_WHERE % "'IHMAMA'", "P")
def ihc_subtype_group_p(spark, sf):
    reports = ihc_reports(X.reports(spark, sf, "P", brand=False), "P")
    df = ihc_subtypes(reports, X.answers(spark, sf, "ihc", "P", P4), "P")
    return df.select("ficha", "sequencial", "categoria_final")


_SAMPLES = f"""(SELECT * EXCLUDE (j), unnest(CASE WHEN len(l) > 0 THEN l ELSE [CAST(NULL AS JSON)] END) AS j
    FROM (SELECT *, CAST(json_extract(j, '$.amostras') AS JSON[]) AS l FROM {Q.parsed('samples')}))"""


@register("ihc_subtype_samples", f"""SELECT ficha, id_item, {Q.field('amostra_id')} AS amostra_id, ki AS ki67_float,
    categoria_final FROM ({Q.subtypes(_SAMPLES)}) WHERE """ + _IHC_WHERE % "'IH-NEO', 'IHMAMA'")
def ihc_subtype_samples(spark, sf):
    reports = ihc_reports(X.reports(spark, sf, brand=False))
    df = ihc_subtypes(reports, X.answers(spark, sf, "samples"), samples=True)
    return df.select("ficha", "id_item", "amostra_id", "ki67_float", "categoria_final")


@register("ihc_stage", f"""SELECT heu_status_her2, count(*) AS n, {", ".join(
    f"count(*) FILTER (WHERE acertou_{f}) AS acertos_{f}" for f in V.IHC_FIELDS)}
    FROM {Q.ihc_compared(_IHC_WHERE % "'IH-NEO', 'IHMAMA'")} GROUP BY ALL""")
def ihc_stage(spark, sf):
    reports = ihc_reports(X.reports(spark, sf, brand=False))
    return ihc_counts(ihc_comparison(ihc_subtypes(ihc_gold(reports), X.answers(spark, sf, "ihc"))))


def ihc_counts(compared):
    return compared.groupBy("heu_status_her2").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"acertou_{f}").alias(f"acertos_{f}") for f in V.IHC_FIELDS])


@register("ihc_stage_group_p", f"""SELECT heu_status_her2, count(*) AS n, {", ".join(
    f"count(*) FILTER (WHERE acertou_{f}) AS acertos_{f}" for f in V.IHC_FIELDS)}
    FROM {Q.ihc_compared(_IHC_WHERE % "'IHMAMA'", version=1)} GROUP BY ALL""", "P")
def ihc_stage_group_p(spark, sf):
    reports = ihc_reports(X.reports(spark, sf, "P", brand=False), "P")
    df = ihc_comparison(ihc_subtypes(ihc_gold(reports, "P"), X.answers(spark, sf, "ihc", "P", P4), "P"), "P")
    return df.groupBy("heu_status_her2").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"acertou_{f}").alias(f"acertos_{f}") for f in V.IHC_FIELDS])


@register("ihc_samples_sheet", "SELECT ficha, id_item, amostra_id, " + ", ".join(
    [*[f"acertou_{f}" for f in V.IHC_FIELDS], *[f"{S.count(p)} AS ctg_{m}" for m, p in V.MARKERS.items()],
     "NOT (" + " AND ".join(f"coalesce(acertou_{f}, false)" for f in V.IHC_FIELDS) + ") AS erro"])
    + f" FROM (SELECT *, {Q.field('amostra_id')} AS amostra_id FROM {Q.ihc_compared(source=_SAMPLES)})")
def ihc_samples_sheet(spark, sf):
    """Validation sheet with one row per sample of a report."""
    gold = ihc_gold(X.reports(spark, sf, brand=False), sheet=True)
    labelled = ihc_subtypes(gold, X.answers(spark, sf, "samples"), samples=True)
    df = validation_sheet(ihc_comparison(labelled))
    return df.select("ficha", "id_item", "amostra_id", *[f"acertou_{f}" for f in V.IHC_FIELDS],
                     *[f"ctg_{m}" for m in V.MARKERS], "erro")


@register("ihc_subtype_literal_answers", f"""SELECT ficha, id_item, er AS receptor_estrogeno, pr AS receptor_progesterona,
    her2 AS status_her2, ki AS ki67_float, categoria_final FROM ({Q.subtypes(Q.parsed('ihc'))})""")
def ihc_subtype_literal_answers(spark, sf):
    """Answers written as Python literals give what the same answers in JSON give."""
    literal = F.replace(F.replace("resposta_llm", F.lit('"'), F.lit("'")), F.lit("null"), F.lit("None"))
    answers = X.answers(spark, sf, "ihc").withColumn("resposta_llm", literal)
    df = ihc_subtypes(X.reports(spark, sf, brand=False), answers, keys=V.REPORT_KEYS["F"], literal=True)
    return df.select("ficha", "id_item", "receptor_estrogeno", "receptor_progesterona", "status_her2",
                     "ki67_float", "categoria_final")
