"""Prompt text, answer parsing and subtypes."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions import answers as A
from careline.operators import answers as O
from careline.operators.joins import join_keys
from workloads import fixtures as X
from workloads import sqlanswers as Q
from workloads import sqltext as S
from workloads.q_text import joined
from workloads.registry import register

F3, P4 = V.REPORT_KEYS["F"], V.REPORT_KEYS["P"]


@register("prompt_template", """
    SELECT ficha, id_item, 'Extraia 100% dos campos. Laudo: [' || coalesce(laudo_tratado, 'null') || ']' AS prompt FROM reports""")
def prompt_template(spark, sf):
    prompt = A.render("Extraia 100%% dos campos. Laudo: [%s]", F.col("laudo_tratado"))
    return X.reports(spark, sf, brand=False).select("ficha", "id_item", prompt.alias("prompt"))


@register("prompt_concat", """
    SELECT conv_id, turn, 'Texto: "' || text || '" Responda em JSON.' AS prompt FROM conversations""")
def prompt_concat(spark, sf):
    prompt = A.render_concat('Texto: "', F.col("text"), '" Responda em JSON.')
    return X.table(spark, sf, "conversations").select("conv_id", "turn", prompt.alias("prompt"))


@register("prompt_replace", """
    SELECT doc_id, 'Laudo $1: ' || text || ' fim' AS prompt FROM documents""")
def prompt_replace(spark, sf):
    """Dollar signs and backslashes of a text are kept as they are."""
    prompt = A.render_replace("Laudo $1: {laudo_texto} fim", F.col("text"))
    return X.table(spark, sf, "documents").select("doc_id", prompt.alias("prompt"))


@register("strip_fences", f"""SELECT conv_id, turn, {Q.clean("fenced")} AS limpo FROM (
    SELECT *, CASE role WHEN 'user' THEN '```python' ELSE '```json' END || chr(10) || text || ' ``` ' AS fenced
    FROM conversations)""")
def strip_fences(spark, sf):
    df = X.table(spark, sf, "conversations").withColumn("fenced", F.concat(
        F.when(F.col("role") == "user", "```python").otherwise("```json"), F.lit("\n"),
        F.col("text"), F.lit(" ``` ")))
    return df.select("conv_id", "turn", A.strip_fences(F.col("fenced")).alias("limpo"))


@register("first_object", r"""SELECT ficha, id_item, regexp_extract(resposta_patologia, '(\{[^}]+\})', 1) AS objeto FROM reports""")
def first_object(spark, sf):
    df = X.answers(spark, sf, "pathology")
    return df.select("ficha", "id_item", A.first_object(F.col("resposta_llm")).alias("objeto"))


def _pathology_cells(fill=False):
    cells = []
    for f in V.PATHOLOGY_FIELDS:
        s = S.joined(Q.string_list(f)) if f == V.PATHOLOGY_FIELDS[0] else Q.field(f)
        cells.append(f"{f'coalesce({s}, {Q.NI})' if fill and f != V.PATHOLOGY_FIELDS[0] else s} AS {f}")
    return "SELECT ficha, id_item, " + ", ".join(cells)


def _pathology_out(df):
    first, *rest = V.PATHOLOGY_FIELDS
    return df.select("ficha", "id_item", joined(F.col(first)).alias(first), *rest)


@register("parse_pathology_answers", f"{_pathology_cells()} FROM {Q.parsed('pathology')}")
def parse_pathology_answers(spark, sf):
    return _pathology_out(O.parse_answers(X.answers(spark, sf, "pathology"), O.PATHOLOGY_SCHEMA))


@register("parse_picked_objects", f"{_pathology_cells()} FROM {Q.parsed('pathology', pick=True)}")
def parse_picked_objects(spark, sf):
    df = X.answers(spark, sf, "pathology")
    return _pathology_out(O.parse_answers(df, O.PATHOLOGY_SCHEMA, pick_object=True))


@register("parse_ihc_answers", "SELECT ficha, id_item, " + ", ".join(
    f"{Q.field(f)} AS {f}" for f in V.IHC_FIELDS) + f" FROM {Q.parsed('ihc')}")
def parse_ihc_answers(spark, sf):
    df = O.parse_answers(X.answers(spark, sf, "ihc"), O.IHC_SCHEMA)
    return df.select("ficha", "id_item", *V.IHC_FIELDS)


@register("parse_event_props", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events""")
def parse_event_props(spark, sf):
    df = X.table(spark, sf, "events").select("event_id", "props")
    return O.parse_answers(df, "k STRING", answer="props")


@register("parse_literal_answers", "SELECT ficha, id_item, " + ", ".join(
    f"json_extract_string(TRY_CAST(resposta_imuno AS JSON), '$.{f}') AS {f}" for f in V.IHC_FIELDS) + " FROM reports")
def parse_literal_answers(spark, sf):
    """Answers spelled as Python literals: single quotes and None."""
    text = F.replace(F.replace("resposta_llm", F.lit('"'), F.lit("'")), F.lit("null"), F.lit("None"))
    df = X.answers(spark, sf, "ihc").withColumn("r", A.parse_literal(text, O.IHC_SCHEMA))
    return df.select("ficha", "id_item", "r.*")


@register("fill_sentinel", f"{_pathology_cells(fill=True)} FROM {Q.parsed('pathology')}")
def fill_sentinel(spark, sf):
    df = O.parse_answers(X.answers(spark, sf, "pathology"), O.PATHOLOGY_SCHEMA)
    return _pathology_out(O.fill_sentinel(df, V.PATHOLOGY_FIELDS))


@register("safe_ints", "SELECT ficha, id_item, " + ", ".join(
    f"{Q.whole(Q.field(f))} AS {f}" for f in V.PATHOLOGY_FIELDS[1:5]) + f" FROM {Q.parsed('pathology')}")
def safe_ints(spark, sf):
    df = O.parse_answers(X.answers(spark, sf, "pathology"), O.PATHOLOGY_SCHEMA)
    return O.safe_ints(df, V.PATHOLOGY_FIELDS[1:5]).select("ficha", "id_item", *V.PATHOLOGY_FIELDS[1:5])


@register("ki67_number", f"""
    SELECT ficha, id_item, coalesce(TRY_CAST({Q.field('ki67_percentual')} AS DOUBLE), 0.0) AS ki67_float
    FROM {Q.parsed('ihc')}""")
def ki67_number(spark, sf):
    df = O.parse_answers(X.answers(spark, sf, "ihc"), O.IHC_SCHEMA)
    return O.with_ki67_number(df).select("ficha", "id_item", "ki67_float")


_SAMPLES = f"""(SELECT ficha, id_item, unnest(CASE WHEN len(l) > 0 THEN l ELSE [CAST(NULL AS JSON)] END) AS j
    FROM (SELECT *, CAST(json_extract(j, '$.amostras') AS JSON[]) AS l FROM {Q.parsed('samples')}))"""


@register("explode_samples", f"""
    SELECT ficha, id_item, {Q.field('amostra_id')} AS amostra_id, {Q.field('status_her2')} AS status_her2,
    {Q.field('ki67_percentual')} AS ki67_percentual FROM {_SAMPLES}""")
def explode_samples(spark, sf):
    df = O.explode_samples(X.answers(spark, sf, "samples"))
    return df.select("ficha", "id_item", "amostra_id", "status_her2", "ki67_percentual")


@register("subtype_by_report", f"SELECT ficha, id_item, categoria_final FROM ({Q.subtypes(Q.parsed('ihc'))})")
def subtype_by_report(spark, sf):
    df = O.with_ki67_number(O.parse_answers(X.answers(spark, sf, "ihc"), O.IHC_SCHEMA))
    return O.with_subtype(df).select("ficha", "id_item", "categoria_final")


@register("subtype_by_sample", f"""SELECT ficha, id_item, {Q.field('amostra_id')} AS amostra_id, categoria_final
    FROM ({Q.subtypes(_SAMPLES)})""")
def subtype_by_sample(spark, sf):
    df = O.with_ki67_number(O.explode_samples(X.answers(spark, sf, "samples")))
    return O.with_subtype(df).select("ficha", "id_item", "amostra_id", "categoria_final")


@register("subtype_counts", f"""SELECT categoria_final, count(*) AS n FROM ({Q.subtypes(Q.parsed('ihc'))}) GROUP BY 1""")
def subtype_counts(spark, sf):
    df = O.with_ki67_number(O.parse_answers(X.answers(spark, sf, "ihc"), O.IHC_SCHEMA))
    return O.with_subtype(df).groupBy("categoria_final").agg(F.count(F.lit(1)).alias("n"))


@register("join_answers_four_keys", """
    SELECT ficha, sigla_exame, id_marca, sequencial, CAST(length(laudo_tratado) AS INT) AS tamanho, resposta_imuno AS resposta_llm
    FROM reports""", "P")
def join_answers_four_keys(spark, sf):
    df = X.reports(spark, sf, "P", brand=False).select(*P4, F.length("laudo_tratado").alias("tamanho"))
    return join_keys(df, X.answers(spark, sf, "ihc", "P", P4), P4)


@register("pair_answers_by_key", """
    SELECT ficha, id_item, sigla_exame, resposta_patologia AS resposta_llm FROM reports""")
def pair_answers_by_key(spark, sf):
    """Answers go to their reports by key, whatever order either side is read in."""
    df = X.reports(spark, sf, brand=False).select(*F3, "sigla_exame")
    out = join_keys(df, X.answers(spark, sf, "pathology"), F3)
    return out.select("ficha", "id_item", "sigla_exame", "resposta_llm")
