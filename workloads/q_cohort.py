"""Cohort filters."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators import cohort
from careline.operators.followup import with_categories
from careline.operators.joins import attach_returns
from careline.sources import read_returns
from workloads import fixtures as X
from workloads import sqltext as S
from workloads.registry import register

AS_OF = f"DATE '{X.AS_OF}'"
AGE = f"date_diff('day', dth_nascimento_cliente, {AS_OF}) / 365.25"
BRANDS = ("Building", "machinery", "AUTOMOBILE", "houseHold")


def as_of():
    return F.lit(X.AS_OF).cast("date")


def filtered(name, where, apply, group="F", extra=()):
    """Reports one filter keeps."""
    cols = ["ficha", "id_item", *extra]

    @register(name, f"SELECT {', '.join(cols)} FROM reports WHERE {where}", group)
    def query(spark, sf):
        return apply(X.reports(spark, sf, group, brand="marca" in extra)).select(*cols)


@register("age_at_date", f"SELECT ficha, id_item, {AGE} AS idade_cliente FROM reports")
def age_at_date(spark, sf):
    df = cohort.with_age(X.reports(spark, sf, brand=False), as_of())
    return df.select("ficha", "id_item", "idade_cliente")


filtered("care_line_filter", "linha_cuidado = 'mama'", cohort.for_care_line)
for _stage, _groups in V.EXAM_CODES.items():
    for _group, _codes in _groups.items():
        filtered(f"exam_codes_{_stage}_{_group.lower()}",
                 "sigla_exame IN (" + ", ".join(f"'{c}'" for c in _codes) + ")",
                 lambda df, s=_stage, g=_group: cohort.with_exam_codes(df, s, g), _group,
                 ("sigla_exame",))
filtered("female_filter", "upper(sexo_cliente) = 'F'", cohort.female_only, extra=("sexo_cliente",))
filtered("age_band_filter", f"{AGE} >= 40 AND {AGE} < 76",
         lambda df: cohort.age_between(cohort.with_age(df, as_of())))
filtered("brand_list_filter", "upper(marca) IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD')",
         lambda df: cohort.brand_in(df, BRANDS), extra=("marca",))
filtered("brand_single_filter", "marca = 'BUILDING'",
         lambda df: cohort.brand_is(df, "BUILDING"), extra=("marca",))
filtered("category_filter", f"({S.categories()})[-1] IN (1, 2, 3)",
         lambda df: cohort.category_in(with_categories(df)))
filtered("topography_filter", "regexp_matches(laudo_tratado, '(?i)Topografia: mama')", cohort.mentions)
filtered("breast_and_carcinoma_filter",
         "regexp_matches(laudo_tratado, '(?i)mama') AND regexp_matches(laudo_tratado, '(?i)carcinoma')",
         cohort.mentions_all)
filtered("keyword_gate", "regexp_matches(laudo_tratado, '(?i)(" + "|".join(V.MALIGNANCY_TERMS) + ")')",
         lambda df: cohort.gate(df).filter("should_call_llm"))


@register("lower_text_filter", """
    SELECT ficha, id_item, lower(laudo_tratado) AS laudo_tratado FROM reports
    WHERE regexp_matches(laudo_tratado, '(?i)Topografia: mama')""", "P")
def lower_text_filter(spark, sf):
    df = cohort.lower_text(cohort.mentions(X.reports(spark, sf, "P", brand=False)))
    return df.select("ficha", "id_item", "laudo_tratado")


@register("no_return_filter", """
    SELECT r.ficha, r.id_item FROM reports r LEFT JOIN returns e ON e.ficha_origem = r.ficha
    AND e.id_cliente = r.id_cliente AND e.linha_cuidado = r.linha_cuidado WHERE e.ficha IS NULL""")
def no_return_filter(spark, sf):
    df = X.reports(spark, sf, brand=False).select("ficha", "id_item", "id_cliente", "linha_cuidado")
    joined = attach_returns(df, read_returns(spark, X.raw_returns(spark, sf)))
    return cohort.no_return(joined).select("ficha", "id_item")


@register("activation_rules", f"""
    SELECT r.ficha, r.id_item FROM reports r LEFT JOIN returns e ON e.ficha_origem = r.ficha
    AND e.id_cliente = r.id_cliente AND e.linha_cuidado = r.linha_cuidado
    WHERE e.ficha IS NULL AND ({S.categories()})[-1] IN (1, 2, 3)
    AND r.sigla_exame IN ('MAMOG', 'MAMOGDIG', 'MAMOPROT', 'MAMOG3D') AND upper(sexo_cliente) = 'F'
    AND {AGE} >= 40 AND {AGE} < 76
    AND upper(r.marca) IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD')""")
def activation_rules(spark, sf):
    df = with_categories(cohort.with_age(X.reports(spark, sf), as_of()))
    joined = attach_returns(df, read_returns(spark, X.raw_returns(spark, sf)))
    rules = cohort.ActivationRules(brands=BRANDS)
    return cohort.activation_filter(joined, rules).select("ficha", "id_item")


_DIMENSION = "(VALUES " + ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in V.EXAM_DIMENSION
) + ") AS d(sigla_exame, mnemonico, descricao, etapa)"


@register("exam_mnemonics", f"""
    SELECT r.ficha, r.id_item, r.sigla_exame, d.mnemonico, d.descricao, d.etapa
    FROM reports r LEFT JOIN {_DIMENSION} ON r.sigla_exame = d.sigla_exame""")
def exam_mnemonics(spark, sf):
    df = cohort.with_mnemonic(X.reports(spark, sf, brand=False))
    return df.select("ficha", "id_item", "sigla_exame", "mnemonico", "descricao", "etapa")
