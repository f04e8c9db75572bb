"""Return plans, reminder lists and follow-up figures."""

from pyspark.sql import functions as F

from careline.operators import cohort
from careline.operators import followup as U
from careline.plans.imaging import history
from careline.sources import read_returns
from workloads import fixtures as X
from workloads import sqltext as S
from workloads.q_cohort import AGE, AS_OF, BRANDS, as_of
from workloads.q_scan import text
from workloads.registry import register

CAT = f"({S.categories()})[-1]"
MONTHS = "CASE WHEN BIRADS IN (1, 2) THEN 12 WHEN BIRADS = 3 THEN 6 ELSE 0 END"
DUE = "CASE WHEN BIRADS IN (1, 2) THEN dth_pedido + 360 WHEN BIRADS = 3 THEN dth_pedido + 180 END"
WITH_CAT = f"(SELECT *, {CAT} AS BIRADS, {AGE} AS idade FROM reports)"


@register("return_months", f"SELECT ficha, id_item, {MONTHS} AS retorno_cliente FROM {WITH_CAT}")
def return_months(spark, sf):
    df = U.with_return_plan(U.with_categories(X.reports(spark, sf, brand=False)))
    return df.select("ficha", "id_item", "retorno_cliente")


@register("predicted_return", f"""
    SELECT ficha, id_item, CAST(CAST({DUE} AS TIMESTAMP) AS VARCHAR) AS dth_previsao_retorno,
    CAST(CAST({DUE} AS DATE) - dth_pedido AS INT) AS dias_ate_retorno FROM {WITH_CAT}""")
def predicted_return(spark, sf):
    df = U.with_return_plan(U.with_categories(X.reports(spark, sf, brand=False)))
    return df.select("ficha", "id_item", *text("dth_previsao_retorno"), "dias_ate_retorno")


@register("return_date_as_timestamp", """
    SELECT ficha_origem, CAST(CAST(dth_pedido AS TIMESTAMP) AS VARCHAR) AS dth_pedido_retorno_elegivel FROM returns""")
def return_date_as_timestamp(spark, sf):
    from careline.functions.followup import as_ts

    df = read_returns(spark, X.raw_returns(spark, sf))
    return df.select("ficha_origem", as_ts(F.col("dth_pedido_retorno_elegivel")).cast("string")
                     .alias("dth_pedido_retorno_elegivel"))


@register("complementary_exams", """
    SELECT sigla_exame, CASE sigla_exame WHEN 'BRCA1' THEN 'BRCAS1' WHEN 'CINTMAMA' THEN 'CIMAMA' ELSE 'P-CH16' END AS mnemonico,
    count(*) AS n FROM reports WHERE sigla_exame IN ('BRCA1', 'CINTMAMA', 'PAINELMAMA') GROUP BY 1""")
def complementary_exams(spark, sf):
    return U.count_complementary(X.reports(spark, sf, brand=False))


_JOINED = f"""(SELECT r.*, e.ficha AS volta, e.valores_exame FROM {WITH_CAT} r LEFT JOIN returns e
    ON e.ficha_origem = r.ficha AND e.id_cliente = r.id_cliente AND e.linha_cuidado = r.linha_cuidado
    WHERE r.linha_cuidado = 'mama' AND r.sigla_exame IN ('MAMOG', 'MAMOGDIG', 'MAMOPROT', 'MAMOG3D'))"""


@register("overdue_rate", f"""
    SELECT retorno_cliente, count(*) AS pacientes, count(*) FILTER (WHERE atraso) AS em_atraso,
      count(*) FILTER (WHERE atraso) / count(*) AS taxa_atraso
    FROM (SELECT {MONTHS} AS retorno_cliente, id_cliente, bool_or(volta IS NULL) AS atraso
      FROM {_JOINED} WHERE {DUE} < {AS_OF} GROUP BY ALL) GROUP BY 1""")
def overdue_rate(spark, sf):
    returns = read_returns(spark, X.raw_returns(spark, sf))
    return U.overdue_rate(history(X.reports(spark, sf, brand=False), returns), as_of())


@register("reminder_effect", f"""
    SELECT retorno_cliente, count(*) AS lembretes, count(volta) AS retornos,
      count(volta) / count(*) AS taxa_retorno, CAST(coalesce(sum(valores_exame), 0) AS DOUBLE) AS valor_retornos
    FROM (SELECT {MONTHS} AS retorno_cliente, * FROM {_JOINED} WHERE BIRADS IN (1, 2, 3)
      QUALIFY row_number() OVER (PARTITION BY ficha ORDER BY id_item) = 1) GROUP BY 1""")
def reminder_effect(spark, sf):
    from careline.operators.rows import dedupe

    returns = X.raw_returns(spark, sf)
    sent = history(X.reports(spark, sf, brand=False), read_returns(spark, returns))
    sent = dedupe(cohort.category_in(sent), ["ficha"], ["id_item"])
    return U.reminder_effect(sent, returns)


def _consents(spark, sf):
    return X.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id_cliente"),
        F.when(F.col("c_acctbal") > 6000, "e-mail").when(F.col("c_acctbal") > 3000, "sms")
        .when(F.col("c_acctbal") > 0, "whatsapp").otherwise("nenhum").alias("consentimento"))


@register("channel_list", f"""
    SELECT ficha, id_item FROM {WITH_CAT}
    WHERE upper(marca) IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD') AND idade >= 40 AND idade < 76
    AND sigla_exame IN ('MAMOG', 'MAMOGDIG', 'MAMOPROT', 'MAMOG3D') AND BIRADS IN (1, 2, 3)
    AND {DUE} BETWEEN DATE '1999-01-01' AND DATE '2000-06-30'
    AND id_cliente IN (SELECT c_custkey FROM customer
      WHERE c_acctbal > 6000 OR (c_acctbal > 0 AND c_acctbal <= 3000))
    AND id_cliente NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)""")
def channel_list(spark, sf):
    df = U.with_return_plan(U.with_categories(cohort.with_age(X.reports(spark, sf), as_of())))
    rules = U.ChannelRules(brands=BRANDS, due_from="1999-01-01", due_to="2000-06-30",
                           consents=("e-mail", "whatsapp"))
    controls = X.table(spark, sf, "customer").filter("c_nationkey = 7").select(
        F.col("c_custkey").alias("id_cliente"))
    return U.channel_list(df, rules, _consents(spark, sf), controls).select("ficha", "id_item")
