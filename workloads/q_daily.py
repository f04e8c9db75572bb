"""Figures kept by day, sketches, attribution, streams of returns, bucketed joins."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators import daily
from careline.operators import evaluate as E
from careline.operators.followup import attribute_returns
from careline.plans.ihc import ihc_comparison, ihc_gold, ihc_reports, ihc_subtypes
from careline.plans.imaging import history
from careline.session import scratch_path
from careline.sources import read_returns
from careline.sources.bucketed import bucket_count, read_bucketed, save_bucketed
from careline.streaming.returns import not_returned, once_per_key
from workloads import fixtures as X
from workloads import q_evaluate, q_followup, q_stages
from workloads import sqlanswers as Q
from workloads.registry import ORACLES, register


def _kept(states_of, rows, path):
    """States of all days, first from two thirds of the rows; then the days with late rows are read again, whole."""
    spark, kept = rows.sparkSession, f"{path}-linhas"
    rows.write.parquet(kept)  # flags of a row, which both readings use, are found once
    rows = spark.read.parquet(kept)
    late = F.pmod(F.xxhash64("ficha", "id_item"), F.lit(3)) == 0
    daily.keep_days(states_of(rows.filter(~late)), path)
    days = rows.filter(late).select(F.col("dth_pedido").cast("date").alias("_dia")).distinct()
    again = rows.join(days, F.col("dth_pedido").cast("date") == F.col("_dia"), "left_semi")
    daily.keep_days(states_of(again), path)
    return daily.read_days(spark, path)


def _accuracy_states(spark, sf):
    compared = q_evaluate._ihc(spark, sf).select("ficha", "id_item", "dth_pedido", *q_evaluate.IHC_FLAGS)
    return _kept(lambda df: daily.accuracy_days(df, V.IHC_FIELDS), compared, scratch_path(spark, "acerto"))


@register("accuracy_from_days", Q.accuracy(Q.ihc_compared(), V.IHC_FIELDS))
def accuracy_from_days(spark, sf):
    """Rates from daily states, of which most were replaced by a second reading."""
    return daily.accuracy_from_days(_accuracy_states(spark, sf))


@register("errors_from_days", q_evaluate._summary_sql(Q.ihc_compared(), V.IHC_FIELDS))
def errors_from_days(spark, sf):
    return daily.errors_from_days(_accuracy_states(spark, sf)).withColumn("percentual", F.round("percentual", 6))


@register("overdue_from_days", None)
def overdue_from_days(spark, sf):
    returns = read_returns(spark, X.raw_returns(spark, sf))
    planned = history(X.reports(spark, sf, brand=False), returns).select(
        "ficha", "id_item", "dth_pedido", "retorno_cliente", "id_cliente", "dth_previsao_retorno", "ficha_retorno_elegivel")
    return daily.overdue_from_days(_kept(daily.overdue_days, planned, scratch_path(spark, "atraso")), q_followup.as_of())


@register("profile_from_days", "WITH f AS (SELECT " + ", ".join(
    f"{s} AS {k}" for k, s in q_evaluate._profile_flags().items()) + " FROM reports) " + " UNION ALL ".join(
    f"SELECT '{k}' AS classe, CAST(count(*) FILTER (WHERE {k}) AS BIGINT) AS laudos, count(*) FILTER (WHERE {k}) / count(*) AS fracao FROM f"
    for k in q_evaluate._profile_flags()))
def profile_from_days(spark, sf):
    flags = list(q_evaluate._profile_flags())
    flagged = E.inconsistencies(X.reports(spark, sf, brand=False)).select("ficha", "id_item", "dth_pedido", *flags)
    return daily.profile_from_days(_kept(lambda df: daily.profile_days(df, flags), flagged, scratch_path(spark, "perfil")))


@register("describe_from_days", """
    SELECT coluna, n, round(media, 4) AS media, round(desvio, 4) AS desvio, minimo, maximo, true AS q1_perto, true AS mediana_perto, true AS q3_perto FROM (
      SELECT 'o_totalprice' AS coluna, count(o_totalprice) AS n, avg(o_totalprice) AS media, stddev_samp(o_totalprice) AS desvio,
        CAST(min(o_totalprice) AS DOUBLE) AS minimo, CAST(max(o_totalprice) AS DOUBLE) AS maximo FROM orders
      UNION ALL SELECT 'o_custkey', count(o_custkey), avg(o_custkey), stddev_samp(o_custkey), CAST(min(o_custkey) AS DOUBLE),
        CAST(max(o_custkey) AS DOUBLE) FROM orders)""")
def describe_from_days(spark, sf):
    """A describe with quartiles merged from daily sketches; each quartile's rank is held against the rows."""
    orders, cols = X.table(spark, sf, "orders"), ["o_totalprice", "o_custkey"]
    path = scratch_path(spark, "resumo")
    daily.keep_days(E.describe_state(orders.withColumn("dia", F.col("o_orderdate").cast("date")), cols, ["dia"]), path)
    found = E.describe_from(daily.read_days(spark, path))
    tall = orders.select(F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("double").alias("_v")) for c in cols])).alias("r")).select("r.*")
    near = []
    for q, rank in E.QUARTILES.items():
        below, upto = F.count_if(F.col("_v") < F.col(q)) / F.count(F.lit(1)), F.count_if(F.col("_v") <= F.col(q)) / F.count(F.lit(1))
        near.append(((below <= rank + E.RANK_ERROR) & (upto >= rank - E.RANK_ERROR)).alias(f"{q}_perto"))
    ranks = tall.join(found.select("coluna", *E.QUARTILES), "coluna").groupBy("coluna").agg(*near)
    return found.join(ranks, "coluna").select("coluna", "n", *[F.round(c, 4).alias(c) for c in ("media", "desvio")], "minimo", "maximo",
                                              *[f"{q}_perto" for q in E.QUARTILES])


@register("reminder_attribution", """
    WITH lembretes AS (SELECT DISTINCT o_custkey AS c, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 5 = 0)
    SELECT o_orderkey AS ficha, CAST((SELECT max(d) FROM lembretes l WHERE l.c = o_custkey AND l.d <= CAST(o_orderdate AS DATE)
        AND l.d >= CAST(o_orderdate AS DATE) - 400) AS VARCHAR) AS dth_lembrete,
      CAST(CAST(o_orderdate AS DATE) - (SELECT max(d) FROM lembretes l WHERE l.c = o_custkey AND l.d <= CAST(o_orderdate AS DATE)
        AND l.d >= CAST(o_orderdate AS DATE) - 400) AS INT) AS dias_lembrete
    FROM orders""")
def reminder_attribution(spark, sf):
    """Each visit with the patient's last reminder of the 400 days before it."""
    visits = X.visits(spark, sf)
    sent = visits.filter("ficha % 5 = 0").select("id_cliente", F.col("dth_pedido").alias("dth_lembrete"))
    out = attribute_returns(visits.select("ficha", "id_cliente", F.col("dth_pedido").alias("dth_retorno")), sent, within=400)
    return out.select("ficha", F.col("dth_lembrete").cast("string").alias("dth_lembrete"), "dias_lembrete")


_WITHIN = 200
_CLOCK = "(SELECT least((SELECT max(dth_pedido) FROM v), (SELECT max(dth_pedido_retorno) FROM n)) AS t)"


@register("stream_not_returned", f"""
    WITH v AS (SELECT ficha, id_cliente, dth_pedido FROM visits),
    n AS (SELECT ficha_origem, id_cliente, dth_pedido AS dth_pedido_retorno FROM returns)
    SELECT v.ficha, v.id_cliente FROM v WHERE v.dth_pedido + {_WITHIN} < (SELECT t FROM {_CLOCK})
      AND NOT EXISTS (SELECT 1 FROM n WHERE n.ficha_origem = v.ficha AND n.id_cliente = v.id_cliente
        AND n.dth_pedido_retorno BETWEEN v.dth_pedido AND v.dth_pedido + {_WITHIN})""")
def stream_not_returned(spark, sf):
    """Visits without a return, from two streams of files in order of date, several batches."""
    path = scratch_path(spark, "espera")
    visits = X.visits(spark, sf).select("ficha", "id_cliente", "dth_pedido")
    returns = X.raw_returns(spark, sf).select("ficha_origem", "id_cliente", F.col("dth_pedido").alias("dth_pedido_retorno"))
    for k, (low, high) in enumerate((("1900-01-01", "1997-01-01"), ("1997-01-01", "1999-06-01"), ("1999-06-01", "2100-01-01"))):
        visits.filter(f"dth_pedido >= '{low}' AND dth_pedido < '{high}'").write.mode("append").parquet(f"{path}/visits")
        returns.filter(f"dth_pedido_retorno >= '{low}' AND dth_pedido_retorno < '{high}'").write.mode("append").parquet(f"{path}/returns")
        late = not_returned(spark.readStream.schema(visits.schema).parquet(f"{path}/visits"),
                            spark.readStream.schema(returns.schema).parquet(f"{path}/returns"), _WITHIN)
        (late.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(visits.schema).parquet(f"{path}/out").select("ficha", "id_cliente")


@register("stream_reminders", "SELECT DISTINCT l_orderkey AS ficha, o_custkey AS id_cliente FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber % 2 = 1")
def stream_reminders(spark, sf):
    """One reminder per visit over files that come in any order."""
    path = scratch_path(spark, "lembretes")
    lines = X.reports(spark, sf, brand=False).filter("id_item % 2 = 1").select("ficha", "id_cliente", "id_item", "dth_pedido")
    for part in (1, 0, 2):
        lines.filter(F.pmod(F.xxhash64("ficha", "id_item"), F.lit(3)) == part).write.mode("append").parquet(f"{path}/in")
        once = once_per_key(spark.readStream.schema(lines.schema).parquet(f"{path}/in"), ["ficha"], "dth_pedido", 40_000)
        (once.select("ficha", "id_cliente").writeStream.format("parquet").option("path", f"{path}/out")
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{path}/out")


@register("ihc_stage_bucketed", None)
def ihc_stage_bucketed(spark, sf):
    """The stage over reports and answers that lie in buckets of their key."""
    keys, names = V.REPORT_KEYS["F"], []
    sources = {"laudos": X.reports(spark, sf, brand=False), "respostas": X.answers(spark, sf, "ihc")}
    buckets = bucket_count(sources["laudos"])
    for kind, df in sources.items():
        path = scratch_path(spark, kind)
        names.append(f"careline_{kind}_{path.rpartition('-')[2]}")
        save_bucketed(df, names[-1], keys, buckets, path)
    reports, answers = (read_bucketed(spark, n) for n in names)
    return q_stages.ihc_counts(ihc_comparison(ihc_subtypes(ihc_gold(ihc_reports(reports)), answers)))


# The same rows as the computations over whole tables.
ORACLES |= {"overdue_from_days": ORACLES["overdue_rate"], "ihc_stage_bucketed": ORACLES["ihc_stage"]}
