"""Figures kept up by day: small additive states, one set of rows for each day of reports.

A day's state holds sums that add up over days.  ``keep_days`` stores states in a table; a day that is
read again replaces its state, so late rows and corrections do no harm and no other day's reports are read.  ``*_from_days`` give what a computation over all rows would.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careline.operators import tables
from careline.operators.evaluate import HIT

DAY, MONTH = "dia", "mes"


def _by_day(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn(DAY, F.col(day).cast("date"))


def _unpivot_days(sums: DataFrame, names: Sequence[str], cells: Sequence[str], label: str) -> DataFrame:
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"{i}_{c}").alias(c) for c in cells]) for i, n in enumerate(names)]))
    return sums.select(DAY, rows.alias("r")).select(DAY, "r.*")


def accuracy_days(compared: DataFrame, fields: Sequence[str], day: str = "dth_pedido") -> DataFrame:
    """Per day and field of compared rows: hits, rows with a flag, and rows."""
    aggs = []
    for i, f in enumerate(fields):
        flag = F.col(HIT + f).cast("int")
        aggs += [F.coalesce(F.sum(flag), F.lit(0)).alias(f"{i}_acertos"), F.count(flag).alias(f"{i}_avaliados"), F.count(F.lit(1)).alias(f"{i}_total")]
    return _unpivot_days(_by_day(compared, day).groupBy(DAY).agg(*aggs), fields, ("acertos", "avaliados", "total"), "campo")


def accuracy_from_days(states: DataFrame, rate: str = "share") -> DataFrame:
    """Hits, total and rate per field; see ``evaluate.accuracy``."""
    base = F.sum("total" if rate == "share" else "avaliados")
    share = F.when(base > 0, F.sum("acertos") / base).otherwise(F.lit(0.0))
    return states.groupBy("campo").agg(F.sum("acertos").alias("acertos"), F.sum("total").alias("total"), share.alias("taxa_acerto"))


def errors_from_days(states: DataFrame) -> DataFrame:
    """Misses per field and their percentage of all rows, with a total; see ``evaluate.error_summary``."""
    misses = F.sum(F.col("avaliados") - F.col("acertos"))
    rows = F.sum("total")
    share = F.when(rows > 0, misses / rows * 100).otherwise(F.lit(0.0))
    by_field = states.groupBy("campo").agg(misses.alias("erros"), share.alias("percentual"))
    total = by_field.agg(F.lit("Total").alias("campo"), F.coalesce(F.sum("erros"), F.lit(0)).alias("erros"),
                         F.coalesce(F.sum("percentual"), F.lit(0.0)).alias("percentual"))
    return by_field.unionByName(total)


def profile_days(flagged: DataFrame, flags: Sequence[str], day: str = "dth_pedido") -> DataFrame:
    """Per day and class of wording: reports that show it, and reports."""
    aggs = [a for i, f in enumerate(flags) for a in (F.count_if(F.col(f)).alias(f"{i}_laudos"), F.count(F.lit(1)).alias(f"{i}_total"))]
    return _unpivot_days(_by_day(flagged, day).groupBy(DAY).agg(*aggs), flags, ("laudos", "total"), "classe")


def profile_from_days(states: DataFrame) -> DataFrame:
    """Reports per class and their share; see ``evaluate.inconsistency_profile``."""
    share = F.when(F.sum("total") > 0, F.sum("laudos") / F.sum("total")).otherwise(F.lit(0.0))
    return states.groupBy("classe").agg(F.sum("laudos").alias("laudos"), share.alias("fracao"))


def overdue_days(planned: DataFrame, day: str = "dth_pedido") -> DataFrame:
    """Per day, advised months and patient: whether a visit has no return yet, and when it is due.

    Patients are counted once over all days, so the state keeps them: three small columns in place of reports.
    ``planned`` has the return plan and the left-joined return visit.
    """
    due = _by_day(planned, day).filter(F.col("retorno_cliente") > 0)
    return due.groupBy(DAY, "retorno_cliente", "id_cliente", F.col("dth_previsao_retorno").cast("date").alias("previsao")).agg(
        F.max(F.col("ficha_retorno_elegivel").isNull()).alias("atraso"))


def overdue_from_days(states: DataFrame, as_of: Column) -> DataFrame:
    """Patients past their date and those without a return, by months advised; see ``followup.overdue_rate``."""
    patients = states.filter(F.col("previsao") < as_of).groupBy("retorno_cliente", "id_cliente").agg(F.max("atraso").alias("_atraso"))
    return patients.groupBy("retorno_cliente").agg(
        F.count(F.lit(1)).alias("pacientes"), F.count_if("_atraso").alias("em_atraso"), F.avg(F.col("_atraso").cast("int")).alias("taxa_atraso"))


def keep_days(states: DataFrame, path: str, days: Sequence | None = None) -> None:
    """Store the states of the days that were read: each replaces what the table has of its day.

    ``days`` names the days that were read; those among them without a row are removed.  The table is
    partitioned by month, and only the months of these days are rewritten.
    """
    spark = states.sparkSession
    found = states.withColumn(MONTH, F.date_format(DAY, "yyyy-MM")).persist()  # states are small; rows are read once
    try:
        if not tables.table_exists(spark, path):
            tables.overwrite(found, path, [MONTH])
            return
        read = found.select(DAY).distinct().union(spark.createDataFrame([(str(d),) for d in days or ()], "d string").select(F.col("d").cast("date")))
        months = [r[0] for r in read.select(F.date_format(DAY, "yyyy-MM")).distinct().collect()]
        stored = tables.read_table(spark, path).filter(F.col(MONTH).isin(months))
        kept = stored.join(read.distinct(), DAY, "left_anti")
        tables.replace_partitions(found.unionByName(kept), path, months)
    finally:
        found.unpersist()


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path).drop(MONTH)
