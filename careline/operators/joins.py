"""Joins between reports, their extractions and return visits."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.sources.tables import RETURN_KEYS


def join_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on named keys; also the key form of pairing answers with reports."""
    return a.join(b, list(keys), how)


def attach_returns(reports: DataFrame, returns: DataFrame) -> DataFrame:
    """Left-join the return visits of :func:`careline.sources.read_returns`.

    A patient who returned twice for one visit gives two rows.
    """
    origin, client, line = RETURN_KEYS
    return reports.join(
        returns.withColumnRenamed(origin, "ficha"), ["ficha", client, line], "left"
    )


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def expand_struct(df: DataFrame, col: str) -> DataFrame:
    """Put a struct's fields next to the row."""
    return df.select("*", f"{col}.*").drop(col)


def derive_returns(visits: DataFrame, codes: Sequence[str] | None = V.EXAM_CODES["return"]["F"],
                   key: str = "ficha", client: str = "id_cliente", ordered: str = "dth_pedido",
                   code: str = "sigla_exame") -> DataFrame:
    """Next later-dated visit of the same patient that holds a return exam.

    One row per origin visit that has one: ``ficha_origem``, the patient, the
    return's key and date, and ``dias_entre_ficha``.  Of several return visits on
    the next day the smallest key wins.  ``codes=None`` accepts any exam.

    Visits are first reduced to one row per patient and day, so the ordered
    window holds at most one row per calendar day however many visits a patient
    has, and the join back spreads a busy patient over the days.
    """
    day = F.col(ordered).cast("date")
    eligible = F.lit(True) if codes is None else F.col(code).isin(*codes)
    lines = visits.select(key, client, day.alias("_dia"), eligible.alias("_elegivel"))
    days = lines.groupBy(client, "_dia").agg(
        F.min(F.when(F.col("_elegivel"), F.col(key))).alias("_chave")
    )
    later = (
        Window.partitionBy(client).orderBy(F.desc("_dia"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    candidate = F.when(F.col("_chave").isNotNull(), F.struct("_dia", "_chave"))
    nexts = (
        days.withColumn("_proxima", F.last(candidate, ignorenulls=True).over(later))
        .filter(F.col("_proxima").isNotNull())
        .select(client, "_dia", F.col("_proxima._chave").alias("ficha"),
                F.col("_proxima._dia").alias("dth_pedido"),
                F.datediff("_proxima._dia", "_dia").alias("dias_entre_ficha"))
    )
    origins = lines.select(F.col(key).alias("ficha_origem"), client, "_dia").distinct()
    return origins.join(nexts, [client, "_dia"]).drop("_dia")
