"""Reminders and missed returns as streams."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_returned(reports: DataFrame, returns: DataFrame, within_days: int, late_days: int = 0,
                 keys: Sequence[str] = ("ficha", "id_cliente"), ordered: str = "dth_pedido", came: str = "dth_pedido_retorno") -> DataFrame:
    """Reports of a stream without a return of the returns' stream within so many days.

    A stream-stream left outer join with watermarks: a report is held until its window has closed, and
    comes out when no return has been seen by then.  The clock is the older of the two streams' latest
    dates, less ``late_days``; a return older than the clock is too late and changes nothing.  A report
    whose window is still open when the stream ends is not out yet.  ``returns`` has ``ficha_origem`` in
    place of ``ficha``; reports without a key or date are no one's and never come out.
    """
    delay = f"{late_days} days"
    left = reports.withColumn("_pedido", F.col(ordered).cast("timestamp")).withWatermark("_pedido", delay)
    right = returns.select(*[F.col("ficha_origem" if k == "ficha" else k).alias(f"_r_{k}") for k in keys],
                           F.col(came).cast("timestamp").alias("_retorno")).withWatermark("_retorno", delay)
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_r_{k}"))
    window = (F.col("_retorno") >= F.col("_pedido")) & (F.col("_retorno") <= F.col("_pedido") + F.expr(f"INTERVAL {within_days} DAYS"))
    joined = left.join(right, same & window, "left_outer").filter(F.col("_retorno").isNull())
    return joined.drop("_pedido", "_retorno", *[f"_r_{k}" for k in keys])


def once_per_key(stream: DataFrame, keys: Sequence[str], event_time: str, within_days: int) -> DataFrame:
    """Rows of a stream whose key has not been seen for so many days: one reminder per visit.

    State is kept for the keys of these days alone, over all batches and restarts; of rows of one key it
    is not defined which one passes, so carry columns that the key determines.
    """
    timed = stream.withColumn("_quando", F.col(event_time).cast("timestamp")).withWatermark("_quando", f"{within_days} days")
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_quando")
