"""Row counts, distinct values, survivors and row numbers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careline.session import ensure_checkpoint_dir


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a frame."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in a total order.

    Spark pre-limits every map task to one row per key before the shuffle, so a
    key that holds a large share of the rows does not reach one task whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_ordem", F.row_number().over(w)).filter("_ordem = 1").drop("_ordem")


def dedupe_complete(df: DataFrame, keys: Sequence[str], order: Sequence,
                    required: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with NULLs (in ``required`` or any column), then keep one per key."""
    return dedupe(df.dropna(subset=list(required) if required else None), keys, order)


def with_row_index(df: DataFrame, order: Sequence[str], out: str = "index") -> DataFrame:
    """Zero-based position in a total order, without a one-partition window.

    Rows are range-partitioned and sorted once and the result is checkpointed, so
    both passes see the same partitions.  A partition's offset is the number of
    rows in the partitions before it (one number per partition), and the position
    inside a partition is the low part of the generated row id.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    tagged = ordered.withColumn("_particao", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = tagged.groupBy("_particao").agg(F.count(F.lit(1)).alias("_linhas"))
    before = Window.orderBy("_particao").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_particao", F.coalesce(F.sum("_linhas").over(before), F.lit(0)).alias("_inicio")
    )
    # One row per partition: bounded by the shuffle width.
    return (
        tagged.join(F.broadcast(offsets), "_particao")
        .withColumn(out, F.col("_inicio") + F.col("_local"))
        .drop("_particao", "_local", "_inicio")
    )


def sample_first(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First ``n`` rows of a total order, for repeatable smoke runs."""
    return df.orderBy(*order).limit(n)
