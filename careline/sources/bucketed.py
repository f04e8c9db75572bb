"""Report, answer and return tables bucketed on the report key, for joins without a shuffle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

BUCKET_BYTES = 128 << 20
_MOST_BUCKETS = 100_000  # what Spark allows by default


def bucket_count(*tables: DataFrame, least: int = 8, target: int = BUCKET_BYTES) -> int:
    """Buckets of which one of the largest table holds about ``target`` bytes in memory, however large it is.

    One aggregate for each table: sixteen bytes a value, and the bytes of its texts.
    """
    sizes = []
    for df in tables:
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long") for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
        row = sum(texts, F.lit(16 * len(df.columns)).cast("long"))
        sizes.append(df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0])
    return min(max(least, -(-max(sizes) // target)), _MOST_BUCKETS)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Write a catalog table in so many buckets of the key, each sorted by it.

    Tables that are joined need the same keys, in one order, and the same number of buckets; choose it so
    that a bucket of the largest table suits a task (``bucket_count``).  The rows are shuffled once here, by bucket, so that
    each bucket is one file.  ``path`` puts the files elsewhere than in the warehouse.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
