"""Name -> Spark query and oracle SQL."""

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from careline.session import configure
from workloads.fixtures import oracle as with_tables



def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings; on a local master without a checkpoint folder, with one."""
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not given and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="careline-"))
    return configure(spark)


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None, group: str = "F") -> Callable[[Query], Query]:
    """Register a query with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf: fn(prepared(spark), sf)
        if sql is not None:
            ORACLES[name] = with_tables(sql, group)
        return fn

    return add
