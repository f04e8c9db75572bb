"""Helpers shared by the operators of this subpackage."""

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of ``[\x20\x09-\x0D]``; everything else belongs to a word.
BLANKS = " \t\n\x0b\x0c\r"


#: Documents are long: what goes to Python at once is kept small, as it is held in memory on both sides.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches that suit whole documents."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only on a local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="careline-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder: computed once, and safe from lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose own ``__`` columns do not touch those of its first argument.

    Input columns that begin with two underscores, and are not named as an argument, are renamed
    while the operator works.
    """

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        named = {a for a in (*args, *options.values()) if isinstance(a, str)}
        odd = [c for c in docs.columns if c.startswith("__") and c not in named]
        mark = "aside_"
        while any(c.startswith(mark) for c in docs.columns):
            mark += "_"
        there = {c: f"{mark}{i}" for i, c in enumerate(odd)}
        if not there:
            return operator(docs, *args, **options)
        return operator(docs.withColumnsRenamed(there), *args, **options).withColumnsRenamed({v: k for k, v in there.items()})

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a variable, so that it is computed once although lambdas use it."""
    return F.transform(F.array(value), body)[0]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """A document's id (null: below all others) and a hash of its text.

    Rows that agree in both are copies of one row and always get one result, so the pair
    serves as a row's key even where ids repeat or are null.
    """
    return [F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63)).cast("bigint")).alias("__id"),
            F.xxhash64(F.col(text_col)).alias("__text_hash")]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(spaced, " "), "")
