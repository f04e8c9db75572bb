"""Scans and projections over the source tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETURN_COLUMNS = {
    "dth_pedido": "dth_pedido_retorno_elegivel",
    "ficha": "ficha_retorno_elegivel",
    "siglas_ficha": "siglas_ficha_retorno_elegivel",
    "marca": "marca_retorno_elegivel",
    "unidade": "unidade_retorno_elegivel",
    "convenio": "convenio_retorno_elegivel",
    "valores_exame": "valores_exame_retorno_elegivel",
    "valores_ficha": "valores_ficha_retorno_elegivel",
    "qtd_exame": "qtd_exame_retorno_elegivel",
    "secao": "secao_retorno_elegivel",
    "dias_entre_ficha": "dias_entre_ficha_elegivel",
}
RETURN_KEYS = ("ficha_origem", "id_cliente", "linha_cuidado")


def _load(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A DataFrame as is, a catalog table by name, anything with a slash as parquet."""
    if isinstance(source, DataFrame):
        return source
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_reports(spark: SparkSession, source: str | DataFrame,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """Report scan with an explicit projection."""
    df = _load(spark, source)
    return df.select(*cols) if cols else df


def read_returns(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Return-visit scan: the join keys and the renamed visit columns."""
    df = _load(spark, source)
    renamed = [F.col(old).alias(new) for old, new in RETURN_COLUMNS.items()]
    return df.select(*RETURN_KEYS, *renamed)


def exists(spark: SparkSession, name: str) -> bool:
    """Whether a catalog table or temporary view is there."""
    return spark.catalog.tableExists(name)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def all_but(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """A small literal table, for dimensions and fixtures."""
    return spark.createDataFrame(rows, schema)
