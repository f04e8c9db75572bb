"""Model answers, read from a table, to typed columns."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from careline import fixed_values as V
from careline.functions.answers import (
    first_object,
    float_or_zero,
    int_or_null,
    parse_literal,
    strip_fences,
)
from careline.functions.markers import ihc_labels
from careline.functions.pathology import LOWERED, pathology_labels, with_lowered
from careline.functions.subtype import molecular_subtype

TEXT = "laudo_tratado"
ANSWER = "resposta_llm"

PATHOLOGY_SCHEMA = StructType(
    [StructField("descritores_malignidade", ArrayType(StringType()))]
    + [StructField(name, StringType()) for name in V.PATHOLOGY_FIELDS[1:]]
)
IHC_SCHEMA = StructType([StructField(name, StringType()) for name in V.IHC_FIELDS])
SAMPLES_SCHEMA = StructType([StructField("amostras", ArrayType(
    StructType([StructField("amostra_id", StringType()), *IHC_SCHEMA.fields])
))])


def answer_struct(c: Column, schema: StructType, languages=("python", "json"),
                  pick_object: bool = False, literal: bool = False) -> Column:
    """Cleaned answer text as a struct; unreadable text gives NULL fields.

    ``literal`` reads Python literals (which JSON, but for its bare words, also is).
    """
    text = strip_fences(c, languages)
    text = first_object(text) if pick_object else text
    if literal:
        return parse_literal(text, schema)
    parsed = F.from_json(text, schema)
    # no object begins with a letter: a failing parse is slow
    return parsed if pick_object else F.when(~F.substring(c, 1, 1).rlike("[A-Za-z]"), parsed)


def parse_answers(df: DataFrame, schema: StructType, answer: str = ANSWER,
                  languages=("python", "json"), pick_object: bool = False,
                  literal: bool = False) -> DataFrame:
    """Replace the answer text by one column per schema field."""
    parsed = df.withColumn("_resposta", answer_struct(F.col(answer), schema, languages, pick_object, literal))
    return parsed.select("*", "_resposta.*").drop(answer, "_resposta")


def fill_sentinel(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL to the not-stated sentinel, or to an empty list for list columns."""
    lists = {f.name for f in df.schema if isinstance(f.dataType, ArrayType)}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.array().cast("array<string>") if c in lists
                      else F.lit(V.NOT_STATED))
        for c in cols
    })


def safe_ints(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric labels as INT, sentinel as NULL."""
    return df.withColumns({c: int_or_null(F.col(c)) for c in cols})


def with_ki67_number(df: DataFrame) -> DataFrame:
    """Add ``ki67_float``: the percentage as a number, 0.0 when it is none."""
    return df.withColumn("ki67_float", float_or_zero(F.col("ki67_percentual")))


def explode_samples(df: DataFrame, answer: str = ANSWER, languages=("python", "json"),
                    literal: bool = False) -> DataFrame:
    """One row per sample of the answer; reports without samples keep one row."""
    samples = answer_struct(F.col(answer), SAMPLES_SCHEMA, languages, literal=literal)["amostras"]
    return (
        df.withColumn("_amostra", F.explode_outer(samples))
        .select("*", "_amostra.*").drop(answer, "_amostra")
    )


def with_subtype(df: DataFrame) -> DataFrame:
    """Add ``categoria_final`` from the four markers."""
    return df.withColumn("categoria_final", molecular_subtype(
        F.col("receptor_estrogeno"), F.col("receptor_progesterona"),
        F.col("status_her2"), F.col("ki67_float"),
    ))


def pseudo_gold(df: DataFrame, kind: str, text: str = TEXT, as_text: bool = False,
                versions: dict[str, int] | None = None) -> DataFrame:
    """Add the pattern-based labels as ``heu_*``.

    ``as_text`` turns pathology numbers to text and fills the sentinel, the form
    answers have; otherwise missing labels stay NULL.
    """
    df, low = with_lowered(df, text)
    found = ihc_labels if kind == "ihc" else pathology_labels
    labels = {f"heu_{k}": c for k, c in found(low, versions).items()}
    if as_text and kind != "ihc":
        first = f"heu_{V.PATHOLOGY_FIELDS[0]}"
        labels = {
            k: c if k == first else F.coalesce(c.cast("string"), F.lit(V.NOT_STATED))
            for k, c in labels.items()
        }
    return df.withColumns(labels).drop(*LOWERED)
