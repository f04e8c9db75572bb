"""Comparison of answers with the types their JSON gives them.

``compare`` sees answers as text.  Here an answer stays a variant: the number 2 is not the
text "2", and a field that is null is not one that is missing.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from careline import fixed_values as V
from careline.functions.answers import first_object, strip_fences
from careline.operators.evaluate import GOLD, HIT

RAW = "_variante"


def answer_variant(c: Column, languages=("python", "json"), pick_object: bool = False) -> Column:
    """Cleaned answer text as a variant, NULL for text that is no JSON."""
    text = strip_fences(c, languages)
    if pick_object:
        return F.try_parse_json(first_object(text))
    # no JSON begins with these letters: a failing parse is slow
    return F.when(~F.substring(c, 1, 1).rlike("[A-HJ-MO-Za-eg-mo-su-z]"), F.try_parse_json(text))


def with_variant(df: DataFrame, answer: str = "resposta_llm", languages=("python", "json"),
                 pick_object: bool = False) -> DataFrame:
    """Replace the answer text by one variant column, ``_variante``."""
    return df.withColumn(RAW, answer_variant(F.col(answer), languages, pick_object)).drop(answer)


def field_variant(field: str, raw: str = RAW) -> Column:
    """A field of the answer: NULL if the answer lacks it, a variant null if it says null."""
    return F.try_variant_get(F.col(raw), f"$.{field}", "variant")


def value_kind(v: Column, schema: Column | None = None) -> Column:
    """What a field holds: texto, inteiro, decimal, booleano, lista, objeto, nulo, or ausente.

    ``schema`` is the field's ``schema_of_variant``, if it is there already.
    """
    kind = F.schema_of_variant(v) if schema is None else schema
    return (
        F.when(v.isNull(), "ausente").when(kind == "VOID", "nulo").when(kind == "STRING", "texto")
        .when(kind == "BIGINT", "inteiro").when(kind == "BOOLEAN", "booleano")
        .when(kind.startswith("ARRAY"), "lista").when(kind.startswith("OBJECT"), "objeto")
        .otherwise("decimal")
    )


def answer_kind(field: str, raw: str = RAW) -> Column:
    """``value_kind`` of an answer's field, ``ilegivel`` where the whole answer could not be read."""
    return F.when(F.col(raw).isNull(), "ilegivel").otherwise(value_kind(field_variant(field, raw)))


def _equal_scalar(v: Column, kind: Column, gold: Column, numeric: bool) -> Column:
    """Equal in type and value; 2 and 2.0 are one number, and true and false are 1 and 0."""
    stated = F.lit(V.NOT_STATED)
    text = F.when(kind == "ausente", stated).when(kind == "texto", F.try_variant_get(v, "$", "string"))
    if not numeric:
        return F.coalesce(text == F.coalesce(gold, stated), F.lit(False))
    number = F.when(kind.isin("inteiro", "decimal"), F.try_variant_get(v, "$", "double")).when(
        kind == "booleano", F.try_variant_get(v, "$", "boolean").cast("double"))
    # gold that was not found stands as the sentinel's text
    return F.coalesce(F.when(gold.isNull(), text == stated).otherwise(number == gold.cast("double")), F.lit(False))


def _found_list(v: Column, kind: Column) -> Column:
    """A list's texts, NULL for anything else in it; a missing list is an empty one."""
    items = F.try_variant_get(v, "$", "array<variant>")
    texts = F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    return F.when(v.isNull(), F.array().cast("array<string>")).when(kind == "lista", texts)


def _equal_set(found: Column, gold: Column) -> Column:
    """Equal as sets of texts; a missing list is an empty one, one with anything but texts is a miss."""
    empty = F.array().cast("array<string>")
    wanted = F.array_sort(F.array_distinct(F.coalesce(gold, empty)))
    plain = ~F.exists(found, lambda x: x.isNull())
    return F.coalesce(plain & (F.array_sort(F.array_distinct(found)) == wanted), F.lit(False))


def compare_typed(df: DataFrame, fields: Sequence[str], raw: str = RAW) -> DataFrame:
    """Add one flag per field: the answer's value against ``heu_*``, in type and value.

    A field that the answer lacks counts as the not-stated sentinel (an empty list for lists), as does
    pattern output that is NULL; a field that is null is a miss, whatever the pattern found.  An
    answer that could not be read lacks every field.
    """
    gold = {f: df.schema[GOLD + f].dataType for f in fields}
    lists = [f for f in fields if isinstance(gold[f], ArrayType)]
    value, form, kind, found = ({f: F.col(f"_{name}_{f}") for f in fields} for name in ("valor", "forma", "tipo", "lista"))
    # Values, their kinds and lists are columns of their own: each branch of a CASE would take them from the answer anew.
    steps = [{f"_valor_{f}": field_variant(f, raw) for f in fields}, {f"_forma_{f}": F.schema_of_variant(value[f]) for f in fields},
             {f"_tipo_{f}": value_kind(value[f], form[f]) for f in fields}, {f"_lista_{f}": _found_list(value[f], kind[f]) for f in lists}]
    flags = {}
    for f in fields:
        flags[HIT + f] = (_equal_set(found[f], F.col(GOLD + f)) if f in lists
                          else _equal_scalar(value[f], kind[f], F.col(GOLD + f), isinstance(gold[f], NumericType)))
    for columns in steps:
        df = df.withColumns(columns)
    return df.withColumns(flags).drop(*[name for columns in steps for name in columns])


def answer_type_profile(df: DataFrame, fields: Sequence[str], raw: str = RAW) -> DataFrame:
    """How often each field comes as each kind of value: ``campo``, ``tipo``, ``n``."""
    # counted within each task before anything is shuffled
    kinds = F.explode(F.array(*[F.struct(F.lit(f).alias("campo"), answer_kind(f, raw).alias("tipo")) for f in fields]))
    return df.select(kinds.alias("r")).select("r.*").groupBy("campo", "tipo").agg(F.count(F.lit(1)).alias("n"))
