"""Stage 2: carcinoma flag of biopsy reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.functions.pathology import carcinoma_flag, raw_carcinoma
from careline.operators.cohort import (
    age_between,
    female_only,
    for_care_line,
    with_age,
    with_exam_codes,
)
from careline.operators.increment import since

OUTPUT = ("id_marca", "id_unidade", "id_cliente", "id_ficha", "ficha", "id_item", "id_subitem",
          "id_exame", "sigla_exame", "dth_pedido", "dth_resultado", "_datestamp",
          "laudo_tratado", "linha_cuidado", "RAW_CARCINOMA", "HAS_CARCINOMA")


def biopsy_flags(reports: DataFrame, as_of: Column, group: str = "F",
                 target: DataFrame | None = None, either_order: bool = False) -> DataFrame:
    """Women of the age band with a biopsy, and whether breast carcinoma is reported."""
    df = with_exam_codes(for_care_line(since(reports, target, inclusive=False)), "biopsy", group)
    df = age_between(with_age(female_only(df), as_of))
    df = df.withColumn("RAW_CARCINOMA", raw_carcinoma(F.col("laudo_tratado"), either_order))
    df = df.withColumn("HAS_CARCINOMA", carcinoma_flag(F.col("RAW_CARCINOMA")))
    return df.select(*[c for c in OUTPUT if c in df.columns])
