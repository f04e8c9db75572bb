"""Stage 1: imaging category, predicted return, reminder list."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators.cohort import (
    AGE,
    ActivationRules,
    female_only,
    for_care_line,
    report_rules,
    with_age,
    with_exam_codes,
)
from careline.operators.followup import with_categories, with_return_plan
from careline.operators.increment import since
from careline.operators.joins import attach_returns, not_in
from careline.operators.rows import dedupe
from careline.sources.tables import RETURN_COLUMNS, all_but


def _extracted(reports: DataFrame, group: str, section: str) -> DataFrame:
    """Mammograms with their categories.

    The category is a projection of the row it was read from, so no join of the
    reports with themselves is needed; report keys are unique.
    """
    df = with_exam_codes(for_care_line(reports), "mammogram", group)
    if group == "P":
        df = female_only(df)
    return with_categories(df, group, section=section)


def history(reports: DataFrame, returns: DataFrame, group: str = "F",
            target: DataFrame | None = None, section: str = "reference") -> DataFrame:
    """Every new mammogram with category, return visit and return plan.

    ``section`` says where categories are read: see ``with_categories``.

    ``target`` is the table written so far; group F re-reads its last day, group
    P starts after it.
    """
    df = since(reports, target, inclusive=group == "F")
    df = _extracted(df, group, section)
    # The text is dropped before the shuffle of the join, unless the table keeps it.
    if group == "F":
        df = all_but(df, "laudo_tratado")
    return with_return_plan(attach_returns(all_but(df, "dth_nascimento_cliente"), returns))


def activation_list(reports: DataFrame, returns: DataFrame, as_of: Column, group: str = "F",
                    brands: Sequence[str] = (), order: Sequence[str] | None = None,
                    section: str = "reference") -> DataFrame:
    """Visits to remind: one row per ``ficha``, the first by report key.

    Nobody on the list has returned, so the return visits are anti-joined by key
    alone and their columns are NULL.
    """
    rules = ActivationRules(exam_codes=V.EXAM_CODES["mammogram"][group], brands=tuple(brands))
    df = all_but(_extracted(with_age(reports, as_of), group, section), "laudo_tratado")
    chosen = all_but(report_rules(df, rules), AGE, "dth_nascimento_cliente")
    came = returns.filter(F.col("ficha_retorno_elegivel").isNotNull())
    chosen = not_in(chosen, came.withColumnRenamed("ficha_origem", "ficha"),
                    ("ficha", "id_cliente", "linha_cuidado"))
    chosen = chosen.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in returns.schema
        if f.name in RETURN_COLUMNS.values()
    })
    keys = [k for k in V.REPORT_KEYS[group] if k != "ficha"]
    return with_return_plan(dedupe(chosen, ["ficha"], order or keys))
