"""Cohort filters over reports."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions.followup import age_years
from careline.sources.tables import from_rows

AGE = "idade_cliente"
TEXT = "laudo_tratado"


def with_age(df: DataFrame, as_of: Column, birth: str = "dth_nascimento_cliente") -> DataFrame:
    """Add the age in years at ``as_of``."""
    return df.withColumn(AGE, age_years(F.col(birth), as_of))


def for_care_line(df: DataFrame, line: str = V.CARE_LINE) -> DataFrame:
    return df.filter(F.col("linha_cuidado") == line)


def with_exam_codes(df: DataFrame, stage: str, group: str = "F") -> DataFrame:
    """Reports whose exam code belongs to a stage of a group."""
    return df.filter(F.col("sigla_exame").isin(*V.EXAM_CODES[stage][group]))


def female_only(df: DataFrame) -> DataFrame:
    return df.filter(F.upper("sexo_cliente") == "F")


def age_between(df: DataFrame, lo: float = V.AGE_FROM, hi: float = V.AGE_BELOW) -> DataFrame:
    """Half-open age band."""
    return df.filter((F.col(AGE) >= lo) & (F.col(AGE) < hi))


def _brand(names: Sequence[str]) -> Column:
    return F.upper("marca").isin(*[n.upper() for n in names])


def brand_in(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Brand equal to any of the names, in any letter case."""
    return df.filter(_brand(names))


def brand_is(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("marca") == name)


def category_in(df: DataFrame, values: Sequence[int] = V.REMINDER_CATEGORIES) -> DataFrame:
    return df.filter(F.col("BIRADS").isin(*values))


def no_return(df: DataFrame, col: str = "ficha_retorno_elegivel") -> DataFrame:
    """Reports whose left-joined return visit is missing."""
    return df.filter(F.col(col).isNull())


def mentions(df: DataFrame, pattern: str = V.TOPOGRAPHY_BREAST, text: str = TEXT) -> DataFrame:
    return df.filter(F.col(text).rlike(f"(?i){pattern}"))


def mentions_all(df: DataFrame, patterns: Sequence[str] = ("mama", "carcinoma"),
                 text: str = TEXT) -> DataFrame:
    for pattern in patterns:
        df = mentions(df, pattern, text)
    return df


def lower_text(df: DataFrame, text: str = TEXT) -> DataFrame:
    return df.withColumn(text, F.lower(text))


def gate_flag(c: Column, terms: Sequence[str] = V.MALIGNANCY_TERMS,
              any_case_accents: bool = False) -> Column:
    """Any term inside the text, without word boundaries.

    Letter case is ignored for plain letters only, unless ``any_case_accents``.
    """
    flags = "(?iu)" if any_case_accents else "(?i)"
    # Terms are literal: quote them for the regular expression.
    return c.rlike(flags + "(" + "|".join(rf"\Q{t}\E" for t in terms) + ")")


def gate(df: DataFrame, terms: Sequence[str] = V.MALIGNANCY_TERMS, text: str = TEXT,
         out: str = "should_call_llm") -> DataFrame:
    """Add the flag that saves a model call for reports without any term."""
    return df.withColumn(out, gate_flag(F.col(text), terms))


@dataclass(frozen=True)
class ActivationRules:
    """Who gets a reminder.  ``brands`` empty means every brand."""

    exam_codes: Sequence[str] = V.EXAM_CODES["mammogram"]["F"]
    age_from: float = V.AGE_FROM
    age_below: float = V.AGE_BELOW
    categories: Sequence[int] = V.REMINDER_CATEGORIES
    brands: Sequence[str] = field(default_factory=tuple)


def report_rules(df: DataFrame, rules: ActivationRules) -> DataFrame:
    """The rules that look at the report alone; expects the age and ``BIRADS``."""
    df = female_only(df.filter(F.col("sigla_exame").isin(*rules.exam_codes)))
    if rules.brands:
        df = brand_in(df, rules.brands)
    return category_in(age_between(df, rules.age_from, rules.age_below), rules.categories)


def activation_filter(df: DataFrame, rules: ActivationRules) -> DataFrame:
    """Exam code, sex, age, brand, category and no-return rules together.

    Expects also the left-joined return columns.
    """
    return no_return(report_rules(df, rules))


def exam_dimension(df: DataFrame) -> DataFrame:
    """The literal exam-code dimension."""
    return from_rows(
        df.sparkSession, V.EXAM_DIMENSION,
        "sigla_exame string, mnemonico string, descricao string, etapa string",
    )


def with_mnemonic(df: DataFrame) -> DataFrame:
    """Add the other group's code, description and stage; NULL for foreign codes.

    The dimension is a literal of fixed size, so it is broadcast.
    """
    return df.join(F.broadcast(exam_dimension(df)), "sigla_exame", "left")
