"""Stage 3: pathology labels of answers against pattern labels."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from careline import fixed_values as V
from careline.operators.answers import (
    PATHOLOGY_SCHEMA,
    TEXT,
    fill_sentinel,
    parse_answers,
    pseudo_gold,
    safe_ints,
)
from careline.operators.cohort import (
    female_only,
    for_care_line,
    lower_text,
    mentions,
    with_exam_codes,
)
from careline.operators.evaluate import compare
from careline.operators.increment import since
from careline.operators.joins import join_keys
from careline.operators.typed import compare_typed, with_variant
from careline.sources.tables import all_but

NUMBERS = V.PATHOLOGY_FIELDS[1:5]


def pathology_reports(reports: DataFrame, group: str = "F",
                      target: DataFrame | None = None) -> DataFrame:
    """Reports the stage reads; group P lower-cases them and has no sex rule."""
    df = with_exam_codes(for_care_line(since(reports, target, inclusive=True)), "pathology", group)
    if group == "P":
        return lower_text(mentions(df))
    return mentions(female_only(df))


def pathology_typed(reports: DataFrame, answers: DataFrame, group: str = "F", keys: Sequence[str] | None = None,
                    languages=("python", "json"), pick_object: bool = False) -> DataFrame:
    """Answers as variants against pattern labels in their own types, and a flag per field.

    Patterns run on the report scan and answers are parsed below the join, so neither text is shuffled.
    """
    gold = all_but(pseudo_gold(reports, "pathology", versions=V.RULE_VERSIONS[group]), TEXT)
    df = join_keys(gold, with_variant(answers, languages=languages, pick_object=pick_object), keys or V.REPORT_KEYS[group])
    return compare_typed(df, V.PATHOLOGY_FIELDS)


def pathology_labels(reports: DataFrame, answers: DataFrame, rule: str = "sentinel",
                     group: str = "F", keys: Sequence[str] | None = None,
                     languages=("python", "json"), literal: bool = False,
                     keep_text: bool = False) -> DataFrame:
    """Answer labels, pattern labels and a flag per field.

    ``answers`` has the report keys (``keys``, by default the group's) and
    ``resposta_llm``, in JSON or as Python literals.  The patterns run on the
    report scan; the text goes through the join only if it is to be kept.
    """
    text = rule in ("sentinel", "strict")
    gold = pseudo_gold(reports, "pathology", as_text=text, versions=V.RULE_VERSIONS[group])
    df = join_keys(gold if keep_text else all_but(gold, TEXT), answers, keys or V.REPORT_KEYS[group])
    df = parse_answers(df, PATHOLOGY_SCHEMA, languages=languages, pick_object=rule == "sentinel", literal=literal)
    if text:
        df = fill_sentinel(df, V.PATHOLOGY_FIELDS)
    else:
        df = safe_ints(df, NUMBERS)
        if rule == "null_miss":
            df = fill_sentinel(df, (V.PATHOLOGY_FIELDS[0], V.PATHOLOGY_FIELDS[5]))
    return compare(df, V.PATHOLOGY_FIELDS, rule)
