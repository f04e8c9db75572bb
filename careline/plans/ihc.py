"""Stage 4: immunohistochemistry markers, subtype and comparison."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from careline import fixed_values as V
from careline.functions.pathology import with_lowered
from careline.operators.answers import (
    IHC_SCHEMA,
    TEXT,
    explode_samples,
    parse_answers,
    pseudo_gold,
    with_ki67_number,
    with_subtype,
)
from careline.operators.cohort import female_only, for_care_line, mentions_all, with_exam_codes
from careline.operators.evaluate import compare, with_mentions
from careline.operators.increment import since
from careline.operators.joins import join_keys
from careline.sources.tables import all_but


def ihc_reports(reports: DataFrame, group: str = "F", target: DataFrame | None = None) -> DataFrame:
    """Reports the stage reads; group P starts after the mark."""
    df = since(reports, target, inclusive=group == "F")
    df = with_exam_codes(for_care_line(df), "ihc", group)
    return mentions_all(female_only(df))


def ihc_gold(reports: DataFrame, group: str = "F", versions: dict[str, int] | None = None,
             sheet: bool = False, keep_text: bool = False) -> DataFrame:
    """Reports with their pattern markers, and for a ``sheet`` the mentions, in place of the text.

    The pattern versions are the group's; ``versions`` replaces single ones.
    """
    chosen = {**V.RULE_VERSIONS[group], **(versions or {})}
    if sheet:
        reports = with_mentions(with_lowered(reports, TEXT)[0])
    df = pseudo_gold(reports, "ihc", versions=chosen)
    return df if keep_text else all_but(df, TEXT)


def ihc_subtypes(reports: DataFrame, answers: DataFrame, group: str = "F",
                 samples: bool = False, languages=("python", "json"),
                 keys: Sequence[str] | None = None, literal: bool = False) -> DataFrame:
    """Five markers, Ki-67 as a number and the subtype, per report or per sample.

    Answers are JSON, or Python literals with ``literal``; ``keys`` replaces the
    group's report keys.  Give ``ihc_gold(reports)`` to compare afterwards: the
    patterns then run once per report, below the join and the samples.
    """
    df = join_keys(reports, answers, keys or V.REPORT_KEYS[group])
    if samples:
        df = explode_samples(df, languages=languages, literal=literal)
    else:
        df = parse_answers(df, IHC_SCHEMA, languages=languages, literal=literal)
    return with_subtype(with_ki67_number(df))


def ihc_comparison(labelled: DataFrame, group: str = "F",
                   versions: dict[str, int] | None = None) -> DataFrame:
    """Answer markers against pattern markers, a flag per field.

    Pattern markers are those of ``ihc_gold``; rows that still carry the text
    instead get them here.
    """
    if f"heu_{V.IHC_FIELDS[0]}" not in labelled.columns:
        labelled = ihc_gold(labelled, group, versions, keep_text=True)
    return compare(labelled, V.IHC_FIELDS, "strict", numeric=("ki67_percentual",))
