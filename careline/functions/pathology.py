"""Labels read from biopsy and pathology reports."""

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline import fixed_values as V

# Unicode word classes, and "." stopping at "\n" only.
UNICODE = "(?Ud)"
UNICODE_ANY_CASE = "(?iuUd)"

# Repeats that need not give back what they took: what follows never begins with
# the same characters.  The matches stay the same, in time linear in the text.
_REPEATS = (r"\s*", r"\s+", r"\d*", r"\d+", r"[:\-]?", r"/?")


def possessive(pattern: str) -> str:
    """A fixed pattern in its linear form: runs of spaces or digits are taken whole."""
    for repeat in _REPEATS:
        pattern = pattern.replace(repeat, repeat + "+")
    return pattern


_GROUP = re.compile(r"\((?:\?:)?([^()]*)\)([?*{]?)")
_NO_LITERAL = re.compile(r"\[[^\]]*\](?:[*+?]|\{[^}]*\})?|\\[a-zA-Z](?:[*+?]|\{[^}]*\})?|\.(?:\*|\{[^}]*\})\??|\\?[^\n\\][?*]")


def literals(pattern: str) -> list[str]:
    """Pieces of plain text that every match of a fixed pattern holds: signs first, then the longest."""
    plain = re.sub(r"\[(\\[+\-])\](?![*+?{])", r"\1", pattern)
    while _GROUP.search(plain):
        plain = _GROUP.sub(lambda m: "\n" if m[2] or "|" in m[1] else m[1], plain)
    pieces = re.sub(r"\\(.)", r"\1", _NO_LITERAL.sub("\n", plain)).split("\n")
    return sorted({x for x in pieces if len(x) > 1 or not x.isalnum()} - {""}, key=lambda x: (x.isalnum(), -len(x), x))


def holds(text: Column, pattern: str) -> Column:
    """Whether the text holds two plain pieces of the pattern: a cheap look before the search."""
    found = F.lit(True)
    for piece in literals(pattern)[:2]:
        found = found & F.contains(text, F.lit(piece))
    return found


_LONG, _RUN, _PAIR = " " * 64, " " * 8, "  "


def squeezed(text: Column) -> Column:
    """Long runs of spaces made short, but never a single space; patterns that count no characters do not tell the difference."""
    short = F.replace(F.replace(text, F.lit(_LONG), F.lit(_PAIR)), F.lit(_RUN), F.lit(_PAIR))
    return F.when(F.contains(text, F.lit(_RUN)), short).otherwise(text)


def short_lower(c: Column) -> Column:
    """Lower-cased text without long runs of spaces."""
    return F.lower(squeezed(c))


class Lowered(NamedTuple):
    """A report's lower-cased text, and that without long runs of spaces; the pattern functions take it for the text."""
    whole: Column
    short: Column


def lowered(c: Column | Lowered) -> Lowered:
    return c if isinstance(c, Lowered) else Lowered(F.lower(c), short_lower(c))


LOWERED = ("_laudo_inteiro", "_laudo_curto")


def with_lowered(df: DataFrame, text: str) -> tuple[DataFrame, Lowered]:
    """``df`` with a report's lower-cased text in columns of their own, and these columns.

    A branch of a CASE that lower-cases the text does so anew; a column is found once per row.
    Columns that ``df`` already has from here are used.
    """
    whole, short = LOWERED
    if short in df.columns:
        return df, Lowered(F.col(whole), F.col(short))
    df = df.withColumn(short, short_lower(F.col(text)))
    df = df.withColumn(whole, F.when(F.contains(F.col(text), F.lit(_RUN)), F.lower(F.col(text))).otherwise(F.col(short)))
    return df, Lowered(F.col(whole), F.col(short))


# A line that names a breast topography and a carcinoma.  The first line with
# either order decides; only topography-first captures group 1.  Atomic groups
# keep the search linear on very long lines.
_CARCINOMA_LINE = (
    r"(?mi)^(?:(?>.*?Topografia:)(?>.*?MAMA).*(CARCINOMA)"
    r"|(?>.*?(CARCINOMA))(?>.*?Topografia:).*?MAMA)"
)


def raw_carcinoma(c: Column, either_order: bool = False) -> Column:
    """The term as written after "Topografia: ... MAMA" on one line, else ``''``.

    ``either_order`` also accepts the term in front of the topography.
    """
    after = F.regexp_extract(c, _CARCINOMA_LINE, 1)
    if not either_order:
        return after
    return F.concat(after, F.regexp_extract(c, _CARCINOMA_LINE, 2))


def has_carcinoma(c: Column, either_order: bool = False) -> Column:
    """True unless the term is empty; a NULL report is TRUE."""
    return carcinoma_flag(raw_carcinoma(c, either_order))


def carcinoma_flag(raw: Column) -> Column:
    """Flag of an already extracted term, so the pattern runs once per report."""
    return F.when(raw == "", False).otherwise(True)


def carcinoma_phrase(c: Column) -> Column:
    """The whole sentence around the first "carcinoma", ``''`` if there is none."""
    # Anchored at sentence starts: one pass over each sentence.
    return F.trim(F.regexp_extract(c, r"(?i)(?:^|\.)([^.]*?carcinoma[^.]*)", 1))


def malignancy_terms(c: Column | Lowered, terms=V.MALIGNANCY_TERMS) -> Column:
    """Sorted distinct terms present as whole words, any letter case."""
    terms = [t.lower() for t in terms]
    text = lowered(c).whole
    if all(re.fullmatch(r"\w+", t) for t in terms):
        # Single words cannot overlap, so one scan finds them all.
        words, begins = "|".join(re.escape(t) for t in terms), "".join(sorted({t[0] for t in terms}))
        found = F.regexp_extract_all(text, F.lit(rf"{UNICODE}(?=[{begins}])\b({words})\b"), F.lit(1))
    else:
        found = F.array_compact(
            F.array(*[
                F.when(text.rlike(rf"{UNICODE}\b{re.escape(t)}\b"), F.lit(t)) for t in terms
            ])
        )
    return F.coalesce(F.sort_array(F.array_distinct(found)), F.array().cast("array<string>"))


def _number(c: Column | Lowered, pattern: str) -> Column:
    # No match is made NULL first: casting an empty string is a slow failure.
    text = lowered(c).short
    found = F.when(holds(text, pattern), F.regexp_extract(text, UNICODE + possessive(pattern), 1))
    return F.nullif(found, F.lit("")).try_cast("int")


def histologic_grade(c: Column | Lowered) -> Column:
    return _number(c, V.HISTOLOGIC_GRADE)


def nuclear_grade(c: Column | Lowered) -> Column:
    return _number(c, V.NUCLEAR_GRADE)


def tubule_score(c: Column | Lowered) -> Column:
    return _number(c, V.TUBULE_SCORE)


def mitotic_index(c: Column | Lowered, version: int = 2) -> Column:
    """Number before ``mm2``; version 2 also accepts "mitose(s)" in between."""
    return _number(c, V.MITOTIC_INDEX[version])


def histologic_type(c: Column | Lowered, types=V.HISTOLOGIC_TYPES, fixed: bool = False) -> Column:
    """First phrase of the list contained in the report, NULL if none.

    Phrases are compared as plain text, so the two that carry a character class
    never match; ``fixed`` reads the class and returns the plain spelling.
    """
    text = lowered(c).whole if any("  " in phrase for phrase in types) else lowered(c).short
    label = None
    for phrase in types:
        if fixed and phrase in V.HISTOLOGIC_TYPES_PLAIN:
            hit, value = text.rlike(phrase), V.HISTOLOGIC_TYPES_PLAIN[phrase]
        else:
            hit, value = F.contains(text, F.lit(phrase)), phrase
        label = F.when(hit, value) if label is None else label.when(hit, value)
    return label


def pathology_labels(c: Column | Lowered, versions: dict[str, int] | None = None) -> dict[str, Column]:
    """The six labels of a report by field name, missing ones NULL."""
    v = {**V.RULE_VERSIONS["F"], **(versions or {})}
    return dict(zip(V.PATHOLOGY_FIELDS, (
        malignancy_terms(c), histologic_grade(c), nuclear_grade(c),
        tubule_score(c), mitotic_index(c, v["mitotic"]), histologic_type(c),
    )))
