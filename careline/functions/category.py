"""Imaging category (0-6) read from a mammogram report."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from careline import fixed_values as V


def clean_category_text(c: Column) -> Column:
    """Upper-case the report and delete hyphens, colons, (R) signs and no-break spaces."""
    return F.regexp_replace(F.upper(c), V.CATEGORY_NOISE, "")


def pick_section(c: Column, section: str = "reference") -> Column:
    """First line minus a header it starts with; ``section="all"`` keeps every line."""
    if section == "all":
        return c
    if section != "reference":
        raise ValueError(f"unknown section rule: {section}")
    return F.regexp_extract(c, rf"(?mi)({V.SECTION_HEADERS})?(.*)", 2)


def category_mentions(c: Column, keywords: str = V.CATEGORY_KEYWORDS["F"]) -> Column:
    """Every category token after a keyword, in text order (``4A``, ``III``, ...).

    The optional trailing keyword takes a directly following mention with it:
    "BIRADS 4A. CATEGORIA IV" yields only ``4A``.
    """
    pattern = rf"(?mi)({keywords}|CAT\W)\s*({V.CATEGORY_VALUES})\W*\w?({keywords})?(\W|$)"
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(2))


def normalise_categories(tokens: Column) -> Column:
    """Roman to arabic, whole numbers above 6 dropped, digits of the rest as INT.

    ``10`` is dropped but ``10A`` keeps its digits and becomes 10.
    """

    def to_int(token: Column) -> Column:
        value = None
        for roman, number in V.ROMAN_VALUES.items():
            branch = token == roman
            value = F.when(branch, number) if value is None else value.when(branch, number)
        # Only whole numbers are cast: a failing cast is far slower than the test.
        whole = F.when(token.rlike("^[0-9]+$"), token).try_cast("int")
        return value.when(whole > V.HIGHEST_CATEGORY, F.lit(None)).otherwise(
            F.regexp_replace(token, "[^0-9]", "").try_cast("int")
        )

    return F.filter(F.transform(tokens, to_int), lambda x: x.isNotNull())


def category_list(c: Column, group: str = "F", section: str = "reference") -> Column:
    """Normalised categories of a raw report text."""
    text = pick_section(clean_category_text(c), section)
    return normalise_categories(category_mentions(text, V.CATEGORY_KEYWORDS[group]))


def category_min(categories: Column) -> Column:
    return F.array_min(categories)


def category_max(categories: Column) -> Column:
    return F.array_max(categories)


def category_last(categories: Column) -> Column:
    return F.try_element_at(categories, F.lit(-1))


def documented_category(c: Column) -> Column:
    """Last "BI-RADS" mention; first digit from 5 characters before it to 15 after."""
    # The greedy prefix runs to the last mention.
    pattern = rf"(?is)^(.*)BI-?RADS(.{{0,{V.DOCUMENTED_AFTER}}})"
    before = F.right(F.regexp_extract(c, pattern, 1), F.lit(V.DOCUMENTED_BEFORE))
    window = F.concat(before, F.lit(" "), F.regexp_extract(c, pattern, 2))
    return F.nullif(F.regexp_extract(window, r"[0-9]", 0), F.lit("")).try_cast("int")


def category(c: Column, rule: str = "reference", group: str = "F") -> Column:
    """One category per report: last of the first line, of all lines, or the documented rule."""
    if rule == "documented":
        return documented_category(c)
    section = {"reference": "reference", "all": "all"}[rule]
    return category_last(category_list(c, group, section))
