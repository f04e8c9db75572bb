"""Prompt text and model-answer text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from careline import fixed_values as V


def render(template: str, c: Column) -> Column:
    """Put the report in the template's ``%s``; a literal ``%`` is written ``%%``."""
    return F.format_string(template, c)


def render_concat(prefix: str, c: Column, suffix: str) -> Column:
    return F.concat(F.lit(prefix), c, F.lit(suffix))


def render_replace(template: str, c: Column, placeholder: str = "{laudo_texto}") -> Column:
    """Literal replacement, so ``$`` and backslashes in a report are kept."""
    return F.replace(F.lit(template), F.lit(placeholder), c)


def strip_fences(c: Column, languages=("python", "json")) -> Column:
    """Remove code-fence markers with or without one of the languages, then trim."""
    marks = "|".join([f"```{name}" for name in languages] + ["```"])
    fenced = F.contains(c, F.lit("```"))
    return F.trim(F.when(fenced, F.regexp_replace(c, marks, "")).otherwise(c))


def first_object(c: Column) -> Column:
    """First ``{...}`` with something in it, up to the first closing brace, ``''`` if none."""
    # Anchored: if the first opening brace finds no closing one, no later one does.
    return F.regexp_extract(c, r"^(?:[^{]|\{\})*+(\{[^}]++\})", 1)


def parse_literal(c: Column, schema) -> Column:
    """Python-literal text to a struct; anything unreadable gives NULL fields.

    Bare None/True/False are rewritten first; ``\\G`` walks over quoted strings,
    so the same words inside a string stay as they are.
    """
    text = c
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        first, rest = word[0], word[1:]
        walked = (
            rf"[^'\"{first}]++"
            r"|'(?:[^'\\]++|\\.)*+'"
            r'|"(?:[^"\\]++|\\.)*+"'
            rf"|{first}(?!{rest}\b)"
        )
        text = F.regexp_replace(text, rf"\G((?:{walked})*+){word}\b", f"$1{json_word}")
    return F.from_json(text, schema, {
        "allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
    })


def int_or_null(c: Column) -> Column:
    """Sentinel (any case, with or without accent) or text that is no number: NULL; else int."""
    digits = F.regexp_extract(c, r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*$", 1)
    stated = ~F.lower(c).isin(*V.NOT_STATED_SPELLINGS) & (digits != "")
    return F.when(stated, digits).try_cast("int")


def float_or_zero(c: Column) -> Column:
    """A text as a number, 0.0 when it is none."""
    # Text that cannot start a number is left out: a failing cast is slow.
    number = F.when(c.rlike(r"^\s*[+-]?(?:[0-9.]|(?i:nan|inf))"), c)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def number_or_zero(c: Column) -> Column:
    """A text that is a decimal number, infinity or NaN as a number, everything else 0.0."""
    plain = c.rlike(r"^\s*[+-]?(?i:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|inf|infinity)\s*$")
    return F.coalesce(F.when(plain, F.trim(c)).try_cast("double"), F.lit(0.0))


def sorted_set(c: Column) -> Column:
    """Array in sorted order, for order-free comparison; NULL counts as empty."""
    return F.sort_array(F.coalesce(c, F.array().cast("array<string>")))


def preview(c: Column, n: int = 100) -> Column:
    return F.substring(c, 1, n)
