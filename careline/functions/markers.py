"""Marker status read from immunohistochemistry reports."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions.pathology import UNICODE, UNICODE_ANY_CASE, Lowered, holds, literals, lowered, possessive


def linear_form(pattern: str) -> str:
    """``head.*?tail`` as a pattern that tries one head per line.

    The gap ends at a line break, so if the first head of a line finds no tail,
    no later head of that line does.  A head that itself spans a line break is
    the last of its line and is tried too.  Signs and spaces in front of a value
    belong to the gap; only spaces that begin with the line break end it.
    """
    head, tail = pattern.split(".*?", 1)
    gap, loose = ".*?", r"[:\-]?\s*"
    if tail.startswith(loose):
        gap, tail = r"(?:.*?|.*+\n\s*+)", tail[len(loose):]
    inline = head.replace(r"[-\s]", r"[-\s&&[^\n]]").replace(r"\s*", r"[\s&&[^\n]]*+")
    return rf"(?m)(?:^(?:(?!{inline}).)*+{inline}|(?!{inline}){possessive(head)}){gap}{possessive(tail)}"


def _search(c: Column | Lowered, pattern: str, use) -> Column:
    """``use(text, pattern)`` on lower-cased text in linear form, only where the pattern's plain pieces are there at all.

    The pieces are looked up in text without long runs of spaces, which is searched too unless the pattern
    counts characters.
    """
    whole, short = lowered(c)
    linear = linear_form(pattern) if ".*?" in pattern else possessive(pattern)
    return F.when(holds(short, pattern), use(whole if ".{" in pattern else short, UNICODE + linear))


def status_by_rules(c: Column | Lowered, rules) -> Column:
    """Label of the first rule that fires, else the not-stated sentinel.

    Rules are searched in lower-cased text, which lets the literal start of a
    pattern be found by fast substring search.
    """
    branches = []
    for pattern, label in rules:
        if isinstance(label, dict):
            pairs = [F.lit(x) for pair in label.items() for x in pair]
            found = _search(c, pattern, lambda t, p: F.regexp_extract(t, p, 1))
            branches.append(F.try_element_at(F.create_map(*pairs), found))
        else:
            branches.append(F.when(_search(c, pattern, Column.rlike), F.lit(label)))
    return F.coalesce(*branches, F.lit(V.NOT_STATED))


def er_status(c: Column | Lowered, version: int = 2) -> Column:
    """Oestrogen receptor."""
    return status_by_rules(c, V.ER_RULES[version])


def pr_status(c: Column | Lowered, version: int = 2) -> Column:
    """Progesterone receptor; 2 tests positive first, 3 the direct form and then negative first."""
    return status_by_rules(c, V.PR_RULES[version])


def her2_status(c: Column | Lowered, version: int = 2) -> Column:
    return status_by_rules(c, V.HER2_RULES[version])


def ck56_status(c: Column | Lowered, version: int = 2) -> Column:
    return status_by_rules(c, V.CK56_RULES[version])


def _decimal(found: Column) -> Column:
    """Matched digits with comma or point as a double, NULL for an empty match."""
    return F.replace(F.nullif(found, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def ki67(c: Column | Lowered, version: int = 2) -> Column:
    """First percentage after Ki-67, 0.0 if there is none."""
    found = _search(c, V.KI67_PERCENT[version], lambda t, p: F.regexp_extract(t, p, 1))
    return F.coalesce(_decimal(found), F.lit(0.0))


def ihc_labels(c: Column | Lowered, versions: dict[str, int] | None = None) -> dict[str, Column]:
    """The five markers of a report by field name."""
    v = {**V.RULE_VERSIONS["F"], **(versions or {})}
    return dict(zip(V.IHC_FIELDS, (
        er_status(c, v["er"]), pr_status(c, v["pr"]), her2_status(c, v["her2"]),
        ki67(c, v["ki67"]), ck56_status(c, v["ck56"]),
    )))


def marker_count(c: Column, marker: str, patterns=V.MARKERS) -> Column:
    """Occurrences of one marker in the report."""
    count = F.regexp_count(F.lower(c), F.lit(UNICODE + possessive(patterns[marker])))
    return F.coalesce(count, F.lit(0))


def marker_context(c: Column, marker: str, n: int = V.CONTEXT_CHARS, patterns=V.MARKERS) -> Column:
    """The ``n`` characters after the first mention, stripped; ``''`` if not mentioned."""
    after = F.regexp_extract(c, rf"(?s){UNICODE_ANY_CASE}{possessive(patterns[marker])}(.{{0,{n}}})", 1)
    return F.coalesce(F.regexp_replace(after, r"(?U)^\s+|\s+$", ""), F.lit(""))


def mention_scan(c: Column, patterns=V.MARKERS, n: int = V.CONTEXT_CHARS, low: Lowered | None = None) -> Column:
    """All mentions of all markers in one search: an array of (marcador, trecho) in the order of the text.

    ``trecho`` is the mention with the ``n`` characters after it; only these short pieces are looked
    at again to tell the markers apart.  ``low`` is the text's lower-cased form, if there are columns of it.
    """
    any_of = "|".join(f"(?:{possessive(p)})" for p in patterns.values())
    # A cheap look at the letter that may begin a mention goes first.
    begins = "".join(sorted({letter for p in patterns.values() for letter in re.findall(r"(?:\\b|\(\?:|\|)([a-z])", p)}))
    # The piece is captured ahead, so a context does not hide the mentions in it.
    search = rf"{UNICODE_ANY_CASE}(?=[{begins}])(?=((?:{any_of})(?s:.{{0,{n}}})))."
    found = F.when(_may_mention(low or c, patterns), F.regexp_extract_all(c, F.lit(search), F.lit(1)))
    pieces = F.coalesce(found, F.array().cast("array<string>"))
    return F.filter(F.transform(pieces, lambda p: F.struct(_marker_of(p, patterns).alias("marcador"), p.alias("trecho"))),
                    lambda m: m["marcador"].isNotNull())


def _may_mention(c: Column | Lowered, patterns) -> Column:
    """False only where no marker can be found: a cheap look for the plain pieces of a pattern.

    i, k and s have further forms that any-case patterns accept and lower-casing keeps; pieces end there.
    """
    text, found = lowered(c).short, F.lit(False)
    for p in patterns.values():
        pieces = sorted({x for piece in literals(p) for x in re.split("[iks]", piece) if x}, key=len, reverse=True)
        # a pattern without a piece may stand anywhere
        holds_all = F.lit(True)
        for piece in pieces:
            holds_all = holds_all & F.contains(text, F.lit(piece))
        found = found | holds_all
    return found


_MENTION_CHARS = 40


def _marker_of(piece: Column, patterns) -> Column:
    """The marker that a piece begins with; its first characters nearly always tell."""

    def first_hit(low: Column) -> Column:
        found = None
        for name, pattern in patterns.items():
            hit = low.rlike(rf"{UNICODE}^(?:{possessive(pattern)})")
            found = F.when(hit, name) if found is None else found.when(hit, name)
        return found

    head = F.lower(F.substring(piece, 1, _MENTION_CHARS))
    return F.coalesce(F.transform(F.array(head), first_hit)[0],
                      F.when(F.char_length(piece) > _MENTION_CHARS, F.transform(F.array(F.lower(piece)), first_hit)[0]))


def scanned_count(scan: Column, marker: str) -> Column:
    """Mentions of one marker in a scan."""
    return F.size(F.filter(scan, lambda m: m["marcador"] == marker))


def scanned_context(scan: Column, marker: str, patterns=V.MARKERS) -> Column:
    """What follows the first mention of one marker in a scan, stripped; ``''`` if there is none."""
    first = F.try_element_at(F.filter(scan, lambda m: m["marcador"] == marker), F.lit(1))["trecho"]
    after = F.regexp_replace(first, rf"{UNICODE_ANY_CASE}^(?:{possessive(patterns[marker])})\s*+|\s+$", "")
    return F.coalesce(after, F.lit(""))


_NUMBER = r"(\d{1,3}(?:[.,]\d+)?)"
_PERCENT_RANGE = rf"(?iu){_NUMBER}(?:\s*(?:-|–|a|até)\s*{_NUMBER})?\s*%"


def _bound(c: Column, group: int) -> Column:
    return _decimal(F.regexp_extract(c, _PERCENT_RANGE, group))


def range_max(c: Column) -> Column:
    """First percentage of a text; the upper value when it is a range ("20-30%")."""
    return F.greatest(_bound(c, 1), _bound(c, 2))


def has_percent_range(c: Column) -> Column:
    """True when the first percentage of a text is a range."""
    return F.coalesce(_bound(c, 2).isNotNull(), F.lit(False))
