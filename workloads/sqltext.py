"""Oracle spellings of the text rules, written for the other regex engine."""

from careline import fixed_values as V

T = "laudo_tratado"


def category_tokens(text=T, group="F", section="reference"):
    clean = rf"regexp_replace(upper({text}), '[-:®]|\xa0', '', 'g')"
    if section == "reference":
        clean = f"regexp_extract({clean}, '(?mi)({V.SECTION_HEADERS})?(.*)', 2)"
    kw = V.CATEGORY_KEYWORDS[group]
    pattern = rf"(?mi)({kw}|CAT\W)\s*({V.CATEGORY_VALUES})\W*\w?({kw})?(\W|$)"
    return f"regexp_extract_all({clean}, '{pattern}', 2)"


def categories(text=T, group="F", section="reference"):
    return (
        f"list_filter(list_transform({category_tokens(text, group, section)}, lambda x: CASE x "
        "WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 WHEN 'IV' THEN 4 WHEN 'V' THEN 5 WHEN 'VI' THEN 6 "
        "ELSE CASE WHEN TRY_CAST(x AS INT) > 6 THEN NULL "
        "ELSE TRY_CAST(regexp_replace(x, '[^0-9]', '', 'g') AS INT) END END), lambda x: x IS NOT NULL)"
    )


def status(rules, text=T):
    low, cases = f"lower({text})", []
    for pattern, label in rules:
        if isinstance(label, dict):
            cases += [f"WHEN regexp_extract({low}, '{pattern}', 1) = '{k}' THEN '{v}'" for k, v in label.items()]
        else:
            cases.append(f"WHEN regexp_matches({low}, '{pattern}') THEN '{label}'")
    return "CASE " + " ".join(cases) + f" ELSE '{V.NOT_STATED}' END"


def ki67(version=2, text=T):
    return (f"coalesce(TRY_CAST(replace(regexp_extract(lower({text}), '{V.KI67_PERCENT[version]}', 1), "
            "',', '.') AS DOUBLE), 0.0)")


def number(pattern, text=T):
    return f"TRY_CAST(regexp_extract(lower({text}), '{pattern}', 1) AS INT)"


def terms(text=T, words=V.MALIGNANCY_TERMS):
    # Unicode word boundaries spelled out; constant patterns compile once.
    items = ", ".join(
        rf"CASE WHEN regexp_matches(lower({text}), '(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|$)') THEN '{w}' END"
        for w in words)
    return f"list_sort(list_filter([{items}], lambda w: w IS NOT NULL))"


def joined(expr):
    return f"coalesce(array_to_string({expr}, '|'), '')"


def histologic_type(text=T):
    return "CASE " + " ".join(
        f"WHEN contains(lower({text}), '{t}') THEN '{t}'" for t in V.HISTOLOGIC_TYPES) + " END"


def count(pattern, text=T):
    return f"CAST(coalesce(len(regexp_extract_all(lower({text}), '{pattern}')), 0) AS INT)"


def context(marker, n=100, text=T):
    return (f"coalesce(trim(regexp_extract({text}, '(?is){V.MARKERS[marker]}(.{{0,{n}}})', 1), "
            "' ' || chr(10) || chr(9) || chr(13)), '')")


def pathology(text=T, mitotic=2):
    return dict(zip(V.PATHOLOGY_FIELDS, (
        terms(text), number(V.HISTOLOGIC_GRADE, text), number(V.NUCLEAR_GRADE, text),
        number(V.TUBULE_SCORE, text), number(V.MITOTIC_INDEX[mitotic], text), histologic_type(text))))


def ihc(text=T, v=2):
    return dict(zip(V.IHC_FIELDS, (
        status(V.ER_RULES[v], text), status(V.PR_RULES[v], text), status(V.HER2_RULES[v], text),
        ki67(v, text), status(V.CK56_RULES[v], text))))
