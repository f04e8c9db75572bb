"""Text-mining operators over all reports and over whole documents."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions import answers as A
from careline.functions import category as C
from careline.functions import markers as M
from careline.functions import pathology as P
from careline.operators import cohort
from careline.operators.answers import pseudo_gold
from careline.operators.evaluate import marker_counts
from workloads import fixtures as X
from workloads import sqltext as S
from workloads import texts as T
from workloads.registry import register

TEXT = "laudo_tratado"


def joined(c):
    return F.coalesce(F.array_join(c.cast("array<string>"), "|"), F.lit(""))


def over_reports(name, sql, group="F", **exprs):
    """One projection of all reports: key plus the named functions of the text."""
    cells = ", ".join(f"{s} AS {n}" for n, s in sql.items())

    @register(name, f"SELECT ficha, id_item, {cells} FROM reports", group)
    def query(spark, sf):
        df = X.reports(spark, sf, group, brand=False)
        return df.select("ficha", "id_item", *[e(F.col(TEXT)).alias(n) for n, e in exprs.items()])


_CLEAN = C.clean_category_text
_CLEAN_SQL = r"regexp_replace(upper(laudo_tratado), '[-:®]|\xa0', '', 'g')"
over_reports("category_clean_text", {"limpo": _CLEAN_SQL}, limpo=_CLEAN)
over_reports("category_first_line",
             {"secao": f"regexp_extract({_CLEAN_SQL}, '(?mi)({V.SECTION_HEADERS})?(.*)', 2)"},
             secao=lambda c: C.pick_section(_CLEAN(c)))
over_reports("category_mentions", {"brutos": S.joined(S.category_tokens())},
             brutos=lambda c: joined(C.category_mentions(C.pick_section(_CLEAN(c)))))
over_reports("category_mentions_group_p", {"brutos": S.joined(S.category_tokens(group="P"))}, "P",
             brutos=lambda c: joined(
                 C.category_mentions(C.pick_section(_CLEAN(c)), V.CATEGORY_KEYWORDS["P"])))
over_reports("category_normalised", {"categorias": S.joined(S.categories())},
             categorias=lambda c: joined(C.category_list(c)))
over_reports(
    "category_min_max_last",
    {"MIN_BIRADS": f"list_min({S.categories()})", "MAX_BIRADS": f"list_max({S.categories()})",
     "BIRADS": f"({S.categories()})[-1]"},
    MIN_BIRADS=lambda c: C.category_min(C.category_list(c)),
    MAX_BIRADS=lambda c: C.category_max(C.category_list(c)),
    BIRADS=lambda c: C.category(c),
)
over_reports("category_all_lines", {"BIRADS": f"({S.categories(section='all')})[-1]"},
             BIRADS=lambda c: C.category(c, "all"))
_LAST = rf"regexp_extract(laudo_tratado, '(?is)^(.*)BI-?RADS(.{{0,15}})', %d)"
over_reports(
    "category_documented_rule",
    {"BIRADS": f"TRY_CAST(regexp_extract(right({_LAST % 1}, 5) || ' ' || {_LAST % 2}, '[0-9]') AS INT)"},
    BIRADS=lambda c: C.category(c, "documented"))

_CARCINOMA = V.CARCINOMA_LINE
_RAW = f"regexp_extract(laudo_tratado, '{_CARCINOMA}', 1)"
over_reports("carcinoma_flag",
             {"RAW_CARCINOMA": _RAW, "HAS_CARCINOMA": f"CASE WHEN {_RAW} = '' THEN false ELSE true END"},
             RAW_CARCINOMA=lambda c: P.raw_carcinoma(c), HAS_CARCINOMA=lambda c: P.has_carcinoma(c))
over_reports("carcinoma_flag_either_order",
             {"HAS_CARCINOMA": f"coalesce(regexp_matches(laudo_tratado, '{_CARCINOMA}'), true)"},
             HAS_CARCINOMA=lambda c: P.has_carcinoma(c, either_order=True))
over_reports("carcinoma_phrase", {"frase": "trim(regexp_extract(laudo_tratado, '(?i)[^.]*carcinoma[^.]*'))"},
             frase=lambda c: P.carcinoma_phrase(c))
over_reports("malignancy_terms", {"descritores": S.joined(S.terms())},
             descritores=lambda c: joined(P.malignancy_terms(c)))
over_reports("histologic_grade", {"v": S.number(V.HISTOLOGIC_GRADE)},
             v=lambda c: P.histologic_grade(c))
over_reports("nuclear_grade", {"v": S.number(V.NUCLEAR_GRADE)}, v=lambda c: P.nuclear_grade(c))
over_reports("tubule_score", {"v": S.number(V.TUBULE_SCORE)},
             v=lambda c: P.tubule_score(c))
for _v in (1, 2):
    over_reports(f"mitotic_index_v{_v}", {"v": S.number(V.MITOTIC_INDEX[_v])}, v=lambda c, v=_v: P.mitotic_index(c, v))
over_reports("histologic_type", {"v": S.histologic_type()}, v=lambda c: P.histologic_type(c))
over_reports(
    "histologic_type_fixed",
    {"v": "CASE " + " ".join(
        f"WHEN regexp_matches(lower(laudo_tratado), '{t}') THEN '{V.HISTOLOGIC_TYPES_PLAIN[t]}'"
        if t in V.HISTOLOGIC_TYPES_PLAIN else f"WHEN contains(lower(laudo_tratado), '{t}') THEN '{t}'"
        for t in V.HISTOLOGIC_TYPES) + " END"},
    v=lambda c: P.histologic_type(c, fixed=True))

for _name, _rules, _fn in (("er", V.ER_RULES, M.er_status), ("pr", V.PR_RULES, M.pr_status),
                           ("her2", V.HER2_RULES, M.her2_status), ("ck56", V.CK56_RULES, M.ck56_status)):
    for _v in _rules:
        over_reports(f"{_name}_status_v{_v}", {"status": S.status(_rules[_v])}, status=lambda c, fn=_fn, v=_v: fn(c, v))
for _v in V.KI67_PERCENT:
    over_reports(f"ki67_v{_v}", {"ki67": S.ki67(_v)}, ki67=lambda c, v=_v: M.ki67(c, v))

over_reports("marker_counts", {f"ctg_{m}": S.count(p) for m, p in V.MARKERS.items()},
             **{f"ctg_{m}": lambda c, m=m: M.marker_count(c, m) for m in V.MARKERS})
over_reports("marker_contexts", {f"txt_{m}": S.context(m) for m in V.MARKERS},
             **{f"txt_{m}": lambda c, m=m: M.marker_context(c, m) for m in V.MARKERS})
_RANGE = r"(?i)(\d{1,3}(?:[.,]\d+)?)(?:\s*(?:-|–|a|até)\s*(\d{1,3}(?:[.,]\d+)?))?\s*%"


def _bound(n):
    return f"TRY_CAST(replace(regexp_extract({S.context('ki67')}, '{_RANGE}', {n}), ',', '.') AS DOUBLE)"


over_reports("ki67_range_max", {"maximo": f"greatest({_bound(1)}, {_bound(2)})"},
             maximo=lambda c: M.range_max(M.marker_context(c, "ki67")))
over_reports("text_preview", {"inicio": "substring(laudo_tratado, 1, 100)"}, inicio=lambda c: A.preview(c, 100))
over_reports("lower_text", {"laudo_tratado": "lower(laudo_tratado)"}, laudo_tratado=F.lower)


@register("sorted_terms", f"SELECT ficha, id_item, {S.joined(S.terms())} AS termos FROM reports")
def sorted_terms(spark, sf):
    """Array order does not matter once sorted."""
    df = X.reports(spark, sf, brand=False)
    shuffled = F.reverse(P.malignancy_terms(F.col(TEXT)))
    return df.select("ficha", "id_item", joined(A.sorted_set(shuffled)).alias("termos"))


@register("pseudo_gold_pathology", "SELECT ficha, id_item, " + ", ".join(
    f"{S.joined(s) if k == V.PATHOLOGY_FIELDS[0] else s} AS heu_{k}" for k, s in S.pathology().items())
    + " FROM reports")
def pseudo_gold_pathology(spark, sf):
    df = pseudo_gold(X.reports(spark, sf, brand=False), "pathology")
    first, *rest = [f"heu_{k}" for k in V.PATHOLOGY_FIELDS]
    return df.select("ficha", "id_item", joined(F.col(first)).alias(first), *rest)


@register("pseudo_gold_pathology_text", "SELECT ficha, id_item, " + ", ".join(
    f"{S.joined(s) if k == V.PATHOLOGY_FIELDS[0] else f'coalesce(CAST({s} AS VARCHAR), {chr(39)}NÃO INFORMADO{chr(39)})'} AS heu_{k}"
    for k, s in S.pathology().items()) + " FROM reports")
def pseudo_gold_pathology_text(spark, sf):
    df = pseudo_gold(X.reports(spark, sf, brand=False), "pathology", as_text=True)
    first, *rest = [f"heu_{k}" for k in V.PATHOLOGY_FIELDS]
    return df.select("ficha", "id_item", joined(F.col(first)).alias(first), *rest)


@register("pseudo_gold_ihc", "SELECT ficha, id_item, " + ", ".join(
    f"{s} AS heu_{k}" for k, s in S.ihc().items()) + " FROM reports")
def pseudo_gold_ihc(spark, sf):
    df = pseudo_gold(X.reports(spark, sf, brand=False), "ihc")
    return df.select("ficha", "id_item", *[f"heu_{k}" for k in V.IHC_FIELDS])


_PADDED = "replace(laudo_tratado, ' ', repeat(' ', 400))"


def _padded_labels(reports):
    df = reports.select("ficha", "id_item", F.expr(_PADDED).alias(TEXT))
    out = pseudo_gold(pseudo_gold(df, "ihc"), "pathology")
    return out.select("ficha", "id_item", *[f"heu_{k}" for k in (*V.IHC_FIELDS, *V.PATHOLOGY_FIELDS[1:])])


@register("padded_reports", "SELECT ficha, id_item, " + ", ".join(
    f"{s} AS heu_{k}" for k, s in {**S.ihc(S.T), **{n: s for n, s in S.pathology(S.T).items() if n != V.PATHOLOGY_FIELDS[0]}}.items())
    + f" FROM (SELECT ficha, id_item, {_PADDED} AS laudo_tratado FROM reports)")
def padded_reports(spark, sf):
    """Every pattern label of reports whose words stand 400 spaces apart."""
    return _padded_labels(X.reports(spark, sf, brand=False))


# The prose has accented letters next to short words: the oracle replaces them by
# a plain letter, so its ASCII word boundary sees what a Unicode one sees.
_PLAIN = (r"regexp_replace(regexp_replace(lower(laudo_tratado), 'estr[oó]g([eê]nio|eno)', 'estrogeno', 'g'), "
          r"'[^\P{L}a-z]', 'x', 'g')")


@register("marker_counts_loose", "SELECT ficha, id_item, " + ", ".join(
    f"CAST(coalesce(len(regexp_extract_all({_PLAIN}, '{p}')), 0) AS INT) AS ctg_{m}" for m, p in V.MARKERS_LOOSE.items())
    + " FROM reports")
def marker_counts_loose(spark, sf):
    df = marker_counts(X.reports(spark, sf, brand=False))
    return df.select("ficha", "id_item", *[f"ctg_{m}" for m in V.MARKERS_LOOSE])


def over_documents(name, items, sql, **exprs):
    cells = ", ".join(f"{s} AS {n}" for n, s in sql.items())

    @register(name, f"SELECT doc_id, {cells} FROM {X.oracle_documents(items)}")
    def query(spark, sf):
        df = X.report_documents(spark, sf, items)
        return df.select("doc_id", *[e(F.col(TEXT)).alias(n) for n, e in exprs.items()])


over_documents("document_marker_counts", T.IHC_TEXTS,
               {f"ctg_{m}": f"CAST(coalesce(len(regexp_extract_all({_PLAIN}, '{p}')), 0) AS INT)"
                for m, p in V.MARKERS_LOOSE.items()},
               **{f"ctg_{m}": lambda c, m=m: M.marker_count(c, m, V.MARKERS_LOOSE)
                  for m in V.MARKERS_LOOSE})
over_documents("document_ihc_labels", T.IHC_TEXTS, S.ihc(), **{k: lambda c, k=k: M.ihc_labels(c)[k] for k in V.IHC_FIELDS})
over_documents("document_marker_contexts", T.IHC_TEXTS, {f"txt_{m}": S.context(m) for m in V.MARKERS},
               **{f"txt_{m}": lambda c, m=m: M.marker_context(c, m) for m in V.MARKERS})
_WORDS = ("the", "of", "and", "les", "une", "und", "der", "los", "que")
over_documents("document_terms", T.PATHOLOGY_TEXTS, {"termos": S.joined(S.terms(words=_WORDS))},
               termos=lambda c: joined(P.malignancy_terms(c, _WORDS)))
_PATHOLOGY_SQL = S.pathology()
_PATHOLOGY_SQL["descritores_malignidade"] = S.joined(_PATHOLOGY_SQL["descritores_malignidade"])
_PATHOLOGY = {k: lambda c, k=k: P.pathology_labels(c)[k] for k in V.PATHOLOGY_FIELDS}
_PATHOLOGY["descritores_malignidade"] = lambda c: joined(P.malignancy_terms(c))
over_documents("document_pathology_labels", T.PATHOLOGY_TEXTS, _PATHOLOGY_SQL, **_PATHOLOGY)
over_documents("document_carcinoma", T.BIOPSY_TEXTS, {"RAW_CARCINOMA": _RAW,
               "frase": "trim(regexp_extract(laudo_tratado, '(?i)[^.]*carcinoma[^.]*'))"},
               RAW_CARCINOMA=lambda c: P.raw_carcinoma(c), frase=lambda c: P.carcinoma_phrase(c))
over_documents("document_categories", T.CATEGORY_TEXTS, {"categorias": S.joined(S.categories(section="all"))},
               categorias=lambda c: joined(C.category_list(c, section="all")))
_GATE = ("tion", "ent", "ung", "que")
over_documents("document_gate", T.PATHOLOGY_TEXTS,
               {"passa": "regexp_matches(laudo_tratado, '(?i)(tion|ent|ung|que)')"},
               passa=lambda c: cohort.gate_flag(c, _GATE))
