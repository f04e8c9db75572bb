import random
import re
import time

import pytest
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions import markers as M
from careline.functions import pathology as L

P, N, I, X = V.POSITIVE, V.NEGATIVE, V.INCONCLUSIVE, V.NOT_STATED


def test_er_versions(apply):
    texts = ["RECEPTOR DE ESTRÓGENO - POSITIVO", "receptor de estrogênio: negativo", "ER+alto", "er-x",
             "ER+ ", "receptor de estrogegenio positivo", None]
    assert apply(M.er_status, texts) == [P, N, P, N, X, X, X]
    assert apply(lambda c: M.er_status(c, 1), texts) == [X, X, P, N, X, P, X]


def test_pr_versions_and_distance(apply):
    head = "receptor de progesterona"
    texts = [f"{head}{'x' * 44} positivo", f"{head}{'x' * 45} positivo", f"{head}{'x' * 59} negativo",
             f"{head}{'x' * 60} negativo", f"{head} - NEGATIVO (controle interno positivo)", f"{head}: positivo"]
    assert apply(lambda c: M.pr_status(c, 1), texts) == [X, X, X, X, N, P]
    assert apply(M.pr_status, texts) == [P, X, X, X, P, P]
    assert apply(lambda c: M.pr_status(c, 3), texts) == [P, P, N, X, N, P]


def test_her2_versions(apply):
    texts = ["HER-2 - ESCORE 0", "her2 escore: 1+", "HER 2 escore 2+", "HER-2 ESCORE 3+", "HER2 score 3+",
             "her-2: positivo", "HER2 negativo; escore 3+", "HER2 3+x", "HER2 3+ ", "her2 escore 2", "x"]
    assert apply(lambda c: M.her2_status(c, 1), texts) == [N, N, I, P, X, X, P, P, X, X, X]
    assert apply(M.her2_status, texts) == [N, N, I, P, P, P, N, P, X, X, X]
    assert apply(lambda c: M.her2_status(c, 3), texts) == [N, N, I, P, P, P, P, P, X, X, X]


def test_ki67_versions(apply):
    texts = ["Ki-67: 20%", "KI67 15,5 %", "ki 67 em 7.5%", "KI67" + "x" * 100 + "9%", "KI67" + "x" * 101 + "9%",
             "Ki-67 sem valor", None]
    assert apply(M.ki67, texts) == [20.0, 15.5, 7.5, 9.0, 0.0, 0.0, 0.0]
    assert apply(lambda c: M.ki67(c, 1), texts) == [20.0, 5.0, 7.5, 9.0, 9.0, 0.0, 0.0]


def test_ck56_versions(apply):
    texts = ["CK5/6 - POSITIVO", "ck5 / 6 negativo, controle positivo", "CK5/6+x", "CK5/6-x",
             "CK5/6" + " " * 70 + "negativo", "CK5/6" + " " * 71 + "negativo", "CK5/6 nada"]
    assert apply(lambda c: M.ck56_status(c, 1), texts) == [P, P, P, N, N, N, X]
    assert apply(M.ck56_status, texts) == [P, N, P, N, N, X, X]


def test_counts_and_contexts(apply):
    texts = ["HER2 a. her2 b. xher2", "KI67" + "\n" + "a" * 120, "", None]
    assert apply(lambda c: M.marker_count(c, "her2"), texts) == [2, 0, 0, 0]
    assert apply(lambda c: M.marker_context(c, "her2"), texts) == ["a. her2 b. xher2", "", "", ""]
    assert apply(lambda c: M.marker_context(c, "ki67"), texts) == ["", "a" * 99, "", ""]


def test_range_upper_value(apply):
    texts = ["em 20-30% das", "20 a 30 %", "15%", "3,5 até 7,5%", "sem", None]
    assert apply(M.range_max, texts) == [30.0, 30.0, 15.0, 7.5, None, None]
    assert apply(M.has_percent_range, texts) == [True, True, False, True, False, False]


def _first_rule(text, rules):
    low = text.lower()
    for pattern, label in rules:
        found = re.search(pattern, low)
        if found and isinstance(label, str):
            return label
        if found and found.group(1) in label:
            return label[found.group(1)]
    return X


ALL_RULES = [(f"{n}{v}", rules) for n, by in (("er", V.ER_RULES), ("pr", V.PR_RULES), ("her2", V.HER2_RULES),
                                               ("ck56", V.CK56_RULES)) for v, rules in by.items()]


@pytest.mark.parametrize("rules", [r for _, r in ALL_RULES], ids=[n for n, _ in ALL_RULES])
def test_rules_agree_with_another_regex_engine(apply, rules):
    """Random report pieces, with no-break spaces, accents and line breaks."""
    rng = random.Random(11)
    parts = ["receptor de estrógeno", "RECEPTOR DE ESTROGÊNIO", "receptor  de progesterona*", "HER-2", "her2",
             "HER 2", "CK5/6", "ck5 / 6", "her\n2", "ck5\n/ 6", "ER", "pr", "+", "-", ": ", " escore ", "SCORE", "0", "1+", "2+", "3+", "2",
             " positivo", " NEGATIVO", "positivo", "é", "ç", "\n", "\r", " ", ". ", " x" * 20, "células "]
    texts = ["".join(rng.choices(parts, k=rng.randint(2, 12))) for _ in range(4000)]
    got = apply(lambda c: M.status_by_rules(c, rules), texts)
    wrong = [(t, g) for t, g in zip(texts, got) if g != _first_rule(t, rules)]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("version", [1, 2])
def test_ki67_agrees_with_another_regex_engine(apply, version):
    rng = random.Random(5)
    parts = ["ki67", "KI-67", "ki\n67", "ki 67", "20", "5", ",", ".", "%", " %", "-", ": ", "x" * 30, "\n", " em ", "100", " \n ", "   ", " \n\n: ", "1.1", "12.345", "\xa0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(2, 12))) for _ in range(4000)]

    def expected(t):
        m = re.search(V.KI67_PERCENT[version], t.lower())
        return float(m.group(1).replace(",", ".")) if m else 0.0

    assert apply(lambda c: M.ki67(c, version), texts) == [expected(t) for t in texts]


@pytest.mark.parametrize("marker", list(V.MARKERS))
def test_counts_and_contexts_agree_with_another_regex_engine(apply, marker):
    rng = random.Random(3)
    parts = ["receptor de estrógeno", "Receptor de Progesterona", "her2", "HER2", "ck5/6", "KI-67", "er", "é", " ",
             " ", "\n", "\t", ".", "x", "y" * 40]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    for patterns in (V.MARKERS, V.MARKERS_LOOSE):
        rx = re.compile(patterns[marker], re.IGNORECASE)
        assert apply(lambda c: M.marker_count(c, marker, patterns), texts) == [len(rx.findall(t)) for t in texts]
    rx = re.compile(V.MARKERS[marker], re.IGNORECASE)

    def context(t):
        m = rx.search(t)
        return t[m.end():m.end() + 100].strip() if m else ""

    assert apply(lambda c: M.marker_context(c, marker), texts) == [context(t) for t in texts]


def test_many_mentions_on_one_long_line(apply):
    """Open gaps cost linear time however often a marker is named."""
    texts = ["her2 " * 100_000, "ki67 " * 100_000, "ck5/6 " * 100_000, "her2 " * 50_000 + "escore 3+"]
    start = time.time()
    assert apply(M.her2_status, texts) == [X, X, X, P]
    assert apply(lambda c: M.ki67(c, 1), texts) == [0.0] * 4
    assert apply(lambda c: M.ck56_status(c, 1), texts) == [X] * 4
    assert time.time() - start < 40


HEADS = {"er": ["receptor de estrogênio", "er"], "pr": ["receptor de progesterona", "pr"], "her2": ["her2", "her-2 escore", "her 2 score"],
         "ck56": ["ck5/6", "ck5 / 6"], "ki67": ["ki67", "ki-67 1"]}
STATUS = {"er": (M.er_status, V.ER_RULES), "pr": (M.pr_status, V.PR_RULES), "her2": (M.her2_status, V.HER2_RULES), "ck56": (M.ck56_status, V.CK56_RULES)}


@pytest.mark.parametrize("name", list(HEADS))
def test_padding_costs_linear_time(apply, name):
    """A head in front of 100,000 spaces, line breaks, digits or signs, with and without a value behind."""
    texts = [h + pad * 100_000 + end for h in HEADS[name] for pad in (" ", "\n", " \n", "1", "-", ": ", ".1") for end in ("x", " positivo")]
    start = time.time()
    if name == "ki67":
        for version in V.KI67_PERCENT:
            assert len(apply(lambda c, v=version: M.ki67(c, v), texts)) == len(texts)
    else:
        fn, rules = STATUS[name]
        for version in rules:
            apply(lambda c, v=version: fn(c, v), texts)
    assert time.time() - start < 60


def test_one_scan_gives_the_counts_and_contexts_of_single_searches(spark):
    """Random texts of mention parts: the scan against one search per marker."""
    import random

    from careline.operators.evaluate import marker_counts, with_mentions

    random.seed(5)
    parts = ["receptor", " de ", "estrogênio", "ESTRÓGENO", "estrogeno", "progesterona", "her2", "HER2", "ck5", "/6", "ck5 / 6", "ki67", "Ki-67", "ki", " 67",
             " ", "\n", "\u00a0", ".", "é", "er", "x" * 60, "\u017f", "e\u017ftrogeno", "20%", "receptor de progesterona", "receptor  de\nestrogenio "]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(400)] + [None, "", "her2" * 3, "her2 " * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, laudo_tratado string")
    single = {}
    for m in V.MARKERS:
        n = M.marker_count(F.col("laudo_tratado"), m)
        single |= {f"ctg_{m}": n, f"txt_{m}": F.when(n > 0, M.marker_context(F.col("laudo_tratado"), m)).otherwise("")}
    names = ["i", *single]
    want = [tuple(r) for r in df.withColumns(single).orderBy("i").select(names).collect()]
    assert [tuple(r) for r in with_mentions(df).orderBy("i").select(names).collect()] == want
    loose = {f"ctg_{m}": M.marker_count(F.col("laudo_tratado"), m, V.MARKERS_LOOSE) for m in V.MARKERS_LOOSE}
    want = [tuple(r) for r in df.withColumns(loose).orderBy("i").select("i", *loose).collect()]
    assert [tuple(r) for r in marker_counts(df).orderBy("i").select("i", *loose).collect()] == want


def test_plans_search_a_report_once(spark):
    from careline.operators import evaluate as E

    df = spark.createDataFrame([("x",)], "laudo_tratado string")
    for out in (E.with_mentions(df), E.inconsistency_profile(df), E.marker_counts(df), E.validation_sheet(df, fields=[])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") == 1, plan


def _fixed_patterns():
    rules = [r for group in (V.ER_RULES, V.PR_RULES, V.HER2_RULES, V.CK56_RULES) for version in group.values() for r, _ in version]
    return [*rules, *V.KI67_PERCENT.values(), *V.MITOTIC_INDEX.values(), V.HISTOLOGIC_GRADE, V.NUCLEAR_GRADE, V.TUBULE_SCORE, *V.MARKERS.values(), *V.MARKERS_LOOSE.values()]


def test_pieces_of_a_pattern_stand_in_every_match():
    from workloads import texts as T

    seen = set()
    for pattern in _fixed_patterns():
        for text in (*T.IHC_TEXTS, *T.PATHOLOGY_TEXTS, "ER +a PR -a her2 3+a ck5/6 +a mitotico 3 / 10 mitoses / mm2", "her2: 3+x er -x pr +x ck5 / 6 -x"):
            for m in re.finditer(pattern, text.replace("{p}", "12").lower()):
                seen.add(pattern)
                assert all(piece in m.group() for piece in L.literals(pattern)), (pattern, m.group())
    assert len(seen) > 25
    assert L.literals(r"\ber\s*[\+]\b") == ["+", "er"] and L.literals(r"\b(?:a+bc|er)\b") == []


def test_long_runs_of_spaces_are_searched_short(apply):
    """A run never becomes a single space, and no pattern sees the difference."""
    runs = [1, 2, 3, 7, 8, 9, 16, 63, 64, 65, 127, 128, 400, 1000]
    texts = ["a" + " " * n + "b" for n in runs]
    short = apply(L.squeezed, [*texts, None])
    assert short[-1] is None and all(len(s) <= 2 + 32 for s in short[:-1])
    for n, s in zip(runs, short):
        assert len(s) - 2 == n if n < 8 else len(s) - 2 >= 2
    gaps = [f"receptor{' ' * n}de  progesterona{' ' * n}positivo" for n in (1, 45, 46, 500)]
    assert apply(lambda c: M.pr_status(c, 2), gaps) == [V.POSITIVE, V.POSITIVE, V.NOT_STATED, V.NOT_STATED]
    assert apply(lambda c: M.er_status(c, 2), [f"receptor{' ' * 900}de estrogeno{' ' * 900}negativo"]) == [V.NEGATIVE]
    assert apply(L.histologic_type, [f"carcinoma de mama{' ' * n}tubular" for n in (1, 2, 9, 400)]) == ["carcinoma de mama tubular", None, None, None]
