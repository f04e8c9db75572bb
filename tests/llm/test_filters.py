"""The filter audit against counting document by document in every order."""

from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pytest

from careline.llm import filters
from careline.llm.sql import ORACLES
from tests.conftest import SF
from tests.llm.brute import WORD
from workloads.check import connect

LONG = " ".join(f"w{i}" for i in range(250))


def fails(text):
    text = text or ""
    words = WORD.findall(text)
    return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text)]


def brute(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    rows = []
    for i, t, lang in docs:
        copy = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in docs)
        good = any(j is not None and j == i and q == 1 for j, q, _ in labels)
        toxic = any(j is not None and j == i and x == 1 for j, _, x in labels)
        rows.append((lang or "", [*fails(t), copy], good, toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        steps, removed = [], [0] * 5
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                removed[f] += len(gone)
                steps.append((part, "".join("ABCDE"[k] for k in order), step, len(left), len(gone), sum(r[0][f] for r in own) - len(gone),
                              sum(r[0][f] and sum(r[0]) == 1 for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        out += [(*s[:-1], removed[s[-1]]) for s in steps]
    return sorted(out)


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_counts_like_going_through_every_order(spark):
    random = np.random.default_rng(1)
    texts = [None, "", "a b", LONG, LONG + " #", LONG.upper(), "w " * 300, LONG, "x" * 50_000, "é\x1c\x85 É", "A&" + LONG]
    docs = [(int(random.integers(0, 60)), texts[random.integers(0, len(texts))], [None, "de", "en"][random.integers(0, 3)]) for _ in range(150)]
    docs += docs[:10] + [(None, LONG, "en"), (None, LONG, "en"), (None, None, None)]
    labels = [(int(random.integers(0, 70)), [None, 0, 1][random.integers(0, 3)], int(random.integers(0, 2))) for _ in range(80)] + [(None, 1, 1), (3, 1, None)]
    got = filters.audit(*frames(spark, docs, labels))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_shapley_values_are_the_mean_over_orders():
    random = np.random.default_rng(2)
    for n in (1, 2, 3, 5):
        masks = random.integers(0, 1 << n, 200)
        removed = [int(((masks & s) != 0).sum()) for s in range(1 << n)]
        want = [Fraction(0)] * n
        for order in permutations(range(n)):
            before = 0
            for f in order:
                want[f] += Fraction(removed[before | 1 << f] - removed[before], factorial(n))
                before |= 1 << f
        assert filters.shapley(removed, n) == want


def test_no_rows_and_clashing_columns(spark):
    docs, labels = frames(spark, [], [])
    assert filters.audit(docs, labels).count() == 0
    docs, labels = frames(spark, [(1, LONG, "en"), (2, LONG, "en")], [(2, 1, 0)])
    clash = docs.selectExpr("*", "1 AS _id", "2 AS _mask", "3 AS _part", "4 AS removed")
    got = filters.audit(clash, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got.kept, got.removed, got.unique_fails, got.good_lost, got.shapley) == (1, 1, 1, 1, 120)


def test_one_id_or_text_of_a_third_of_all_rows(spark):
    docs = [(7, f"{i}", "en") for i in range(40)] + [(100 + i, LONG, "en") for i in range(40)] + [(200 + i, f"x{i}", "fr") for i in range(40)]
    labels = [(7, 1, 1), (110, 1, 0), (205, 0, 1)]
    assert sorted(tuple(r) for r in filters.audit(*frames(spark, docs, labels)).collect()) == brute(docs, labels)


def test_sql_says_the_same(spark):
    from __spark_entry__ import queries

    got = queries()["op11_filter_audit"](spark, SF)
    cur = connect(SF).execute(ORACLES["op11_filter_audit"])
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in got.select(names).collect()) == sorted(cur.fetchall())


@pytest.mark.parametrize("text", [None, "", " \t", "a " * 199 + "a", "a " * 200, "Ab" * 40, "100 %"])
def test_text_filters_one_by_one(text):
    mask = filters.text_failures(None if text is None else text.encode())
    assert [bool(mask >> i & 1) for i in range(4)] == fails(text)
