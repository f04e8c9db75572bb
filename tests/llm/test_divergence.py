"""The divergence audit and its transducers against plain loops."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from careline.llm import divergence
from careline.llm.sql import ORACLES
from careline.llm.transducer import Vocabulary, build
from tests.conftest import SF
from tests.llm.brute import LOWER
from workloads.check import connect

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    words = [TERM.findall(t.translate(LOWER)) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        df = Counter(w for (_, a, _), ws in zip(rows, words) if a == lang for w in set(ws))
        kept = sorted((w for w, n in df.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for (_, a, s), ws in zip(rows, words):
            if a == lang:
                counts[s].update(w for w in ws if df[w] >= min_docs)

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 1) // total for w in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(b, sum((p[s][w] - p[b][w]) ** 2 // p[b][w] for w in kept)) for b in counts if b != s]
            terms = [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    return sorted(tuple(r) for r in divergence.divergence(docs, **options).collect())


def random_rows(seed, n=120):
    random = np.random.default_rng(seed)
    vocabulary = ["a", "b", "ab", "abc", "abcdefgh", "abcdefghi", "abcdefghij", "é", "éa", "語", "ZZ", "zz", "stop", "stops"]
    weight = random.random(len(vocabulary))
    texts = [" ".join(random.choice(vocabulary, random.integers(0, 30), p=weight / weight.sum())).replace(" ", random.choice([" ", "_", "1"])) for _ in range(n)]
    return [(t, [None, "de", "en"][random.integers(0, 3)], ["s0", "s1", "s2", None][random.integers(0, 4)]) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_like_plain_loops(spark, seed):
    rows = random_rows(seed) + [(None, "en", "s0"), ("", "en", "lone"), ("unseen", "xx", "one"), ("rare", "xx", "two"), ("x" * 30_000, "en", "s1")] + [("tie", "t", "a")] * 3
    assert run(spark, rows) == brute(rows)


def test_several_ranges_and_passes(spark):
    """Small ranges and passes give the same, also where beginnings of eight bytes repeat."""
    rows = random_rows(3)
    assert run(spark, rows, pass_bytes=400, term_range=6, chunk=3) == brute(rows)


def test_no_rows_and_other_columns(spark):
    assert run(spark, []) == []
    rows = random_rows(4, 40)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS term", "2 AS place", "3 AS n", "4 AS chunk")
    assert sorted(tuple(r) for r in divergence.divergence(docs).collect()) == brute(rows)


def test_top_terms_are_cut_by_rank(spark):
    rows = random_rows(5)
    assert run(spark, rows, top=2) == brute(rows, top=2)


def test_sql_says_the_same(spark):
    from __spark_entry__ import queries

    got = queries()["op12_source_divergence"](spark, SF)
    cur = connect(SF).execute(ORACLES["op12_source_divergence"])
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in got.select(names).collect()) == sorted(cur.fetchall())


def random_terms(seed, n):
    random = np.random.default_rng(seed)
    return sorted({bytes(random.choice(list(b"ab\xc3"), random.integers(1, 14))) for _ in range(n)})


def test_transducer_is_minimal_and_gives_ordinals():
    terms = random_terms(1, 500)
    made = build(terms)
    endings = {frozenset(t[len(head):] for t in terms if t.startswith(head)) for t in terms for head in (t[:k] for k in range(len(t) + 1))}
    assert len(made.final) == len(endings)
    assert [made.term(i) for i in range(len(terms))] == terms
    assert made.n_terms == len(terms)


def test_vocabulary_of_ranges_finds_every_term_and_no_other():
    terms, others = random_terms(2, 3000), random_terms(3, 3000)
    parts = [(terms[at], 100 + at, build(terms[at:at + 37])) for at in range(0, len(terms), 37)]
    known = Vocabulary(parts)
    words = terms + others + [b"zzz", b"\x01"]
    data, lengths = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    place = {t: 100 + i for i, t in enumerate(terms)}
    assert known.ordinals(data, ends - lengths, ends).tolist() == [place.get(w, -1) for w in words]


def test_shares_stay_exact_for_large_counts():
    for count, total, terms in ((10**12, 10**15, 10**7), (5, 2**60, 9), (2**40, 2**41, 3)):
        assert divergence.share(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 1) // (total + terms)
