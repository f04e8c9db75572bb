import math
import random

from pyspark.sql import functions as F

from careline.llm import quality
from careline.llm.queries import op2_quality_rules
from tests.conftest import SF
from tests.llm import brute

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_query_counts_match_brute_force(spark):
    want = {r.doc_id: brute.quality_counts(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op2_quality_rules(spark, SF).collect():
        assert tuple(r[c] for c in COUNTS) == want[r.doc_id]
        n, rep = want[r.doc_id][0], want[r.doc_id][4]
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.base_failed and r.kept)


def test_counts_of_odd_texts(spark):
    random.seed(6)
    data = [None, "", " \t\n", "a b c d e f g h", "a b c d e f g", "x " * 30, "# | <\n# | <\n\n\n  \n", "é" * 9, "w" * 200_000,
            " ".join(random.choices("abc", k=400)), "l\n" * 50, "\x0b\x0c\r", "q w e r t y u i q w e r t y u i q", "a1 " * 30000]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(data)], "doc_id bigint, text string, n_words string, n_lines int")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in quality.measure(df).collect()}
    for i, t in enumerate(data):
        if i == 13:
            assert got[i] == (30000, 60000, 0, 0, 30000)
        else:
            assert got[i] == brute.quality_counts(t), i


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 10, 59, 400, 3000) for k in (0, 1, 3, n // 100, n // 20) if k <= n]
    df = spark.createDataFrame(cases, "k bigint, n bigint")
    for r in df.withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.05)).collect():
        exact = sum(math.comb(r.n, i) * 0.05**i * 0.95**(r.n - i) for i in range(r.k + 1))
        assert (r.p == 1 and exact >= 0.5 - 1e-9) if r.k > r.n * 0.05 else math.isclose(r.p, exact, rel_tol=1e-9)


def holdout(spark, share, n=3000):
    """Good documents of which a share has many symbols."""
    rows = [(i, "s", True, 100, 1000, 150 if i < share * n else 0, 10, 0, 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, s string, g boolean, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint")


def test_cutoffs_keep_the_risk(spark):
    cut = lambda df: {r.rule: r.cutoff for r in quality.cutoffs(df, "s", "g").collect()}
    few, many, none = cut(holdout(spark, 0.001)), cut(holdout(spark, 0.012)), cut(holdout(spark, 0.0, n=40))
    assert few["symbols"] == quality.LADDERS["symbols"][-1]  # 3 of 3,000 surely are under 1.25 %
    assert many["symbols"] == 160  # 36 of 3,000 are not: the ladder ends above 150 per mille
    assert set(none.values()) == {None}  # 40 rows prove nothing


def test_false_rejection_is_bounded_on_fresh_data(spark):
    """Cutoffs from one sample reject at most alpha of the good documents of the population."""
    random.seed(11)
    population = [min(999, int(random.expovariate(1 / 40))) for _ in range(20000)]
    sample = random.sample(population, 2500)
    rows = [(i, "s", True, 100, 1000, v, 10, 0, 0) for i, v in enumerate(sample)]
    df = spark.createDataFrame(rows, "doc_id bigint, s string, g boolean, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint")
    cutoff = next(r.cutoff for r in quality.cutoffs(df, "s", "g").collect() if r.rule == "symbols")
    assert cutoff is not None and sum(v > cutoff for v in population) / len(population) <= quality.ALPHA


def test_judge_odd_tables(spark):
    text = "some plain words that go on for a while " * 3
    docs = spark.createDataFrame([(1, text, None, 7), (1, text, None, 7), (None, text, "en", 7), (2, None, "en", 7)],
                                 "doc_id bigint, text string, lang string, quality int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, 1), (2, None)], "doc_id bigint, quality int")
    got = quality.judge(docs, labels).collect()
    assert len(got) == 4 and all(r.kept == (not r.base_failed) for r in got)
    assert quality.judge(docs, labels.limit(0)).count() == 4
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_query_equals_sql_where_the_method_rejects(spark):
    """On the larger tables cutoffs do reject documents; the smaller ones only show the base rules."""
    from careline.llm.queries import op2_quality_rules
    from careline.llm.sql import ORACLES
    from workloads.check import connect

    sf = "/root/testdata/sf0.1"
    got = op2_quality_rules(spark, sf)
    cur = connect(sf).execute(ORACLES["op2_quality_rules"])
    want = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in got.select([d[0] for d in cur.description]).collect()) == want
    assert sum(not r[-2] and not r[-1] for r in want) > 100
