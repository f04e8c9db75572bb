"""Decoding against trying every path, the classifier against held-out documents."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from careline.llm import toxicity as T
from careline.llm.queries import held_out
from tests.llm.brute import LOWER

CORPUS = ["you are an idiot and a moron", "such a stupid idea", "the idea is about a house on the hill", "all that trash talk", "a loser is a loser"]


def plain_grams(text):
    out = []
    for word in "".join(c if c.isascii() and c.isalpha() or not c.isascii() else " " for c in text.translate(LOWER)).split():
        line = [0, 0, 0, *[T._symbol(c) for c in word], 0]
        out += [((a * 28 + b) * 28 + c) * 28 + d for a, b, c, d in zip(line, line[1:], line[2:], line[3:])]
    return sorted(out)


@pytest.fixture(scope="module")
def chances():
    total = np.zeros(28**4, np.int64)
    for text in CORPUS * 5:
        total += np.bincount(T.grams(text.encode()), minlength=28**4)
    at = np.flatnonzero(total)
    return T.log_chances(at, total[at])


@pytest.mark.parametrize("text", ["", "a", "Ab c", "..x1y", "über ÉTÉ z", "a" * 40])
def test_grams(text):
    assert sorted(T.grams(text.encode()).tolist()) == plain_grams(text)


def test_chances_sum_to_one(chances):
    assert np.allclose(np.exp(chances.reshape(-1, 28).astype(float)).sum(axis=1), 1, atol=1e-4)


def path_score(text, chances):
    total, context = 0.0, (0, 0, 0)
    for char in text + " ":
        symbol = 0 if char == " " else T._symbol(char)
        if symbol or any(context):
            a, b, c = context
            total += float(chances[((a * 28 + b) * 28 + c) * 28 + symbol])
        context = (*context[1:], symbol) if symbol else (0, 0, 0)
    return total


@pytest.mark.parametrize("span", ["1d10t", "m0r0n", "i d i o t", "stuuupid", "$tup1d", "tr@sh", "l.0.s.e.r", "a1b2", "iii", "1$1", "x 1 y", "lo$$er"])
def test_viterbi_finds_the_likeliest_path(span, chances):
    pieces = T.lattice(span)
    got = T.viterbi(pieces, chances.tolist())
    paths = {"".join(p) for p in product(*pieces)}
    assert got in paths
    assert path_score(got, chances) == pytest.approx(max(path_score(p, chances) for p in paths), abs=1e-4)


def test_decoder_restores_words(chances):
    decode = T.Decoder(chances)
    assert decode("You 1d10t!") == "you idiot!"
    assert decode("an i d i o t, a  m0r0n") == "an idiot a  moron"
    assert decode("stuuuupid tr@sh | s.t.u.p.i.d i_d_i_o_t") == "stupid trash | stupid idiot"
    for same in ("", "the house on the hill", "in 2024", "word$$$ word*** !!!", "a b", "x1"[:1]):
        assert decode(same) == same


def test_decoding_does_not_depend_on_what_was_seen(chances):
    texts = ["1d10t m0r0n", "l0ser " * 5, "i d i o t", "x" * 3000 + "1y"]
    small, large = T.Decoder(chances, remembered=1), T.Decoder(chances)
    assert [small(t) for t in texts * 2] == [large(t) for t in texts * 2]


def test_counts_see_what_decoding_restores(chances):
    model = T.Model(chances, {"=idiot": 0, "stup*": 1}, None)
    decode = T.Decoder(chances)
    for text in ("You 1d10t!", "i d i o t and stuuupid", "stupid, idiot; (idiot)", "nothing here", "idiot$$$ i.d.i.o.t"):
        words = T._WORD.findall(decode(text))
        want = {k: np.log1p(n) for k, n in ((0, words.count("idiot")), (1, sum(w.startswith("stup") for w in words))) if n}
        got = model.counts(text, decode)
        assert {k: v for k, v in got.items() if k < 2} == pytest.approx(want)


def test_fit_is_a_minimum():
    random = np.random.default_rng(1)
    x = np.c_[random.random((300, 3)), np.ones(300)]
    y = (x[:, 0] + random.random(300) > 1.2).astype(int)
    w = T.fit(x, y)
    gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + np.array([0.3, 0.3, 0.3, 1e-6]) * w
    assert np.abs(gradient).max() < 1e-3


def test_held_out_documents(spark):
    """Scores of documents that were not learnt from, and of the same texts with letters hidden."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = T.train(docs, labels, ~held_out(F.col("doc_id")))
    rows = T.scores(docs.join(labels, "doc_id").where(held_out(F.col("doc_id"))), model).select("toxic", "score").collect()
    caught = [r.score >= 0.5 for r in rows if r.toxic]
    clean = [r.score < 0.5 for r in rows if not r.toxic]
    assert sum(caught) >= 0.85 * len(caught) and sum(clean) >= 0.97 * len(clean)
    pair = spark.createDataFrame([("such a stupid idiot and moron , worthless trash",), ("such a stup1d i d i o t and m0r0n , w0rthless tr@sh",)], "text string")
    shown = [r.toxicity for r in T.detect(pair, model).collect()]
    assert shown[0].restored == shown[1].restored and shown[0].score == shown[1].score > 0.5


def test_odd_rows_and_tables(spark):
    kinds = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "fine words " * 3, None), (2, "fine words " * 3, None), (None, "you idiot", "z")], kinds)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.train(docs, labels, F.lit(True))
    assert model.weights is None
    assert {r.score for r in T.scores(docs, model).collect()} == {0.0}
    none = spark.createDataFrame([], kinds)
    assert T.scores(none, T.train(none, labels, F.lit(True))).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    scored = T.detect(docs, T.train(docs, labels, F.lit(True)), into="score")
    assert scored.columns == docs.columns and scored.count() == 5
    assert all(0 <= r.score.score <= 1 for r in scored.collect())


def test_sample_is_bounded_where_one_id_has_many_texts(spark):
    docs = spark.range(200).selectExpr("1L AS doc_id", "concat('text ', id) AS text").union(spark.range(2, 30).selectExpr("id", "'copy'"))
    labels = spark.range(1, 30).selectExpr("id AS doc_id", "int(id % 2) AS toxic")
    sample = T.labelled_sample(docs, labels, "doc_id", "text", "toxic", 20)
    assert sample.count() == 20
    assert T.labelled_sample(docs, labels, "doc_id", "text", "toxic", 1000).count() == 228
