import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from careline.llm import lm_score
from careline.llm.queries import op1_lm_score
from tests.conftest import SF


def grammar(n, seed):
    """Sentences in which a word follows from its neighbours."""
    random.seed(seed)
    pairs = [(f"red{i}", f"apple{i}", f"falls{i}") for i in range(30)]
    return [" ".join(w for _ in range(random.randint(3, 12)) for w in random.choice(pairs)) for _ in range(n)]


def test_chances_of_all_words_sum_to_one():
    weights, around = lm_score.start_weights(), np.array([[1, 2, 3, 4], [0, 0, 9, 700]], np.int32)
    for row in around:
        every = np.arange(lm_score.TOKENS, dtype=np.int32)
        total = np.exp(lm_score.log_chances(weights, every, np.tile(row, (len(every), 1)))).sum()
        assert abs(total - 1) < 1e-3


def test_contexts_stop_at_the_edges():
    words, around = lm_score.contexts([np.array([5, 6, 7], np.int32), np.array([], np.int32), np.array([8], np.int32)])
    assert words.tolist() == [5, 6, 7, 8]
    assert around.tolist() == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0]]


def test_score_is_the_sum_over_words(spark):
    """The batched score equals a plain loop over the words of each text."""
    texts = [None, "", "  ", "one", "one two three four five six", "a b " * 5000, "a b c", "a b c"]
    words, weights = ["one", "a", "b", "three"], lm_score.start_weights()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, lm int")
    got = {r.doc_id: (r.lm.n_words, r.lm.log_likelihood) for r in lm_score.score(df, words, weights).collect()}
    numbers = lm_score.Numbers(words)
    for i, t in enumerate(texts):
        ids = [0, 0, *numbers.of(t).tolist(), 0, 0]
        want = 0.0
        for at in range(2, len(ids) - 2):
            h = np.tanh(np.concatenate([weights["e"][ids[at + k]] for k in (-2, -1, 1, 2)]) @ weights["w"])
            c, w = divmod(ids[at], lm_score.WIDTH)
            for x, k in ((h @ weights["c"] + weights["d"], c), (h @ weights["v"][c] + weights["u"][c], w)):
                want += float(x[k] - np.log(np.exp(x).sum()))
        assert got[i][0] == len(ids) - 4 and abs(got[i][1] - want) <= 1e-4 * max(1, abs(want))


def test_training_tells_order_from_disorder(spark):
    texts = grammar(3000, 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    words = lm_score.vocabulary(df, "text")
    assert len(words) == 90 and set(words) == {w for t in texts for w in t.split()}
    weights = lm_score.train(df, "text", words, masked=0.5, batch=64)
    numbers = lm_score.Numbers(words)

    def mean(ts, w):
        return lm_score.log_chances(w, *lm_score.contexts([numbers.of(t) for t in ts])).mean()

    fresh = grammar(200, 2)
    mixed = [" ".join(random.sample(t.split(), len(t.split()))) for t in fresh]
    assert mean(fresh, weights) > mean(fresh, lm_score.start_weights()) + 2
    assert mean(fresh, weights) > mean(mixed, weights) + 1
    assert mean(fresh, weights) > -np.log(90)  # better than any prediction that ignores the neighbours


def test_every_place_is_trained_on(spark):
    """Each word stands beside one other word only, so its embedding moves if that place is trained on."""
    df = spark.createDataFrame([(f"left{i} right{i}",) for i in range(300)], "text string").repartition(2)
    words = lm_score.vocabulary(df, "text")
    moved = lm_score.train(df, "text", words)["e"] != lm_score.start_weights()["e"]
    assert len(words) == 600 and moved.any(axis=1)[1:601].all()


def test_hashed_words_have_chances_of_their_own(spark):
    """Words outside the vocabulary: slot chance times n / (total + 1), the rest for words not counted."""
    random.seed(4)
    texts = [None, "", " ".join(f"w{i}" for i in range(9000)), *(" ".join(f"w{random.randint(0, 8999)}" for _ in range(1000)) for _ in range(40))]
    texts.append(texts[7])
    n = Counter(w for t in texts for w in (t or "").split())
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, lm int").repartition(3)
    counts = lm_score.word_counts(df, "text")
    assert {r.word: r.n for r in counts.collect()} == n
    words, weights = lm_score.most_frequent(counts), lm_score.start_weights()
    known, total = set(words), Counter()
    slot = lambda w: zlib.crc32(w.encode()) % lm_score.HASHED
    for w in n.keys() - known:
        total[slot(w)] += n[w]

    def shares(t):
        return sum(np.log(max(n[w], 1) / (total[slot(w)] + 1)) for w in (t or "").split() if w not in known)

    def both(docs):
        plain = {r.doc_id: r.lm.log_likelihood for r in lm_score.score(docs, words, weights).collect()}
        got = lm_score.score(docs, words, weights, counts=counts)
        assert got.columns == ["doc_id", "text", "lm"]
        return [(r.text, r.lm.log_likelihood - plain[r.doc_id]) for r in got.collect()]

    got = both(df)
    assert len(got) == len(texts) and sum(shares(t) < 0 for t, _ in got) == 42
    assert all(abs(d - shares(t)) < 1e-6 * max(1, -shares(t)) for t, d in got)
    new = spark.createDataFrame([(1, "never before seen", 0)], "doc_id bigint, text string, lm int")
    assert abs(both(new)[0][1] - shares("never before seen")) < 1e-9
    trained = lm_score.train(df, "text", words)
    whole = {r.doc_id: r.lm.log_likelihood for r in lm_score.pseudo_likelihood(df).collect()}
    want = lm_score.log_chances(trained, *lm_score.contexts([lm_score.Numbers(words).of(texts[2])])).sum() + shares(texts[2])
    assert abs(whole[2] - want) < 1e-2 * -want and abs(whole[7] - whole[len(texts) - 1]) < 1e-3


def test_query_and_empty_tables(spark):
    got = op1_lm_score(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert {r.doc_id: r.n_words for r in got} == {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert all(r.log_likelihood < 0 for r in got if r.n_words)
    assert lm_score.pseudo_likelihood(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")
    assert {(r.lm.n_words, r.lm.log_likelihood) for r in lm_score.pseudo_likelihood(blank).collect()} == {(0, 0.0)}


def test_step_follows_the_gradient():
    """One step from the start against differences of the mean of all chances, weight by weight."""
    random = np.random.default_rng(3)
    word, near = random.integers(0, lm_score.TOKENS, 40).astype(np.int32), random.integers(0, 30, (40, 2 * lm_score.SIDE)).astype(np.int32)
    start = {k: v.astype(np.float64) for k, v in lm_score.start_weights().items()}
    trainer = lm_score.Trainer(lm_score.start_weights())
    trainer.step(word, near)

    def loss(weights):
        return -lm_score.log_chances(weights, word, near).mean()

    for name in start:
        moved = np.argwhere(trainer.seen[name] > 1.0001e-3)
        for at in map(tuple, moved[random.permutation(len(moved))[:6]]):
            up, down = ({**start, name: start[name].copy()} for _ in range(2))
            up[name][at] += 1e-4
            down[name][at] -= 1e-4
            gradient = (loss(up) - loss(down)) / 2e-4
            found = np.sqrt(max(0.0, float(trainer.seen[name][at]) - 1e-3))
            assert abs(abs(gradient) - found) < 0.05 * found + 1e-4
            step = float(trainer.weights[name][at]) - start[name][at]
            assert step * gradient <= 0 and abs(abs(step) - lm_score.RATE * found / np.sqrt(float(trainer.seen[name][at]))) < 0.05 * abs(step) + 1e-5


def test_steps_use_their_arrays_again():
    """New arrays at each step took over 4 MB of new pages, and as much time as the sums."""
    random, trainer = np.random.default_rng(5), lm_score.Trainer(lm_score.start_weights())
    word, near = random.integers(0, lm_score.TOKENS, 2048).astype(np.int32), random.integers(0, 900, (2048, 2 * lm_score.SIDE)).astype(np.int32)
    trainer.step(word, near)
    tracemalloc.start()
    trainer.step(word, near)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000


def test_numbers_of_many_texts_are_those_of_each():
    """Arrow's splitting and numbering against ``str.split`` and a plain dictionary."""
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    texts = [None, "", " ", *(f"{c}one{c}{c}tw\u00f6 {c}" for c in spaces), "x\u200by one " * 300, "tw\u00f6", "\ufeffone"]
    known = {"one": 1, "tw\u00f6": 2}
    want = [[known.get(w, lm_score.TOKENS - lm_score.HASHED + zlib.crc32(w.encode()) % lm_score.HASHED) for w in (t or "").split()] for t in texts]
    for some in (slice(None), slice(2, 9), slice(0, 0)):
        found, sizes = lm_score.Numbers(list(known)).of_all(pa.array(texts, pa.string())[some])
        assert found.tolist() == [x for row in want[some] for x in row] and sizes.tolist() == [len(row) for row in want[some]]


def test_hashed_words_travel_by_part(spark):
    """Not a row for each word of each text: one for each batch and part, with all its words."""
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(1, 200)) for i in range(1, 301)] + [None, "", "w1 w2"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    found = lm_score.hashed_words(df, "text", ["w1"], 8).collect()
    assert len(found) <= 8 and len({r.part for r in found}) == len(found)
    assert Counter(w for r in found for w in r.words.split(" ")) == Counter(w for t in texts for w in (t or "").split() if w != "w1")
    assert all(len(r.words.split(" ")) == sum(r.sizes) for r in found) and sum(sum(r.copies) for r in found) == 301


def test_vocabulary_ranks_ties_by_word(spark):
    """The histogram that leaves out rare words leaves none of the most frequent out."""
    rows = [(f"w{i:05d}", 1 + (i * 7919) % 60 ** (1 + i % 3)) for i in range(9000)]
    got = lm_score.most_frequent(spark.createDataFrame(rows, "word string, n bigint"))
    assert got == [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:lm_score.TOKENS - lm_score.HASHED - 1]]
