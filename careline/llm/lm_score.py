"""Masked pseudo-likelihood: how well each word of a text can be told from the words on both sides.

A small network sees the two words before and the two behind a place and predicts the word there.
Words are numbered by a vocabulary of the corpus; the rest share hashed numbers.  A number's chance is
that of its class times that of the number within the class (64 classes of 64 numbers), which costs two
layers of 64 instead of one of 4,096.  A hashed word's chance is its number's times the word's share of
the number's occurrences in the corpus; these counts stay in a table, whatever the number of words.  A
document's score is the sum of the logarithms of the chances of all its words, each predicted with
itself hidden.

Training goes over all documents in rounds, each on its share of them.  In a round every task starts
from the same weights, trains on every place of its documents (the word there is hidden, as it is no
input) and gives its weights and the number of places; their weighted mean is the next round's start.
So each place of the corpus is trained on once.
"""

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm.common import cut, shielded

SIDE = 2
CLASSES = WIDTH = 64
TOKENS = CLASSES * WIDTH
#: Numbers kept for hashed words; the others go to the most frequent ones, and the first is the text's edge.
HASHED = 512
EMBEDDING, HIDDEN = 16, 32
ROUNDS, MASKED, BATCH, RATE = 2, 1.0, 2048, 0.15
#: Scores are held within it, so that their powers and sums stay in range.
LIMIT = 60
_SCORED = 1 << 13
_BLOCK = 1 << 13
#: Words a task holds before it passes on their counts.
_COUNTED = 1 << 21
#: Parts in which words outside the vocabulary meet their counts: at least so many, and one for so many words.
PARTS, PART_WORDS = 32, 1 << 21
_SHAPES = {"e": (TOKENS, EMBEDDING), "w": (2 * SIDE * EMBEDDING, HIDDEN), "c": (HIDDEN, CLASSES), "d": (CLASSES,),
           "v": (CLASSES, HIDDEN, WIDTH), "u": (CLASSES, WIDTH)}


def start_weights() -> dict[str, np.ndarray]:
    """The common start: small random numbers from a fixed seed."""
    random = np.random.default_rng(0)
    scale = {"e": 0.3, "w": 0.2, "c": 0.1, "v": 0.1}
    return {k: (random.standard_normal(s) * scale.get(k, 0)).astype(np.float32) for k, s in _SHAPES.items()}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in _SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([np.prod(s) for s in _SHAPES.values()])
    return {k: part.reshape(s).astype(np.float32) for (k, s), part in zip(_SHAPES.items(), np.split(values, ends[:-1]))}


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, parted by white space as by ``str.split``, and how many each text has."""
    lists = pc.utf8_split_whitespace(texts.fill_null(""))
    words, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    real = pc.not_equal(words, "")  # white space at a text's edges leaves empty words
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), np.diff(before[ends], prepend=0)


def hashes(words: pa.Array) -> np.ndarray:
    """The CRC-32 of each word."""
    coded = words.dictionary_encode()
    plain = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    each = np.fromiter(map(zlib.crc32, plain), np.int64, len(plain))
    return each[coded.indices.to_numpy()]


class Numbers:
    """Words to numbers: their place in the vocabulary, a hash of the unknown ones."""

    def __init__(self, vocabulary: list[str]):
        self.words = pa.array(vocabulary, pa.string())

    def known(self, words: pa.Array) -> np.ndarray:
        """Each word's number, 0 for the unknown ones."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy() + np.int32(1)

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of all texts in a row, and how many each text has."""
        words, sizes = split(texts)
        numbers = self.known(words)
        unknown = numbers == 0
        numbers[unknown] = TOKENS - HASHED + hashes(words.filter(pa.array(unknown))) % HASHED
        return numbers, sizes

    def of(self, text: str | None) -> np.ndarray:
        return self.of_all(pa.array([text], pa.string()))[0]


def contexts(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts in a row, and the numbers around each; 0 beyond a text's edge."""
    return places(np.concatenate(parts), np.array([len(p) for p in parts]))


def places(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``contexts`` of texts whose words are in a row already."""
    line, at = np.zeros(len(words) + SIDE * (len(sizes) + 1) + 1, np.int32), np.arange(len(words)) + np.repeat(np.arange(len(sizes)) * SIDE, sizes)
    line[at + SIDE] = words
    near = np.lib.stride_tricks.sliding_window_view(line, 2 * SIDE + 1)[at]
    return words, np.delete(near, SIDE, axis=1)


def _layers(weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Copies of the weights, each output layer in one array with its constants as the last row."""
    return {"e": weights["e"].copy(), "w": weights["w"].copy(), "c": np.concatenate([weights["c"], weights["d"][None]]),
            "v": np.concatenate([weights["v"], weights["u"][:, None]], axis=1)}


def _parts(layers: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights inside their layers."""
    c, v = layers["c"], layers["v"]
    return {"e": layers["e"], "w": layers["w"], "c": c[:-1], "d": c[-1], "v": v[:, :-1], "u": v[:, -1]}


class Room:
    """Arrays by name that are used again: new ones would take new pages from the system at each step."""

    def __init__(self, kind: np.dtype):
        self.kind, self.held = kind, {}

    def __call__(self, name: str, *shape: int, kind: np.dtype | None = None) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind or self.kind)
        return self.held[name][:size].reshape(shape)


def _seen(e: np.ndarray, near: np.ndarray, room: Room) -> np.ndarray:
    """The first layer: the embeddings of the words around each place."""
    x = room("x", *near.shape, EMBEDDING)
    return np.take(e, near, axis=0, out=x, mode="clip").reshape(len(near), -1)  # no number is out of range


def _hidden(x: np.ndarray, w: np.ndarray, room: Room) -> np.ndarray:
    """The hidden layer, and a last column of ones for the constants of the next."""
    h, inner = room("h", len(x), HIDDEN + 1), np.dot(x, 2 * w, out=room("inner", len(x), HIDDEN))
    # the hyperbolic tangent, 1 - 2 / (exp(2 x) + 1); beyond the limit it is 1 already
    np.clip(inner, -LIMIT, LIMIT, out=inner)
    np.exp(inner, out=inner)
    inner += 1
    np.divide(-2, inner, out=inner)
    np.add(inner, 1, out=h[:, :-1])
    h[:, -1] = 1
    return h


def _limited(layer: np.ndarray) -> bool:
    """Whether no score of this layer can be beyond the limit, as no input is beyond 1."""
    return bool(np.abs(layer).sum(axis=-2).max() <= LIMIT)


def _powers(x: np.ndarray) -> np.ndarray:
    """The powers of e of the scores, in place, and each row's sum."""
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _errors(x: np.ndarray, chosen: np.ndarray, limited: bool = False) -> np.ndarray:
    """From scores the chances less 1 for the chosen ones, by the number of rows, in place."""
    if not limited:
        np.clip(x, -LIMIT, LIMIT, out=x)
    total = _powers(x)
    total *= len(x)
    x *= (1 / total)[:, None]
    x.reshape(-1)[np.arange(0, x.size, x.shape[1]) + chosen] -= 1 / len(x)
    return x


def _log_chance(x: np.ndarray, chosen: np.ndarray, limited: bool) -> np.ndarray:
    """The logarithm of one chance of each row of scores; the scores are used up."""
    if not limited:
        np.clip(x, -LIMIT, LIMIT, out=x)
    own = x[np.arange(len(x)), chosen]
    return own - np.log(_powers(x))


def _segments(kind: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by class, and (class, from, to) of each class's rows."""
    order = np.argsort(kind.astype(np.uint16), kind="stable")  # numbers of 16 bits are sorted by digits
    return order, _runs(kind)


def _runs(kind: np.ndarray) -> list[tuple[int, int, int]]:
    """(Class, from, to) of each class's rows, once they are in order."""
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
    return [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _within(v: np.ndarray, h: np.ndarray, segments: list[tuple[int, int, int]], room: Room) -> np.ndarray:
    """Scores of the words of each row's class."""
    scores = room("within", len(h), WIDTH)
    for c, a, b in segments:
        np.dot(h[a:b], v[c], out=scores[a:b])
    return scores


def log_chances(weights: dict[str, np.ndarray], words: np.ndarray, around: np.ndarray) -> np.ndarray:
    """The logarithm of each word's chance between the words around it."""
    out, layers = np.empty(len(words), np.float64), _layers(weights)
    c, v = layers["c"], layers["v"]
    limited, room = (_limited(c), _limited(v)), Room(c.dtype)
    # all places are ordered by class, and scored in small blocks, most of them of few classes
    order = np.argsort((words // WIDTH).astype(np.uint16), kind="stable")
    for at in range(0, len(words), _SCORED):
        rows = order[at:at + _SCORED]
        word, near = words[rows], around.take(rows, axis=0)
        kind = word // WIDTH
        h = _hidden(_seen(layers["e"], near, room), layers["w"], room)
        got = _log_chance(np.dot(h, c, out=room("by_class", len(word), CLASSES)), kind, limited[0]).astype(np.float64)
        out[rows] = got + _log_chance(_within(v, h, _runs(kind), room), word % WIDTH, limited[1])
    return out


class Trainer:
    """Stochastic gradient descent with a step of its own for each weight (Adagrad)."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = RATE):
        self.layers = _layers(weights)
        self.squares = {k: np.full_like(v, 1e-3) for k, v in self.layers.items()}
        self.room = Room(self.layers["c"].dtype)
        self.weights, self.seen = _parts(self.layers), _parts(self.squares)
        self.rate, self.n = rate, 0

    def _move(self, name: str, gradient: np.ndarray) -> None:
        spare = np.multiply(gradient, gradient, out=self.room(f"spare {name}", *gradient.shape))
        self.squares[name] += spare
        gradient /= np.sqrt(self.squares[name], out=spare)
        gradient *= self.rate
        self.layers[name] -= gradient

    def step(self, word: np.ndarray, near: np.ndarray) -> None:
        """One step on a batch of words and the words around them."""
        order, segments = _segments(word // WIDTH)
        word, near, n, room = word[order], near.take(order, axis=0), len(word), self.room
        e, w, c, v = self.layers.values()
        x = _seen(e, near, room)
        h = _hidden(x, w, room)
        by_class = _errors(np.dot(h, c, out=room("by_class", n, CLASSES)), word // WIDTH, _limited(c))
        inner = _errors(_within(v, h, segments, room), word % WIDTH)
        to_v, back, more = room("to_v", *v.shape), room("back", n, HIDDEN), room("inner", n, HIDDEN)
        to_v.fill(0)
        for k, a, b in segments:
            part = inner[a:b]
            np.dot(part, v[k, :-1].T, out=back[a:b])
            np.dot(h[a:b].T, part, out=to_v[k])
        back += np.dot(by_class, c[:-1].T, out=more)
        np.multiply(h[:, :-1], h[:, :-1], out=more)
        back *= np.subtract(1, more, out=more)
        # each number's gradient is the sum over the places that see it, one column at a time
        slot, to_x, to_e = near.ravel().astype(np.intp), room("to_x", EMBEDDING, near.size, kind=np.float64), room("to_e", *e.shape)
        to_x[:] = np.dot(back, w.T, out=room("within", n, x.shape[1])).reshape(-1, EMBEDDING).T
        for k, column in enumerate(to_x):
            to_e[:, k] = np.bincount(slot, column, TOKENS)
        self._move("c", h.T @ by_class)
        self._move("v", to_v)
        self._move("w", x.T @ back)
        self._move("e", to_e)
        self.n += n


def _blocks(sizes: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Rows by 256, and their words."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for at in range(0, len(sizes), 256):
        to = min(at + 256, len(sizes))
        yield slice(at, to), slice(ends[at], ends[to])


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """Every word of all documents and how often it occurs: ``word`` and ``n``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(pc.value_counts(pa.chunked_array(held, pa.string())).flatten(), ["word", "n"])

        for batch in batches:
            held.append(split(batch.column(0))[0])
            if sum(map(len, held)) > _COUNTED:  # a task passes on what it has counted, and starts anew
                yield counted()
                held.clear()
        yield counted()

    return docs.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str) -> list[str]:
    """The most frequent words of all documents; ties in order of the word."""
    return most_frequent(word_counts(docs, text))


def most_frequent(counts: DataFrame) -> list[str]:
    """The vocabulary's words, of the counts of all words."""
    # rare words are left out by a histogram of at most eight bins for each doubling of the count; the others are
    # ranked in 64 groups first: what reaches the driver does not grow with the number of tasks
    most, enough, least = TOKENS - HASHED - 1, 0, 0
    size = F.floor(8 * F.log2("n"))
    for r in counts.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        enough, least = enough + r["count"], r["size"]
        if enough >= most:
            break
    group = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(64))).orderBy(F.desc("n"), "word")
    top = counts.where(size >= least).withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= most)
    return [r.word for r in top.orderBy(F.desc("n"), "word").limit(most).collect()]


def _mean(table: pa.Table) -> pa.Table:
    """The weighted mean of one block of weights."""
    total, n = np.zeros(1), 0.0
    for weight, data in zip(table.column("n").to_pylist(), table.column("data")):
        total = total + weight * np.frombuffer(data.as_py(), np.float32)
        n += weight
    data = pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())
    return pa.table({"block": table.column("block")[:1], "n": [n], "data": data})


def train(docs: DataFrame, text: str, words: list[str], *, rounds: int = ROUNDS, masked: float = MASKED, batch: int = BATCH,
          rate: float = RATE) -> dict[str, np.ndarray]:
    """Weights from all documents; see the module's text."""
    context = docs.sparkSession.sparkContext
    weights, numbers = start_weights(), context.broadcast(words)
    for turn in range(rounds):
        begin = context.broadcast(flat(weights))

        def learn(batches: Iterable[pa.RecordBatch], turn=turn, begin=begin) -> Iterator[pa.RecordBatch]:
            trainer, of_all = Trainer(shaped(begin.value), rate / (turn + 1)), Numbers(numbers.value).of_all
            random, left = np.random.default_rng(turn), [np.zeros(0, np.int32), np.zeros((0, 2 * SIDE), np.int32)]
            for batch_of_texts in batches:
                found, sizes = of_all(batch_of_texts.column(0))
                for rows, at in _blocks(sizes):
                    word, near = places(found[at], sizes[rows])
                    if masked < 1:
                        chosen = np.flatnonzero(random.random(len(word)) < masked)
                        word, near = word[chosen], near[chosen]
                    word, near = np.concatenate([left[0], word]), np.concatenate([left[1], near])
                    mixed = random.permutation(len(word))
                    full = len(word) // batch * batch
                    for k in range(0, full, batch):
                        chosen = mixed[k:k + batch]
                        trainer.step(word[chosen], near.take(chosen, axis=0))
                    left = [word[mixed[full:]], near[mixed[full:]]]
            if len(left[0]):
                trainer.step(*left)
            if trainer.n:
                values = flat(trainer.weights)
                for k, at in enumerate(range(0, len(values), _BLOCK)):
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([float(trainer.n)]), pa.array([values[at:at + _BLOCK].tobytes()], pa.binary())],
                                                     ["block", "n", "data"])

        share = docs.select(text).where(F.pmod(F.xxhash64(text), F.lit(rounds)) == turn)
        kind = "block bigint, n double, data binary"
        # tasks' weights meet in 64 groups first, so no task reads those of all others
        got = share.mapInArrow(learn, kind).withColumn("part", F.spark_partition_id() % 64)
        got = got.groupBy("part", "block").applyInArrow(_mean, kind)
        parts = got.groupBy("block").applyInArrow(_mean, kind).orderBy("block").collect()
        if parts:
            weights = shaped(np.concatenate([np.frombuffer(r.data, np.float32) for r in parts]))
    return weights


def hashed_words(docs: DataFrame, text: str, words: list[str], parts: int) -> DataFrame:
    """The words outside the vocabulary, by part of all words: joined by a space, of one text after the other.

    For each of these texts its words' number ``sizes`` and keys, and in ``copies`` 1 once for each text's copy.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = Numbers(shared.value).known, ["part", "words", "sizes", "__h1", "__h2", "copies"]
        for batch in batches:
            own, sizes = split(batch.column("__text"))
            unknown = known(own) == 0
            rows, own = np.repeat(np.arange(len(sizes)), sizes)[unknown], own.filter(pa.array(unknown))
            if not len(own):
                continue
            part = hashes(own) // HASHED % parts
            order = np.argsort(part, kind="stable")
            rows, part, own = rows[order], part[order], own.take(pa.array(order))
            # where a text begins within its part, and among these where a part begins
            begin = np.flatnonzero(np.diff(part, prepend=-1) | np.diff(rows, prepend=-1))
            first = np.flatnonzero(np.diff(part[begin], prepend=-1))
            row, copies = rows[begin], np.zeros(len(begin), np.int64)
            copies[np.unique(row, return_index=True)[1]] = 1
            lists = lambda at, end, values: pa.ListArray.from_arrays(pa.array(np.append(at, end), pa.int32()), values)
            each = [np.diff(begin, append=len(rows)), *(batch.column(k).to_numpy()[row] for k in ("__h1", "__h2")), copies]
            yield pa.RecordBatch.from_arrays([pa.array(part[begin[first]]), pc.binary_join(lists(begin[first], len(rows), own), " "),
                                              *(lists(first, len(begin), pa.array(x)) for x in each)], names)

    kind = "part bigint, words string, sizes array<bigint>, __h1 array<bigint>, __h2 array<bigint>, copies array<bigint>"
    return docs.select(*_text_key(text), F.col(text).alias("__text")).mapInArrow(find, kind)


def _text_key(text: str) -> list:
    return [F.xxhash64(F.col(text)).alias("__h1"), F.xxhash64(F.lit(1), F.col(text)).alias("__h2")]


def share_sums(docs: DataFrame, text: str, words: list[str], counts: DataFrame) -> DataFrame:
    """For each text with words outside the vocabulary the sum of the logarithms of their shares.

    A word that was counted ``n`` times, in a slot of ``total`` occurrences, has the share
    n / (total + 1); what is left, 1 / (total + 1), is for the words that were not counted.
    """
    crc = F.crc32(F.col("word").cast("binary"))
    known = docs.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.string())}))
    counted = counts.join(F.broadcast(known), "word", "left_anti").withColumn("slot", crc % HASHED)
    totals = np.zeros(HASHED)
    for r in counted.groupBy("slot").agg(F.sum("n").alias("total")).collect():
        totals[r.slot] = r.total
    # words meet their counts in parts by another piece of their hash, whose number follows the number of words
    parts = int(max(PARTS, totals.sum() // PART_WORDS))
    counted = counted.withColumn("part", F.floor(crc / HASHED) % parts)

    def shares(found: pa.Table, counted: pa.Table) -> pa.Table:
        flat = lambda k: pc.list_flatten(found.column(k)).to_numpy()
        own, sizes = pc.list_flatten(pc.split_pattern(found.column("words"), " ")).combine_chunks(), flat("sizes")
        if not len(own):
            return pa.table({k: pa.array([], kind) for k, kind in zip(("__h1", "__h2", "shares", "copies"), (pa.int64(), pa.int64(), pa.float64(), pa.int64()))})
        rest = counted.column("word").combine_chunks()
        share = np.log(counted.column("n").to_numpy() / (totals[counted.column("slot").to_numpy()] + 1))
        at = pc.index_in(own, value_set=rest).fill_null(-1).to_numpy()
        each = np.append(share, 0)[at]
        new = at < 0
        each[new] = -np.log(totals[hashes(own.filter(pa.array(new))) % HASHED] + 1)
        sums = np.add.reduceat(each, np.cumsum(sizes) - sizes)
        return pa.table({"__h1": flat("__h1"), "__h2": flat("__h2"), "shares": sums, "copies": flat("copies")})

    found = hashed_words(docs, text, words, parts).groupBy("part").cogroup(counted.groupBy("part"))
    sums = found.applyInArrow(shares, "__h1 bigint, __h2 bigint, shares double, copies bigint")
    # copies of a text bring their words once each, and get one sum
    return sums.groupBy("__h1", "__h2").agg((F.sum("shares") / F.sum("copies")).alias("__shares"))


@shielded
def score(docs: DataFrame, words: list[str], weights: dict[str, np.ndarray], text: str = "text", into: str = "lm",
          counts: DataFrame | None = None) -> DataFrame:
    """``docs`` with the struct ``into``: n_words, and log_likelihood, the sum over all words of the text.

    Without ``counts`` (of ``word_counts``) a word outside the vocabulary has the chance of its whole slot.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, flat(weights)))

    @F.arrow_udf("struct<n_words: bigint, log_likelihood: double>")
    def judge(texts: pa.Array) -> pa.Array:
        own, total = shaped(shared.value[1]), np.zeros(len(texts))
        found, n = Numbers(shared.value[0]).of_all(texts)
        for rows, at in _blocks(n):
            got = log_chances(own, *places(found[at], n[rows]))
            total[rows] = np.bincount(np.repeat(np.arange(len(n[rows])), n[rows]), got, len(n[rows]))
        return pa.StructArray.from_arrays([pa.array(n), pa.array(total)], ["n_words", "log_likelihood"])

    if counts is None:
        return docs.withColumn(into, judge(F.col(text)))
    keys = dict(zip(("__h1", "__h2"), _text_key(text)))
    scored = docs.withColumns(keys | {into: judge(F.col(text))}).join(share_sums(docs, text, words, counts), ["__h1", "__h2"], "left")
    total = F.col(into)["log_likelihood"] + F.coalesce("__shares", F.lit(0.0))
    return scored.withColumn(into, F.struct(F.col(into)["n_words"].alias("n_words"), total.alias("log_likelihood"))).drop("__h1", "__h2", "__shares")


def pseudo_likelihood(docs: DataFrame, text: str = "text", into: str = "lm") -> DataFrame:
    """Train on all texts of ``docs`` and score each: ``into`` is a struct of n_words and log_likelihood.

    Words are parted by white space.  Null, empty and blank texts have no words and score 0; a table
    of such texts, or none, is scored by the untrained network.  Texts count as often as they occur,
    and copies score alike.  Other columns stay, one named like ``into`` is replaced.

    Every counted word has a chance of its own; see ``share_sums``.

    The text is read once to count words, once in each round (whose share of the rows is parted by a
    hash of the text), once to score and once for the words outside the vocabulary, which meet their
    counts in a shuffle by word.  The driver gets the vocabulary and the weights, whose sizes do not
    depend on the corpus; what tasks send grows with their number.
    """
    counts = cut(word_counts(docs, text))
    words = most_frequent(counts)
    return score(docs, words, train(docs, text, words), text, into, counts)
