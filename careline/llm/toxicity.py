"""Toxicity of texts that hide their words: a noisy channel is decoded before the text is scored.

What was written is taken for a noisy form of what was meant.  The channel writes letters as digits or
marks (``1d10t``), puts separators between single letters (``i d i o t``) and repeats letters
(``idiooot``).  A piece of text that may have come through it is a lattice of readings; the reading that is
likeliest under a character language model of the corpus is found by Viterbi's algorithm.  Text of which
every character has one reading is its own decoding.

The restored text is scored by logistic regression over words and beginnings of words that labelled toxic
documents hold more often than others.
"""

import re
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.llm.common import cut

# Fixed values of the channel: what a character may stand for, and what may stand between single letters.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
SEPARATORS = " ._*~/-"

#: Most labelled documents that the classifier is fitted on, most features it has, and documents that a feature needs.
FIT_ROWS, FEATURES, LEAST_DOCS = 20_000, 400, 3
BEGINNINGS = (4, 5, 6)
EDGE, OTHER, SYMBOLS, ORDER = 0, 27, 28, 4

_LETTER = r"[^\W\d_]"
_SPLIT, _BLANKS = re.compile(r"([^\w@$!|+€£]+)"), re.compile(r"(\s+)")
_AROUND = ".,;:?!\"'()"
_NOISE, _THRICE, _WORD = re.compile(r"[0-9@$!|+€£]"), re.compile(rf"({_LETTER})\1\1"), re.compile(rf"{_LETTER}+")
_END = re.compile(r"[!|+€£]+$|[@$]{3,}$")
#: Symbols of UTF-8 bytes: letters, one for all characters beyond ASCII (by their first byte), an edge for the rest.
_CODES = np.full(256, EDGE, np.int32)
_CODES[97:123] = _CODES[65:91] = np.arange(1, 27)
_CODES[192:] = OTHER
_PIECE = 1 << 20


def _symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else OTHER


def grams(data: bytes) -> np.ndarray:
    """The numbers of the four-symbol sequences within the words of a UTF-8 text, each word between three edges and one."""
    codes = np.frombuffer(data, np.uint8)
    codes = _CODES[codes[(codes < 128) | (codes >= 192)]]
    codes = np.r_[np.int32(EDGE), codes, np.int32(EDGE)]
    edge = codes == EDGE
    codes = codes[~(edge & np.r_[False, edge[:-1]])]
    line = np.repeat(codes, np.where(codes == EDGE, ORDER - 1, 1))
    a, b, c, d = (line[k:len(line) - ORDER + 1 + k] for k in range(ORDER))
    number = ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d
    return number[(c != EDGE) | ((a == EDGE) & (b == EDGE) & (d != EDGE))]


def gram_counts(docs: DataFrame, text: str) -> DataFrame:
    """(gram, n) over all texts; at most 28^4 rows, of which each task sends those it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for batch in batches:
            held, size = [], 0
            for i, t in enumerate(batch.column(0), 1):
                held.append(t.as_py() or b"")
                size += len(held[-1])
                if size > _PIECE or i == batch.num_rows:
                    seen = np.bincount(grams(b"\n".join(held)))
                    total[:len(seen)] += seen
                    held, size = [], 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    return docs.select(F.col(text).cast("binary")).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def log_chances(gram: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The logarithm of each symbol's chance after three others, flat over four-symbol numbers.

    Counts of shorter contexts are mixed in by the number of different symbols seen (Witten and Bell).
    """
    counts = np.zeros(SYMBOLS**ORDER)
    counts[gram] = n
    counts = counts.reshape((SYMBOLS,) * ORDER)
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(ORDER):
        own = counts.sum(axis=tuple(range(ORDER - 1 - k))) if k < ORDER - 1 else counts
        kinds = (own > 0).sum(axis=-1, keepdims=True)
        total = own.sum(axis=-1, keepdims=True)
        chance = np.where(total > 0, (own + kinds * chance) / np.maximum(total + kinds, 1), chance)
    return np.log(chance).astype(np.float32).ravel()


def is_spaced(span: str) -> bool:
    """Three or more single characters with one separator between them."""
    return len(span) > 4 and len(span) % 2 == 1 and span[1] in SEPARATORS and span[1::2] == span[1] * (len(span) // 2)


def lattice(span: str) -> list[list[str]]:
    """The readings of each piece of a span; a space is an edge of a word."""
    out, i = [], 0
    spaced = is_spaced(span)
    while i < len(span):
        char, n = span[i], 1
        while i + n < len(span) and span[i + n] == char:
            n += 1
        if spaced and i % 2:
            out.append(["", " "])
            i += 1
            continue
        letters = READINGS.get(char)
        if letters is None:
            out.append([char, char * 2, char * n] if n > 2 else [char * n])
        elif n > 2:
            out.append([*letters, *[c * 2 for c in letters], " "])
        else:
            out += [[*letters, " "]] * n
        i += n
    return out


def viterbi(pieces: list[list[str]], chances) -> str:
    """The likeliest string through a lattice, from the edge of a word to the edge of a word."""
    square = SYMBOLS * SYMBOLS
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for readings in [*pieces, [" "]]:
        new: dict[int, tuple[float, tuple | None]] = {}
        for context, (score, path) in states.items():
            for reading in readings:
                at, total = context, score
                for char in reading:
                    if char != " ":
                        symbol = _symbol(char)
                        total += chances[at * SYMBOLS + symbol]
                        at = at % square * SYMBOLS + symbol
                    elif at:
                        total += chances[at * SYMBOLS]
                        at = 0
                if at not in new or total > new[at][0]:
                    new[at] = (total, (path, reading))
        states = new
    out, path = [], states[0][1]
    while path:
        path, reading = path
        out.append(reading)
    return "".join(reversed(out[1:]))


class Decoder:
    """Restores texts; the decodings of pieces are remembered up to a bound.

    A piece is what stands between blanks; in it, a token is a run of letters, digits and marks that may stand
    for letters.  Three or more single characters with the same separator between them are one span: within a
    piece, or, for the blank, of pieces (punctuation around them left aside).
    """

    def __init__(self, chances: np.ndarray, remembered: int = 50_000):
        self.chances, self.remembered = chances.tolist(), remembered
        self.seen: dict[str, str] = {}

    def piece(self, piece: str) -> str:
        """The decoding of one piece."""
        read = self.seen.get(piece)
        if read is None:
            read = self._piece(piece)
            if len(piece) <= 64:
                if len(self.seen) >= self.remembered:
                    self.seen.clear()
                self.seen[piece] = read
        return read

    def _piece(self, piece: str) -> str:
        parts = _SPLIT.split(piece)
        out, at = [], 0
        while at < len(parts):
            gap, n = parts[at + 1] if at + 1 < len(parts) else "", 1
            if len(parts[at]) == 1 and gap and gap in SEPARATORS:
                while at + 2 * n < len(parts) and len(parts[at + 2 * n]) == 1 and parts[at + 2 * n - 1] == gap:
                    n += 1
            span = gap.join(parts[at:at + 2 * n:2]) if n > 2 else parts[at]
            n = n if n > 2 else 1
            out += [self._token(span), *parts[at + 2 * n - 1:at + 2 * n]]
            at += 2 * n
        return "".join(out)

    def _token(self, token: str) -> str:
        """The decoding of a token or span: marks at the end are punctuation, three or more of any are decoration."""
        end = _END.search(token)
        body = token[:end.start()] if end else token
        if not _WORD.search(body) or not (_NOISE.search(body) or _THRICE.search(body) or is_spaced(body)):
            return token
        return viterbi(lattice(body), self.chances) + token[len(body):]

    def blank_spans(self, pieces: list[str]) -> list[tuple[int, int, str]]:
        """(from, to, decoding) of spans of single characters among the pieces of a text."""
        single = [i for i, p in enumerate(pieces) if len(p) < 3 and len(p.strip(_AROUND)) == 1]
        out, at = [], 0
        while at < len(single):
            first, n = single[at], 1
            while at + n < len(single) and single[at + n] == first + n:
                n += 1
            chars = [p.strip(_AROUND) for p in pieces[first:first + n]] if n > 2 else []
            if any(c.isalpha() for c in chars):
                out.append((first, first + n, viterbi(lattice(" ".join(chars)), self.chances)))
            at += n
        return out

    def __call__(self, text: str) -> str:
        """The restored text, in lower case."""
        parts = _BLANKS.split(text.lower().strip())
        pieces, gaps, at, out = parts[::2], [*parts[1::2], ""], 0, []
        for first, to, read in [*self.blank_spans(pieces), (len(pieces), len(pieces), "")]:
            out += [self.piece(p) + g for p, g in zip(pieces[at:first], gaps[at:first])]
            out += [read, gaps[to - 1]] if to > first else []
            at = to
        return "".join(out)


def word_features(word: str) -> tuple[str, ...]:
    """A word itself and its beginnings."""
    return ("=" + word, *[word[:n] + "*" for n in BEGINNINGS if len(word) >= n])


@dataclass
class Model:
    """A character model, the features with their numbers, and the weights (bias last)."""

    chances: np.ndarray
    features: dict[str, int]
    weights: np.ndarray | None

    def __post_init__(self):
        self.words = {f[1:] for f in self.features if f[0] == "="}
        self.heads = {f[:BEGINNINGS[0]] for f in self.features if f[0] != "="}

    def counts(self, text: str, decode: Decoder) -> dict[int, float]:
        """Values of the features of one text after decoding: logarithms of counts, and how often any of them occurs."""
        out: Counter[int] = Counter()
        text = text.lower()
        pieces, plain = text.split(), _THRICE.search(text) is None
        spans = decode.blank_spans(pieces)
        for first, to, _ in spans:
            pieces[first:to] = [""] * (to - first)
        found = [(read, 1) for _, _, read in spans]
        for piece, n in Counter(pieces).items():
            word = piece.strip(_AROUND)
            if word.isalpha() and (plain or not _THRICE.search(word)):  # as most are: no reading but its own
                if word in self.words or word[:BEGINNINGS[0]] in self.heads:
                    found.append((word, n))
            elif piece:
                found.append((decode.piece(piece), n))
        hits = 0
        for read, n in found:
            for word in _WORD.findall(read):
                own = [self.features[f] for f in word_features(word) if f in self.features]
                hits += n * bool(own)
                for k in own:
                    out[k] += n
        n = len(self.features)
        values = {k: float(np.log1p(v)) for k, v in out.items()}
        if hits:
            values[n] = float(np.log1p(hits))
        values |= {n + least: 1.0 for least in (1, 2, 3) if hits >= least}
        return values | {n + 4: 1.0}

    @property
    def width(self) -> int:
        return len(self.features) + 5

    def score(self, text: str, decode: Decoder) -> float:
        if self.weights is None:
            return 0.0
        margin = sum(self.weights[k] * v for k, v in self.counts(text, decode).items())
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def feature_counts(sample: DataFrame, chances: np.ndarray) -> DataFrame:
    """(feature, toxic, clean): documents of either label whose restored text holds a feature."""
    shared = sample.sparkSession.sparkContext.broadcast(chances)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode, seen = Decoder(shared.value), (Counter(), Counter())

        def counted() -> pa.RecordBatch:
            names = list(seen[0] | seen[1])
            cells = [pa.array(names, pa.string()), pa.array([seen[1][f] for f in names], pa.int64()), pa.array([seen[0][f] for f in names], pa.int64())]
            return pa.RecordBatch.from_arrays(cells, ["feature", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = set(_WORD.findall(decode(text.as_py() or "")))
                seen[toxic].update({f for w in words for f in word_features(w)})
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield counted()
                    seen = (Counter(), Counter())
        yield counted()

    found = sample.select("text", "toxic").mapInArrow(count, "feature string, toxic bigint, clean bigint")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidence(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """The log-likelihood ratio of a feature's documents against the labels' shares, 0 unless it leans to toxic."""
    n = toxic + clean
    share = n_toxic / (n_toxic + n_clean)
    part = lambda x, e: F.when(x > 0, x * F.log(x / (n * e))).otherwise(F.lit(0.0))
    return F.when(toxic > n * share, 2 * (part(toxic, share) + part(clean, 1 - share))).otherwise(F.lit(0.0))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.3, steps: int = 25) -> np.ndarray:
    """Logistic regression with squared weights as penalty (not on the bias), by Newton's method."""
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """At most ``rows`` different labelled documents, those whose ids have the smallest hashes: (id, h, text, toxic 0/1)."""
    order = [F.xxhash64("id"), "id"]
    marks = labels.select(F.col(key).alias("id"), F.col(label).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    marks = marks.groupBy("id").agg((F.max("toxic") >= 1).cast("int").alias("toxic")).orderBy(*order).limit(rows)
    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h")).join(F.broadcast(marks), "id")
    # an id may have many texts
    chosen = found.select("id", "h").distinct().orderBy(*order, "h").limit(rows)
    return found.join(F.broadcast(chosen), ["id", "h"])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", *,
          fit_rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    """The character model from all documents, features and weights from labelled ones where ``learn_from`` (of ``key``) holds.

    Labelled are documents with a non-null label; 1 or more in any of an id's rows is toxic.  The classifier is
    fitted on ``fit_rows`` documents at most; of repeated rows it sees one.  With no document of either label there
    are no weights.  The driver gets the counts of 28^4 symbol sequences at most, the features, and the sample's values.
    """
    grams_seen = gram_counts(docs, text).toArrow()
    chances = log_chances(grams_seen.column("gram").to_numpy(), grams_seen.column("n").to_numpy())
    sample = cut(labelled_sample(docs.where(learn_from), labels.where(learn_from), key, text, label, fit_rows).coalesce(64))
    n = dict.fromkeys((0, 1), 0) | {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n[0] or not n[1]:
        return Model(chances, {}, None)
    counted = feature_counts(sample, chances).where(F.col("toxic") >= LEAST_DOCS)
    score = evidence(F.col("toxic"), F.col("clean"), n[1], n[0])
    # a feature that stands in clean documents as often says little about a document that has it
    ranked = counted.where(F.col("toxic") > F.col("clean")).withColumn("score", score).where("score > 10")
    best = [r.feature for r in ranked.orderBy(F.desc("score"), "feature").limit(features).collect()]
    model = Model(chances, {f: i for i, f in enumerate(best)}, None)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        decode = Decoder(known.chances)
        for batch in batches:
            got = [known.counts(t.as_py() or "", decode) for t in batch.column("text")]
            cells = [batch.column("id"), batch.column("h"), batch.column("toxic"), pa.array([list(g) for g in got], pa.list_(pa.int32())),
                     pa.array([list(g.values()) for g in got], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cells, ["id", "h", "toxic", "at", "value"])

    kind = f"id {sample.schema['id'].dataType.simpleString()}, h bigint, toxic int, at array<int>, value array<double>"
    rows = sample.mapInArrow(values, kind).dropDuplicates(["id", "h"]).toArrow().sort_by([("id", "ascending"), ("h", "ascending")])
    x = np.zeros((rows.num_rows, model.width), np.float32)
    for i, (at, value) in enumerate(zip(rows.column("at").to_pylist(), rows.column("value").to_pylist())):
        x[i, at] = value
    return Model(chances, model.features, fit(x, rows.column("toxic").to_numpy()))


def detect(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with the struct ``into``: ``restored`` (the decoded, lower-cased text) and ``score`` (0 to 1).

    Only the text is looked at; null and empty texts are restored to an empty text and scored by the bias, and by 0
    if the model has no weights.  Rows are judged one by one, so repeats and ties do not matter; a column named
    like ``into`` is replaced.
    """
    return docs.withColumn(into, _judge(docs, model, True)(F.col(text)))


def scores(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """Like ``detect``, with the score alone."""
    return docs.withColumn(into, _judge(docs, model, False)(F.col(text)))


def _judge(docs: DataFrame, model: Model, with_text: bool):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<restored: string, score: double>" if with_text else "double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        decode = Decoder(known.chances)
        for texts in batches:
            restored, found = [], np.zeros(len(texts))
            for i, t in enumerate(texts):
                found[i] = known.score(t.as_py() or "", decode)
                if with_text:
                    restored.append(decode(t.as_py() or ""))
            yield pa.StructArray.from_arrays([pa.array(restored, pa.string()), pa.array(found)], ["restored", "score"]) if with_text else pa.array(found)

    return judge
