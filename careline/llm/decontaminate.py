"""Benchmark decontamination with suffix arrays over the documents.

The documents are the training side: each task sorts its shard's suffixes once, and every suffix of
every benchmark item is looked for by binary search in every shard.  Words are numbered by the
benchmark's vocabulary (0: not in it, or end of a document), and only suffixes that begin with word
pairs of the benchmark are sorted, since no other can match; those are few in clean text.  The order
goes as deep as a window; matches are then followed word by word to their full length.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.llm.common import cut, let, row_key, shielded

WINDOW = 13
#: Benchmark text that is searched for in one pass over the documents; more takes more passes.
BLOCK_BYTES = 2 << 20
#: Words of documents in one suffix array.
SHARD_WORDS = 1 << 20
#: Word pairs that a suffix must begin with, where windows are that long.
_LEAD = 4
#: Matches that are followed at once.
_PAIRS = 1 << 18

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPANS = "array<struct<start: int, stop: int>>"
_MATCHES = "array<struct<item_id: string, item_start: int, doc_start: int, n_words: int>>"
_RESULT = f"struct<n_words: bigint, spans: {_SPANS}, items: array<string>, matches: {_MATCHES}>"
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("items", pa.list_(pa.string())), ("matches", pa.list_(pa.struct([
        ("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])))])


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


class Block:
    """Benchmark items made ready for the search."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        texts = [[self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)] for _, text in items]
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        #: Item words in a row, each item followed by a 0; the last zeros let a window be cut anywhere.
        self.text = np.zeros(starts[-1] + window, np.int64)
        for s, t in zip(starts, texts):
            self.text[s:s + len(t)] = t
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, t in enumerate(texts):
            for j in range(max(1, len(t) - window + 1) if t else 0):
                found.setdefault(tuple(t[j:j + window]), []).append((i, j))
        windows = sorted(found)
        self.length = np.array([len(w) for w in windows], np.int64)
        self.windows = np.zeros((len(windows), window), np.int64)
        for k, w in enumerate(windows):
            self.windows[k, :len(w)] = w
        self.owners = [sorted({i for i, _ in found[w]}) for w in windows]
        #: Every place of every window, in order of the window and of the word to the left (0: the item begins).
        places = np.array([(k, i, j) for k, w in enumerate(windows) for i, j in found[w]], np.int64).reshape(-1, 3)
        text_at = starts[places[:, 1]] + places[:, 2]
        key = places[:, 0] * (len(self.numbers) + 1) + np.where(places[:, 2] > 0, self.text[text_at - 1], 0)
        order = np.argsort(key, kind="stable")
        self.place_key, self.place_text = key[order], text_at[order]
        self.place_item, self.place_at = places[order, 1], places[order, 2]
        self.lead = min(_LEAD, int(self.length.min()) - 1) if windows else 0
        rows = np.flatnonzero((self.text[:-1] > 0) & (self.text[1:] > 0))
        self.pairs = np.zeros(1 << 22, bool)
        self.pairs[self._slot(self.text[rows], self.text[rows + 1])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 2654435761 + b * 40503) & ((1 << 22) - 1)

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Positions whose suffix may begin with a window."""
        usable = text > 0
        if self.lead:
            pair = np.zeros(len(text), bool)
            pair[:-1] = usable[:-1] & usable[1:] & self.pairs[self._slot(text[:-1], text[1:])]
            usable = pair.copy()
            for k in range(1, self.lead):
                usable[:-k] &= pair[k:]
                usable[-k:] = False
        return np.flatnonzero(usable)

    def suffix_array(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidate suffixes in order, as far as a window is deep, and their first words."""
        at = self.candidates(text)
        depth = self.windows.shape[1]
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        heads = padded[at[:, None] + np.arange(depth)]
        order = np.lexsort(heads.T[::-1]) if len(at) else at
        return at[order], heads[order]

    def search(self, heads: np.ndarray, beyond: bool) -> np.ndarray:
        """For each window the first suffix that begins with it, or the first beyond those that do."""
        low, high = np.zeros(len(self.windows), np.int64), np.full(len(self.windows), len(heads))
        counted = np.arange(self.windows.shape[1]) < self.length[:, None]
        while (open_ := low < high).any():
            rows = np.flatnonzero(open_)
            middle = (low[rows] + high[rows]) // 2
            differs = np.where(counted[rows], heads[middle] - self.windows[rows], 0)
            where = (differs != 0).argmax(axis=1)
            sign = differs[np.arange(len(rows)), where]
            right = sign <= 0 if beyond else sign < 0
            low[rows[right]] = middle[right] + 1
            high[rows[~right]] = middle[~right]
        return low

    def matches(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of each occurrence of a window in a shard."""
        if not len(self.windows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, heads = self.suffix_array(text)
        low, high = self.search(heads, False), self.search(heads, True)
        n = high - low
        window = np.repeat(np.arange(len(n)), n)
        return window, places[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]

    def longest(self, text: np.ndarray, window: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Matches that no word to the left makes longer, and their full length: place, position, words.

        Each place of a window is tried, but for those with the document's word on their left: these are
        parts of longer matches.
        """
        most = len(self.numbers) + 1
        left = np.where(at > 0, text[at - 1], 0)
        bounds = [np.searchsorted(self.place_key, k, side) for k, side in (
            (window * most, "left"), (window * most + left, "left"), (window * most + left, "right"), ((window + 1) * most, "left"))]
        bounds[2] = np.where(left > 0, bounds[2], bounds[1])  # a word that no item has, or none
        for low, high in (bounds[:2], bounds[2:]):
            ends = np.cumsum(high - low)
            for start in range(0, int(ends[-1]) if len(ends) else 0, _PAIRS):
                pair = np.arange(start, min(start + _PAIRS, int(ends[-1])))
                row = np.searchsorted(ends, pair, "right")
                place = high[row] - ends[row] + pair
                yield place, at[row], self.followed(text, at[row], place, self.length[window[row]])

    def followed(self, text: np.ndarray, at: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Words that matches of ``n`` words have in full."""
        there, n, padded = self.place_text[place], n.copy(), np.concatenate([text, [0]])
        going = np.arange(len(at))
        while len(going):
            a, b = at[going] + n[going], there[going] + n[going]
            going = going[(a < len(padded)) & (padded[np.minimum(a, len(padded) - 1)] > 0) & (
                padded[np.minimum(a, len(padded) - 1)] == self.text[np.minimum(b, len(self.text) - 1)])]
            n[going] += 1
        return n


def search_shard(block: Block, texts: list[list[bytes]]) -> list[dict]:
    """The result of each document of a shard."""
    get = block.numbers.get
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = ends - [len(t) + 1 for t in texts]
    text = np.zeros(int(ends[-1]), np.int64)
    for s, t in zip(starts, texts):
        text[s:s + len(t)] = [get(w, 0) for w in t]
    out = [{"n_words": len(t), "spans": [], "items": [], "matches": []} for t in texts]
    window, at = block.matches(text)
    order = np.argsort(at, kind="stable")
    window, at = window[order], at[order]
    doc = np.searchsorted(ends, at, "right")
    for d in np.unique(doc):
        rows = slice(*np.searchsorted(doc, [d, d + 1]))
        a, b = at[rows] - starts[d], at[rows] - starts[d] + block.length[window[rows]]
        far = np.maximum.accumulate(b)
        new = np.r_[True, a[1:] > far[:-1]]
        begins = np.flatnonzero(new)
        out[d]["spans"] = [{"start": int(x), "stop": int(y)} for x, y in zip(a[begins], far[np.r_[begins[1:] - 1, len(a) - 1]])]
        held = set().union(*[block.owners[w] for w in np.unique(window[rows])])
        out[d]["items"] = sorted({block.names[i] for i in held})
    for place, at, n in block.longest(text, window, at):
        for d, w, p, k in zip(np.searchsorted(ends, at, "right"), place, at, n):
            out[d]["matches"].append({"item_id": block.names[block.place_item[w]], "item_start": int(block.place_at[w]),
                                      "doc_start": int(p - starts[d]), "n_words": int(k)})
    for d in np.unique(doc):
        out[d]["matches"].sort(key=lambda m: (m["doc_start"], m["item_id"], m["item_start"]))
    return out


_BLOCKS: dict[int, Block] = {}


def _block(shared, window: int) -> Block:
    if shared.value[0] not in _BLOCKS:
        _BLOCKS.clear()
        _BLOCKS[shared.value[0]] = Block(shared.value[1], window)
    return _BLOCKS[shared.value[0]]


def _searched(docs: DataFrame, items: list[tuple[str, str]], text: str, into: str, window: int) -> DataFrame:
    """``docs`` with the struct ``into``: what is found of a bounded block of items."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items))

    @F.arrow_udf(_RESULT)
    def find(texts: pa.Array) -> pa.Array:
        block, out, shard, size = _block(shared, window), [], [], 0
        for value in texts:
            shard.append(words(value.as_py()))
            size += len(shard[-1])
            if size >= SHARD_WORDS:
                out += search_shard(block, shard)
                shard, size = [], 0
        out += search_shard(block, shard) if shard else []
        return pa.array(out, _ARROW)

    return docs.withColumn(into, find(F.col(text)))


def covered(spans: Column) -> Column:
    """Number of words in spans that are sorted by start and may overlap."""
    state = F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("far")), lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], s["far"]))).alias("n"),
        F.greatest(s["far"], x["stop"]).alias("far")))
    return state["n"]


@shielded
def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", into: str = "hits", *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the struct ``into``: n_words, n_hit, items, spans, matches, contaminated.

    A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is
    one window.  ``spans`` are the runs of document words inside an occurrence of a window (start and
    stop), ``n_hit`` their number of words, ``items`` the ids (as strings, sorted) of items of which a
    window occurs, and ``contaminated`` says that n_hit > 0 and 20 * n_hit >= n_words.  ``matches``
    are the longest verbatim matches, each that neither side can make longer, with every item and at
    every place of it: item, word offsets in item and document, words.  Null and empty texts have no words, on either
    side; a null item id is written ``null``; items that agree in id and text count once; an empty
    benchmark finds nothing.  Input columns stay, but one named like ``into`` is replaced.

    The benchmark goes to the tasks in blocks of about ``block_bytes`` (an item is never cut), one
    pass over the documents for each; a benchmark of one block, the usual case, takes no shuffle.
    """
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("text"))
    items = items.where(F.length("text") > 0).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    blocks = ([tuple(r) for r in sorted(items.where(part == k).collect())] for k in range(n))
    if n == 1:
        found = _searched(docs, next(blocks), text, "__found", window).withColumns({
            "__spans": F.col("__found.spans"), "__items": F.col("__found.items"), "__matches": F.col("__found.matches"),
            "__n": F.col("__found.n_words")})
    else:
        own = docs.withColumns(dict(zip(("__id", "__text_hash"), row_key(id_col, text))))
        parts = None
        for block in blocks:
            one = _searched(own.select("__id", "__text_hash", text), block, text, "__found", window)
            one = cut(one.select("__id", "__text_hash", "__found").distinct().where(F.size("__found.spans") > 0))
            parts = one if parts is None else parts.union(one)
        every = parts.groupBy(F.col("__id").alias("__did"), F.col("__text_hash").alias("__dhash")).agg(
            F.sort_array(F.flatten(F.collect_list("__found.spans"))).alias("__spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("__found.items")))).alias("__items"),
            F.flatten(F.collect_list("__found.matches")).alias("__matches"))
        found = own.join(every, (F.col("__id") == F.col("__did")) & (F.col("__text_hash") == F.col("__dhash")), "left")
        count = F.size(F.filter(F.split(F.col(text), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != ""))
        found = found.withColumn("__n", F.coalesce(count, F.lit(0)).cast("bigint"))
    empty = F.array()
    result = let(F.struct(F.col("__n").alias("n"), covered(F.col("__spans")).alias("hit")), lambda x: F.struct(
        x["n"].alias("n_words"), F.coalesce(x["hit"], F.lit(0)).alias("n_hit"),
        F.coalesce("__items", empty.cast("array<string>")).alias("items"),
        F.coalesce("__spans", empty.cast(_SPANS)).alias("spans"),
        F.coalesce("__matches", empty.cast(_MATCHES)).alias("matches"),
        F.coalesce((x["hit"] > 0) & (20 * x["hit"] >= x["n"]), F.lit(False)).alias("contaminated")))
    return found.withColumn(into, result).drop("__id", "__text_hash", "__did", "__dhash", "__found", "__spans", "__items", "__matches", "__n")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; see ``contamination``."""
    return contamination(docs, benchmark, into="__hits", **options).where("NOT __hits.contaminated").drop("__hits")
