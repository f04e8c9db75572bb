"""Substring dedup: words go that belong to a window of words which also stands earlier.

Windows are found to be equal in buckets.  A window's minimiser is the smallest hash of its runs of
four words; consecutive windows that share it (a super-k-mer) travel together as one string, so a
window costs about three words of shuffle instead of twenty, and equal windows reach one bucket.
There they are sorted by hash, and equal hashes are compared byte by byte.

Before the shuffle each task does the same with its own windows: what stands earlier in the same
chunk of documents is settled there, so a passage with many copies travels once for each chunk.  The
windows at a frequent passage's edges differ but share its minimiser; if a minimiser has more windows
than a bucket should hold, its windows are dealt out one by one, by their own hash, and in two rounds:
first among the chunks of a group, then among the groups, so that a window with a copy in every chunk
meets about the square root of their number at once.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careline.llm.common import cut, row_key, shielded

WINDOW, GRAM = 20, 4
#: Text that a task looks at at once, and packed text that a bucket should hold.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 24 << 20
#: A minimiser is hot from this many super-k-mers on, and from this share of all (so hot ones are few);
#: it is counted if it stands this often in one task.  Bytes that a super-k-mer takes, about.
HOT_RUNS, HOT_SHARE, REPORTED, RUN_BYTES = 1 << 15, 1 << 20, 4, 160
_PIECE = 1 << 20

_META = np.dtype([("id", "<i8"), ("hash", "<i8"), ("start", "<i4"), ("words", "<i4")])
_SPAN = np.dtype([("id", "<i8"), ("hash", "<i8"), ("start", "<i4"), ("stop", "<i4")])
_ROUTED = "bucket bigint, part bigint, spans boolean, data binary"
_SPANS = "__did bigint, __dhash bigint, start int, stop int"

_POWERS = np.cumprod(np.r_[np.uint64(1), np.full((1 << 16) - 1, 0x9E3779B97F4A7C15 | 1, np.uint64)])
_Q = [pow(0xC2B2AE3D27D4EB4F, 1 << k, 1 << 64) for k in range(6)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all bits."""
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


class Words:
    """Words of a buffer in which every word is followed by one blank or line break."""

    def __init__(self, data: bytes):
        self.data = data
        self.bytes = np.frombuffer(data, np.uint8)
        self.stops = np.flatnonzero((self.bytes == 32) | (self.bytes == 10))
        self.starts = np.r_[0, self.stops[:-1] + 1] if len(self.stops) else self.stops

    def hashes(self) -> np.ndarray:
        """64 bits for each word."""
        out, at = np.empty(len(self.stops), np.uint64), 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.stops, self.starts[at] + _PIECE)))
            a, n = self.starts[at], self.stops[at:to] - self.starts[at:to] + 1
            offset = np.arange(n.sum()) - np.repeat(self.starts[at:to] - a, n)
            value = (self.bytes[a:self.stops[to - 1] + 1].astype(np.uint64) + np.uint64(offset.max() >> 16) + np.uint64(1)) * _POWERS[offset & 0xFFFF]
            value[self.stops[at:to] - a] = 0
            out[at:to] = np.add.reduceat(value, self.starts[at:to] - a)
            at = to
        return mix(out)


def _joined(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of 2^k words, from that of single words."""
    for i in range(k):
        n = 1 << i
        h = h[:-n] + h[n:] * np.uint64(_Q[i]) if len(h) > n else h[:0]
    return h


def window_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each run of twenty words: of sixteen, and of the four behind."""
    four = _joined(h, 2)
    sixteen = _joined(h, 4)
    n = max(0, len(h) - WINDOW + 1)
    return mix(sixteen[:n] + four[16:16 + n] * np.uint64(_Q[4]))


def minimisers(h: np.ndarray) -> np.ndarray:
    """Smallest hash among the seventeen runs of four words of each window."""
    low = mix(_joined(h, 2))
    n = max(0, len(h) - WINDOW + 1)
    for k in (1, 2, 4, 8):
        low = np.minimum(low[:-k], low[k:]) if len(low) > k else low[:0]
    return np.minimum(low[:n], low[1:n + 1])


def _unequal(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which stretches of n bytes at a and at b differ."""
    out, ends, at = np.zeros(len(a), bool), np.cumsum(n), 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
        k = n[at:to]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        differ = data[np.repeat(a[at:to], k) + step] != data[np.repeat(b[at:to], k) + step]
        out[at:to] = np.logical_or.reduceat(differ, np.cumsum(k) - k)
        at = to
    return out


def first_equal(words: Words, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each window (its first word in ``at``, rising) the first window of the same words."""
    order = np.argsort(hashes, kind="stable")
    new = np.r_[True, hashes[order][1:] != hashes[order][:-1]] if len(at) else np.zeros(0, bool)
    first = np.empty(len(at), np.int64)
    first[order] = at[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    again = np.flatnonzero(first != at)
    i, f = at[again], first[again]
    # next to a pair of equal windows a pair is equal if its last words are
    chained = np.r_[False, (np.diff(i) == 1) & (np.diff(f) == 1)] if len(i) else np.zeros(0, bool)
    a = np.where(chained, words.starts[np.where(chained, i + WINDOW - 1, i)], words.starts[i])
    b = np.where(chained, words.starts[np.where(chained, f + WINDOW - 1, f)], words.starts[f])
    n = words.stops[i + WINDOW - 1] - a
    odd = n != words.stops[f + WINDOW - 1] - b
    same = ~odd
    odd[same] = _unequal(words.bytes, a[same], b[same], n[same])
    if odd.any():  # two texts, one hash: settle the windows of these hashes by their text
        rows = np.flatnonzero(np.isin(hashes, hashes[again[odd]]))
        seen: dict[bytes, int] = {}
        for r in rows:
            w = at[r]
            first[r] = seen.setdefault(words.data[words.starts[w]:words.stops[w + WINDOW - 1]], w)
    return first


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each run, given which rows begin one."""
    first = np.flatnonzero(breaks)
    return first, np.r_[first[1:], len(breaks)] - 1 if len(first) else first


class Chunk:
    """Documents of at least a window, in order of their keys, each key once."""

    def __init__(self, rows: list[tuple[int, int, bytes]]):
        rows = list({(i, h): (i, h, t) for i, h, t in rows}.values())
        rows.sort(key=lambda r: r[:2])
        self.words = Words(b"".join(t + b"\n" for _, _, t in rows))
        n = np.array([t.count(b" ") + 1 for _, _, t in rows], np.int64)
        self.id = np.array([r[0] for r in rows], np.int64)
        self.hash = np.array([r[1] for r in rows], np.int64)
        self.begin = np.cumsum(n) - n
        self.h = self.words.hashes()
        self.at = np.concatenate([b + np.arange(k - WINDOW + 1) for b, k in zip(self.begin, n)]) if rows else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(rows)), n - WINDOW + 1)
        self.low = minimisers(self.h)[self.at]

    def spans(self, rows: np.ndarray) -> np.ndarray:
        """Spans of words that these windows (row numbers, rising) cover."""
        at, doc = self.at[rows], self.doc[rows]
        first, last = _runs(np.r_[True, (np.diff(at) != 1) | (np.diff(doc) != 0)]) if len(at) else (rows, rows)
        out = np.empty(len(first), _SPAN)
        out["id"], out["hash"] = self.id[doc[first]], self.hash[doc[first]]
        out["start"] = at[first] - self.begin[doc[first]]
        out["stop"] = at[last] - self.begin[doc[first]] + WINDOW
        return out


def _chunks(batches: Iterable[pa.RecordBatch], chunk_bytes: int) -> Iterator[Chunk]:
    rows, size = [], 0
    for batch in batches:
        for i, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = (text.as_py() or "").encode("utf-8", "replace").split()
            if len(words) >= WINDOW:
                rows.append((i, h, b" ".join(words)))
                size += len(rows[-1][2])
            if size >= chunk_bytes:
                yield Chunk(rows)
                rows, size = [], 0
    if rows:
        yield Chunk(rows)


class _Tally:
    """Exact counts of 64-bit numbers; what is held is bounded."""

    def __init__(self, limit: int = 1 << 22):
        self.limit, self.value, self.n = limit, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, value: np.ndarray) -> bool:
        """Count numbers; whether more are held now than should be."""
        value, n = np.unique(value, return_counts=True)
        self.value, where = np.unique(np.r_[self.value, value], return_inverse=True)
        self.n = np.bincount(where, np.r_[self.n, n], len(self.value)).astype(np.int64)
        return len(self.value) > self.limit

    def often(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        rows = self.n >= least
        value, n = self.value[rows], self.n[rows]
        self.value, self.n = self.value[:0], self.n[:0]
        return value, n


def _survey(chunk_bytes: int, reported: int):
    """Super-k-mers and bytes of each task (minimiser null), and the minimisers that are not rare in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, held, runs, size = _Tally(), [], 0, 0

        def counted() -> pa.RecordBatch:
            value, n = tally.often(reported)
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n), pa.array(np.zeros(len(n), np.int64))], ["minimiser", "n", "size"])

        for chunk in _chunks(batches, chunk_bytes):
            first, _ = _runs(np.r_[True, (np.diff(chunk.low) != 0) | (np.diff(chunk.doc) != 0)])
            held.append(chunk.low[first])
            runs, size = runs + len(first), size + len(chunk.words.data)
            if sum(map(len, held)) > 1 << 20:
                if tally.add(np.concatenate(held)):
                    yield counted()
                held = []
        if held:
            tally.add(np.concatenate(held))
        yield counted()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([runs]), pa.array([size])], ["minimiser", "n", "size"])

    return run


def _packed(meta: np.ndarray, text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(len(meta).to_bytes(8, "little") + meta.tobytes() + text)


def _unpacked(data: bytes, kind: np.dtype) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    end = 8 + int.from_bytes(raw[:8], "little") * kind.itemsize
    return np.frombuffer(raw[8:end], kind), raw[end:]


def _records(words: Words, at: np.ndarray, owner: np.ndarray, ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray,
             bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Windows as packed text by bucket: consecutive ones of one owner and bucket are one record.

    ``at`` are the windows' first words, ``starts`` the same as places in their document, ``ids`` and ``hashes`` the documents' keys.
    """
    begin, last = _runs(np.r_[True, (np.diff(at) != 1) | (np.diff(owner) != 0) | (np.diff(bucket) != 0)]) if len(at) else (at, at)
    order = np.argsort(bucket[begin], kind="stable")
    begin, last = begin[order], last[order]
    own = bucket[begin]
    meta = np.empty(len(begin), _META)
    meta["id"], meta["hash"], meta["start"] = ids[begin], hashes[begin], starts[begin]
    meta["words"] = at[last] - at[begin] + WINDOW
    a, b = words.starts[at[begin]], words.stops[at[last] + WINDOW - 1]
    first_row, last_row = _runs(np.r_[True, np.diff(own) != 0]) if len(own) else (own, own)
    for x, y in zip(first_row.tolist(), (last_row + 1).tolist()):
        text = b"\n".join([words.data[s:e] for s, e in zip(a[x:y].tolist(), b[x:y].tolist())]) + b"\n"
        yield int(own[x]), _packed(meta[x:y], text)


def _dealt(value: np.ndarray, n: int) -> np.ndarray:
    return (mix(value) % np.uint64(n)).astype(np.int64)


def _row(bucket: int, part: int, spans: bool, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([part]), pa.array([spans]), pa.array([data], pa.binary())],
                                      ["bucket", "part", "spans", "data"])


def _route(hot: np.ndarray, buckets: int, chunk_bytes: int, groups: int = 0):
    """Text -> super-k-mers by bucket, and spans that a chunk settles by itself; with ``groups`` windows of hot
    minimisers alone, by their own hash and group of chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            hashes = window_hashes(chunk.h)[chunk.at]
            first = first_equal(chunk.words, chunk.at, hashes)
            own = mix(chunk.hash[:1].view(np.uint64))
            if not groups:
                spans = chunk.spans(np.flatnonzero(first != chunk.at))
                if len(spans):
                    yield _row(int(own[0] % np.uint64(buckets)), 0, True, _packed(spans, b""))
            rows = np.flatnonzero((first == chunk.at) & (np.isin(chunk.low, hot) == bool(groups)))
            at, doc = chunk.at[rows], chunk.doc[rows]
            bucket = _dealt(hashes[rows] if groups else chunk.low[rows], buckets)
            for number, data in _records(chunk.words, at, doc, chunk.id[doc], chunk.hash[doc], at - chunk.begin[doc], bucket):
                yield _row(number, int(own[0] % np.uint64(groups)) if groups else 0, False, data)

    return run


class _Met:
    """All windows that came to a bucket, in order of their documents, and the first of the same words for each."""

    def __init__(self, packed: Iterable[bytes]):
        metas, texts = [], []
        for data in packed:
            meta, text = _unpacked(data, _META)
            metas.append(meta)
            texts += text.split(b"\n")[:-1]
        meta = np.concatenate(metas) if metas else np.empty(0, _META)
        order = np.lexsort((meta["start"], meta["hash"], meta["id"]))
        self.meta = meta = meta[order]
        self.words = Words(b"".join([texts[i] + b"\n" for i in order.tolist()]))
        n = meta["words"].astype(np.int64)
        begin, k = np.cumsum(n) - n, n - WINDOW + 1
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        self.record = np.repeat(np.arange(len(k)), k)
        self.at = begin[self.record] + step
        self.start = meta["start"][self.record] + step
        self.hashes = window_hashes(self.words.hashes())[self.at] if len(self.at) else np.zeros(0, np.uint64)
        self.first = first_equal(self.words, self.at, self.hashes)
        origin = np.searchsorted(begin, self.first, "right") - 1
        # a repeated row is the same document: its windows are no earlier ones
        self.late = ((meta["id"][self.record] != meta["id"][origin]) | (meta["hash"][self.record] != meta["hash"][origin])
                     | (self.start != meta["start"][origin] + self.first - begin[origin]))

    def spans(self) -> np.ndarray:
        """Spans of words covered by windows that stand earlier."""
        rows = np.flatnonzero(self.late)
        a, r = self.start[rows], self.record[rows]
        i, j = _runs(np.r_[True, (np.diff(a) != 1) | (np.diff(r) != 0)]) if len(rows) else (rows, rows)
        spans = np.empty(len(i), _SPAN)
        spans["id"], spans["hash"], spans["start"], spans["stop"] = self.meta["id"][r[i]], self.meta["hash"][r[i]], a[i], a[j] + WINDOW
        return spans


def _settle(first_bucket: int, buckets: int):
    """The first round of hot windows: spans, and one window of the same words for the second round."""

    def run(table: pa.Table) -> pa.Table:
        met = _Met(d.as_py() for d in table.column("data"))
        out, spans = [], met.spans()
        if len(spans):
            out.append((first_bucket + int(table.column("part")[0].as_py() % buckets), True, _packed(spans, b"")))
        rows = np.flatnonzero(met.first == met.at)
        record = met.record[rows]
        out += [(first_bucket + b, False, data) for b, data in _records(
            met.words, met.at[rows], record, met.meta["id"][record], met.meta["hash"][record], met.start[rows], _dealt(met.hashes[rows], buckets))]
        return pa.table({"bucket": pa.array([o[0] for o in out], pa.int64()), "part": pa.array([0] * len(out), pa.int64()),
                         "spans": pa.array([o[1] for o in out], pa.bool_()), "data": pa.array([o[2] for o in out], pa.binary())})

    return run


def _judge(table: pa.Table) -> pa.Table:
    """Spans of words covered by windows that stand earlier, from all that came to a bucket."""
    kinds = table.column("spans").to_pylist()
    done = [_unpacked(d.as_py(), _SPAN)[0] for d, spans in zip(table.column("data"), kinds) if spans]
    if not all(kinds):
        done.append(_Met(d.as_py() for d, spans in zip(table.column("data"), kinds) if not spans).spans())
    spans = np.concatenate(done)
    return pa.table({"__did": spans["id"], "__dhash": spans["hash"], "start": spans["start"], "stop": spans["stop"]})


def _kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
    kept, n_words, n_removed = [], [], []
    for text, own in zip(texts, spans):
        words = (text.as_py() or "").encode("utf-8", "replace").split()
        n_words.append(len(words))
        if own.is_valid and len(own):
            keep = np.ones(len(words), bool)
            for s in own.as_py():
                keep[s["start"]:s["stop"]] = False
            words = [words[i] for i in np.flatnonzero(keep)]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode("utf-8"))
    return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                                      ["kept", "n_words", "n_removed"])


def routed_windows(rows: DataFrame, chunk_bytes: int, bucket_bytes: int, hot_runs: int) -> DataFrame:
    """What comes to each bucket, from rows of id, hash and text: packed windows, and spans that are settled."""
    survey = cut(rows.mapInArrow(_survey(chunk_bytes, min(REPORTED, hot_runs)), "minimiser bigint, n bigint, size bigint").groupBy("minimiser").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size")))
    total = survey.where("minimiser IS NULL").first()
    often = survey.where("minimiser IS NOT NULL").where(F.col("n") >= max(hot_runs, (total["n"] if total else 0) // HOT_SHARE))
    often = often.select("minimiser", "n").collect()  # at most HOT_SHARE of them
    size = total["size"] if total else 0
    hot, buckets = np.array([r.minimiser for r in often], np.int64).view(np.uint64), max(1, -(-3 * size // bucket_bytes))
    routed = rows.mapInArrow(_route(hot, buckets, chunk_bytes), _ROUTED)
    if not often:
        return _spread(routed, buckets)
    groups = max(1, math.isqrt(size // chunk_bytes))
    many = max(1, -(-sum(r.n for r in often) * WINDOW * RUN_BYTES // bucket_bytes))
    met = rows.mapInArrow(_route(hot, max(1, many // groups), chunk_bytes, groups), _ROUTED)
    return _spread(routed.unionByName(met.groupBy("bucket", "part").applyInArrow(_settle(buckets, many), _ROUTED)), buckets + many)


def _spread(routed: DataFrame, buckets: int) -> DataFrame:
    """A partition for every few buckets, where the session's shuffles would have fewer."""
    parts = min(buckets // 4, 1 << 16)
    few = parts <= int(routed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return routed if few else routed.repartition(parts, "bucket")


@shielded
def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", into: str = "deduped", *,
                          chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``docs`` with the struct ``into``: ``kept`` (kept words joined by one blank), ``n_words``, ``n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a window is twenty consecutive words of one document.
    A word goes if a window covers it whose words also start earlier: in a document with a smaller id,
    or earlier in the same one.  Windows are judged on the input.  Null and empty texts have no words;
    texts of fewer than twenty are left alone.  A null id is below all others; rows with one id and
    different texts are ordered by a hash of the text, and rows that agree in both are one document
    and share its result.  Other columns stay, one named like ``into`` is replaced.
    """
    own = docs.withColumns(dict(zip(("__id", "__text_hash"), row_key(id_col, text))))
    routed = routed_windows(own.select("__id", "__text_hash", text), chunk_bytes, bucket_bytes, hot_runs)
    spans = routed.groupBy("bucket").applyInArrow(_judge, _SPANS).groupBy("__did", "__dhash").agg(
        F.collect_list(F.struct("start", "stop")).alias("__spans"))
    keep = F.arrow_udf(_kept, "struct<kept: string, n_words: bigint, n_removed: bigint>")
    return (own.join(spans, (F.col("__id") == F.col("__did")) & (F.col("__text_hash") == F.col("__dhash")), "left")
            .withColumn(into, keep(F.col(text), F.col("__spans"))).drop("__id", "__text_hash", "__did", "__dhash", "__spans"))
