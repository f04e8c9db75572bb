"""Source divergence audit: how far the words of a language's sources differ from one another.

1. Document frequencies of all terms are counted; a language keeps those in enough documents.
2. The kept terms are sorted and become minimal acyclic transducers, one for each range of 65,536 terms,
   that give a term's place in the order.
3. The text is streamed through the transducers and recounted by source: counts are lists of (place,
   number) for each 4,096 places, merged over the tasks.
4. For each 4,096 places of a language the sources' counts are compared with each other's and with the
   language's.  All arithmetic is in integers; ties go by place, which is the order of the terms.
"""

import re
from collections import Counter
from collections.abc import Iterable
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm.common import cut
from careline.llm.transducer import Transducer, Vocabulary, build
from careline.operators.rows import with_row_index

#: Documents that a kept term is in; terms of a source that are reported; the scale of shares.
MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Terms of a transducer, places of a list of counts, and bytes of transducers that are broadcast at once:
#: a larger vocabulary takes one more pass over the text for each.
RANGE, CHUNK, PASS_BYTES = 1 << 16, 1 << 12, 64 << 20
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_TERM = np.zeros(256, bool)
_IS_TERM[97:123] = _IS_TERM[128:] = True
#: Counts that a task holds before it merges them, terms it holds before it passes them on, bytes of text looked at at once.
_HELD, _DISTINCT, _PIECE = 1 << 21, 200_000, 1 << 20


def _named(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    cells = {"lang": F.col(lang).cast("string"), "source": F.col(source).cast("string"), "text": F.col(text)}
    return df.select(*[F.coalesce(c, F.lit("")).alias(n) for n, c in cells.items()])


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, n): the number of rows of a language that hold a term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter[bytes]] = {}

        def counted() -> pa.RecordBatch:
            lang = pa.array([a for a, terms in seen.items() for _ in terms], pa.string())
            term = pa.array([t for terms in seen.values() for t in terms], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([lang, term, pa.array([n for terms in seen.values() for n in terms.values()], pa.int64())],
                                              ["lang", "term", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                data = text.as_py()
                if not _TERM.search(data.lower()):
                    continue
                seen.setdefault(lang, Counter()).update(set(_TERM.findall(data.lower())))
                if sum(map(len, seen.values())) > _DISTINCT:
                    yield counted()
                    seen.clear()
        yield counted()

    rows = docs.select("lang", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(count, "lang string, term string, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Kept terms and their places in the order of (language, term): (lang, term, place)."""
    kept = document_frequencies(docs).where(F.col("n") >= min_docs).select("lang", "term")
    return cut(with_row_index(kept, ["lang", "term"], "place"))


def transducers(terms: DataFrame, size: int = RANGE) -> DataFrame:
    """One transducer for each language and range of places: its first term and place, and its arrays."""

    def make(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        sorted_terms = [t.as_py().encode() for t in rows.column("term")]
        made = build(sorted_terms)
        cells = {"lang": rows.column("lang")[:1], "place": rows.column("place")[:1], "first": [sorted_terms[0]], "root": [made.root],
                 "n_terms": [made.n_terms], "size": [made.nbytes]}
        return pa.table(cells | {c: [getattr(made, c).tobytes()] for c in ("key", "target", "skip", "final")})

    return terms.groupBy("lang", F.floor(F.col("place") / size).alias("range")).applyInArrow(
        make, "lang string, place bigint, first binary, root bigint, n_terms bigint, size bigint, key binary, target binary, skip binary, final binary")


def passes(sizes: Iterable[tuple[str, int, int]], limit: int = PASS_BYTES) -> list[list[tuple[str, int]]]:
    """(lang, place, bytes) of transducers in order, dealt to passes that stay under the limit."""
    out, held = [], limit + 1
    for lang, place, size in sizes:
        if held + size > limit:
            out.append([])
            held = 0
        out[-1].append((lang, place))
        held += size
    return out


def load(rows: Iterable) -> dict[str, Vocabulary]:
    """A vocabulary for each language from rows of ``transducers``."""
    by_lang: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.place)):
        arrays = (np.frombuffer(r[c], t) for c, t in (("key", np.int64), ("target", np.int32), ("skip", np.int32), ("final", bool)))
        by_lang.setdefault(r.lang, []).append((bytes(r.first), r.place, Transducer(*arrays, r.root, r.n_terms)))
    return {lang: Vocabulary(parts) for lang, parts in by_lang.items()}


def spans(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in lower-cased bytes; ``texts`` are the places where a text begins."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_TERM[data]
    starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # two texts that touch are not one term
    joined = texts[(texts > 0) & (texts < len(data))]
    joined = joined[inside[joined] & inside[joined + 1]]
    starts[joined], ends[joined] = True, True
    return np.flatnonzero(starts), np.flatnonzero(ends)


class Counts:
    """Numbers of (group, place) pairs, merged when there are many."""

    def __init__(self, chunk: int = CHUNK):
        self.chunk = chunk
        self.groups: dict[tuple[str, str], int] = {}
        self.key, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new, self.n_new = [], 0

    def add(self, group: tuple[str, str], places: np.ndarray) -> None:
        number = self.groups.setdefault(group, len(self.groups))
        self.new.append(places | number << 40)
        self.n_new += len(places)

    def merge(self) -> None:
        key, n = np.unique(np.concatenate(self.new), return_counts=True) if self.new else (self.key[:0], self.n[:0])
        both, where = np.unique(np.concatenate([self.key, key]), return_inverse=True)
        self.key, self.n = both, np.bincount(where, np.concatenate([self.n, n]), len(both)).astype(np.int64)
        self.new, self.n_new = [], 0

    def lists(self) -> pa.RecordBatch:
        """What was counted, as one row for each group and chunk of places; it is forgotten then."""
        self.merge()
        names, chunk = list(self.groups), (self.key & (1 << 40) - 1) // self.chunk + (self.key >> 40 << 40)
        first = np.flatnonzero(np.r_[True, np.diff(chunk) != 0]) if len(chunk) else chunk
        ends = np.r_[first[1:], len(chunk)]
        group = [names[g] for g in chunk[first] >> 40]
        own = ((self.key & (1 << 40) - 1) % self.chunk).astype(np.uint16)
        cells = [pa.array([g[0] for g in group], pa.string()), pa.array([g[1] for g in group], pa.string()),
                 pa.array(chunk[first] & (1 << 40) - 1, pa.int64()),
                 pa.array([own[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                 pa.array([self.n[a:b].astype(np.uint32).tobytes() for a, b in zip(first, ends)], pa.binary())]
        self.__init__(self.chunk)
        return pa.RecordBatch.from_arrays(cells, ["lang", "source", "chunk", "places", "counts"])


def recount(docs: DataFrame, parts: dict[str, Vocabulary], chunk: int = CHUNK) -> DataFrame:
    """Lists of counts of the vocabularies' terms: (lang, source, chunk, places, counts, n), one row for each chunk that a source has."""
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value, Counts(chunk)
        for batch in batches:
            for group, data, texts in _pieces(batch):
                data = _LOWER[data]
                places = known[group[0]].ordinals(data, *spans(data, texts))
                counts.add(group, places[places >= 0])
                if counts.n_new > _HELD:
                    counts.merge()
                    if len(counts.key) > _HELD:
                        yield counts.lists()
        yield counts.lists()

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chunk, np.int64)
        for batch in batches:
            for places, counts in zip(batch.column("places"), batch.column("counts")):
                total[np.frombuffer(places.as_py(), np.uint16)] += np.frombuffer(counts.as_py(), np.uint32)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([*[pa.array([k.as_py()]) for k in key], pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                                          pa.array([total[at].tobytes()], pa.binary()), pa.array([int(total.sum())])],
                                         ["lang", "source", "chunk", "places", "counts", "n"])

    rows = docs.where(F.col("lang").isin(list(parts))).select("lang", "source", F.col("text").cast("binary").alias("text"))
    kind = "lang string, source string, chunk bigint, places binary, counts binary"
    return rows.mapInArrow(stream, kind).groupBy("lang", "source", "chunk").applyInArrow(merged, kind + ", n bigint")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, str], np.ndarray, np.ndarray]]:
    """The texts of a batch by group, about a megabyte at once: group, bytes, and where each text begins."""
    by_group: dict[tuple[str, str], list[int]] = {}
    for i, group in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
        by_group.setdefault(group, []).append(i)
    for group, rows in by_group.items():
        held, size = [], 0
        for i in rows:
            held.append(batch.column("text")[i].as_py())
            size += len(held[-1])
            if size > _PIECE or i == rows[-1]:
                yield group, np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held[:-1])])
                held, size = [], 0


def share(count: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + n_terms)), exactly: three decimals at a time stay within 64 bits."""
    rest, out, whole = count.astype(np.int64) + 1, np.zeros(count.shape, np.int64), int(total) + int(n_terms)
    if whole < 1 << 53:
        for _ in range(3):
            rest = rest * 1000
            out = out * 1000 + rest // whole
            rest %= whole
        return out + 1
    return np.array([1 + SCALE * int(c) // whole for c in rest.ravel()], np.int64).reshape(count.shape)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); below 2^63, as shares are at most SCALE + 1."""
    return (p - q) * (p - q) // q


_FOUND = "lang string, source string, other string, place bigint, value bigint"


def compare_chunk(rows: pa.Table, top: int = TOP, chunk: int = CHUNK) -> pa.Table:
    """One chunk of a language: each pair's part of the distance, and each source's best terms of the chunk.

    Rows are all sources of the language, with the sum of all their counts (``total``); those without a term
    in the chunk have null lists.
    """
    rows = rows.sort_by("source")
    lang, first, size = (rows.column(c)[0].as_py() for c in ("lang", "first", "size"))
    terms, names = rows.column("n_terms")[0].as_py(), rows.column("source").to_pylist()
    totals = [t or 0 for t in rows.column("total").to_pylist()]
    counts = np.zeros((len(names), chunk), np.int64)
    for i, (places, n) in enumerate(zip(rows.column("places"), rows.column("counts"))):
        if places.is_valid:
            counts[i, np.frombuffer(places.as_py(), np.uint16)] = np.frombuffer(n.as_py(), np.int64)
    begin = first % chunk
    counts = counts[:, begin:begin + size]
    p = np.array([share(c, t, terms) for c, t in zip(counts, totals)])
    source, other, place, value = [], [], [], []
    for i, q in enumerate(p):
        rest = [k for k in range(len(names)) if k != i]
        source += [names[k] for k in rest]
        other += [names[i]] * len(rest)
        value += distance(p[rest], q).sum(axis=1).tolist()
    place = [None] * len(value)
    q = share(counts.sum(axis=0), sum(totals), terms)
    for i, name in enumerate(names):
        at = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        far = distance(p[i][at], q[at])
        best = np.lexsort((at, -far))[:top]
        source += [name] * len(best)
        other += [None] * len(best)
        place += (first + at[best]).tolist()
        value += far[best].tolist()
    return pa.table({"lang": pa.array([lang] * len(value), pa.string()), "source": pa.array(source, pa.string()), "other": pa.array(other, pa.string()),
                     "place": pa.array(place, pa.int64()), "value": pa.array(value, pa.int64())})


def _ranked(rows: DataFrame, part: str, item: str | Column, order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), order))
    return rows.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", rank.alias("rank"), order)


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", *, min_docs: int = MIN_DOCS,
               top: int = TOP, pass_bytes: int = PASS_BYTES, term_range: int = RANGE, chunk: int = CHUNK) -> DataFrame:
    """(lang, source, part, item, value, rank): a source's distance to each other source of its language (``pair``), and
    the terms it uses more than the language does (``term``, the ``top`` first).

    Terms are runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased.  Null text, language
    and source are empty strings; every row is a document, so repeated rows count each time.  Sources without a
    kept term are compared by the shares that absent terms have; a language that keeps no term has distances of
    0 and no ``term`` rows, one with a single source no ``pair`` rows, an empty table no rows.  Other columns
    are not read.

    The vocabulary comes to the driver and to the tasks in parts of ``pass_bytes``, each with a pass over the text; a
    part is made of transducers of ``term_range`` terms, and counts are kept in lists of ``chunk`` places (65,536 at most).
    The distances of all pairs of a language's sources are asked for, so the result grows with their square.
    """
    if term_range % chunk:
        raise ValueError("term_range must be a multiple of chunk")  # or one list would come from two passes
    docs = _named(docs, text, lang, source)
    terms = vocabulary(docs, min_docs)
    made = cut(transducers(terms, term_range))
    sizes = [tuple(r) for r in made.select("lang", "place", "size").orderBy("lang", "place").collect()]
    lists = []
    for chosen in passes(sizes, pass_bytes):
        wanted = made.where(F.struct("lang", "place").isin([F.struct(F.lit(a), F.lit(b).cast("bigint")) for a, b in chosen]))
        lists.append(cut(recount(docs, load(wanted.collect()), chunk)))
    groups = cut(docs.select("lang", "source").distinct())
    spark = docs.sparkSession
    kind = "lang string, source string, chunk bigint, places binary, counts binary, n bigint"
    counted = spark.createDataFrame([], kind)
    for one in lists:
        counted = counted.unionByName(one)
    totals = groups.join(counted.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    sized = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.min("place").alias("low"))
    low, high = F.col("low"), F.col("low") + F.col("n_terms")
    spread = sized.select("lang", "n_terms", low, high.alias("high"),
                          F.explode(F.sequence(F.floor(low / chunk), F.floor((high - 1) / chunk))).alias("chunk"))
    first = F.greatest("low", F.col("chunk") * chunk)
    spread = spread.select("lang", "n_terms", "chunk", first.alias("first"), (F.least("high", (F.col("chunk") + 1) * chunk) - first).alias("size"))
    dense = spread.join(totals, "lang").join(counted.drop("n"), ["lang", "source", "chunk"], "left")

    def compare(rows: pa.Table) -> pa.Table:
        return compare_chunk(rows, top, chunk)

    found = cut(dense.groupBy("lang", "chunk").applyInArrow(compare, _FOUND))
    sums = found.where(F.col("other").isNotNull()).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    pairs = groups.join(groups.withColumnRenamed("source", "other"), "lang").where(F.col("source") != F.col("other"))
    pairs = pairs.join(sums, ["lang", "source", "other"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    best = _ranked(found.where(F.col("place").isNotNull()), "term", "place", "place").where(F.col("rank") <= top)
    best = best.drop("item").join(terms.select("place", F.col("term").alias("item")), "place")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return _ranked(pairs, "pair", "other", "other").select(columns).unionByName(best.select(columns))
