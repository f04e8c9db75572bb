"""SimHash near-dedup: fingerprints of word shingles, linked at a small Hamming distance.

The 64 bits are cut into six blocks.  Two fingerprints that differ in at most three bits agree in
at least three whole blocks, so they meet when rows are joined on each choice of three blocks; what
meets is then verified.  Copies are one fingerprint from the start, and a group that meets on a
block key is not paired off: a search through it gives a spanning forest, whose links connect the
same fingerprints as all its pairs would.  A group too large for one task meets again on its
remaining bits, cut into four more blocks of which a close pair shares one, until it is small; ten
remaining bits leave at most 1,024 fingerprints, so this ends.
"""

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm.common import cut

DISTANCE = 3
#: Most fingerprints that one task compares with each other; larger groups are split by further blocks.
GROUP = 1024
_HASHES = 1 << 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of all word shingles; zero if there is no word."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHES):
        block = np.array(hashes[at:at + _HASHES], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, into: str, width: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of the whole text as a (signed) bigint."""

    @F.arrow_udf("bigint")
    def mark(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(texts))
        return pa.array(values.view(np.int64))

    return docs.withColumn(into, mark(F.col(text)))


def hex_digits(mark: Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n blocks of the given bits."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits), n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_masks() -> list[int]:
    blocks = _blocks(list(range(64)), 2 * DISTANCE)
    return [sum(c) for c in combinations(blocks, DISTANCE)]


def _more_masks(mask: int) -> list[int]:
    """A mask with each of four blocks of its remaining bits added."""
    left = [b for b in range(64) if not mask >> b & 1]
    return [mask | m for m in _blocks(left, DISTANCE + 1) if m]


def _keyed(marks: DataFrame, masks: Column) -> DataFrame:
    rows = marks.select("mark", F.explode(masks).alias("mask"))
    return rows.withColumn("key", F.col("mark").bitwiseAND(F.col("mask")))


def forest(marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the pairs within the distance connect: each mark (uint64) is searched for once."""
    links, rest = [], marks
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= DISTANCE
            found = rest[near]
            if len(found):
                links.append((np.full(len(found), at), found))
                frontier += list(found)
                rest = rest[~near]
    return links


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of marks -> links."""
    for batch in batches:
        groups = batch.column(0)
        ends = groups.offsets.to_numpy()
        flat = groups.values.to_numpy(zero_copy_only=False).view(np.uint64)
        pairs = ends[:-1][np.diff(ends) == 2]
        near = np.bitwise_count(flat[pairs] ^ flat[pairs + 1]) <= DISTANCE
        found = [(flat[pairs[near]], flat[pairs[near] + 1])]
        for i in np.flatnonzero(np.diff(ends) > 2):
            found += forest(flat[ends[i]:ends[i + 1]])
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def links(marks: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) between distinct fingerprints, column ``mark``, that connect all close ones."""
    masks = _first_masks()
    rows = _keyed(marks, F.array(*[F.lit(_signed(m)) for m in masks]))
    together = Window.partitionBy("mask", "key")
    out = None
    while True:
        met = cut(rows.withColumn("n", F.count("*").over(together)).where("n > 1"))
        small = (met.where(F.col("n") <= group).groupBy("mask", "key").agg(F.collect_list("mark").alias("marks"))
                 .select("marks").mapInArrow(_links, "a bigint, b bigint"))
        out = small if out is None else out.union(small)
        large = met.where(F.col("n") > group)
        if large.isEmpty():
            return out.distinct()
        more = {m: _more_masks(m) for m in masks}
        masks = sorted({x for xs in more.values() for x in xs})
        of_mask = F.create_map(*[c for m, xs in more.items() for c in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in xs]))])
        rows = _keyed(large.select("mark", of_mask[F.col("mask")].alias("masks")), F.col("masks")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by alternating star contraction.

    Large stars tie a node's larger neighbours to its smallest one, small stars tie the smaller ones;
    when nothing changes any more each component is one star.  The number of rounds grows with the
    logarithm of a component's length.
    """
    edges, before = cut(edges.select("a", "b")), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(low).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles of ``width`` words are
    counted with repeats, a text with fewer words is one shingle, and one without words (null or
    empty) has fingerprint zero and is linked like any other.  Two fingerprints link at three or fewer
    differing bits; ``component_id`` is the smallest id that can be reached over links.  Rows with one
    id are separate members of their groups; a null id is nobody's component id, unless a group has
    no other.  Other columns are left out.
    """
    marks = cut(with_fingerprint(docs.select(id_col, text), text, "mark", width).select(id_col, "mark"))
    nodes = cut(marks.groupBy("mark").agg(F.min(id_col).alias("first")))
    stars = components(links(nodes.select("mark")))
    rooted = nodes.join(stars, nodes["mark"] == stars["node"], "left").select(
        "mark", "first", F.coalesce("root", "mark").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_mark = rooted.join(least, "root").select("mark", "component_id")
    return marks.join(of_mark, "mark").select(id_col, hex_digits(F.col("mark")).alias("fingerprint"), "component_id")
