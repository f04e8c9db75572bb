"""Sharding by extendible hashing: a directory of hash prefixes, in which only what is too large is split."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from careline.llm.common import cut

LIMIT_BYTES = 64 << 20
#: Bits of hash; the first 60 of an MD5 sum.
BITS = 60
#: Bits by which too large a bucket is looked at more closely in one round.
_STEP = 8


def hash_bits(key: Column) -> Column:
    """Hash of a key (null: of the empty text) as a whole number of 60 bits."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def prefix(bits: Column, depth: Column) -> Column:
    """The first ``depth`` bits, as text; the empty text for none."""
    return F.substring(F.lpad(F.bin(bits), BITS, "0"), F.lit(1), depth)


def _head(bits: Column, depth: int) -> Column:
    return F.shiftright(bits, BITS - depth)


def directory(sizes: DataFrame, limit: int, start_bits: int = 12) -> DataFrame:
    """Buckets (head, depth, bytes, rows) of rows (bits, bytes): the shortest prefixes that fit the limit.

    Sizes are summed at ``start_bits`` bits and upwards from there, which gives the buckets of all
    shorter prefixes; a prefix is a bucket if it fits (or holds a single row) and its parent does not.  Only rows of prefixes
    that are still too large are summed again, with more bits.  Prefixes of all bits are the last to
    be taken, whatever their size: their rows share one hash.
    """
    found, rest, base, depth = None, sizes, 0, min(start_bits, BITS)
    while True:
        sums = rest.groupBy(_head(F.col("bits"), depth).alias("head")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        levels = F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth")
        every = cut(sums.select("head", "bytes", "rows", levels)
                    .groupBy("depth", F.expr(f"shiftright(head, {depth} - depth)").alias("head"))
                    .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        fit = (F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.col("depth") == BITS)
        parents = every.where(~fit).select((F.col("depth") + 1).alias("depth"), F.col("head").alias("parent"))
        own = every.where(fit).withColumn("parent", F.shiftright("head", 1))
        leaves = own.where(F.col("depth") > base).join(parents, ["depth", "parent"], "left_semi").select("head", "depth", "bytes", "rows")
        if base == 0:
            leaves = leaves.union(own.where("depth = 0").select("head", "depth", "bytes", "rows"))
        found = leaves if found is None else found.union(leaves)
        large = every.where((F.col("depth") == depth) & ~fit).select(F.col("head").alias("__head"))
        if depth == BITS or large.isEmpty():
            return found
        rest = rest.join(large, _head(F.col("bits"), depth) == F.col("__head"), "left_semi")
        base, depth = depth, min(BITS, depth + _STEP)


def assign(docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, limit: int = LIMIT_BYTES, start_bits: int = 12) -> DataFrame:
    """(id, bytes, shard, depth, part, shard_bytes, shard_rows) for each row of ``docs``.

    ``shard`` is the hash prefix of the id (bits as text, empty for the root), ``depth`` its length,
    shard_bytes and shard_rows are its size.  Every shard has at most ``limit`` bytes of text, with
    two exceptions that no hash can split: a single row above the limit is a shard of its own, and
    rows that share a hash (repeated or null ids) and exceed the limit together are cut into parts,
    each within the limit or a single row.  ``part`` is 0 everywhere else.  Null and empty texts have
    0 bytes.  No rows: no shard.  Other columns are left out.

    The text is read once, for its length; what is summed, in part before the shuffle, and joined are
    ids, hashes and lengths.  Rows that share a hash are cut into parts where they lie, so they need
    not meet.
    """
    rows = cut(docs.select(F.col(id_col).alias("__id"), hash_bits(F.col(id_col)).alias("bits"),
                           F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes")))
    rows = rows.withColumn("place", F.spark_partition_id())  # fixed, as the rows are materialised
    buckets = cut(directory(rows.select("bits", "bytes", F.lit(1).alias("rows")), limit, start_bits))
    depths = sorted(r.depth for r in buckets.select("depth").distinct().collect()) or [0]  # 61 at most
    heads = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _head(F.col("bits"), d).alias("head")) for d in depths]))
    table = buckets.select("depth", "head", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"))
    placed = rows.withColumn("at", heads).select("*", "at.depth", "at.head").drop("at").join(table, ["depth", "head"])
    over = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    here = Window.partitionBy("bits", "place").orderBy("bytes", "__id").rowsBetween(Window.unboundedPreceding, 0)
    # rows of up to half the limit fill a part until half is reached; each larger one opens a part
    half = limit // 2
    filled = F.floor(F.greatest(F.sum(F.least("bytes", F.lit(half))).over(here) - 1, F.lit(0)) / F.lit(half))
    local = filled + F.when(F.col("bytes") > half, 1).otherwise(0)
    parted = placed.where(over).withColumn("part", (F.shiftleft(F.col("place").cast("bigint"), 32) + local).cast("bigint"))
    out = placed.where(~over).withColumn("part", F.lit(0).cast("bigint")).unionByName(parted)
    return out.select(F.col("__id").alias(id_col), "bytes", prefix(F.col("bits"), F.col("depth")).alias("shard"),
                      F.col("depth").cast("int").alias("depth"), "part", "shard_bytes", "shard_rows")
