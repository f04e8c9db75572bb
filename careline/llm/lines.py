"""Line dedup: lines that several documents share stay only in one of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careline.llm.common import BLANKS, cut, let, row_key, shielded

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line held by at least this share of all shared lines' rows is hot: at most 2,000 lines can be.
HOT_SHARE = 2000


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without outer ``[\\x20\\x09-\\x0D]``, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)  # ASCII only: lower() does the same, and faster
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _keys(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """A row for each line that is long enough: document, position and 128 bits of hash of its key."""
    return (docs.select(*row_key(id_col, text), F.posexplode(split_lines(F.col(text))).alias("__pos", "__line"))
            .select("__id", "__text_hash", "__pos", line_key(F.col("__line")).alias("__key"))
            .where(F.char_length("__key") >= min_chars)
            .select("__id", "__text_hash", "__pos", F.xxhash64("__key").alias("__h1"),
                    F.xxhash64(F.lit(1), "__key").alias("__h2")))


@shielded
def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, min_chars: int = 10,
                        min_docs: int = 2) -> DataFrame:
    """``docs`` with ``text`` rid of repeated lines, and columns ``n_lines`` (before) and ``n_dropped``.

    A line whose key (see ``line_key``) has at least ``min_chars`` code points and stands in at least
    ``min_docs`` documents is dropped from all of them but the one with the smallest id, which keeps
    each of its copies.  Documents are told apart by id, so rows that share an id are parts of one
    document; a null id is an id below all others.  Null and empty texts have one empty line.  A text
    that loses lines is joined again in the old order; others come out as they went in (null: empty).
    Input columns named ``n_lines`` or ``n_dropped`` are replaced, all others are kept.

    The text is read three times and shuffled once.  What is grouped and joined are hashes: counts are
    summed before the shuffle, and lines that a large share of all rows have are looked up in a
    broadcast table of at most 2,000 rows, so that no task gets all rows of one line.
    """
    keys = _keys(docs, id_col, text, min_chars)
    if min_docs == 2:  # two ids differ if the smallest and the largest do
        counted = keys.groupBy("__h1", "__h2").agg(F.min("__id").alias("__first"), F.max("__id").alias("__last"),
                                                   F.count("*").alias("__n")).where("__first < __last")
    else:
        counted = (keys.groupBy("__h1", "__h2", "__id").agg(F.count("*").alias("__n")).groupBy("__h1", "__h2")
                   .agg(F.min("__id").alias("__first"), F.count("*").alias("__docs"), F.sum("__n").alias("__n"))
                   .where(F.col("__docs") >= min_docs))
    shared = cut(counted.select("__h1", "__h2", "__first", "__n"))
    limit = (shared.agg(F.sum("__n")).first()[0] or 0) / HOT_SHARE
    hot = F.broadcast(shared.where(F.col("__n") > limit).where(F.col("__n") > 1000)
                      .select("__h1", "__h2", F.col("__first").alias("__hot")))
    cold = shared.select(F.col("__h1").alias("__k1"), F.col("__h2").alias("__k2"), "__first")
    # A line found among the hot ones gets a key of its own: it spreads, and meets nothing in the second join.
    found = keys.join(hot, ["__h1", "__h2"], "left").withColumn(
        "__h1", F.when(F.col("__hot").isNull(), F.col("__h1")).otherwise(F.xxhash64("__id", "__text_hash", "__pos")))
    found = found.join(cold, (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2"))
                       & F.col("__hot").isNull(), "left")
    drops = (found.where(F.col("__id") != F.coalesce("__hot", "__first"))
             .groupBy(F.col("__id").alias("__did"), F.col("__text_hash").alias("__dhash"))
             .agg(F.collect_set("__pos").alias("__drop")))
    own, own_hash = row_key(id_col, text)
    joined = docs.withColumns({"__id": own, "__text_hash": own_hash}).join(
        drops, (F.col("__id") == F.col("__did")) & (F.col("__text_hash") == F.col("__dhash")), "left")
    rest = let(split_lines(F.col(text)), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop")), lambda i: F.get(lines, i)), "\n"))
    return joined.withColumns({
        "n_lines": F.size(split_lines(F.col(text))).cast("bigint"),
        "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint"),
        text: F.when(F.col("__drop").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(rest),
    }).drop("__id", "__text_hash", "__did", "__dhash", "__drop")
