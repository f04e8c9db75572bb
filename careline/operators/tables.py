"""Keyed result tables on plain parquet: overwrite, upsert, create-or-merge.

A table folder holds ``data/gen=N/...`` parquet folders and ``versions/N.json``
files naming the live folders and the schema.  A write adds one generation and
then publishes one version file by rename, so readers see the old or the new
table, never a mix, and a failed job leaves the old one.  One writer at a time.
"""

import json
from collections import Counter
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from careline.operators.rows import dedupe

_GEN = "gen"


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert as a plan: matched target rows with the source's values, the rest of both as it is.

    Columns that the source lacks keep their value in matched rows and are NULL in
    inserted ones.  A target row may match one source row at most; NULL keys match
    nothing.
    """
    keys = list(keys)
    new = source.withColumns({f"_novo_{c}": F.col(c) for c in source.columns if c not in keys}).withColumn("_novo", F.lit(True))
    new = new.select(*keys, *[c for c in new.columns if c.startswith("_novo")])
    both = target.join(new, keys, "left")
    matched = F.col("_novo")
    cells = [F.col(c) if c in keys or c not in source.columns else
             F.when(matched, F.col(f"_novo_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns]
    added = [F.when(matched, F.col(f"_novo_{c}")).alias(c) for c in source.columns if c not in target.columns]
    inserted = source.join(target.select(*keys), keys, "left_anti")
    return both.select(*cells, *added).unionByName(inserted, allowMissingColumns=True)


# A narrower number may come to a wider column.
_WIDER = {"tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
          "int": ("bigint", "double"), "bigint": (), "float": ("double",)}


def match_types(source: DataFrame, schema: StructType) -> DataFrame:
    """The source in the table's column types; raise where that would change a value."""
    casts = {}
    for f in schema:
        if f.name not in source.columns:
            continue
        have, want = source.schema[f.name].dataType.simpleString(), f.dataType.simpleString()
        if have == want:
            continue
        if want not in _WIDER.get(have, ()) and have != "void":
            raise ValueError(f"column {f.name} is {want} in the table and {have} in the source")
        casts[f.name] = F.col(f.name).cast(f.dataType)
    return source.withColumns(casts) if casts else source


class _Folder:
    """Small file operations through the Hadoop file system of the session."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        if not self._fs.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(path)]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def publish(self, name: str, text: str) -> None:
        """Write next to the target and rename; an existing target is a second writer."""
        if self._fs.exists(self._path(name)):
            raise RuntimeError(f"{self.root}/{name} was written by someone else")
        staged = self._path(f"{name}.tmp")
        self._fs.mkdirs(staged.getParent())
        stream = self._fs.create(staged, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not self._fs.rename(staged, self._path(name)):
            raise RuntimeError(f"{self.root}/{name} was written by someone else")


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(n[:-5]) for n in folder.names("versions") if n.endswith(".json"))


def _latest(folder: _Folder) -> dict | None:
    versions = _versions(folder)
    return json.loads(folder.read(f"versions/{versions[-1]:08d}.json")) if versions else None


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_versions(_Folder(spark, path)))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version; date partitions of a partitioned table are pruned."""
    folder = _Folder(spark, path)
    return _read(spark, folder, _latest(folder))


def _read(spark: SparkSession, folder: _Folder, state: dict, dirs=None) -> DataFrame:
    dirs = state["dirs"] if dirs is None else dirs
    schema = StructType.fromJson(state["schema"])
    if not dirs:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(StructType(schema.fields).add(_GEN, IntegerType()))
        .option("basePath", f"{folder.root}/data")
        .parquet(*[f"{folder.root}/data/{d}" for d in dirs])
        .select(*schema.names)
    )


def _leaf_dirs(folder: _Folder, top: str, depth: int) -> list[str]:
    if depth == 0:
        return [top]
    children = [n for n in folder.names(f"data/{top}") if "=" in n]
    return [d for n in children for d in _leaf_dirs(folder, f"{top}/{n}", depth - 1)]


def _commit(df: DataFrame, folder: _Folder, state: dict | None, keep: Sequence[str],
            by: Sequence[str], keep_empty: bool = True, figures: Sequence[Column] = (),
            replaced: Sequence[str] | None = None) -> dict:
    """Write one generation and publish it; the figures (aggregates) come from the write itself.

    With ``replaced``, folders to keep are dropped if they are named there or written anew.
    """
    generation = max(
        [int(n.split("=")[1]) for n in folder.names("data") if n.startswith(f"{_GEN}=")],
        default=0,
    ) + 1
    top = f"{_GEN}={generation}"
    # Rebalancing merges small output partitions and splits a hot date.
    out = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    seen = Observation()
    writer = out.observe(seen, F.count(F.lit(1)).alias("linhas"), *figures).write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{folder.root}/data/{top}")
    found = seen.get
    if not keep_empty and not found["linhas"]:
        folder.delete(f"data/{top}")
        return found
    new = _leaf_dirs(folder, top, len(by))
    if replaced is not None:
        gone = {*replaced, *[d.partition("/")[2] for d in new]}
        keep = [d for d in keep if d.partition("/")[2] not in gone]
    version = (_versions(folder) or [0])[-1] + 1
    folder.publish(f"versions/{version:08d}.json", json.dumps({
        "schema": json.loads(df.schema.json()),
        "by": list(by),
        "dirs": list(keep) + new,
    }))
    return found


def overwrite(df: DataFrame, path: str, by: Sequence[str] = (), keep_empty: bool = True,
              figures: Sequence[Column] = ()) -> dict:
    """Replace a table's rows and schema, optionally partitioned by columns.

    Returns ``linhas``, the number of rows, and the given aliased aggregates, such as the
    high-water mark: they are observed while the rows are written, so nothing is read again.
    Without ``keep_empty`` an empty frame leaves the table as it was.
    """
    folder = _Folder(df.sparkSession, path)
    return _commit(df, folder, _latest(folder), (), by, keep_empty, figures)


def replace_partitions(df: DataFrame, path: str, emptied: Sequence[str] = ()) -> dict:
    """Replace the partitions that the frame has rows of, and remove those of the ``emptied`` values.

    For tables with one partition column.  Other partitions are neither read nor written.
    """
    folder = _Folder(df.sparkSession, path)
    state = _latest(folder)
    if len(state["by"]) != 1:
        raise ValueError("replace_partitions needs a table with one partition column")
    source = match_types(df, StructType.fromJson(state["schema"]))
    return _commit(source, folder, state, state["dirs"], state["by"], replaced=[f"{state['by'][0]}={v}" for v in emptied])


def check_unambiguous(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a target row is matched by two source rows: an update would be ambiguous.

    Repeated keys that the target does not have are plain insertions.
    """
    repeated = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    twice = repeated.join(target.select(*keys), list(keys), "left_semi").limit(1).collect()
    if twice:
        raise ValueError(f"upsert source has more than one row for {twice[0].asDict()}")


def _within(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows between the source's smallest and largest keys: row groups outside are not read."""
    ends = source.agg(*[f(k).alias(f"{f.__name__}_{i}") for i, k in enumerate(keys) for f in (F.min, F.max)]).first()
    for i, k in enumerate(keys):
        low, high = ends[f"min_{i}"], ends[f"max_{i}"]
        if low is not None and target.schema[k].dataType.typeName() in _ORDERED:
            target = target.filter((F.col(k) >= F.lit(low)) & (F.col(k) <= F.lit(high)))
    return target


_ORDERED = ("byte", "short", "integer", "long", "string", "date", "timestamp")


def _has_key(keys: Sequence[str]):
    found = F.lit(True)
    for k in keys:
        found = found & F.col(k).isNotNull()
    return found


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in the order; rows with a NULL in the key are no key's and all stay."""
    found = _has_key(keys)
    return dedupe(df.filter(found), keys, order).unionByName(df.filter(~found))


def _winners(source: DataFrame, stored: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Source rows that come before their key's other rows, stored ones included.

    A key whose stored row comes first gives no row, so the stored one stays as it is.  Stored rows are
    read in the source's columns alone; a column that the table lacks is NULL in them.
    """
    shared = [c for c in source.columns if c in stored.columns]
    old = stored.select(shared).join(source.select(*keys), list(keys), "left_semi").withColumn("_novo", F.lit(0))
    both = source.withColumn("_novo", F.lit(1)).unionByName(old, allowMissingColumns=True)
    return first_per_key(both, keys, [*order, F.desc("_novo")]).filter("_novo = 1").drop("_novo")


def upsert(df: DataFrame, path: str, keys: Sequence[str], order: Sequence | None = None) -> None:
    """Update matched keys, insert the rest.

    Only folders (dates, in a partitioned table) that hold a matched key are
    rewritten; finding them reads the key columns alone, and of those only what
    lies between the smallest and the largest key.  With ``order``, of the rows of
    a key, stored ones included, the first in that order stays; ``order`` may use the
    source's columns.  A stored row that loses keeps the columns that the source lacks,
    and rows with a NULL in the key are always inserted.  An empty frame writes nothing.
    """
    spark, keys = df.sparkSession, list(keys)
    folder = _Folder(spark, path)
    state = _latest(folder)
    source = match_types(df, StructType.fromJson(state["schema"])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if source.isEmpty():
            return
        target = _read(spark, folder, state)
        # File paths are URL-encoded; a plus sign is literal in them.
        file_path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        folder_of = F.regexp_extract(file_path, rf"^.*/data/({_GEN}=\d+.*)/[^/]+$", 1)
        # One row per live folder at most; compact() keeps that at one per date.
        near = _within(target, source, keys) if state["dirs"] else target
        touched = sorted(
            row[0] for row in (near.select(*keys, folder_of.alias("_pasta"))
                               .join(source.select(*keys), keys, "left_semi")
                               .select("_pasta").distinct().collect() if state["dirs"] else ())
        )
        stored = _read(spark, folder, state, touched)
        new = source
        if order:
            new = _winners(source, stored, keys, order)
        else:
            check_unambiguous(source, stored, keys)
        keep = [d for d in state["dirs"] if d not in touched]
        _commit(merge_frames(stored, new, keys), folder, state, keep, state["by"])
    finally:
        source.unpersist()


def save(df: DataFrame, path: str, keys: Sequence[str], by: Sequence[str] = (),
         order: Sequence | None = None) -> None:
    """Nothing for an empty frame; upsert an existing table; create a missing one.

    The frame is computed once: a new table learns from its own write whether there was a row.
    ``by`` should be the date column of a table that grows by dates: an unpartitioned one is
    rewritten whole by every upsert.
    """
    if table_exists(df.sparkSession, path):
        upsert(df, path, keys, order)
    else:
        overwrite(first_per_key(df, keys, order) if order else df, path, by, keep_empty=False)


def compact(spark: SparkSession, path: str) -> None:
    """One folder per date (or partition value): those that upserts have piled up are merged."""
    folder = _Folder(spark, path)
    state = _latest(folder)
    value_of = lambda d: d.partition("/")[2]
    count = Counter(map(value_of, state["dirs"]))
    piled = [d for d in state["dirs"] if count[value_of(d)] > 1]
    if piled:
        keep = [d for d in state["dirs"] if count[value_of(d)] == 1]
        _commit(_read(spark, folder, state, piled), folder, state, keep, state["by"])


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` versions, and the folders that none of those names.

    Readers of an older version fail from then on; run it when no writer does.
    """
    if keep < 1:
        raise ValueError("expire keeps one version at least")
    folder = _Folder(spark, path)
    versions = _versions(folder)
    for v in versions[:-keep]:
        folder.delete(f"versions/{v:08d}.json")
    kept = [json.loads(folder.read(f"versions/{v:08d}.json")) for v in versions[-keep:]]
    live = {d for state in kept for d in state["dirs"]}
    depths = {d.split("/")[0]: d.count("/") for d in live}
    for top in folder.names("data"):
        if not top.startswith(f"{_GEN}="):
            continue
        if top not in depths:
            folder.delete(f"data/{top}")
            continue
        for leaf in _leaf_dirs(folder, top, depths[top]):
            if leaf not in live:
                folder.delete(f"data/{leaf}")
