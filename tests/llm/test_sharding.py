import hashlib

import pytest
from pyspark.sql import functions as F

from careline.llm import sharding
from careline.llm.sql import sharding as sharding_sql
from tests.conftest import SF
from workloads.check import connect


@pytest.mark.parametrize(("limit", "start_bits"), [(100_000, 12), (20_000, 12), (20_000, 2), (3_000, 5), (1 << 26, 12)])
def test_equals_sql(spark, limit, start_bits):
    df = sharding.assign(spark.read.parquet(f"{SF}/documents.parquet"), limit=limit, start_bits=start_bits)
    cur = connect(SF).execute(sharding_sql(limit))
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r) for r in df.select(names).collect()) == sorted(cur.fetchall())


def test_shards_fit_and_only_large_ones_split(spark):
    rows = sharding.assign(spark.read.parquet(f"{SF}/documents.parquet"), limit=20_000).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.bytes)
        bits = f"{int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16):060b}"
        assert bits.startswith(r.shard) and len(r.shard) == r.depth
    assert all(sum(b) <= 20_000 or len(b) == 1 for b in shards.values())
    for s in shards:
        parent = [b for t, bs in shards.items() if s and t.startswith(s[:-1]) for b in bs]
        assert not s or sum(parent) > 20_000


def test_repeated_ids_are_cut_into_parts(spark):
    data = [(None, "x" * n) for n in (10, 10, 10, 60, 70, 0, 30)] * 5 + [(1, "y" * 500), (2, None), (3, "")]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in data], "doc_id bigint, text string, part int, shard string").repartition(3)
    rows = sharding.assign(docs, limit=100).collect()
    assert len(rows) == len(data)
    parts = {}
    for r in rows:
        parts.setdefault((r.shard, r.part), []).append(r.bytes)
    assert all(sum(b) <= 100 or len(b) == 1 for b in parts.values())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sharding.assign(docs.limit(0)).count() == 0
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {(r.shard, r.bytes) for r in sharding.assign(nothing).collect()} == {("", 0)}
