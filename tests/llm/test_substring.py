import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from careline.llm import substring
from careline.llm.queries import op7_substring_dedup
from tests.conftest import SF
from tests.llm import brute


def rows(df):
    return sorted((r.doc_id, r.deduped.n_words, r.deduped.n_removed, brute.sha(r.deduped.kept)) for r in df.collect())


def make(spark, data):
    return spark.createDataFrame([(i, t, 1) for i, t in data], "doc_id bigint, text string, deduped int")


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op7_substring_dedup(spark, SF).collect()) == brute.substring_dedup(docs)


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 2000, "bucket_bytes": 3000}, {"chunk_bytes": 500, "bucket_bytes": 4000, "hot_runs": 8}])
def test_copies_and_shared_passages(spark, options):
    """Many small chunks and buckets, and minimisers that count as hot, change nothing."""
    random.seed(4)
    words = ["alpha", "be", "c", "delta,", "é", "zz-top"]
    passages = [random.choices(words, k=random.randint(15, 60)) for _ in range(6)]
    data = []
    for i in range(120):
        parts = [random.choices(words, k=random.randint(0, 30)) if random.random() < 0.5 else random.choice(passages) for _ in range(3)]
        data.append((i, " \n".join(" ".join(p) for p in parts)))
    data += [(200, data[3][1]), (201, data[3][1]), (300, "one word " * 200), (301, None), (302, ""), (303, " \t"), (304, "w" * 50000),
             (305, " ".join(f"w{i}" for i in range(20000)) + " " + " ".join(f"w{i}" for i in range(500, 530)))]
    df = make(spark, data).repartition(6, F.col("doc_id"))
    assert rows(substring.drop_repeated_windows(df, **options)) == brute.substring_dedup(data)


def test_repeated_rows_null_ids_empty_table(spark):
    text, other = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    data = [(5, text), (5, text), (7, text), (None, other), (2, other)]
    got = sorted(((r.doc_id, r.deduped.n_removed) for r in substring.drop_repeated_windows(make(spark, data)).collect()), key=str)
    assert got == sorted([(5, 0), (5, 0), (7, 25), (None, 0), (2, 25)], key=str)
    assert substring.drop_repeated_windows(make(spark, data).limit(0)).count() == 0


def test_equal_hashes_are_told_apart_by_text():
    data = b"".join(b" ".join(b"%s%d" % (c, i) for i in range(20)) + b"\n" for c in (b"x", b"y", b"x"))
    words = substring.Words(data)
    at = np.array([0, 20, 40])
    assert substring.first_equal(words, at, np.zeros(3, np.uint64)).tolist() == [0, 20, 0]


def test_a_passage_in_every_chunk_fills_no_bucket(spark):
    """One passage once in each of 300 chunks: it counts as hot, and its windows meet in two rounds."""
    passage = " ".join(f"p{k}" for k in range(30))
    data = [(i, " ".join(f"x{i}_{k}" for k in range(40)) + " " + passage + " " + " ".join(f"y{i}_{k}" for k in range(40))) for i in range(300)]
    df = make(spark, data).repartition(8, F.col("doc_id"))
    options = {"chunk_bytes": 500, "bucket_bytes": 20_000, "hot_runs": 100}
    assert rows(substring.drop_repeated_windows(df, **options)) == brute.substring_dedup(data)
    keyed = df.select(*substring.row_key("doc_id", "text"), "text")
    sizes = substring.routed_windows(keyed, **options).groupBy("bucket").agg(F.sum(F.length("data")).alias("n"), F.count("*").alias("rows")).collect()
    assert max(r.n for r in sizes) <= 20_000
    # cold: one row from every chunk at most 300; hot windows came as survivors of 17 groups
    hot = [r for r in sizes if r.bucket >= max(1, -(-3 * sum(len(t) for _, t in data) // 20_000))]
    assert hot and max(r.rows for r in hot) <= 40
