import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from careline.llm import simhash
from careline.llm.queries import op9_simhash
from tests.conftest import SF
from tests.llm import brute


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows(op9_simhash(spark, SF)) == brute.simhash([tuple(r) for r in docs])


def test_odd_texts_and_extra_columns(spark):
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "oNE"), (6, "a b"), (7, "a b c d " * 5000),
            (8, "a b c d " * 5000), (9, "ÄÖ \x0b x y"), (9, "ÄÖ \x0b x y"), (10, "a\x00b c d e f")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in data], "doc_id bigint, text string, mark int, fingerprint string")
    assert rows(simhash.near_duplicates(docs)) == brute.simhash(data)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "same words here now"), (3, "same words here now"), (None, "alone in the world")],
                                 "doc_id bigint, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 3), (3, 3), (None, None)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("group", [16, 1024])
def test_dense_groups_lose_no_link(spark, group):
    """Clusters around few centres, split over several levels, connect what all pairs connect."""
    random.seed(group)
    marks = set()
    for _ in range(4):
        centre = random.getrandbits(64)
        marks |= {centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for _ in range(60)}
        chain = centre
        for _ in range(20):
            chain ^= 1 << random.randrange(64) | 1 << random.randrange(64)
            marks.add(chain)
    marks = sorted(marks)
    df = spark.createDataFrame([(int(np.uint64(m).view(np.int64)),) for m in marks], "mark bigint")
    stars = {r.node: r.root for r in simhash.components(simhash.links(df, group)).collect()}
    roots = brute.groups(len(marks), lambda i, j: (marks[i] ^ marks[j]).bit_count() <= 3)
    signed = [int(np.uint64(m).view(np.int64)) for m in marks]
    got = [stars.get(s, s) for s in signed]
    assert len(set(zip(got, roots))) == len(set(got)) == len(set(roots))


def test_groups_are_not_paired_off(spark):
    """Thousands of copies are one fingerprint, and a dense group gives a forest."""
    n = len(np.unique(np.array([1 << i | 1 << j for i in range(40) for j in range(i)], np.uint64)))
    found = simhash.forest(np.unique(np.array([1 << i | 1 << j for i in range(40) for j in range(i)], np.uint64)))
    assert sum(len(a) for a, _ in found) == n - 1


def test_long_chain_is_one_component(spark):
    edges = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 400)}
