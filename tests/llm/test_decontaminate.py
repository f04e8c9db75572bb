import random

import pytest

from careline.llm import decontaminate
from careline.llm.queries import op3_decontamination
from tests.conftest import SF
from tests.llm import brute


def rows(df):
    return sorted(((r.doc_id, r.hits.n_words, r.hits.n_hit, sorted(r.hits["items"]), r.hits.contaminated) for r in df.collect()), key=lambda r: r[0])


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(i, n, h, len(s), brute.sha(",".join(s)), c) for i, n, h, s, c in brute.contamination(docs, items)]
    assert sorted(tuple(r) for r in op3_decontamination(spark, SF).collect()) == want


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(5)
    words = ["The", "cat", "sat", "on", "a", "mat", "é", "x1", "Zoo"]
    item = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, item(random.choice([2, 5, 13, 14, 30, 60]))) for i in range(40)] + [(50, None), (51, ""), (52, "!!"), (53, "zoo")]
    items += [(60, items[7][1]), (7, items[7][1]), (None, items[9][1])]
    docs = []
    for i in range(80):
        parts = [random.choice(items)[1] or "" if random.random() < 0.4 else item(random.randint(0, 40)) for _ in range(4)]
        docs.append((i, random.choice([" ", "\n", ", "]).join(parts).upper() if i % 5 == 0 else "  ".join(parts)))
    docs += [(90, None), (91, ""), (92, "?!"), (93, "unique " * 30000 + items[5][1])]
    clash = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id bigint, text string, hits string, item_id int")
    return docs, items, clash, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, hits int")


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_one_block_and_many(tables, block_bytes):
    docs, items, left, right = tables
    items = [("null" if i is None else i, t) for i, t in items]
    assert rows(decontaminate.contamination(left, right, block_bytes=block_bytes)) == brute.contamination(docs, items)


def test_matches_are_verbatim_and_maximal(tables):
    docs, items, left, right = tables
    texts = {str(i): decontaminate.words(t) for i, t in items}
    texts["null"] = texts.pop("None")
    own, seen = {i: decontaminate.words(t) for i, t in docs}, 0
    for r in decontaminate.contamination(left, right).collect():
        for m in r.hits.matches:
            a, b = own[r.doc_id], texts[m.item_id]
            i, j, n = m.doc_start, m.item_start, m.n_words
            assert a[i:i + n] == b[j:j + n] and len(b[j:j + n]) == n
            assert i == 0 or j == 0 or a[i - 1] != b[j - 1]
            assert i + n == len(a) or j + n == len(b) or a[i + n] != b[j + n]
            seen += 1
    assert seen > 50


def longest(doc, items, size=13):
    """All matches that cannot be made longer, by comparing every place of a document with every place of an item."""
    out = set()
    for name, b in items:
        for i in range(len(doc)):
            for j in range(len(b)):
                n = 0
                while i + n < len(doc) and j + n < len(b) and doc[i + n] == b[j + n]:
                    n += 1
                if n >= min(size, len(b)) and (i == 0 or j == 0 or doc[i - 1] != b[j - 1]):
                    out.add((name, j, i, n))
    return out


def test_all_longest_matches_are_found(spark, tables):
    """Items that share windows, one that holds a window twice, and the random tables: as by brute force."""
    docs, items, left, right = tables
    w, q = " ".join(f"w{i}" for i in range(13)), " ".join(f"q{i}" for i in range(50))
    some = [("a", w), ("b", f"{w} {q}"), ("c", f"x {w} y {w} {q} z"), ("d", f"{'re ' * 20}end")]
    own = [(1, f"{w} {q}"), (2, f"x {w} {q}"), (3, f"y {w} y {w}"), (4, "re " * 30), (5, f"{q} {w}")]
    few = spark.createDataFrame(own, "doc_id bigint, text string"), spark.createDataFrame(some, "item_id string, text string")
    docs = [d for d in docs if d[0] != 93]
    named = [("null" if i is None else str(i), t) for i, t in items]
    for texts, names, frames in ((own, some, few), (docs, named, (left.where("doc_id != 93"), right))):
        names = sorted({(i, tuple(decontaminate.words(t))) for i, t in names})
        want = {i: longest(decontaminate.words(t), names) for i, t in texts}
        for block_bytes in (1 << 20, 700):
            got = decontaminate.contamination(*frames, block_bytes=block_bytes).collect()
            assert all(len(r.hits.matches) == len(set(r.hits.matches)) for r in got)
            assert {r.doc_id: {(m.item_id, m.item_start, m.doc_start, m.n_words) for m in r.hits.matches} for r in got} == want
    assert ("b", 0, 0, 63) in longest(decontaminate.words(own[0][1]), [(i, decontaminate.words(t)) for i, t in some])


def test_empty_tables(tables):
    _, _, left, right = tables
    assert decontaminate.decontaminate(left, right.limit(0)).count() == left.count()
    assert decontaminate.contamination(left.limit(0), right).count() == 0


def test_clean_documents_stay(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in decontaminate.decontaminate(spark.read.parquet(f"{SF}/documents.parquet"),
                                                         spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert kept == {r[0] for r in brute.contamination(docs, items) if not r[4]}
