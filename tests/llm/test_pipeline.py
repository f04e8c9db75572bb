import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from careline.llm import bpe, langid
from careline.llm.queries import QUERIES, language_model
from tests.conftest import SF
from tests.llm import brute

NATIVE = ("op2_quality_rules", "op4_chat_format", "op8_sharding", "op10_line_dedup")


def test_run_matches_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    extra = spark.createDataFrame([(10_001, "12 34 ?!", "en", "s", 8), (10_002, None, "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra).cache()
    judged = langid.predict(docs, language_model(docs), into="l").select("doc_id", "text", "l.*").collect()
    rows = [(r.doc_id, r.text) for r in judged if r.lang_pred != "und" and r.score >= P.MIN_SCORE]
    assert {10_001, 10_002}.isdisjoint(i for i, _ in rows) and len(rows) >= docs.count() - 12
    rows = drop_lines(rows)
    first = {i: c for i, _, c in brute.simhash(rows)}
    rows = [r for r in rows if first[r[0]] == r[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in brute.contamination(rows, items) if r[4]}
    rows = [r for r in rows if r[0] not in dirty]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = sorted((i, library.encode_ordinary(t)) for i, t in rows)

    left = docs
    for name, stage in P.STAGES[:-1]:
        before = left
        stage(spark, left, SF).write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == P.COLUMNS, name
        assert left.count() <= before.count()
    got = P.STAGES[-1][1](spark, left, SF).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == want
    assert all(r.round_trip for r in got)


FOREIGN = [
    "De oude man liep langzaam door het bos en dacht aan de dagen van zijn jeugd toen alles nog anders was.",
    "Wczoraj wieczorem poszedłem do sklepu, żeby kupić chleb i mleko, ale sklep był już zamknięty.",
    "Eilen illalla kävelin metsässä ja näin suuren hirven, joka katsoi minua hetken ja juoksi pois.",
    "Вчера вечером мы долго гуляли по старому городу и говорили о книгах, которые недавно прочитали.",
    "昨天晚上我们在老城里散步了很久，谈论最近读过的书。",
    "Χθες το βράδυ περπατήσαμε πολλή ώρα στην παλιά πόλη και μιλήσαμε για βιβλία."]
JUNK = ["x 1234 5678 9999 !!! ??? ### 0000", "zxqj kkkk wvvw qqxz jjjj zzzk xqxq vvkk", "$$$ 12.50 | 13.70 | 99 a", "asdf jkl qwer uiop zxcv bnm asdfgh"]


def test_foreign_and_junk_texts_with_letters_go(spark):
    """Texts without id are never learned from; documents of the corpus stay, held out or not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(P.COLUMNS)
    odd = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in FOREIGN + JUNK], docs.schema)
    kept = [r.text for r in P.language_id(spark, docs.unionByName(odd), SF).select("text").collect()]
    assert set(FOREIGN + JUNK).isdisjoint(kept)
    lettered = docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert 0.998 * lettered <= len(kept) <= lettered


def drop_lines(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(brute.LOWER)

    first = {}
    for i, t in sorted(rows):
        for line in t.split("\n"):
            first.setdefault(key(line), i)
    return [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i)) for i, t in rows]


def test_run_is_registered_and_reads_the_tables(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is P.run and set(QUERIES) <= set(entry.queries())
    df = P.run(spark, SF)
    assert 0 < df.count() <= spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_stages_accept_nothing(spark):
    left = spark.read.parquet(f"{SF}/documents.parquet").where(F.lit(False))
    for _, stage in P.STAGES:
        left = stage(spark, left, SF)
        assert left.count() == 0


def test_rows_that_share_an_id(spark):
    """An id goes only if all its rows are copies of documents with smaller ids; rows without id stay."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (9, a), (9, b), (12, a), (12, b), (None, a), (13, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = sorted(((r.doc_id, r.text) for r in P.near_dedup(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(1, a), (9, a), (9, b), (None, a)], key=str)
