import random

from careline.llm import lines
from careline.llm.queries import op10_line_dedup
from tests.conftest import SF
from tests.llm import brute


def rows(df):
    from pyspark.sql import functions as F
    return sorted(tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect())


def make(spark, data):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id bigint, text string, n_lines string, n_dropped int")


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op10_line_dedup(spark, SF).collect()) == brute.line_dedup(docs)


def test_random_and_odd_texts(spark):
    random.seed(3)
    pool = ["a longer line here", "  A LONGER line here\t", "short", "", "É un peu plus long", "é un peu plus long", "\x0b\x0c", "ten chars!", "nine char"]
    data = [(i, "\n".join(random.choices(pool, k=random.randint(0, 6)))) for i in range(60)]
    data += [(100, None), (101, ""), (102, "\n\n"), (103, "very long line " * 20000 + "\na longer line here"), (104, "\n".join(["same line again"] * 3000)),
             (105, "same line again")]
    assert rows(lines.drop_repeated_lines(make(spark, data))) == brute.line_dedup(data)
    assert rows(lines.drop_repeated_lines(make(spark, data), min_docs=3, min_chars=5)) == brute.line_dedup(data, 5, 3)


def test_repeated_rows_and_null_ids(spark):
    data = [(5, "the line of all\nown line of five"), (5, "the line of all\nown line of five"), (None, "the line of all\nb"), (7, "the line of all")]
    got = [tuple(r) for r in lines.drop_repeated_lines(make(spark, data)).select("doc_id", "text", "n_dropped").collect()]
    assert sorted(got, key=str) == sorted([(5, "own line of five", 1), (5, "own line of five", 1), (None, "the line of all\nb", 0), (7, "", 1)], key=str)
    assert lines.drop_repeated_lines(make(spark, data).limit(0)).count() == 0


def test_hot_line_is_looked_up_not_gathered(spark):
    data = [(i, f"the line that everyone has\nline of document {i}\nshared by a few {i // 3}") for i in range(2500)]
    assert rows(lines.drop_repeated_lines(make(spark, data))) == brute.line_dedup(data)
