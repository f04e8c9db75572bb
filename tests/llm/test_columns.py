"""Columns of the user that are named like an operator's own stay as they are."""

import pytest
from pyspark.sql import functions as F

from careline.llm import decontaminate, lines, lm_score, substring

OWN = ["__id", "__text_hash", "__h1", "__h2", "__n", "__shares", "__did", "__dhash", "__drop", "__spans", "aside_0"]


@pytest.mark.parametrize("operator", [
    lines.drop_repeated_lines, substring.drop_repeated_windows, lm_score.pseudo_likelihood,
    lambda df: decontaminate.contamination(df, df.select(F.lit("i").alias("item_id"), "text").limit(1))],
    ids=["lines", "windows", "likelihood", "contamination"])
def test_columns_stay(spark, operator):
    df = spark.createDataFrame([(1, "some words here that are long enough\nand more"), (2, "some words here that are long enough\nand others")],
                               "doc_id long, text string").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in OWN})
    got = operator(df)
    assert set(df.columns) <= set(got.columns)
    assert {tuple(r) for r in got.select("doc_id", *OWN).collect()} == {tuple(r) for r in df.select("doc_id", *OWN).collect()}
    plain = operator(df.drop(*OWN))
    added = [c for c in plain.columns if c not in ("doc_id",)]
    assert sorted(map(str, got.select(added).collect())) == sorted(map(str, plain.select(added).collect()))
