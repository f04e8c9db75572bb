"""Plan shapes and hot keys."""

import pytest
from pyspark.sql import functions as F

from careline.operators import rows
from careline.operators.joins import join_keys
from tests.conftest import SF
from workloads import fixtures as X
from workloads import load


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """Nine tenths of the rows share one key."""
    return spark.range(0, 40000, 1, 12).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 97 + 1).otherwise(0).alias("k"), F.col("id").alias("n"))


def test_dedupe_limits_a_hot_key_before_the_shuffle(spark, hot):
    df = rows.dedupe(hot, ["k"], [F.desc("n")])
    text = plan(df)
    exchange = text.index("Exchange hashpartitioning(k")
    assert "row_number(), 1, Partial" in text[exchange:]
    want = {r.k: r.n for r in hot.groupBy("k").agg(F.max("n").alias("n")).collect()}
    assert {r.k: r.n for r in df.collect()} == want


def test_row_index_is_exact_and_parallel(spark, hot):
    df = rows.with_row_index(hot, ["k", "n"])
    assert df.rdd.getNumPartitions() > 1
    got = [(r["index"], r.k, r.n) for r in df.orderBy("index").collect()]
    want = sorted((r.k, r.n) for r in hot.collect())
    assert got == [(i, *row) for i, row in enumerate(want)]


def test_row_index_same_for_any_partitioning(spark, hot):
    a = rows.with_row_index(hot.repartition(3), ["k", "n"]).agg(F.sum(F.col("index") * F.col("n"))).first()
    b = rows.with_row_index(hot.coalesce(1), ["k", "n"]).agg(F.sum(F.col("index") * F.col("n"))).first()
    assert a == b


def test_row_index_of_nothing(spark, hot):
    assert rows.with_row_index(hot.filter("FALSE"), ["k", "n"]).count() == 0


def test_sample_is_a_top_k(spark, hot):
    assert "TakeOrderedAndProject(limit=5" in plan(rows.sample_first(hot, 5, ["k", "n"]))


def test_skewed_join_is_split_at_run_time(spark, hot):
    """A report side with a hot key is cut into several tasks."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        right = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        df = join_keys(hot.withColumn("texto", F.sha2(F.col("n").cast("string"), 512)), right, ["k"])
        assert len(df.collect()) == 40000
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_python_and_no_pair_joins_in_any_query(spark):
    for name, query in load()[0].items():
        text = plan(query(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)


@pytest.mark.parametrize("name", ["pathology_stage", "pathology_stage_group_p", "ihc_stage", "ihc_stage_group_p",
                                  "accuracy_sentinel", "accuracy_any_fields", "validation_sheet", "ihc_samples_sheet"])
def test_text_stays_below_the_answer_join(spark, tmp_path, monkeypatch, name):
    """Patterns run on the report scan: no join exchange holds the text, nothing searches it above a sample explode."""
    for kind in ("pathology", "ihc", "samples"):
        for group, keys in (("F", ("ficha", "id_item", "id_subitem")), ("P", ("ficha", "sigla_exame", "id_marca", "sequencial"))):
            X.answers(spark, SF, kind, group, keys).write.parquet(f"{tmp_path}/{kind}{group}")
    for group in "FP":
        X.reports(spark, SF, group, brand=False).write.parquet(f"{tmp_path}/reports{group}")
    monkeypatch.setattr(X, "reports", lambda s, sf, group="F", brand=True: s.read.parquet(f"{tmp_path}/reports{group}"))
    monkeypatch.setattr(X, "answers", lambda s, sf, kind, group="F", keys=(): s.read.parquet(f"{tmp_path}/{kind}{group}"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(load()[0][name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any("laudo_tratado" in line for line in lines[:join + 1])
    assert sum("Exchange hashpartitioning" in line for line in lines) >= 2
    scan_side = [line for line in lines if "laudo_tratado" in line]
    assert scan_side and all("Exchange" not in line and "Sort " not in line for line in scan_side)


def test_scans_read_only_what_they_need(spark):
    text = plan(load()[0]["scan_reports"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in text
    orders = X.table(spark, SF, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan(orders)


def test_report_filters_reach_the_scan(spark, tmp_path):
    """Care line, exam code and date go down to parquet, the pattern runs after them."""
    from careline.plans.ihc import ihc_reports

    path = str(tmp_path / "reports")
    X.reports(spark, SF, brand=False).write.parquet(path)
    reports = spark.read.parquet(path)
    text = plan(ihc_reports(reports, target=reports.filter("ficha < 50")).select("ficha", "laudo_tratado"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for part in ("EqualTo(linha_cuidado,mama)", "In(sigla_exame, [IH-NEO,IHMAMA])", "GreaterThanOrEqual(_datestamp"):
        assert part in pushed
    assert "resposta" not in pushed and "sexo_cliente" in pushed


def test_category_is_extracted_once(spark, tmp_path):
    from careline.operators.cohort import category_in
    from careline.operators.followup import with_categories

    path = str(tmp_path / "reports")
    X.reports(spark, SF, brand=False).write.parquet(path)
    text = plan(category_in(with_categories(spark.read.parquet(path))).select("ficha", "MIN_BIRADS", "BIRADS"))
    assert text.count("regexp_extract_all(") == 1


@pytest.mark.parametrize("kind", ["ihc", "pathology"])
def test_labels_lower_a_report_once(spark, kind):
    """The text without long runs of spaces once, the whole text only where it has such runs; labels are those of the plain functions."""
    from careline.functions import markers, pathology
    from careline.operators.answers import pseudo_gold

    gap = ["", " " * 7, " " * 8, " " * 30, " " * 46, " " * 80]
    texts = [f"RECEPTOR de progesterona{g}- POSITIVO. HER2{g}escore{g}3+. ki67{g}12,5%. CK5/6{g}negativo. Carcinoma. GRAU{g} nuclear{g}2" for g in gap] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, laudo_tratado string").repartition(2)
    gold = pseudo_gold(df, kind)
    assert plan(gold).count("lower(") <= 2
    labels = (markers.ihc_labels if kind == "ihc" else pathology.pathology_labels)(F.col("laudo_tratado"))
    want = df.select("*", *[c.alias(f"heu_{k}") for k, c in labels.items()])
    assert gold.columns == want.columns
    assert gold.orderBy("i").collect() == want.orderBy("i").collect()


@pytest.mark.parametrize("name", ["ihc_samples_sheet", "validation_sheet", "inconsistency_flags"])
def test_a_scan_for_mentions_lowers_a_report_once(spark, name):
    from careline.operators.evaluate import inconsistencies
    from careline.plans.ihc import ihc_gold

    df = spark.range(3).select(F.col("id"), F.col("id").cast("string").alias("laudo_tratado"))
    out = inconsistencies(df) if name == "inconsistency_flags" else ihc_gold(df, sheet=True)
    generate = next(line for line in plan(out).splitlines() if "Generate explode" in line)
    assert "lower(" not in generate.split("_marcador")[0].split("lambda")[0]
    assert "_laudo_curto" in generate and not any(c.startswith("_laudo") for c in out.columns)


def test_wide_projections_run_in_methods_the_jvm_compiles(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
