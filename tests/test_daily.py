"""States kept by day, sketches, attribution and bucketed joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from careline.operators import daily, tables
from careline.operators import evaluate as E
from careline.operators.followup import attribute_returns, overdue_rate
from careline.plans.ihc import ihc_comparison, ihc_gold, ihc_reports, ihc_subtypes
from careline.sources.bucketed import bucket_count, read_bucketed, save_bucketed

D0 = dt.date(2024, 1, 20)


def day(n):
    return D0 + dt.timedelta(days=n)


def compared(spark, rows):
    return spark.createDataFrame(rows, "dth_pedido date, acertou_a boolean, acertou_b boolean")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_days_that_are_read_again_replace_their_states(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(day(i % 40), [True, False, None][i % 3], i % 5 == 0) for i in range(200)]
    first = [r for i, r in enumerate(rows) if i % 4]
    states = lambda rs: daily.accuracy_days(compared(spark, rs), ["a", "b"])
    daily.keep_days(states(first), path)
    before = len(list(tmp_path.glob("s/data/gen=2*")))
    late = {r[0] for i, r in enumerate(rows) if i % 4 == 0 and r[0] < day(20)}
    daily.keep_days(states([r for r in rows if r[0] in late]), path)
    now = [r for r in rows if r[0] in late] + [r for r in first if r[0] not in late]
    for rate in ("share", "mean"):
        assert collected(daily.accuracy_from_days(daily.read_days(spark, path), rate)) == collected(E.accuracy(compared(spark, now), ["a", "b"], rate))
    assert collected(daily.errors_from_days(daily.read_days(spark, path))) == collected(E.error_summary(compared(spark, now), ["a", "b"]))
    assert before == 0
    # a day that has no rows any more, in a month that keeps others, and a whole month
    gone = [day(1), *[day(n) for n in range(12, 41)]]
    daily.keep_days(states([]), path, gone)
    left = [r for r in now if r[0] not in gone]
    assert collected(daily.accuracy_from_days(daily.read_days(spark, path))) == collected(E.accuracy(compared(spark, left), ["a", "b"]))


def test_only_the_months_of_the_days_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "s")
    daily.keep_days(daily.accuracy_days(compared(spark, [(day(0), True, True), (day(40), True, True)]), ["a", "b"]), path)
    daily.keep_days(daily.accuracy_days(compared(spark, [(day(40), False, True)]), ["a", "b"]), path)
    assert [p.name for p in tmp_path.glob("s/data/gen=2/mes*")] == ["mes=2024-02"]
    assert {(r.campo, r.acertos) for r in daily.accuracy_from_days(daily.read_days(spark, path)).collect()} == {("a", 1), ("b", 2)}


def test_overdue_counts_a_patient_of_two_days_once(spark, tmp_path):
    rows = [(day(0), 12, 1, None), (day(5), 12, 1, 9), (day(5), 12, 2, 8), (day(6), 6, 2, None), (day(300), 12, 3, None), (day(1), 0, 4, None)]
    planned = spark.createDataFrame(rows, "dth_pedido date, retorno_cliente int, id_cliente int, ficha_retorno_elegivel int").withColumn(
        "dth_previsao_retorno", F.date_add("dth_pedido", F.when(F.col("retorno_cliente") == 12, 360).otherwise(180)).cast("timestamp"))
    path = str(tmp_path / "o")
    daily.keep_days(daily.overdue_days(planned), path)
    as_of = F.lit("2025-02-10").cast("date")
    assert collected(daily.overdue_from_days(daily.read_days(spark, path), as_of)) == collected(overdue_rate(planned, as_of))


def test_replace_partitions_needs_one_partition_column(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    with pytest.raises(ValueError, match="one partition column"):
        tables.replace_partitions(spark.range(1), path)


def test_quartiles_of_merged_sketches(spark):
    random.seed(2)
    values = [random.gauss(1e6, 3) for _ in range(20_000)] + [None] * 50
    df = spark.createDataFrame([(i % 30, v, None) for i, v in enumerate(values)], "dia int, x double, vazio double")
    got = {r.coluna: r for r in E.describe_from(E.describe_state(df, ["x", "vazio"], ["dia"])).collect()}
    known = sorted(v for v in values if v is not None)
    whole = {r.coluna: r for r in E.describe(df, ["x", "vazio"]).collect()}
    for c in ("n", "media", "desvio", "minimo", "maximo"):
        assert got["x"][c] == pytest.approx(whole["x"][c], rel=1e-9)
    for name, rank in E.QUARTILES.items():
        assert abs(known.index(got["x"][name]) / len(known) - rank) <= E.RANK_ERROR
    empty = got["vazio"]
    assert (empty.n, empty.media, empty.desvio, empty.q1, empty.mediana) == (0, None, None, None, None)


def test_quartiles_of_few_rows_are_exact(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    r = E.describe_from(E.describe_state(df, ["x"])).first()
    assert (r.q1, r.mediana, r.q3) == (25.0, 50.0, 75.0)


def test_attribution_against_every_pair(spark):
    random.seed(4)
    returns = [(i, random.randint(1, 5) if i % 3 else 1, day(random.randint(0, 60))) for i in range(200)] + [(900, None, day(3)), (901, 1, None)]
    sent = [(random.randint(1, 4), day(random.randint(0, 60))) for _ in range(40)] + [(None, day(1)), (2, None)]
    sent += sent[:5]
    df = spark.createDataFrame(returns, "ficha int, id_cliente int, dth_retorno date")
    reminders = spark.createDataFrame(sent, "id_cliente int, dth_lembrete date")
    for within in (None, 10):
        want = []
        for ficha, who, when in returns:
            before = [d for c, d in sent if None not in (who, when, c, d) and c == who and d <= when and (within is None or (when - d).days <= within)]
            want.append((ficha, max(before) if before else None, (when - max(before)).days if before else None))
        got = attribute_returns(df, reminders, within=within).select("ficha", "dth_lembrete", "dias_lembrete").collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_joins_of_bucketed_tables_do_not_shuffle(spark, tmp_path):
    """Reports and answers in buckets of their key meet where they lie, also without a broadcast."""
    from workloads import fixtures as X

    sf, keys = "/root/testdata/sf0.001", ["ficha", "id_item", "id_subitem"]
    save_bucketed(X.reports(spark, sf, brand=False), "laudos_b", keys, 4, str(tmp_path / "r"))
    save_bucketed(X.answers(spark, sf, "ihc"), "respostas_b", keys, 4, str(tmp_path / "a"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = ihc_comparison(ihc_subtypes(ihc_gold(ihc_reports(read_bucketed(spark, "laudos_b"))), read_bucketed(spark, "respostas_b")))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        same = ihc_comparison(ihc_subtypes(ihc_gold(ihc_reports(X.reports(spark, sf, brand=False))), X.answers(spark, sf, "ihc")))
        cols = ["ficha", "id_item", "categoria_final", "acertou_status_her2"]
        assert collected(df.select(cols)) == collected(same.select(cols))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("laudos_b", "respostas_b"):
            spark.sql(f"DROP TABLE {name}")


def test_buckets_follow_the_rows(spark):
    """A bucket keeps its size as the table grows, so one task's memory does too."""
    table = lambda n: spark.range(n).select("id", F.repeat(F.lit("x"), 968).alias("texto"))
    assert bucket_count(table(10)) == 8 and bucket_count(table(0), least=1) == 1
    counts = [bucket_count(table(n), least=1, target=100_000) for n in (1000, 6000)]
    assert counts == [10, 60]
    assert bucket_count(table(10), table(6000), least=1, target=100_000) == 60
    assert bucket_count(table(6000).withColumn("texto", F.lit(None).cast("string")), least=1, target=100_000) == 2


def test_rows_of_a_day_are_extracted_once(spark):
    """Days are read twice, but what was found in a report is not looked for again."""
    from workloads import q_daily
    from careline.session import scratch_path

    seen = spark.sparkContext.accumulator(0)
    rows = [(i, 1, day(i % 9), i % 2 == 0) for i in range(90)]

    def counted(row):
        seen.add(1)
        return tuple(row)

    source = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted), "ficha int, id_item int, dth_pedido date, acertou_a boolean")
    states = q_daily._kept(lambda df: daily.accuracy_days(df, ["a"]), source, scratch_path(spark, "uma"))
    assert [(r.campo, r.acertos, r.total) for r in daily.accuracy_from_days(states).collect()] == [("a", 45, 90)]
    assert seen.value == 90
