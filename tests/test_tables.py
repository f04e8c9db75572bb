import datetime as dt

import pytest
from pyspark.sql import functions as F

from careline.operators import increment, tables
from careline.streaming.increments import stream_upsert

DAY = dt.date(2024, 1, 1)


def frame(spark, rows, schema="k int, v string, _datestamp date"):
    return spark.createDataFrame(rows, schema)


def content(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path).collect())


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.mark.parametrize("by", [(), ("_datestamp",)])
def test_save_creates_updates_and_inserts(spark, tmp_path, by):
    path = str(tmp_path / "t")
    tables.save(frame(spark, []), path, ["k"], by)
    assert not tables.table_exists(spark, path)
    tables.save(frame(spark, [(1, "a", day(0)), (2, "a", day(1))]), path, ["k"], by)
    new = frame(spark, [(2, "b", day(1)), (3, "b", day(2))])
    for _ in range(2):
        tables.save(new, path, ["k"], by)
        assert content(spark, path) == [(1, "a", day(0)), (2, "b", day(1)), (3, "b", day(2))]
    tables.save(new.filter("FALSE"), path, ["k"], by)
    assert len(content(spark, path)) == 3


def test_key_that_moves_to_another_date(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(1, "a", day(0)), (2, "a", day(0))]), path, ["k"], ["_datestamp"])
    tables.save(frame(spark, [(1, "b", day(5))]), path, ["k"])
    assert content(spark, path) == [(1, "b", day(5)), (2, "a", day(0))]


def test_untouched_dates_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(i, "a", day(i)) for i in range(6)]), path, ["k"], ["_datestamp"])
    tables.save(frame(spark, [(2, "b", day(2)), (9, "b", day(9))]), path, ["k"])
    files = [r[0] for r in tables.read_table(spark, path).select(F.input_file_name()).distinct().collect()]
    assert len([f for f in files if "/gen=1/" in f]) == 5
    assert len([f for f in files if "/gen=2/" in f]) == 2


def test_awkward_partition_values(spark, tmp_path):
    path = str(tmp_path / "with space+plus" / "data" / "t")
    schema = "k int, v string, grupo string"
    names = ["a b", "a/b=c", "100%", "x+y", "é", None]
    tables.save(frame(spark, [(i, "a", g) for i, g in enumerate(names)], schema), path, ["k"], ["grupo"])
    tables.save(frame(spark, [(i, "b", g) for i, g in enumerate(names)], schema), path, ["k"])
    got = {r.k: (r.v, r.grupo) for r in tables.read_table(spark, path).collect()}
    assert got == {i: ("b", g) for i, g in enumerate(names)}


def test_null_keys_never_match(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(None, "a", day(0))]), path, ["k"])
    tables.save(frame(spark, [(None, "b", day(0)), (None, "c", day(0))]), path, ["k"])
    assert len(content(spark, path)) == 3


def test_ambiguous_source_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(1, "a", day(0))]), path, ["k"])
    with pytest.raises(ValueError):
        tables.save(frame(spark, [(1, "b", day(0)), (1, "c", day(0))]), path, ["k"])
    assert content(spark, path) == [(1, "a", day(0))]


def test_repeated_keys_without_a_match_are_inserted(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(1, "a", day(0)), (1, "b", day(0))]), path, ["k"])
    tables.save(frame(spark, [(2, "a", day(0)), (2, "b", day(0))]), path, ["k"])
    assert [r[:2] for r in content(spark, path)] == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    tables.save(frame(spark, [(1, "c", day(0))]), path, ["k"])
    assert [r[:2] for r in content(spark, path)] == [(1, "c"), (1, "c"), (2, "a"), (2, "b")]


def test_missing_columns_keep_their_values(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(1, "a", day(0)), (2, "b", None)]), path, ["k"])
    tables.save(spark.createDataFrame([(1, None), (3, "c")], "k int, v string"), path, ["k"])
    assert sorted(content(spark, path), key=lambda r: r[0]) == [(1, None, day(0)), (2, "b", None), (3, "c", None)]


def test_type_conflicts_are_refused_before_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(spark.createDataFrame([(1, 5)], "k bigint, n int"), path, ["k"])
    with pytest.raises(ValueError, match="column n is int in the table and string"):
        tables.save(spark.createDataFrame([(1, "x")], "k bigint, n string"), path, ["k"])
    with pytest.raises(ValueError, match="bigint"):
        tables.save(spark.createDataFrame([(1, 6)], "k bigint, n bigint"), path, ["k"])
    tables.save(spark.createDataFrame([(1, 7)], "k int, n int"), path, ["k"])
    assert content(spark, path) == [(1, 7)] and len(tables._versions(tables._Folder(spark, path))) == 2


def test_compact_and_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(i, "a", day(i % 3)) for i in range(9)]), path, ["k"], ["_datestamp"])
    for n in range(4):
        tables.save(frame(spark, [(100 + n, "b", day(n % 3)), (0, f"v{n}", day(0))]), path, ["k"])
    want, folder = content(spark, path), tables._Folder(spark, path)
    before = tables._latest(folder)
    assert len(before["dirs"]) > 3
    tables.compact(spark, path)
    assert content(spark, path) == want and len(tables._latest(folder)["dirs"]) == 3
    tables.expire(spark, path, keep=2)
    assert content(spark, path) == want and len(tables._versions(folder)) == 2
    old = tables._read(spark, folder, before)
    assert sorted(tuple(r) for r in old.collect()) == want
    tables.expire(spark, path, keep=1)
    assert content(spark, path) == want
    live = {d for d in tables._latest(folder)["dirs"]}
    assert {d for t in folder.names("data") if t.startswith("gen=") for d in tables._leaf_dirs(folder, t, 1)} == live
    tables.save(frame(spark, [(0, "last", day(0))]), path, ["k"])
    assert ("last" in {r[1] for r in content(spark, path)})


def test_key_scan_is_bounded_by_the_source(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(i, "a", day(0)) for i in range(50)]), path, ["k"])
    near = tables._within(tables.read_table(spark, path), frame(spark, [(3, "b", day(0)), (7, "b", day(0))]), ["k"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,3)" in plan and "LessThanOrEqual(k,7)" in plan


def test_new_columns_and_overwrite_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(frame(spark, [(1, "a", day(0))]), path, ["k"])
    wider = frame(spark, [(2, "b", day(0))]).withColumn("extra", F.lit(7))
    tables.save(wider, path, ["k"])
    assert {r.k: r.extra for r in tables.read_table(spark, path).collect()} == {1: None, 2: 7}
    tables.overwrite(spark.range(3), path)
    assert tables.read_table(spark, path).columns == ["id"]


def test_overwrite_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(10), path)
    tables.overwrite(tables.read_table(spark, path).filter("id < 4"), path)
    assert tables.read_table(spark, path).count() == 4


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(3), path)
    with pytest.raises(Exception, match="parada"):
        tables.overwrite(spark.range(5).select(F.raise_error(F.lit("parada")).alias("id")), path)
    assert tables.read_table(spark, path).count() == 3
    tables.overwrite(spark.range(5), path)
    assert tables.read_table(spark, path).count() == 5


def test_second_writer_is_noticed(spark, tmp_path):
    folder = tables._Folder(spark, str(tmp_path / "t"))
    folder.publish("versions/00000001.json", "{}")
    with pytest.raises(RuntimeError):
        folder.publish("versions/00000001.json", "{}")


def test_increments(spark):
    df = frame(spark, [(i, "a", day(i)) for i in range(5)])
    target = df.filter("k <= 2")
    keys = lambda d: sorted(r.k for r in d.collect())
    assert keys(increment.since(df, target)) == [2, 3, 4]
    assert keys(increment.since(df, target, inclusive=False)) == [3, 4]
    assert keys(increment.since(df, None)) == [0, 1, 2, 3, 4]
    assert keys(increment.since(df, target.filter("FALSE"))) == [0, 1, 2, 3, 4]
    assert keys(increment.only_new(df, target, ["k"])) == [3, 4]


def test_increment_prunes_date_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(frame(spark, [(i, "a", day(i)) for i in range(5)]), path, ["_datestamp"])
    df = tables.read_table(spark, path)
    plan = increment.since(df, df.filter("k <= 2"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_datestamp" in plan


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    rows = [(i % 7, f"v{i:03d}", day(i % 3)) for i in range(40)]
    frame(spark, rows[:20]).coalesce(1).write.parquet(source)
    schema = frame(spark, []).schema

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(source)
        stream_upsert(stream, path, ["k"], str(tmp_path / checkpoint), order=[F.desc("v")],
                      by=["_datestamp"]).awaitTermination()

    run("c1")
    frame(spark, rows[20:]).coalesce(1).write.mode("append").parquet(source)
    run("c1")
    want = sorted({k: (k, v, d) for k, v, d in sorted(rows, key=lambda r: r[1])}.values())
    assert content(spark, path) == want
    run("c2")
    assert len(content(spark, path)) == len(want)


def test_late_files_do_not_replace_newer_rows(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    rows = [(i % 5, f"v{i:03d}", day(i % 4)) for i in range(60)]
    schema = frame(spark, []).schema
    for part in (rows[40:], rows[:20], rows[20:40]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream_upsert(spark.readStream.schema(schema).parquet(source), path, ["k"], str(tmp_path / "c"),
                      order=[F.desc("v")], by=["_datestamp"]).awaitTermination()
    assert content(spark, path) == sorted({k: (k, v, d) for k, v, d in rows}.values())


def test_ordered_upsert_keeps_missing_columns_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    newest = [F.desc("v")]
    tables.save(spark.createDataFrame([(1, 1, "a", 5), (2, 9, "b", 6)], "k int, v int, s string, extra int"), path, ["k"], order=newest)
    source = [(1, 2, "z"), (1, 3, "y"), (2, 4, "late"), (3, 1, "new"), (None, 1, "n"), (None, 1, "n")]
    tables.save(spark.createDataFrame(source, "k int, v int, s string"), path, ["k"], order=newest)
    got = sorted((tuple(r) for r in tables.read_table(spark, path).collect()), key=str)
    assert got == sorted([(1, 3, "y", 5), (2, 9, "b", 6), (3, 1, "new", None), (None, 1, "n", None), (None, 1, "n", None)], key=str)
    # a wider source: the stored row that wins stays as it is
    tables.save(spark.createDataFrame([(1, 1, "w", 7), (2, 10, "w", 8)], "k int, v int, s string, more int"), path, ["k"], order=newest)
    got = {r.k: r for r in tables.read_table(spark, path).collect() if r.k in (1, 2)}
    assert (got[1].s, got[1].more, got[1].extra) == ("y", None, 5) and (got[2].s, got[2].more, got[2].extra) == ("w", 8, 6)


def test_new_table_has_one_row_per_key_of_an_ordered_source(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 3)], "k int, v int"), path, ["k"], order=[F.desc("v")])
    assert sorted((tuple(r) for r in tables.read_table(spark, path).collect()), key=str) == sorted([(1, 2), (None, 3), (None, 3)], key=str)


def test_empty_frames_write_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], "k int, v int")
    tables.save(none, path, ["k"])
    assert not tables.table_exists(spark, path) and not [p for p in tmp_path.glob("t/data/*")]
    tables.save(spark.createDataFrame([(1, 1)], "k int, v int"), path, ["k"])
    tables.save(none, path, ["k"])
    assert tables.read_table(spark, path).count() == 1 and len(list(tmp_path.glob("t/versions/*.json"))) == 1


def test_figures_come_from_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    found = tables.overwrite(spark.range(10).withColumn("d", F.col("id") % 3), path, ["d"], figures=[F.max("id").alias("marca")])
    assert found == {"linhas": 10, "marca": 9}


def test_expire_refuses_to_keep_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="at least"):
        tables.expire(spark, str(tmp_path / "t"), keep=0)
