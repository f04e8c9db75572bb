"""Run queries against their oracles: ``python -m workloads.check [sf_dir] [name ...]``."""

import math
import sys
import time

import duckdb

from workloads import load

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf):
    """Message of the first difference, or None."""
    queries, oracles = load()
    df = queries[name](spark, sf)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return None if got[1] else "no rows"
    cur = con.execute(oracles[name])
    want = normal([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        extra = list(set(got[1]) ^ set(want[1]))[:4]
        return f"rows {len(got[1])} != {len(want[1])} e.g. {extra}"
    if not want[1]:
        return "both empty"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} of {len(got[1])} rows differ, spark {bad[0][0]} oracle {bad[0][1]}" if bad else None


def main():
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = load()
    names = [n for n in queries if not args or any(a in n for a in args)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:40}{time.time() - start:6.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed, {len([n for n in names if n in oracles])} with oracle")
    spark.stop()
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
