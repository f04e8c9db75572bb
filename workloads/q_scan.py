"""Scans, increments, tables and row operators."""

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.operators import increment, joins, rows, tables
from careline.session import scratch_path
from careline.sources import all_but, columns, exists, read_reports, read_returns, register_view
from careline.sources.tables import RETURN_COLUMNS
from careline.streaming.increments import stream_upsert
from workloads import fixtures as X
from workloads.registry import register

F3 = V.REPORT_KEYS["F"]
P4 = V.REPORT_KEYS["P"]


def text(*cols):
    """Dates as text, so both engines give the same cell."""
    return [F.col(c).cast("string").alias(c) for c in cols]


@register("scan_reports", "SELECT doc_id, lang, source, n_chars FROM documents")
def scan_reports(spark, sf):
    return read_reports(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "source", "n_chars"])


@register("scan_returns", "SELECT ficha_origem, id_cliente, linha_cuidado, " + ", ".join(
    f"CAST({old} AS VARCHAR) AS {new}" for old, new in RETURN_COLUMNS.items()) + " FROM returns")
def scan_returns(spark, sf):
    df = read_returns(spark, X.raw_returns(spark, sf))
    return df.select("ficha_origem", "id_cliente", "linha_cuidado", *text(*RETURN_COLUMNS.values()))


def _events(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("_datestamp")
    )


def _history(spark, sf):
    """The part of the events a previous run has loaded."""
    return _events(spark, sf).filter(F.col("_datestamp") <= F.lit("2024-01-15").cast("date"))


_MARK = "(SELECT max(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15')"


@register("probe_then_load", f"""
    SELECT 'full' AS carga, count(*) AS n FROM events
    UNION ALL SELECT 'incremental', count(*) FROM events WHERE CAST(ts AS DATE) >= {_MARK}""")
def probe_then_load(spark, sf):
    """Existence probe: a missing table means a full load, a present one an increment."""
    register_view(_history(spark, sf), "eventos_carregados")
    out = None
    for label, name in (("full", "eventos_ausentes"), ("incremental", "eventos_carregados")):
        target = spark.table(name) if exists(spark, name) else None
        n = increment.since(_events(spark, sf), target).agg(
            F.lit(label).alias("carga"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@register("increment_inclusive", f"""
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS _datestamp FROM events
    WHERE CAST(ts AS DATE) >= {_MARK}""")
def increment_inclusive(spark, sf):
    df = increment.since(_events(spark, sf), _history(spark, sf), inclusive=True)
    return df.select("event_id", *text("_datestamp"))


@register("increment_exclusive", f"""
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS _datestamp FROM events
    WHERE CAST(ts AS DATE) > {_MARK}""")
def increment_exclusive(spark, sf):
    df = increment.since(_events(spark, sf), _history(spark, sf), inclusive=False)
    return df.select("event_id", *text("_datestamp"))


@register("high_water_mark", "SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS _datestamp FROM orders")
def high_water_mark(spark, sf):
    df = X.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("_datestamp"))
    return increment.mark_frame(df).select(*text("_datestamp"))


@register("append_new_only", """
    SELECT ficha, id_item, id_marca FROM reports r WHERE NOT EXISTS (
      SELECT 1 FROM reports t WHERE t.marca IN ('BUILDING', 'MACHINERY')
      AND t.ficha = r.ficha AND t.id_item = r.id_item AND t.id_subitem = r.id_subitem)""")
def append_new_only(spark, sf):
    df = X.reports(spark, sf)
    loaded = df.filter(F.col("marca").isin("BUILDING", "MACHINERY"))
    return increment.only_new(df, loaded, F3).select("ficha", "id_item", "id_marca")


# -- tables ------------------------------------------------------------------

_LINES = """lines AS (SELECT l_orderkey AS ficha, l_linenumber AS id_item,
    max(l_shipdate) AS enviado FROM lineitem GROUP BY ALL)"""


def _lines(spark, sf):
    return X.table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("ficha"), F.col("l_linenumber").alias("id_item")
    ).agg(F.max("l_shipdate").alias("enviado"))


@register("overwrite_table", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def overwrite_table(spark, sf):
    """A second overwrite replaces rows and schema of the first."""
    path = scratch_path(spark, "overwrite")
    events = _events(spark, sf)
    tables.overwrite(events.select("event_id", "user_id"), path)
    tables.overwrite(events, path)
    return rows.count_by(tables.read_table(spark, path), "event_type")


@register("overwrite_partitioned", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS _datestamp, count(*) AS n,
    CAST(sum(event_id) AS BIGINT) AS chaves FROM events GROUP BY 1""")
def overwrite_partitioned(spark, sf):
    path = scratch_path(spark, "partitioned")
    tables.overwrite(_events(spark, sf), path, by=["_datestamp"])
    df = tables.read_table(spark, path).groupBy("_datestamp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("chaves"))
    return df.select(*text("_datestamp"), "n", "chaves")


@register("merge_three_keys", """
    SELECT ficha, id_item, id_subitem, CASE WHEN id_item >= 4 THEN 'novo' ELSE 'antigo' END AS origem
    FROM reports WHERE id_item >= 4 OR id_item <= 5""")
def merge_three_keys(spark, sf):
    df = X.reports(spark, sf).select(*F3)
    old = df.filter("id_item <= 5").withColumn("origem", F.lit("antigo"))
    new = df.filter("id_item >= 4").withColumn("origem", F.lit("novo"))
    return tables.merge_frames(old, new, F3)


@register("merge_four_keys", """
    SELECT ficha, sigla_exame, id_marca, sequencial,
    CASE WHEN id_marca >= 2 THEN 'novo' ELSE 'antigo' END AS origem
    FROM reports WHERE id_marca <= 3 OR id_marca >= 2""", group="P")
def merge_four_keys(spark, sf):
    df = X.reports(spark, sf, "P").select(*P4)
    old = df.filter("id_marca <= 3").withColumn("origem", F.lit("antigo"))
    new = df.filter("id_marca >= 2").withColumn("origem", F.lit("novo"))
    return tables.merge_frames(old, new, P4)


@register("save_create_or_merge", """
    SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS _datestamp,
    CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN value + 1 ELSE value END AS value FROM events""")
def save_create_or_merge(spark, sf):
    """Create with the first save, merge with the next; an empty save changes nothing."""
    path = scratch_path(spark, "saved")
    events = _events(spark, sf).select("event_id", "value", "_datestamp")
    later = events.filter("_datestamp >= DATE'2024-01-10'").withColumn("value", F.col("value") + 1)
    tables.save(events.filter("_datestamp <= DATE'2024-01-20'"), path, ["event_id"], by=["_datestamp"])
    tables.save(later, path, ["event_id"])
    tables.save(later.filter("FALSE"), path, ["event_id"])
    return tables.read_table(spark, path).select("event_id", *text("_datestamp"), "value")


@register("save_unpartitioned", f"""WITH {_LINES}
    SELECT ficha, id_item, CASE WHEN id_item > 2 THEN 'b' ELSE 'a' END AS lote FROM lines""")
def save_unpartitioned(spark, sf):
    path = scratch_path(spark, "lines")
    df = _lines(spark, sf).select("ficha", "id_item")
    tables.save(df.filter("id_item <= 4").withColumn("lote", F.lit("a")), path, ["ficha", "id_item"])
    tables.save(df.filter("id_item > 2").withColumn("lote", F.lit("b")), path, ["ficha", "id_item"])
    return tables.read_table(spark, path)


@register("increment_view_sql", f"""
    SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) > {_MARK} GROUP BY 1""")
def increment_view_sql(spark, sf):
    """An increment registered as a view and read by SQL text."""
    df = increment.since(_events(spark, sf), _history(spark, sf), inclusive=False)
    name = register_view(df, "eventos_novos")
    return spark.sql(f"SELECT event_type, count(*) AS n FROM {name} GROUP BY event_type")


@register("stream_upsert_events", """
    SELECT user_id, CAST(max(event_id) AS BIGINT) AS event_id FROM events GROUP BY 1""")
def stream_upsert_events(spark, sf):
    """The event file as a stream: the last event of each user, upserted batch by batch."""
    path = scratch_path(spark, "stream")
    schema = X.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    query = stream_upsert(
        stream.select("user_id", "event_id"), f"{path}/table", ["user_id"], f"{path}/checkpoint",
        order=[F.desc("event_id")],
    )
    query.awaitTermination()
    return tables.read_table(spark, f"{path}/table")


@register("stream_upsert_late_files", """
    SELECT user_id, CAST(max(event_id) AS BIGINT) AS event_id FROM events GROUP BY 1""")
def stream_upsert_late_files(spark, sf):
    """Files of the newest events first: later batches bring older rows, which change nothing."""
    path = scratch_path(spark, "late")
    events = X.table(spark, sf, "events").select("user_id", "event_id")
    for part in (2, 0, 1):
        some = events.filter(F.pmod(F.col("user_id") + F.col("event_id"), F.lit(3)) == part)
        some.write.mode("append").parquet(f"{path}/in")
        stream_upsert(spark.readStream.schema(events.schema).parquet(f"{path}/in"), f"{path}/table", ["user_id"],
                      f"{path}/checkpoint", order=[F.desc("event_id")]).awaitTermination()
    return tables.read_table(spark, f"{path}/table")


@register("stream_upsert_fewer_columns", """
    WITH n AS (SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_id % 3 = 0 GROUP BY 1)
    SELECT e.user_id, CAST(coalesce(n.event_id, e.event_id) AS BIGINT) AS event_id, coalesce(n.value, e.value) AS value, e.event_type
    FROM (SELECT user_id, event_id, value, event_type FROM events WHERE event_id % 3 <> 0
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
    LEFT JOIN n ON n.user_id = e.user_id AND n.event_id > e.event_id
    UNION ALL SELECT user_id, CAST(event_id AS BIGINT), value, NULL FROM n WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 3 <> 0)""")
def stream_upsert_fewer_columns(spark, sf):
    """A stream without the type column over a table that has it: newer rows win, types stay."""
    path = scratch_path(spark, "narrow")
    events = X.table(spark, sf, "events").select("user_id", "event_id", "value", "event_type")
    newest = [F.desc("event_id")]
    tables.save(events.filter("event_id % 3 <> 0"), f"{path}/table", ["user_id"], order=newest)
    events.filter("event_id % 3 = 0").drop("event_type").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.drop("event_type").schema).parquet(f"{path}/in")
    stream_upsert(stream, f"{path}/table", ["user_id"], f"{path}/checkpoint", order=newest).awaitTermination()
    return tables.read_table(spark, f"{path}/table")


@register("write_figures", "SELECT count(*) AS linhas, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS marca FROM orders")
def write_figures(spark, sf):
    """Row count and mark of a table, taken from the write that makes it."""
    orders = X.table(spark, sf, "orders")
    found = tables.overwrite(orders, scratch_path(spark, "figures"), figures=[F.max(F.col("o_orderdate").cast("date")).alias("marca")])
    return spark.createDataFrame([(found["linhas"], str(found["marca"]))], "linhas bigint, marca string")


@register("merge_fewer_columns", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value + 1 ELSE value END AS value, event_type FROM events""")
def merge_fewer_columns(spark, sf):
    """An upsert without the type column leaves the types of matched rows as they are."""
    path = scratch_path(spark, "fewer")
    events = X.table(spark, sf, "events").select("event_id", "value", "event_type")
    tables.save(events, path, ["event_id"])
    tables.save(events.filter("event_id % 3 = 0").select("event_id", (F.col("value") + 1).alias("value")), path, ["event_id"])
    tables.compact(spark, path)
    return tables.read_table(spark, path)


# -- projections and rows ----------------------------------------------------

@register("project_columns", "SELECT ficha, id_item, sigla_exame, CAST(dth_pedido AS VARCHAR) AS dth_pedido FROM reports")
def project_columns(spark, sf):
    df = columns(X.reports(spark, sf), "ficha", "id_item", "sigla_exame", "dth_pedido")
    return df.select("ficha", "id_item", "sigla_exame", *text("dth_pedido"))


@register("project_all_but", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def project_all_but(spark, sf):
    return all_but(X.table(spark, sf, "orders"), "o_totalprice", "o_orderdate")


@register("row_count", "SELECT count(*) AS n FROM reports")
def row_count(spark, sf):
    return rows.row_count(X.reports(spark, sf))


@register("count_by_gate", f"""
    SELECT should_call_llm, count(*) AS n FROM (SELECT regexp_matches(laudo_tratado,
    '(?i)({"|".join(V.MALIGNANCY_TERMS)})')
    AS should_call_llm FROM reports) GROUP BY 1""")
def count_by_gate(spark, sf):
    from careline.operators.cohort import gate

    return rows.count_by(gate(X.reports(spark, sf)), "should_call_llm")


@register("distinct_exam_codes", "SELECT DISTINCT sigla_exame FROM reports")
def distinct_exam_codes(spark, sf):
    return rows.distinct_values(X.reports(spark, sf), "sigla_exame")


@register("distinct_sex_exam", "SELECT DISTINCT sexo_cliente, sigla_exame FROM reports")
def distinct_sex_exam(spark, sf):
    return rows.distinct_values(X.reports(spark, sf), "sexo_cliente", "sigla_exame")


@register("dedupe_visit", """
    SELECT ficha, id_item, sigla_exame FROM reports
    QUALIFY row_number() OVER (PARTITION BY ficha ORDER BY id_item, id_subitem) = 1""")
def dedupe_visit(spark, sf):
    df = X.reports(spark, sf).select("ficha", "id_item", "id_subitem", "sigla_exame")
    return rows.dedupe(df, ["ficha"], ["id_item", "id_subitem"]).drop("id_subitem")


@register("dedupe_complete_rows", """
    SELECT ficha, sigla_exame, id_marca, sequencial FROM reports WHERE laudo_tratado IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY ficha, sigla_exame, id_marca ORDER BY sequencial) = 1""", group="P")
def dedupe_complete_rows(spark, sf):
    df = X.reports(spark, sf, "P").select(*P4, "laudo_tratado")
    out = rows.dedupe_complete(df, ["ficha", "sigla_exame", "id_marca"], ["sequencial"])
    return out.select(*P4)


@register("row_index_by_key", f"""WITH {_LINES}
    SELECT ficha, id_item, row_number() OVER (ORDER BY ficha, id_item) - 1 AS index FROM lines""")
def row_index_by_key(spark, sf):
    return rows.with_row_index(_lines(spark, sf).select("ficha", "id_item"), ["ficha", "id_item"])


@register("row_index_documents", """
    SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS index FROM documents""")
def row_index_documents(spark, sf):
    df = X.table(spark, sf, "documents").select("doc_id", "lang")
    return rows.with_row_index(df, ["lang", "doc_id"])


@register("sample_first", """
    SELECT ficha, id_item, sigla_exame FROM reports ORDER BY ficha, id_item LIMIT 200""")
def sample_first(spark, sf):
    df = X.reports(spark, sf).select("ficha", "id_item", "sigla_exame")
    return rows.sample_first(df, 200, ["ficha", "id_item"])


@register("describe_orders", """
    SELECT * FROM (
      SELECT 'o_totalprice' AS coluna, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS media,
        round(stddev_samp(o_totalprice), 4) AS desvio, min(o_totalprice) AS minimo, max(o_totalprice) AS maximo FROM orders
      UNION ALL
      SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 4), round(stddev_samp(o_custkey), 4),
        CAST(min(o_custkey) AS DOUBLE), CAST(max(o_custkey) AS DOUBLE) FROM orders)""")
def describe_orders(spark, sf):
    from careline.operators.evaluate import describe

    df = describe(X.table(spark, sf, "orders"), ["o_totalprice", "o_custkey"])
    return df.withColumns({c: F.round(c, 4) for c in ("media", "desvio")})


# -- joins -------------------------------------------------------------------

@register("join_categories_three_keys", """
    SELECT a.ficha, a.id_item, a.sigla_exame, CAST(length(b.laudo_tratado) AS INT) AS tamanho
    FROM reports a JOIN reports b ON a.ficha = b.ficha AND a.id_item = b.id_item
      AND a.id_subitem = b.id_subitem WHERE b.sigla_exame IN ('MAMOG', 'MAMOGDIG', 'MAMOPROT', 'MAMOG3D')""")
def join_categories_three_keys(spark, sf):
    from careline.operators.cohort import with_exam_codes

    df = X.reports(spark, sf)
    right = with_exam_codes(df, "mammogram").select(*F3, F.length("laudo_tratado").alias("tamanho"))
    out = joins.join_keys(df.select(*F3, "sigla_exame"), right, F3)
    return out.select("ficha", "id_item", "sigla_exame", "tamanho")


@register("join_categories_four_keys", """
    SELECT a.ficha, a.sequencial, a.id_cliente, CAST(length(b.laudo_tratado) AS INT) AS tamanho
    FROM reports a JOIN reports b ON a.ficha = b.ficha AND a.sigla_exame = b.sigla_exame
      AND a.id_marca = b.id_marca AND a.sequencial = b.sequencial
    WHERE b.sigla_exame IN ('MAMO', 'MAMODI') AND upper(b.sexo_cliente) = 'F'""", group="P")
def join_categories_four_keys(spark, sf):
    from careline.operators.cohort import female_only, with_exam_codes

    df = X.reports(spark, sf, "P")
    right = with_exam_codes(female_only(df), "mammogram", "P").select(
        *P4, F.length("laudo_tratado").alias("tamanho"))
    out = joins.join_keys(df.select(*P4, "id_cliente"), right, P4)
    return out.select("ficha", "sequencial", "id_cliente", "tamanho")


@register("attach_returns", """
    SELECT r.ficha, r.id_item, r.id_cliente, e.ficha AS ficha_retorno_elegivel,
    CAST(e.dth_pedido AS VARCHAR) AS dth_pedido_retorno_elegivel, e.dias_entre_ficha AS dias_entre_ficha_elegivel
    FROM reports r LEFT JOIN returns e ON e.ficha_origem = r.ficha AND e.id_cliente = r.id_cliente
      AND e.linha_cuidado = r.linha_cuidado""")
def attach_returns(spark, sf):
    df = X.reports(spark, sf).select("ficha", "id_item", "id_cliente", "linha_cuidado")
    out = joins.attach_returns(df, read_returns(spark, X.raw_returns(spark, sf)))
    return out.select("ficha", "id_item", "id_cliente", "ficha_retorno_elegivel",
                      *text("dth_pedido_retorno_elegivel"), "dias_entre_ficha_elegivel")


@register("reports_without_return", """
    SELECT r.ficha, r.id_item FROM reports r LEFT JOIN returns e ON e.ficha_origem = r.ficha
      AND e.id_cliente = r.id_cliente AND e.linha_cuidado = r.linha_cuidado WHERE e.ficha IS NULL""")
def reports_without_return(spark, sf):
    returns = X.raw_returns(spark, sf).select(F.col("ficha_origem").alias("ficha"), "id_cliente", "linha_cuidado")
    df = X.reports(spark, sf).select("ficha", "id_item", "id_cliente", "linha_cuidado")
    out = joins.not_in(df, returns, ["ficha", "id_cliente", "linha_cuidado"])
    return out.select("ficha", "id_item")


@register("derive_returns_any_exam", "SELECT ficha_origem, id_cliente, ficha, CAST(dth_pedido AS VARCHAR) AS dth_pedido, dias_entre_ficha FROM returns")
def derive_returns_any_exam(spark, sf):
    df = joins.derive_returns(X.visits(spark, sf), codes=None)
    return df.select("ficha_origem", "id_cliente", "ficha", *text("dth_pedido"), "dias_entre_ficha")


@register("derive_returns_exam_codes", "SELECT ficha_origem, id_cliente, ficha, CAST(dth_pedido AS VARCHAR) AS dth_pedido, dias_entre_ficha FROM ("
          + X.next_visit_sql("b.sigla_exame IN ('MAMOG', 'MAMOG3D', 'MAMOGDIG', 'MAMOPROT', 'USMAMAS', 'USMAMASD', 'RMMAMAS')") + ")")
def derive_returns_exam_codes(spark, sf):
    df = joins.derive_returns(X.visits(spark, sf))
    return df.select("ficha_origem", "id_cliente", "ficha", *text("dth_pedido"), "dias_entre_ficha")


@register("expand_event_props", """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def expand_event_props(spark, sf):
    df = X.table(spark, sf, "events").select(
        "event_id", "event_type", F.from_json("props", "k BIGINT").alias("p"))
    return joins.expand_struct(df, "p")
