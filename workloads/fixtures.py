"""Report, return and answer tables derived from the test tables.

Every column is a SQL expression that means the same in Spark and in the oracle
engine, so both sides see the same rows.  Only the list lookup is spelled
differently.  Sizes follow lineitem and orders.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloads import texts as T

AS_OF = "2001-08-01"

# Exam codes by (order + line) mod 16: four stages, returns, others, one foreign.
CODES_F = ("MAMOG", "MAMOGDIG", "MAMOPROT", "MAMOG3D", "BIOMAMUSCORE", "MAMOTORM", "ANATPATP",
           "CTPUNC", "FISHHER", "IH-NEO", "IHMAMA", "USMAMAS", "BRCA1", "CINTMAMA", "PAINELMAMA",
           "HEMOGRAMA")
CODES_P = ("MAMO", "MAMODI", "MAMO", "MAMODI", "USPCOB", "MPMFECG", "MICROH", "FPAH", "MICROH",
           "IHMAMA", "IHMAMA", "USMAX", "BRCAS1", "CIMAMA", "P-CH16", "HEMO")
STAGE_TEXTS = (T.CATEGORY_TEXTS, T.BIOPSY_TEXTS, T.PATHOLOGY_TEXTS, T.IHC_TEXTS)

_SLOT = "((l_orderkey + l_linenumber) % 16)"
_HASH = "(l_orderkey * 31 + l_linenumber * 7)"
_PERCENT = "CAST(l_orderkey % 97 + 2 AS STRING)"


def quoted(text: str) -> str:
    return "'" + text + "'"


def pick(dialect: str, items, index: str) -> str:
    """Element ``index mod length`` of a literal list."""
    values = ", ".join(quoted(t) for t in items)
    at = f"CAST({index} % {len(items)} AS INT) + 1"
    if dialect == "spark":
        return f"element_at(array({values}), {at})"
    return f"list_extract([{values}], {at})"


def _filled(dialect: str, items, index: str) -> str:
    return f"replace({pick(dialect, items, index)}, '{{p}}', {_PERCENT})"


def _text(dialect: str) -> str:
    category, biopsy, pathology, ihc = (_filled(dialect, t, _HASH) for t in STAGE_TEXTS)
    return (f"CASE WHEN (l_orderkey * 7 + l_linenumber) % 29 = 0 THEN NULL "
            f"WHEN {_SLOT} < 4 THEN {category} WHEN {_SLOT} < 6 THEN {biopsy} "
            f"WHEN {_SLOT} < 9 THEN {pathology} WHEN {_SLOT} < 13 THEN {ihc} "
            f"ELSE {category} END")


def _wrapped(answer: str) -> str:
    """Plain, fenced, broken, missing and surrounded answers."""
    k = "((l_orderkey * 5 + l_linenumber) % 11)"
    return (f"CASE {k} WHEN 1 THEN '```python' || chr(10) || {answer} || '```' "
            f"WHEN 2 THEN '```json ' || {answer} || ' ```' "
            f"WHEN 3 THEN substring({answer}, 1, 40) WHEN 4 THEN NULL "
            f"WHEN 5 THEN 'Resposta: ' || {answer} || ' fim' ELSE {answer} END")


def _columns(dialect: str, group: str) -> dict[str, str]:
    codes = CODES_F if group == "F" else CODES_P
    return {
        "ficha": "l_orderkey",
        "id_item": "l_linenumber",
        "id_subitem": "1",
        "sequencial": "l_linenumber",
        "id_ficha": "l_orderkey + 7",
        "id_exame": "l_orderkey * 10 + l_linenumber",
        "id_unidade": "l_orderkey % 17",
        "id_marca": "l_orderkey % 5",
        "id_cliente": "o_custkey",
        "pefi_cliente": "o_custkey + 1000000",
        "linha_cuidado": "CASE WHEN l_orderkey % 23 = 0 THEN 'outra' ELSE 'mama' END",
        "sigla_exame": pick(dialect, codes, _SLOT),
        "sexo_cliente": "CASE o_custkey % 10 WHEN 0 THEN 'm' WHEN 1 THEN 'f' ELSE 'F' END",
        "dth_nascimento_cliente": "DATE '1920-01-01' + CAST((o_custkey * 17) % 21000 AS INT)",
        "dth_pedido": "CAST(o_orderdate AS DATE)",
        "dth_resultado": "CAST(shipped AS DATE)",
        "_datestamp": "CAST(o_orderdate AS DATE)",
        "laudo_tratado": _text(dialect),
        "resposta_patologia": _wrapped(_filled(dialect, T.PATHOLOGY_ANSWERS, _HASH)),
        "resposta_imuno": _wrapped(_filled(dialect, T.IHC_ANSWERS, _HASH)),
        "resposta_amostras": _wrapped(_filled(dialect, T.SAMPLE_ANSWERS, _HASH)),
    }


ANSWER_COLUMNS = {"pathology": "resposta_patologia", "ihc": "resposta_imuno",
                  "samples": "resposta_amostras"}


# -- Spark side -------------------------------------------------------------

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def reports(spark: SparkSession, sf: str, group: str = "F", brand: bool = True) -> DataFrame:
    """One row per order line; ``brand`` adds the customer's segment as brand."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("shipped")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    df = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    columns = _columns("spark", group)
    if brand:
        customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
        df = df.join(customers, df.o_custkey == customers.c_custkey)
        columns["marca"] = "c_mktsegment"
    out = df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])
    return out.drop(*ANSWER_COLUMNS.values())


def answers(spark: SparkSession, sf: str, kind: str, group: str = "F",
            keys=("ficha", "id_item", "id_subitem")) -> DataFrame:
    """Model answers by report key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    columns = {**_columns("spark", group), "resposta_llm": _columns("spark", group)[ANSWER_COLUMNS[kind]]}
    return lines.selectExpr(*[f"{columns[c]} AS {c}" for c in (*keys, "resposta_llm")])


def visits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as visits; the exam code rotates over the code list."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ficha", "o_custkey AS id_cliente", "CAST(o_orderdate AS DATE) AS dth_pedido",
        f"{pick('spark', CODES_F, 'o_orderkey')} AS sigla_exame",
    )


def raw_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Return-visit table: the next visit of a patient, with the columns it needs."""
    from careline.operators.joins import derive_returns

    details = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ficha",
        f"{pick('spark', CODES_F, 'o_orderkey')} AS siglas_ficha",
        "o_orderpriority AS unidade", "o_orderstatus AS secao",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS valores_ficha",
    )
    return derive_returns(visits(spark, sf), codes=None).join(details, "ficha").selectExpr(
        "ficha_origem", "id_cliente", "'mama' AS linha_cuidado", "ficha", "dth_pedido",
        "siglas_ficha", "'BRAND' AS marca", "unidade", "'convenio' AS convenio",
        "CAST(valores_ficha - 1 AS DECIMAL(18,2)) AS valores_exame", "valores_ficha",
        "1 AS qtd_exame", "secao", "dias_entre_ficha",
    )


def report_documents(spark: SparkSession, sf: str, items) -> DataFrame:
    """Whole documents with a report sentence after the prose."""
    return table(spark, sf, "documents").selectExpr(
        "doc_id", "lang", f"text || ' ' || {pick('spark', items, 'doc_id')} AS laudo_tratado"
    )


# -- oracle side ------------------------------------------------------------

def _oracle_columns(group: str) -> str:
    columns = _columns("oracle", group)
    columns["marca"] = "c_mktsegment"
    return ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in columns.items())


def _reports_cte(group: str) -> str:
    return (
        "line AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS shipped "
        "FROM lineitem GROUP BY ALL), "
        f"reports AS (SELECT {_oracle_columns(group)} FROM line "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"
    )


_VISITS_CTE = (
    "visits AS (SELECT o_orderkey AS ficha, o_custkey AS id_cliente, "
    f"CAST(o_orderdate AS DATE) AS dth_pedido, {pick('oracle', CODES_F, 'o_orderkey')} AS sigla_exame "
    "FROM orders)"
)


def next_visit_sql(condition: str = "TRUE") -> str:
    """Next later visit by a self-pair: independent of the day-level plan."""
    return (
        "SELECT a.ficha AS ficha_origem, a.id_cliente, "
        "arg_min(b.ficha, {'d': b.dth_pedido, 'k': b.ficha}) AS ficha, "
        "min(b.dth_pedido) AS dth_pedido, "
        "CAST(min(b.dth_pedido) - a.dth_pedido AS INT) AS dias_entre_ficha "
        "FROM visits a JOIN visits b ON a.id_cliente = b.id_cliente AND b.dth_pedido > a.dth_pedido "
        f"WHERE {condition} GROUP BY a.ficha, a.id_cliente, a.dth_pedido"
    )


_RETURNS_CTE = (
    _VISITS_CTE + f", nexts AS ({next_visit_sql()}), "
    "returns AS (SELECT n.ficha_origem, n.id_cliente, 'mama' AS linha_cuidado, n.ficha, n.dth_pedido, "
    f"{pick('oracle', CODES_F, 'o_orderkey')} AS siglas_ficha, 'BRAND' AS marca, "
    "o_orderpriority AS unidade, 'convenio' AS convenio, o_orderstatus AS secao, "
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 1 AS DECIMAL(18,2)) AS valores_exame, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS valores_ficha, 1 AS qtd_exame, n.dias_entre_ficha "
    "FROM nexts n JOIN orders ON n.ficha = o_orderkey)"
)


def oracle(sql: str, group: str = "F") -> str:
    """Put the derived tables a query names in front of it."""
    parts = []
    if "reports" in sql:
        parts.append(_reports_cte(group))
    if "returns" in sql:
        parts.append(_RETURNS_CTE)
    elif "visits" in sql:
        parts.append(_VISITS_CTE)
    if not parts:
        return sql
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + sql[5:]
    return "WITH " + ", ".join(parts) + " " + sql


def oracle_documents(items) -> str:
    return (f"(SELECT doc_id, lang, text || ' ' || {pick('oracle', items, 'doc_id')} AS laudo_tratado "
            "FROM documents)")
