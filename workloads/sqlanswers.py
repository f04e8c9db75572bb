"""Oracle spellings of answer parsing and comparison."""

from careline import fixed_values as V
from workloads import sqltext as S

NI = f"'{V.NOT_STATED}'"


def clean(col, languages=("python", "json")):
    marks = "|".join([f"```{x}" for x in languages] + ["```"])
    return f"trim(regexp_replace({col}, '{marks}', '', 'g'))"


def json_of(col, pick=False, languages=("python", "json")):
    text = clean(col, languages)
    if pick:
        text = rf"regexp_extract({text}, '(\{{[^}}]+\}})', 1)"
    return f"TRY_CAST({text} AS JSON)"


def field(name, j="j"):
    return f"json_extract_string({j}, '$.{name}')"


def string_list(name, j="j"):
    return f"CAST(json_extract({j}, '$.{name}') AS VARCHAR[])"


def whole(x):
    return f"CASE WHEN lower({x}) IN ('não informado', 'nao informado') THEN NULL ELSE TRY_CAST({x} AS INT) END"


def parsed(kind, pick=False):
    col = {"pathology": "resposta_patologia", "ihc": "resposta_imuno", "samples": "resposta_amostras"}[kind]
    return f"(SELECT *, {json_of(col, pick)} AS j FROM reports)"


def pathology_compared(rule, where="TRUE", text=S.T, mitotic=2, keep="ficha, id_item"):
    """Model and pattern labels side by side, with a flag per field."""
    first, *numbers, kind = V.PATHOLOGY_FIELDS
    text_form = rule in ("strict", "sentinel")
    gold = S.pathology(text, mitotic)
    cells = [f"coalesce({string_list(first)}, []) AS {first}", f"{gold[first]} AS heu_{first}"]
    for n in (*numbers, kind):
        model, heu = field(n), gold[n]
        if text_form:
            model, heu = f"coalesce({model}, {NI})", f"coalesce(CAST({heu} AS VARCHAR), {NI})"
        elif n != kind:
            model = whole(model)
        elif rule == "null_miss":
            model = f"coalesce({model}, {NI})"
        cells += [f"{model} AS {n}", f"{heu} AS heu_{n}"]
    flags = []
    if rule == "strict":
        flags.append(f"list_sort(list_distinct({first})) = list_sort(list_distinct(heu_{first})) AS acertou_{first}")
    else:
        flags.append(f"list_sort({first}) = list_sort(heu_{first}) AS acertou_{first}")
    for n in (*numbers, kind):
        m, h = n, f"heu_{n}"
        if rule == "null_hit" and n != kind:
            test = f"({m} = {h}) OR ({m} IS NULL AND {h} IS NULL)"
        elif rule == "null_miss":
            miss = f"{m} IS NULL OR {h} IS NULL" + (f" OR {m} = {NI}" if n == kind else "")
            test = f"CASE WHEN {miss} THEN false ELSE {m} = {h} END"
        else:
            test = f"{m} = {h}"
        flags.append(f"{test} AS acertou_{n}")
    return (f"(SELECT *, {', '.join(flags)} FROM (SELECT {keep}, {', '.join(cells)} "
            f"FROM {parsed('pathology', rule == 'sentinel')} WHERE {where}))")


def ihc_compared(where="TRUE", version=2, source=None):
    gold = S.ihc(v=version)
    source = source or parsed("ihc")
    cells, flags = [], []
    for n in V.IHC_FIELDS:
        cells += [f"{field(n)} AS {n}", f"{gold[n]} AS heu_{n}"]
        flags.append(
            f"coalesce(TRY_CAST({n} AS DOUBLE), 0.0) = heu_{n} AS acertou_{n}" if n == "ki67_percentual"
            else f"coalesce({n}, {NI}) = heu_{n} AS acertou_{n}")
    return (f"(SELECT *, {', '.join(flags)} FROM (SELECT *, {', '.join(cells)} "
            f"FROM {source} WHERE {where}))")


def accuracy(table, fields, mean=False):
    """Hits, total and rate, one row per field."""
    rows = []
    for f in fields:
        base = f"count(acertou_{f})" if mean else "count(*)"
        rows.append(
            f"SELECT '{f}' AS campo, coalesce(CAST(sum(CAST(acertou_{f} AS INT)) AS BIGINT), 0) AS acertos, "
            f"count(*) AS total, CASE WHEN {base} > 0 THEN "
            f"coalesce(CAST(sum(CAST(acertou_{f} AS INT)) AS DOUBLE), 0) / {base} ELSE 0.0 END AS taxa_acerto FROM c")
    return f"WITH c AS (SELECT * FROM {table}) " + " UNION ALL ".join(rows)


SUBTYPE = """CASE
    WHEN (er = 'POSITIVO' OR pr = 'POSITIVO') AND her2 = 'NEGATIVO' AND ki < 14 THEN 'Luminal A'
    WHEN (er = 'POSITIVO' OR pr = 'POSITIVO') AND her2 = 'NEGATIVO' AND ki >= 14 THEN 'Luminal B'
    WHEN (er = 'POSITIVO' OR pr = 'POSITIVO') AND her2 = 'POSITIVO' THEN 'Luminal com HER2 Positivo'
    WHEN er = 'NEGATIVO' AND pr = 'NEGATIVO' AND her2 = 'POSITIVO' THEN 'HER-2 Superexpresso'
    WHEN er = 'NEGATIVO' AND pr = 'NEGATIVO' AND her2 = 'NEGATIVO' THEN 'Triplo Negativo'
    ELSE 'Indefinido' END"""


def subtypes(source, j="j"):
    """Markers, Ki-67 number and subtype of parsed answers."""
    return (f"SELECT *, {SUBTYPE} AS categoria_final FROM (SELECT *, {field('receptor_estrogeno', j)} AS er, "
            f"{field('receptor_progesterona', j)} AS pr, {field('status_her2', j)} AS her2, "
            f"coalesce(TRY_CAST({field('ki67_percentual', j)} AS DOUBLE), 0.0) AS ki FROM {source})")


# Answers in which every third report has numbers in place of their texts.
NUMBERED = r"CASE WHEN ficha % 3 = 0 THEN regexp_replace({c}, '\"([0-9])\"', '{one}'{all}) ELSE {c} END"


def json_kind(name, j="j"):
    """What a field of an answer holds."""
    t = f"json_type({j}, '$.{name}')"
    return (f"CASE WHEN {j} IS NULL THEN 'ilegivel' WHEN {t} IS NULL THEN 'ausente' WHEN {t} = 'NULL' THEN 'nulo' WHEN {t} = 'VARCHAR' THEN 'texto' "
            f"WHEN {t} IN ('BIGINT', 'UBIGINT') THEN 'inteiro' WHEN {t} = 'DOUBLE' THEN 'decimal' WHEN {t} = 'BOOLEAN' THEN 'booleano' "
            f"WHEN {t} = 'ARRAY' THEN 'lista' ELSE 'objeto' END")


def numbered():
    text = NUMBERED.format(c="resposta_patologia", one="\\1", all=", 'g'")
    return f"(SELECT *, TRY_CAST({clean('resposta')} AS JSON) AS j FROM (SELECT *, {text} AS resposta FROM reports))"


def typed_compared():
    """Flags of answers compared with their types."""
    first, *numbers, last = V.PATHOLOGY_FIELDS
    gold = S.pathology()
    flags = [f"CASE WHEN t = 'lista' THEN NOT list_contains(list_transform(CAST(json_extract(j, '$.{first}') AS JSON[]), lambda x: json_type(x)), 'BIGINT') "
             f"AND list_sort(list_distinct({string_list(first)})) = g WHEN t IN ('ausente', 'ilegivel') THEN len(g) = 0 ELSE false END AS acertou_{first}"]
    for n in (*numbers, last):
        kind, value = json_kind(n), field(n)
        missing = f"{kind} IN ('ausente', 'ilegivel')"
        if n == last:
            flags.append(f"CASE WHEN {missing} THEN heu_{n} IS NULL OR heu_{n} = {NI} WHEN {kind} = 'texto' THEN {value} = coalesce(heu_{n}, {NI}) ELSE false END AS acertou_{n}")
        else:
            flags.append(f"CASE WHEN heu_{n} IS NULL THEN {missing} OR ({kind} = 'texto' AND {value} = {NI}) "
                         f"ELSE {kind} IN ('inteiro', 'decimal') AND TRY_CAST({value} AS DOUBLE) = heu_{n} END AS acertou_{n}")
    cells = ", ".join(f"{gold[n]} AS heu_{n}" for n in (*numbers, last))
    return (f"(SELECT ficha, id_item, {', '.join(flags)} FROM (SELECT *, {json_kind(first)} AS t, {gold[first]} AS g, {cells} FROM {numbered()}))")
