import pytest

from careline import fixed_values as V
from careline.operators import evaluate as E

NI = V.NOT_STATED


def flags(spark, rows, kind, rule, **kw):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], f"i int, x {kind}, heu_x {kind}")
    return [r.acertou_x for r in E.compare(df, ["x"], rule, **kw).orderBy("i").collect()]


PAIRS = [(1, 1), (1, 2), (None, None), (None, 2), (1, None)]


def test_number_rules(spark):
    assert flags(spark, PAIRS, "int", "strict") == [True, False, True, False, False]
    assert flags(spark, PAIRS, "int", "null_hit") == [True, False, True, None, None]
    assert flags(spark, PAIRS, "int", "null_miss") == [True, False, False, False, False]


def test_text_rules(spark):
    pairs = [("a", "a"), (NI, NI), (None, None), (None, NI), ("a", None), (NI, None)]
    assert flags(spark, pairs, "string", "strict") == [True, True, True, True, False, True]
    assert flags(spark, pairs, "string", "null_hit") == [True, True, None, None, None, None]
    assert flags(spark, pairs, "string", "null_miss") == [True, False, False, False, False, False]
    assert flags(spark, pairs, "string", "sentinel") == [True, True, None, None, None, None]


def test_list_rules(spark):
    pairs = [(["b", "a"], ["a", "b"]), (["a", "a"], ["a"]), (None, []), (["a"], None)]
    assert flags(spark, pairs, "array<string>", "strict") == [True, True, True, False]
    for rule in ("null_hit", "null_miss", "sentinel"):
        assert flags(spark, pairs, "array<string>", rule) == [True, False, True, False]


def test_different_types_never_match(spark):
    df = spark.createDataFrame([("2", 2)], "x string, heu_x int")
    assert E.compare(df, ["x"], "strict").first().acertou_x is False


def test_numeric_fields(spark):
    pairs = [("20", "20.0"), (NI, "0"), ("20-30", None), ("5", "6")]
    assert flags(spark, pairs, "string", "strict", numeric=("x",)) == [True, True, True, False]
    df = spark.createDataFrame([("20", 20.0), (None, 0.0)], "x string, heu_x double")
    assert [r.acertou_x for r in E.compare(df, ["x"], numeric=("x",)).collect()] == [True, True]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        flags(spark, PAIRS, "int", "other")


def test_rates_and_verdict(spark):
    rows = [(True, True), (True, False), (None, False), (True, False), (True, False)]
    df = spark.createDataFrame(rows, "acertou_a boolean, acertou_b boolean")
    share = {r.campo: (r.acertos, r.total, r.taxa_acerto) for r in E.accuracy(df).collect()}
    assert share == {"a": (4, 5, 0.8), "b": (1, 5, 0.2)}
    mean = {r.campo: r.taxa_acerto for r in E.accuracy(df, rate="mean").collect()}
    assert mean == {"a": 1.0, "b": 0.2}
    assert {r.campo: r.passou_threshold for r in E.verdict(E.accuracy(df)).collect()} == {"a": 1, "b": 0}
    assert all(r.acertos <= r.total for r in E.accuracy(df).collect())
    empty = E.accuracy(df.filter("FALSE")).collect()
    assert {(r.acertos, r.total, r.taxa_acerto) for r in empty} == {(0, 0, 0.0)}


def test_error_summary_has_a_total(spark):
    df = spark.createDataFrame([(True, False), (False, False), (None, True), (True, True)],
                               "acertou_a boolean, acertou_b boolean")
    got = {r.campo: (r.erros, r.percentual) for r in E.error_summary(df).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0), "Total": (3, 75.0)}
    assert {r.percentual for r in E.error_summary(df.filter("FALSE")).collect()} == {0.0}


def test_any_error_counts_missing(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, True)], "acertou_a boolean, acertou_b boolean")
    assert [r.erro for r in E.any_error(df).collect()] == [False, True, True]
    assert [r.erro for r in E.any_error(df, ["a", "c"]).collect()] == [True, True, True]


def test_describe(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    row = E.describe(df, ["v"]).first()
    assert (row.coluna, row.n, row.media, row.minimo, row.maximo) == ("v", 2, 2.0, 1.0, 3.0)
    assert row.desvio == pytest.approx(2 ** 0.5)


def test_inconsistency_classes(spark):
    texts = ["HER2 a. HER2 b.", "Receptor de progesterona - negativo (controle positivo)", "CK5/6 perda",
             "KI67 em 20-30%", None]
    df = spark.createDataFrame([(t,) for t in texts], "laudo_tratado string")
    got = {r.classe: r.laudos for r in E.inconsistency_profile(df).collect()}
    assert got == {"varios_estrogenio": 0, "varios_progesterona": 0, "varios_her2": 1, "varios_ck5_6": 0,
                   "varios_ki67": 0, "ambos_estrogenio": 0, "ambos_progesterona": 1, "sem_status_estrogenio": 0,
                   "sem_status_progesterona": 0, "sem_status_ck5_6": 1, "faixa_ki67": 1}
