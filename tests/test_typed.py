"""Answers compared with their JSON types, pinned by hand."""

import pytest

from careline import fixed_values as V
from careline.operators.typed import answer_type_profile, compare_typed, with_variant

NI = V.NOT_STATED


def flags(spark, cases, kind, field="grau_histologico"):
    rows = [(i, a, g) for i, (a, g) in enumerate(cases)]
    df = compare_typed(with_variant(spark.createDataFrame(rows, f"i int, resposta_llm string, heu_{field} {kind}")), [field])
    return [r[0] for r in df.orderBy("i").select(f"acertou_{field}").collect()]


@pytest.mark.parametrize("value, gold, hit", [
    ("2", 2, True), ("2.0", 2, True), ('"2"', 2, False), ("null", 2, False), ("3", 2, False), ("true", 1, True), ("true", 2, False), ("[2]", 2, False),
    ("2", None, False), (f'"{NI}"', None, True), ("null", None, False), ('"outro"', None, False)])
def test_numbers(spark, value, gold, hit):
    assert flags(spark, [(f'{{"grau_histologico": {value}}}', gold)], "int") == [hit]


def test_missing_unreadable_and_null_answers(spark):
    cases = [("{}", None), ("{}", 2), ("no json", None), (None, None), (None, 1), ('```json {"grau_histologico": 2} ```', 2)]
    assert flags(spark, cases, "int") == [True, False, True, True, False, True]


def test_texts(spark):
    cases = [('{"f": "a"}', "a"), ('{"f": "A"}', "a"), ('{"f": 1}', "1"), ('{"f": null}', None), ("{}", None), ('{"f": null}', NI), (f'{{"f": "{NI}"}}', None)]
    assert flags(spark, cases, "string", "f") == [True, False, False, False, True, False, True]


def test_lists_are_sets_of_texts(spark):
    cases = [('{"f": ["b", "a", "b"]}', ["a", "b"]), ('{"f": ["a"]}', ["a", "b"]), ("{}", []), ("{}", ["a"]), ('{"f": null}', []), ('{"f": []}', None),
             ('{"f": [1]}', ["1"]), ('{"f": "a"}', ["a"]), ('{"f": [null]}', []), ('{"f": ["a", null]}', ["a"])]
    assert flags(spark, cases, "array<string>", "f") == [True, False, True, False, False, True, False, False, False, False]


def test_kinds(spark):
    texts = ['{"f": "x"}', '{"f": 1}', '{"f": 1.5}', '{"f": 1e3}', '{"f": true}', '{"f": []}', '{"f": {}}', '{"f": null}', "{}", "x", None]
    df = with_variant(spark.createDataFrame([(t,) for t in texts], "resposta_llm string"))
    got = {r.tipo: r.n for r in answer_type_profile(df, ["f"]).collect()}
    assert got == {"texto": 1, "inteiro": 1, "decimal": 2, "booleano": 1, "lista": 1, "objeto": 1, "nulo": 1, "ausente": 1, "ilegivel": 2}


def test_each_field_is_taken_from_the_answer_once(spark):
    fields = {"f": "array<string>", "g": "int", "h": "string"}
    rows = [('{"f": ["a"], "g": 1, "h": "x"}', ["a"], 1, "x"), ("Resposta: {}", [], 2, None), ("nada", [], None, NI), (" {}", None, None, None)]
    df = spark.createDataFrame(rows, "resposta_llm string, " + ", ".join(f"heu_{f} {kind}" for f, kind in fields.items())).repartition(2)
    df = compare_typed(with_variant(df), list(fields))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("schema_of_variant(") <= len(fields) + 1  # and of a list's items
    assert df.columns == ["heu_f", "heu_g", "heu_h", "_variante", "acertou_f", "acertou_g", "acertou_h"]
    got = sorted((r.heu_g or 0, r.acertou_f, r.acertou_g, r.acertou_h) for r in df.collect())
    assert got == [(0, True, True, True), (0, True, True, True), (1, True, True, True), (2, True, False, True)]
