from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions import answers as A
from careline.operators import answers as O


def test_prompts_keep_special_characters(apply):
    texts = ["custa $1 \\n 5%", "x"]
    assert apply(lambda c: A.render("100%% [%s]", c), texts) == [f"100% [{t}]" for t in texts]
    assert apply(lambda c: A.render_concat("a ", c, " b"), texts) == [f"a {t} b" for t in texts]
    assert apply(lambda c: A.render_replace("a {laudo_texto} b", c), texts) == [f"a {t} b" for t in texts]


def test_fences(apply):
    texts = ["```python{}```", "```json {} ```", "``` {} ```", "{}", None]
    assert apply(A.strip_fences, texts) == ["{}", "{}", "{}", "{}", None]
    only = lambda c: A.strip_fences(c, ("python",))
    assert apply(only, ["```json{}```"]) == ["json{}"]


def test_first_object(apply):
    assert apply(A.first_object, ['a {"x": 1} {"y": 2}', "nada", "{}"]) == ['{"x": 1}', "", ""]


def test_literals(apply):
    texts = ["{'a': None, 'b': 'x None, y', 'c': True}", "{'a': 'q'}", "erro", "{\"a\": 'False', 'c': False}", None]
    rows = apply(lambda c: A.parse_literal(c, "a string, b string, c boolean"), texts)
    assert [tuple(r) if r else r for r in rows] == [
        (None, "x None, y", True), ("q", None, None), (None, None, None), ("False", None, False), None]


def test_literal_of_many_strings(apply):
    text = "{" + ", ".join(f"'k{i}': 'v\\'x{i} None'" for i in range(20000)) + ", 'a': None, 'b': 'z'}"
    assert tuple(apply(lambda c: A.parse_literal(c, "a string, b string, k7 string"), [text])[0]) == (
        None, "z", "v'x7 None")


def test_int_or_null(apply):
    texts = ["2", " 3 ", "2.9", "NÃO INFORMADO", "nao informado", "dois", "", "-1", None, "99999999999"]
    assert apply(A.int_or_null, texts) == [2, 3, 2, None, None, None, None, -1, None, None]


def test_float_or_zero(apply):
    texts = ["13.9", "14", "20-30", V.NOT_STATED, "", None, " 7 ", "1e2"]
    assert apply(A.float_or_zero, texts) == [13.9, 14.0, 0.0, 0.0, 0.0, 0.0, 7.0, 100.0]


def test_sorted_set_and_preview(apply):
    assert apply(A.sorted_set, [["b", "a"], None], "array<string>") == [["a", "b"], []]
    assert apply(lambda c: A.preview(c, 3), ["abcdef", "ab", None]) == ["abc", "ab", None]


def test_parse_answers_keeps_broken_rows(spark):
    rows = [(1, '```python\n{"status_her2": "POSITIVO", "ki67_percentual": 20}\n```'), (2, "{quebrado"), (3, None)]
    df = O.parse_answers(spark.createDataFrame(rows, "k int, resposta_llm string"), O.IHC_SCHEMA)
    got = {r.k: (r.status_her2, r.ki67_percentual) for r in df.collect()}
    assert got == {1: ("POSITIVO", "20"), 2: (None, None), 3: (None, None)}
    filled = O.fill_sentinel(df, V.IHC_FIELDS).filter("k = 2").first()
    assert filled.status_her2 == V.NOT_STATED


def test_samples(spark):
    rows = [(1, '{"amostras": [{"amostra_id": "A"}, {"amostra_id": "B"}]}'), (2, '{"amostras": []}'), (3, "erro")]
    df = O.explode_samples(spark.createDataFrame(rows, "k int, resposta_llm string"))
    assert sorted((r.k, r.amostra_id or "") for r in df.collect()) == [(1, "A"), (1, "B"), (2, ""), (3, "")]


def test_subtypes(spark):
    P, N, I = V.POSITIVE, V.NEGATIVE, V.INCONCLUSIVE
    rows = [(P, N, N, 13.9, "Luminal A"), (N, P, N, 14.0, "Luminal B"), (P, P, P, 0.0, "Luminal com HER2 Positivo"),
            (N, N, P, 50.0, "HER-2 Superexpresso"), (N, N, N, 0.0, "Triplo Negativo"), (P, P, I, 5.0, "Indefinido"),
            (None, N, N, 5.0, "Indefinido"), (P, None, N, 5.0, "Luminal A"), (P, P, N, None, "Indefinido"),
            (None, P, P, 1.0, "Luminal com HER2 Positivo"), (V.NOT_STATED, N, N, 1.0, "Indefinido")]
    df = spark.createDataFrame(rows, "receptor_estrogeno string, receptor_progesterona string, status_her2 string, "
                                     "ki67_float double, esperado string")
    assert O.with_subtype(df).filter(~F.col("categoria_final").eqNullSafe(F.col("esperado"))).count() == 0


def test_first_object_equals_the_plain_pattern_in_linear_time(apply):
    import random
    import re
    import time

    random.seed(3)
    texts = ["".join(random.choices("{}ab\n", k=random.randint(0, 12))) for _ in range(500)]
    plain = [(m.group(1) if (m := re.search(r"(\{[^}]+\})", t)) else "") for t in texts]
    assert apply(A.first_object, texts) == plain
    start = time.perf_counter()
    assert apply(A.first_object, ["{" * 200_000, "{}" * 100_000]) == ["", ""]
    assert time.perf_counter() - start < 5
