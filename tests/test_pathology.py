import random
import re
import time

import pytest

from careline import fixed_values as V
from careline.functions import pathology as P


def test_carcinoma_branches(apply):
    texts = [
        "Topografia: MAMA, Carcinoma.", "CARCINOMA. Topografia: MAMA", "Topografia: MAMA\nCARCINOMA",
        "Topografia: pele, CARCINOMA", "", None,
        "CARCINOMA. Topografia: MAMA\nTopografia: MAMA CARCINOMA",
    ]
    assert apply(P.raw_carcinoma, texts) == ["Carcinoma", "", "", "", "", None, ""]
    assert apply(P.has_carcinoma, texts) == [True, False, False, False, False, True, False]
    either = lambda c: P.has_carcinoma(c, either_order=True)
    assert apply(either, texts) == [True, True, False, False, False, True, True]


def test_carcinoma_equals_unrewritten_pattern(apply):
    """The linear pattern returns what the greedy one returns."""
    rng = random.Random(7)
    parts = ["Topografia:", "MAMA", "mama", "CARCINOMA", "carcinoma", " x ", "\n", ". ", "topografia: "]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    greedy = re.compile(r"(?mi).*Topografia:.*MAMA.*(CARCINOMA).*|.*(CARCINOMA).*Topografia:.*MAMA.*")

    def expected(t):
        m = greedy.search(t)
        return (m and m.group(1)) or ""

    assert apply(P.raw_carcinoma, texts) == [expected(t) for t in texts]


def test_long_line_is_searched_in_linear_time(apply):
    text = "Topografia: sem nada " * 20000
    start = time.time()
    assert apply(P.raw_carcinoma, [text]) == [""]
    assert apply(P.carcinoma_phrase, [text]) == [""]
    assert time.time() - start < 20


def test_phrase_is_the_sentence(apply):
    texts = ["Nota. Visto carcinoma in situ. Fim.", "Carcinoma", "nada."]
    assert apply(P.carcinoma_phrase, texts) == ["Visto carcinoma in situ", "Carcinoma", ""]


def test_terms_are_whole_unicode_words(apply):
    texts = [
        "CARCINOMA Invasivo, CDIS.", "carcinomatose cdia", "METÁSTASE e metastático", "ácdi cdiç",
        "carcinoma maligno", "cdi_x", "", None,
    ]
    assert apply(P.malignancy_terms, texts) == [
        ["carcinoma", "cdis", "invasivo"], [], ["metastático", "metástase"], [],
        ["carcinoma", "maligno"], [], [], [],
    ]


def test_each_term(apply):
    assert apply(P.malignancy_terms, [f"x {t.upper()} y" for t in V.MALIGNANCY_TERMS]) == [
        [t] for t in V.MALIGNANCY_TERMS]


def test_terms_of_several_words(apply):
    terms = ("grau alto", "alto")
    assert apply(lambda c: P.malignancy_terms(c, terms), ["Grau alto", "tao alto", "grau"]) == [
        ["alto", "grau alto"], ["alto"], []]


def test_grades(apply):
    texts = ["Grau Histológico: 2", "GRAU HISTOLÓGICO - 3", "grau histologico1", "grau histológico",
             "grau histológico\n2", None]
    assert apply(P.histologic_grade, texts) == [2, 3, 1, None, 2, None]
    assert apply(P.nuclear_grade, ["Grau nuclear:1", "grau nuclear x"]) == [1, None]
    assert apply(P.tubule_score, ["FORMAÇÃO DE TÚBULOS: 3", "formacao de tubulos 2", ""]) == [3, 2, None]


def test_mitotic_index_versions(apply):
    texts = ["Índice mitótico: 3/10 mm2", "mitótico: 2 mm2", "MITÓTICO: 11 mitoses / mm2",
             "mitotico 1 mitose/mm2", "mitótico 5"]
    assert apply(lambda c: P.mitotic_index(c, 1), texts) == [3, 2, None, None, None]
    assert apply(P.mitotic_index, texts) == [3, 2, 11, 1, None]


def test_histologic_type_order_and_literal_classes(apply):
    texts = [t.upper() for t in V.HISTOLOGIC_TYPES if "[" not in t]
    assert apply(P.histologic_type, texts) == [t for t in V.HISTOLOGIC_TYPES if "[" not in t]
    odd = ["Carcinoma de mama metaplásico", "carcinoma de mama cistico adenoide"]
    assert apply(P.histologic_type, odd) == [None, None]
    assert apply(lambda c: P.histologic_type(c, fixed=True), odd) == list(V.HISTOLOGIC_TYPES_PLAIN.values())
    both = ["carcinoma de mama lobular e carcinoma de mama ductal invasivo"]
    assert apply(P.histologic_type, both) == ["carcinoma de mama ductal invasivo"]


@pytest.mark.parametrize("name", ["grau histológico", "grau nuclear", "formação de túbulos", "mitótico", "índice mitótico 3", "mitotico: 3 /"])
def test_padding_costs_linear_time(apply, name):
    texts = [name + pad * 100_000 + end for pad in (" ", "\n", "1", "1 ", " -", "/ ") for end in ("x", " 2", " mm2")]
    start = time.time()
    for fn in (P.histologic_grade, P.nuclear_grade, P.tubule_score, P.mitotic_index, lambda c: P.mitotic_index(c, 1)):
        assert len(apply(fn, texts)) == len(texts)
    assert time.time() - start < 60


PATTERNS = [V.HISTOLOGIC_GRADE, V.NUCLEAR_GRADE, V.TUBULE_SCORE, *V.MITOTIC_INDEX.values()]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_possessive_form_finds_the_same(pattern):
    rng = random.Random(9)
    parts = ["mitótico", "mitotico", "grau  histológico", "grau nuclear", "formação de túbulos", " ", "  ", "\n", ":", "-", "1", "23", "/", " / ",
             "mitose", "mitoses", "mm2", " mm2", "x"]
    plain, quick = re.compile(pattern), re.compile(P.possessive(pattern))
    for _ in range(40_000):
        t = "".join(rng.choices(parts, k=rng.randint(2, 9)))
        a, b = plain.search(t), quick.search(t)
        assert (a and a.groups()) == (b and b.groups()), t
