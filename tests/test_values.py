"""The rules' results by hand, without the values they are built from: a changed value turns red."""

import pytest

from careline.functions import category as C
from careline.functions import markers as M
from careline.functions import pathology as P

POS, NEG, INC, NONE = "POSITIVO", "NEGATIVO", "INCONCLUSIVO", "NÃO INFORMADO"


@pytest.mark.parametrize(("fn", "text", "want"), [
    (lambda c: M.er_status(c, 1), "Receptor de estrogegenio: positivo", POS),
    (lambda c: M.er_status(c, 1), "receptor de estrogêgenio - negativo", NEG),
    (lambda c: M.er_status(c, 1), "receptor de estrogênio - negativo", NONE),
    (lambda c: M.er_status(c, 1), "receptor de estrógeno: positivo", NONE),
    (lambda c: M.er_status(c, 2), "receptor de estrógeno: positivo", POS),
    (lambda c: M.er_status(c, 2), "receptor de estrogeno negativo", NEG),
    (lambda c: M.er_status(c, 2), "ER+x", POS),
    (lambda c: M.er_status(c, 2), "er -x", NEG),
    (lambda c: M.pr_status(c, 1), "receptor de progesterona: positivo", POS),
    (lambda c: M.pr_status(c, 1), "receptor de progesterona* fraco positivo", NONE),
    (lambda c: M.pr_status(c, 2), "receptor de progesterona* fraco positivo", POS),
    (lambda c: M.pr_status(c, 2), "receptor de progesterona " + "x" * 43 + " positivo", POS),
    (lambda c: M.pr_status(c, 2), "receptor de progesterona " + "x" * 44 + " positivo", NONE),
    (lambda c: M.pr_status(c, 2), "receptor de progesterona negativo, controle positivo", POS),
    (lambda c: M.pr_status(c, 3), "receptor de progesterona negativo, controle positivo", NEG),
    (lambda c: M.pr_status(c, 3), "receptor de progesterona - positivo (antes negativo)", POS),
    (lambda c: M.pr_status(c, 3), "PR+x", POS),
    (lambda c: M.her2_status(c, 1), "HER-2 com escore: 0", NEG),
    (lambda c: M.her2_status(c, 1), "HER2 escore 1+", NEG),
    (lambda c: M.her2_status(c, 1), "her 2, escore - 2+", INC),
    (lambda c: M.her2_status(c, 1), "her2 score 3+", NONE),
    (lambda c: M.her2_status(c, 2), "her2 score 3+", POS),
    (lambda c: M.her2_status(c, 2), "HER-2: negativo", NEG),
    (lambda c: M.her2_status(c, 2), "her2 3+x", POS),
    (lambda c: M.her2_status(c, 3), "her2 em células, positivo", POS),
    (lambda c: M.her2_status(c, 3), "her2 " + "x" * 60 + " positivo", NONE),
    (lambda c: M.ck56_status(c, 1), "CK5/6 em células: negativo", NEG),
    (lambda c: M.ck56_status(c, 1), "ck5/6 negativo e positivo", POS),
    (lambda c: M.ck56_status(c, 2), "ck5/6 negativo e positivo", NEG),
    (lambda c: M.ck56_status(c, 2), "ck5 / 6+x", POS),
    (lambda c: M.ki67(c, 1), "Ki-67 em 12.5% das células", 12.5),
    (lambda c: M.ki67(c, 1), "Ki-67 em 12,5%", 5.0),
    (lambda c: M.ki67(c, 2), "Ki-67 em 12,5%", 12.5),
    (lambda c: M.ki67(c, 2), "ki67 " + "x" * 100 + " 30%", 0.0),
    (lambda c: M.ki67(c, 1), "ki67 " + "x" * 100 + " 30%", 30.0),
    (P.histologic_grade, "Grau histológico: 3", 3),
    (P.histologic_grade, "grau histologico 2", 2),
    (P.nuclear_grade, "GRAU NUCLEAR - 1", 1),
    (P.tubule_score, "formacao de túbulos: 2", 2),
    (P.mitotic_index, "Índice mitótico: 11 mitoses / mm2", 11),
    (lambda c: P.mitotic_index(c, 1), "Índice mitótico: 11 mitoses / mm2", None),
    (lambda c: P.mitotic_index(c, 1), "mitotico 3/10 mm2", 3),
    (P.mitotic_index, "mitotico 4 / 10 mm2", 4),
    (P.histologic_type, "Carcinoma de mama lobular invasivo", "carcinoma de mama lobular invasivo"),
    (P.histologic_type, "carcinoma de mama metaplásico", None),
    (lambda c: P.histologic_type(c, fixed=True), "carcinoma de mama metaplasico", "carcinoma de mama metaplásico"),
    (P.malignancy_terms, "CDI invasor, metástase maligna; carcinomatose", ["cdi", "invasor", "maligna", "metástase"]),
    (lambda c: M.marker_count(c, "estrogenio"), "receptor de estrógeno, receptor de estrogênio, er", 2),
    (lambda c: M.marker_count(c, "ki67"), "ki67 KI-67 ki 67 ki667", 3),
    (C.category, "nada\nBI-RADS 2", None),
    (C.category, "BI-RADS 4A", 4),
    (C.category, "Conclusão: categoria II", 2),
    (C.category, "CAT. VI", 6),
    (C.category, "BI-RADS 7", None),
    (C.category, "Categoria 10A", 10),
    (lambda c: C.category(c, "all"), "nada\nBI-RADS 2", 2),
    (lambda c: C.category(c, "documented"), "nada\nBI-RADS categoria 5", 5),
    (P.has_carcinoma, "Topografia: MAMA, carcinoma", True),
    (P.has_carcinoma, "carcinoma. Topografia: MAMA", False),
])
def test_by_hand(apply, fn, text, want):
    assert apply(fn, [text]) == [want]


def test_number_texts(apply):
    from careline.functions.answers import float_or_zero, number_or_zero

    texts = ["14", " 2.5 ", "1e2", ".5", "14d", "14f", "0x1p3", "x", "", None, "inf"]
    assert apply(number_or_zero, texts) == [14.0, 2.5, 100.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float("inf")]
    assert apply(float_or_zero, ["14d", "3"]) == [14.0, 3.0]
