from careline.functions import category as C


def test_tokens_and_categories(apply):
    texts = [
        "Conclusão: BI-RADS®: 0.", "CONCLUSAO: birads 1", "Impressão: categoria II.", "BI-RADS 3",
        "Avaliação: BI-RADS 4A.", "BI-RADS 2. Observação. BI-RADS 3.", "Categoria IV e BI-RADS 5.",
        "Categoria 10A", "Categoria 10", "CAT. VI", "Sem achados.", "", None,
    ]
    assert apply(C.category_list, texts) == [
        [0], [1], [2], [3], [4], [2, 3], [4, 5], [10], [], [6], [], [], None,
    ]


def test_trailing_keyword_swallows_next_mention(apply):
    assert apply(C.category_list, ["BI-RADS 4A. Categoria IV"]) == [[4]]


def test_only_first_line_is_read(apply):
    text = ["linha um\nBI-RADS 2"]
    assert apply(C.category, text) == [None]
    assert apply(lambda c: C.category(c, "all"), text) == [2]


def test_no_break_space_is_removed(apply):
    assert apply(C.clean_category_text, ["bi-rads: ®3"]) == ["BIRADS3"]


def test_header_is_dropped_at_the_start_only(apply):
    pick = lambda c: C.pick_section(C.clean_category_text(c))
    assert apply(pick, ["Conclusão: x\ny", "abc conclusão: x"]) == [" X", "ABC CONCLUSÃO X"]


def test_group_p_keywords(apply):
    texts = ["categorio 3", "categora II", "categoria r 2"]
    assert apply(lambda c: C.category(c, group="P"), texts) == [3, 2, 2]
    assert apply(C.category, texts) == [None, None, None]


def test_last_category_is_kept(apply):
    fns = (C.category_min, C.category_max, C.category_last)
    for fn, want in zip(fns, (2, 5, 3)):
        assert apply(lambda c, f=fn: f(C.category_list(c)), ["BI-RADS 5. Nota. BI-RADS 2. Nota. BI-RADS 3"]) == [want]


def test_huge_number_is_no_category(apply):
    assert apply(C.category_list, ["BI-RADS 99999999999"]) == [[]]


def test_documented_rule_window(apply):
    rule = lambda c: C.category(c, "documented")
    texts = [
        "BI-RADS 1. Novo BI-RADS: 4", "cat 3 BI-RADS", "BI-RADS" + " " * 14 + "2",
        "BI-RADS" + " " * 15 + "2", "5" + "     " + "BI-RADS", "sem", None,
    ]
    assert apply(rule, texts) == [4, 3, 2, None, None, None, None]
