import pytest
from pyspark.sql import functions as F

from careline import sources
from careline.operators import cohort
from careline.session import scratch_path, shared_dir
from tests.conftest import SF


def test_report_scan_by_path_name_and_frame(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    name = sources.register_view(df, "docs_vistos")
    assert sources.exists(spark, name) and not sources.exists(spark, "docs_ausentes")
    for source in (f"{SF}/documents.parquet", name, df):
        assert sources.read_reports(spark, source, ["doc_id", "lang"]).columns == ["doc_id", "lang"]
    assert sources.all_but(df, "text").columns == [c for c in df.columns if c != "text"]


def test_scratch_paths_are_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark)) and shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_unknown_exam_codes_keep_their_rows(spark):
    df = spark.createDataFrame([("IH-MAMA",), ("XPTO",), (None,)], "sigla_exame string")
    got = {r.sigla_exame: (r.mnemonico, r.etapa) for r in cohort.with_mnemonic(df).collect()}
    assert got == {"IH-MAMA": ("IHMAMA", "ihc"), "XPTO": (None, None), None: (None, None)}


def test_gate_has_no_word_boundary_and_plain_case(apply):
    texts = ["carcinomatose", "METÁSTASE", "metástase", "a.b", "nada", None]
    assert apply(cohort.gate_flag, texts) == [True, False, True, False, False, None]
    assert apply(lambda c: cohort.gate_flag(c, any_case_accents=True), texts)[1] is True
    assert apply(lambda c: cohort.gate_flag(c, ["a.b"]), ["axb", "A.B"]) == [False, True]


@pytest.mark.parametrize("group,stage,count", [("F", "mammogram", 4), ("P", "biopsy", 8), ("F", "return", 7)])
def test_exam_code_sets(spark, group, stage, count):
    from careline import fixed_values as V

    codes = [(c,) for c in (*V.EXAM_CODES[stage][group], "OUTRO")]
    df = spark.createDataFrame(codes, "sigla_exame string")
    assert cohort.with_exam_codes(df, stage, group).count() == count


def test_brand_filters(spark):
    df = spark.createDataFrame([("Alfa - x",), ("ALFA - X",), ("beta",), (None,)], "marca string")
    assert cohort.brand_in(df, ["alfa - X"]).count() == 2
    assert cohort.brand_is(df, "beta").count() == 1


def test_sex_filter_ignores_case(spark):
    df = spark.createDataFrame([("f",), ("F",), ("m",), (None,)], "sexo_cliente string")
    assert cohort.female_only(df).select(F.count("*")).first()[0] == 2
