import datetime as dt
import random

from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions import followup as U
from careline.operators import cohort
from careline.operators import followup as O
from careline.operators import joins
from careline.plans.imaging import activation_list, history
from careline.sources import read_returns

DAY = dt.date(2020, 1, 1)


def test_return_plan(spark):
    rows = [(c, dt.datetime(2024, 1, 1, 15, 30)) for c in (0, 1, 2, 3, 4, 5, 6, None)]
    df = spark.createDataFrame(rows, "BIRADS int, dth_pedido timestamp")
    got = {r.BIRADS: (r.retorno_cliente, r.dth_previsao_retorno, r.dias_ate_retorno)
           for r in O.with_return_plan(df).collect()}
    year, half = dt.datetime(2024, 12, 26), dt.datetime(2024, 6, 29)
    assert got == {0: (0, None, None), 1: (12, year, 360), 2: (12, year, 360), 3: (6, half, 180),
                   4: (0, None, None), 5: (0, None, None), 6: (0, None, None), None: (0, None, None)}


def test_age_counts_whole_days(spark):
    rows = [(dt.datetime(1980, 1, 2, 12), dt.datetime(1980, 1, 3)), (dt.datetime(1980, 1, 2), dt.datetime(2020, 1, 2))]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp").select(U.age_years(F.col("a"), F.col("b")))
    assert [r[0] for r in df.collect()] == [0.0, 14610 / 365.25]


def test_age_band_is_half_open(spark):
    df = spark.createDataFrame([(39.99,), (40.0,), (75.99,), (76.0,)], "idade_cliente double")
    assert [r[0] for r in cohort.age_between(df).collect()] == [40.0, 75.99]


def brute_force_returns(visits, codes):
    out = set()
    for key, client, day, _ in visits:
        later = sorted((d, k) for k, c, d, code in visits
                       if c == client and d > day and (codes is None or code in codes))
        if later:
            out.add((key, client, later[0][1], later[0][0], (later[0][0] - day).days))
    return out


def test_derived_returns_against_brute_force(spark):
    rng = random.Random(1)
    # One patient holds a third of the visits, many on the same days.
    visits = [(i, 0 if i % 3 == 0 else rng.randint(1, 20), DAY + dt.timedelta(days=rng.randint(0, 25)),
               rng.choice(["MAMOG", "USMAMAS", "OUTRO", "BRCA1"])) for i in range(600)]
    df = spark.createDataFrame(visits, "ficha int, id_cliente int, dth_pedido date, sigla_exame string")
    for codes in (None, V.EXAM_CODES["return"]["F"]):
        got = {(r.ficha_origem, r.id_cliente, r.ficha, r.dth_pedido, r.dias_entre_ficha)
               for r in joins.derive_returns(df.repartition(5), codes).collect()}
        assert got == brute_force_returns(visits, codes)


def _reports(spark, n=60):
    text = ["BI-RADS 1", "BI-RADS 2", "BI-RADS 3", "BI-RADS 4A", None]
    rows = [(i // 2, i % 2, 1, i % 7, "mama", "MAMOG" if i % 5 else "OUTRO", "F" if i % 3 else "m", "Marca",
             dt.date(1960, 1, 1), DAY, DAY, text[i % 5 if i % 4 else 0]) for i in range(n)]
    return spark.createDataFrame(rows, "ficha int, id_item int, id_subitem int, id_cliente int, linha_cuidado string, "
                                       "sigla_exame string, sexo_cliente string, marca string, "
                                       "dth_nascimento_cliente date, dth_pedido date, _datestamp date, laudo_tratado string")


def _returns(spark, origins):
    rows = [(f, c, "mama", f + 1000, DAY, "x", "m", "u", "v", 1.0, 2.0, 1, "s", 9) for f, c in origins]
    raw = spark.createDataFrame(rows, "ficha_origem int, id_cliente int, linha_cuidado string, ficha int, dth_pedido date, "
                                      "siglas_ficha string, marca string, unidade string, convenio string, "
                                      "valores_exame double, valores_ficha double, qtd_exame int, secao string, "
                                      "dias_entre_ficha int")
    return read_returns(spark, raw)


def test_two_returns_give_two_history_rows(spark):
    reports = _reports(spark)
    one = reports.filter("sigla_exame = 'MAMOG'").first()
    once = history(reports, _returns(spark, [(one.ficha, one.id_cliente)]))
    twice = history(reports, _returns(spark, [(one.ficha, one.id_cliente)] * 2))
    assert twice.count() == once.count() + 1
    assert "laudo_tratado" not in once.columns and "idade_cliente" not in once.columns


def test_activation_list_is_one_row_per_visit_without_return(spark):
    reports = _reports(spark)
    as_of = F.lit("2020-06-01").cast("date")
    every = activation_list(reports, _returns(spark, []), as_of, brands=("MARCA",)).collect()
    assert len({r.ficha for r in every}) == len(every) > 3
    assert all(r.BIRADS in (1, 2, 3) and r.sexo_cliente == "F" for r in every)
    gone = every[0]
    left = activation_list(reports, _returns(spark, [(gone.ficha, gone.id_cliente)]), as_of, brands=("marca",)).collect()
    assert {r.ficha for r in every} - {r.ficha for r in left} <= {gone.ficha}
    assert (gone.ficha, gone.id_cliente) not in {(r.ficha, r.id_cliente) for r in left}
    assert activation_list(reports, _returns(spark, []), as_of, brands=("outra",)).count() == 0


def test_activation_list_same_for_any_partitioning(spark):
    reports, returns = _reports(spark), _returns(spark, [(3, 6)])
    as_of = F.lit("2020-06-01").cast("date")
    one = activation_list(reports.coalesce(1), returns, as_of)
    many = activation_list(reports.repartition(13), returns, as_of)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_overdue_and_reminders(spark):
    rows = [(1, 10, 12, "2024-01-01", None), (2, 10, 12, "2024-01-01", 9), (3, 11, 12, "2024-01-01", 8),
            (4, 12, 12, "2030-01-01", None), (5, 13, 6, "2024-01-01", None), (6, 14, 0, None, None)]
    df = spark.createDataFrame(rows, "ficha int, id_cliente int, retorno_cliente int, dth_previsao_retorno string, "
                                     "ficha_retorno_elegivel int")
    got = {r.retorno_cliente: (r.pacientes, r.em_atraso, r.taxa_atraso)
           for r in O.overdue_rate(df, F.lit("2025-01-01").cast("date")).collect()}
    assert got == {12: (2, 1, 0.5), 6: (1, 1, 1.0)}
    returns = spark.createDataFrame([(2, 10, 5.5), (2, 10, 1.0), (3, 11, None)],
                                    "ficha_origem int, id_cliente int, valores_exame double")
    effect = {r.retorno_cliente: (r.lembretes, r.retornos, r.taxa_retorno, r.valor_retornos)
              for r in O.reminder_effect(df, returns).collect()}
    assert effect == {12: (4, 2, 0.5, 6.5), 6: (1, 0, 0.0, 0.0), 0: (1, 0, 0.0, 0.0)}


def test_channel_rules(spark):
    rows = [(i, i, "A" if i % 2 else "B", 50.0, 2, "MAMOG", f"2024-0{1 + i % 3}-15") for i in range(12)]
    df = spark.createDataFrame(rows, "ficha int, id_cliente int, marca string, idade_cliente double, BIRADS int, "
                                     "sigla_exame string, dth_previsao_retorno string")
    consents = spark.createDataFrame([(i, "sms" if i % 4 else "nenhum") for i in range(12)] * 2,
                                     "id_cliente int, consentimento string")
    controls = spark.createDataFrame([(1,)], "id_cliente int")
    rules = O.ChannelRules(brands=("a",), due_from="2024-02-15", due_to="2024-03-15", consents=("sms",))
    got = sorted(r.ficha for r in O.channel_list(df, rules, consents, controls).collect())
    assert got == [5, 7, 11]
    assert sorted(r.ficha for r in O.channel_list(df, rules, consents).collect()) == [1, 5, 7, 11]
