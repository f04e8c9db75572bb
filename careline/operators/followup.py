"""Predicted returns, reminder lists and follow-up figures."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careline import fixed_values as V
from careline.functions.category import (
    category_last,
    category_list,
    category_max,
    category_min,
    documented_category,
)
from careline.functions.followup import as_ts, days_until, predicted_return, return_months
from careline.operators.cohort import age_between, brand_in, with_mnemonic
from careline.operators.joins import not_in
from careline.operators.rows import count_by, distinct_values


def with_categories(df: DataFrame, group: str = "F", text: str = "laudo_tratado",
                    section: str = "reference") -> DataFrame:
    """Add the lowest, highest and last category of a report.

    ``section`` is "reference" (first line), "all" lines, or "documented": the one
    category near the last mention of the whole text.

    The list is taken out of a one-element array, which keeps later filters on a
    category above the extraction: it runs once per report, not once per use.
    """
    found = (F.array_compact(F.array(documented_category(F.col(text)))) if section == "documented"
             else category_list(F.col(text), group, section))
    once = F.explode(F.array(found))
    return (
        df.withColumn("_categorias", once)
        .withColumns({
            "MIN_BIRADS": category_min(F.col("_categorias")),
            "MAX_BIRADS": category_max(F.col("_categorias")),
            "BIRADS": category_last(F.col("_categorias")),
        }).drop("_categorias")
    )


def with_return_plan(df: DataFrame) -> DataFrame:
    """Add months to return, predicted date and days until it."""
    out = df.withColumns({
        "retorno_cliente": return_months(F.col("BIRADS")),
        "dth_previsao_retorno": predicted_return(F.col("BIRADS"), F.col("dth_pedido")),
    })
    if "dth_pedido_retorno_elegivel" in df.columns:
        out = out.withColumn("dth_pedido_retorno_elegivel", as_ts(F.col("dth_pedido_retorno_elegivel")))
    return out.withColumn(
        "dias_ate_retorno", days_until(F.col("dth_previsao_retorno"), F.col("dth_pedido"))
    )


def count_complementary(df: DataFrame) -> DataFrame:
    """Complementary exams are counted by code, their text is not read."""
    # Counted by code first: the lookup then joins one row per code.
    counts = with_mnemonic(count_by(df, "sigla_exame"))
    return counts.filter(F.col("etapa") == "complementary").select("sigla_exame", "mnemonico", "n")


def overdue_rate(df: DataFrame, as_of: Column) -> DataFrame:
    """Share of patients past a predicted date without a return, by months advised.

    Expects the return plan and the left-joined return visit.
    """
    due = df.filter((F.col("retorno_cliente") > 0)
                    & (F.col("dth_previsao_retorno").cast("date") < as_of))
    late = F.col("ficha_retorno_elegivel").isNull()
    patients = due.groupBy("retorno_cliente", "id_cliente").agg(F.max(late).alias("_atraso"))
    return patients.groupBy("retorno_cliente").agg(
        F.count(F.lit(1)).alias("pacientes"),
        F.count_if("_atraso").alias("em_atraso"),
        F.avg(F.col("_atraso").cast("int")).alias("taxa_atraso"),
    )


def reminder_effect(activation: DataFrame, returns: DataFrame,
                    by: Sequence[str] = ("retorno_cliente",)) -> DataFrame:
    """Do reminded visits come back: reminders, returns, rate and value of the returns.

    ``returns`` is reduced to one row per origin visit before it is joined.
    """
    value = F.coalesce(F.col("valores_exame").cast("decimal(18,2)"), F.lit(0))
    came = returns.groupBy("ficha_origem", "id_cliente").agg(F.sum(value).alias("_valor"))
    joined = activation.select("ficha", "id_cliente", *by).join(
        came.withColumnRenamed("ficha_origem", "ficha"), ["ficha", "id_cliente"], "left"
    )
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lembretes"),
        F.count("_valor").alias("retornos"),
        F.avg(F.col("_valor").isNotNull().cast("int")).alias("taxa_retorno"),
        F.coalesce(F.sum("_valor"), F.lit(0)).cast("double").alias("valor_retornos"),
    )


def attribute_returns(returns: DataFrame, reminders: DataFrame, client: str = "id_cliente", returned: str = "dth_retorno",
                      reminded: str = "dth_lembrete", within: int | None = None) -> DataFrame:
    """``returns`` with ``dth_lembrete`` and ``dias_lembrete``: the patient's last reminder up to each return.

    A reminder of the same day counts; one that is more than ``within`` days old does not.  Returns
    without a patient, a date or a reminder keep NULLs.

    Both sides become one row per patient and day, and a window in order of days carries the last
    reminder along, so a patient's window is bounded by calendar days, however many visits there are.
    """
    day = F.col(returned).cast("date")
    sent = reminders.select(F.col(client).alias("_cliente"), F.col(reminded).cast("date").alias("_dia")).dropna().distinct()
    came = returns.select(F.col(client).alias("_cliente"), day.alias("_dia")).dropna().distinct()
    both = sent.withColumn("_enviado", F.col("_dia")).unionByName(came.withColumn("_enviado", F.lit(None).cast("date")))
    days = both.groupBy("_cliente", "_dia").agg(F.max("_enviado").alias("_enviado"))
    so_far = Window.partitionBy("_cliente").orderBy("_dia").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = days.withColumn("dth_lembrete", F.last("_enviado", ignorenulls=True).over(so_far))
    age = F.datediff("_dia", "dth_lembrete")
    last = last.filter(age.isNotNull() if within is None else age <= within).select("_cliente", "_dia", "dth_lembrete", age.alias("dias_lembrete"))
    # the join spreads a busy patient over the days
    return returns.withColumns({"_cliente": F.col(client), "_dia": day}).join(last, ["_cliente", "_dia"], "left").drop("_cliente", "_dia")


@dataclass(frozen=True)
class ChannelRules:
    """One reminder channel.  The window is inclusive on both ends."""

    brands: Sequence[str]
    due_from: str
    due_to: str
    consents: Sequence[str]
    age_from: float = V.AGE_FROM
    age_below: float = V.AGE_BELOW
    categories: Sequence[int] = V.REMINDER_CATEGORIES
    exam_codes: Sequence[str] = field(default=V.EXAM_CODES["mammogram"]["F"])


def channel_list(df: DataFrame, rules: ChannelRules, consents: DataFrame,
                 controls: DataFrame | None = None) -> DataFrame:
    """Reports to remind through one channel.

    ``df`` has age, category and predicted date; ``consents`` holds
    (id_cliente, consentimento) and ``controls`` the id_cliente to leave out.
    """
    due = F.col("dth_previsao_retorno").cast("date")
    out = age_between(brand_in(df, rules.brands), rules.age_from, rules.age_below).filter(
        F.col("sigla_exame").isin(*rules.exam_codes)
        & F.col("BIRADS").isin(*rules.categories)
        & due.between(F.lit(rules.due_from).cast("date"), F.lit(rules.due_to).cast("date"))
    )
    # One row per patient leaves each map task, however many consents one has.
    agreed = distinct_values(
        consents.filter(F.col("consentimento").isin(*rules.consents)), "id_cliente"
    )
    out = out.join(agreed, "id_cliente", "left_semi")
    if controls is None:
        return out
    return not_in(out, distinct_values(controls, "id_cliente"), ["id_cliente"])
