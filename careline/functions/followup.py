"""Dates and intervals of a recommended return."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from careline import fixed_values as V


def age_years(birth: Column, as_of: Column) -> Column:
    """Whole days since birth over 365.25."""
    days = F.timestamp_diff("DAY", birth.cast("timestamp"), as_of.cast("timestamp"))
    return days / F.lit(V.DAYS_PER_YEAR)


def _by_category(cat: Column, values: dict[int, int], otherwise: Column, build) -> Column:
    grouped: dict[int, list[int]] = {}
    for key, value in values.items():
        grouped.setdefault(value, []).append(key)
    expr = None
    for value, keys in grouped.items():
        hit = cat.isin(keys)
        expr = F.when(hit, build(value)) if expr is None else expr.when(hit, build(value))
    return expr.otherwise(otherwise)


def return_months(cat: Column) -> Column:
    """12 for categories 1 and 2, 6 for 3, else 0."""
    return _by_category(cat, V.RETURN_MONTHS, F.lit(0), F.lit)


def predicted_return(cat: Column, ordered: Column) -> Column:
    """Order date plus 360 or 180 days as a timestamp, else NULL."""
    day = _by_category(
        cat, V.RETURN_DAYS, F.lit(None), lambda days: F.date_add(ordered.cast("date"), days)
    )
    return as_ts(day)


def days_until(predicted: Column, ordered: Column) -> Column:
    return F.datediff(predicted.cast("date"), ordered.cast("date"))


def as_ts(c: Column) -> Column:
    return F.to_timestamp(c)
