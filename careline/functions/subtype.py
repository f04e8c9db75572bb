"""Molecular subtype from four markers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from careline import fixed_values as V


def molecular_subtype(er: Column, pr: Column, her2: Column, ki67: Column) -> Column:
    """Ordered rules; inconclusive, missing or contradictory markers are undefined."""
    hormone = (er == V.POSITIVE) | (pr == V.POSITIVE)
    no_hormone = (er == V.NEGATIVE) & (pr == V.NEGATIVE)
    her2_off, her2_on = her2 == V.NEGATIVE, her2 == V.POSITIVE
    name = V.SUBTYPES
    return (
        F.when(hormone & her2_off & (ki67 < V.KI67_CUT), name["luminal_a"])
        .when(hormone & her2_off & (ki67 >= V.KI67_CUT), name["luminal_b"])
        .when(hormone & her2_on, name["luminal_her2"])
        .when(no_hormone & her2_on, name["her2"])
        .when(no_hormone & her2_off, name["triple_negative"])
        .otherwise(name["undefined"])
    )
