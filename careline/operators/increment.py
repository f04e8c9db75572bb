"""High-water-mark increments."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAMP = "_datestamp"


def mark_frame(df: DataFrame, col: str = STAMP) -> DataFrame:
    """The maximum of a column as a one-row frame."""
    return df.agg(F.max(col).alias(col))


def high_water_mark(df: DataFrame, col: str = STAMP):
    """The maximum of a column as a value, None on an empty table."""
    return mark_frame(df, col).first()[0]


def since(df: DataFrame, target: DataFrame | None, inclusive: bool = True,
          col: str = STAMP) -> DataFrame:
    """Rows at or after (or only after) the target's mark; all rows without a mark.

    The mark is read first and compared as a literal, so it reaches the scan as a
    pushed filter and prunes date partitions.
    """
    mark = None if target is None else high_water_mark(target, col)
    if mark is None:
        return df
    bound = F.lit(mark)
    return df.filter(F.col(col) >= bound if inclusive else F.col(col) > bound)


def only_new(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not have."""
    return df.join(target.select(*keys), list(keys), "left_anti")
