"""Top and bottom rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int = 3,
    rank: str = "rownum",
) -> DataFrame:
    """The first ``n`` rows of every group, numbered from 1.

    The order must be total for a repeatable result. The rank filter lets Spark
    keep only ``n`` rows per group in each task before the shuffle, so a group
    with a third of all rows sends ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_levels(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    n: int = 3,
    descending: bool = True,
    rank: str = "rk",
    values: DataFrame | None = None,
) -> DataFrame:
    """All rows whose ``by`` is among the ``n`` best distinct values of the group.

    Ties can make one group's answer unbounded, so rows are never ranked in a
    window. The distinct values are ranked instead, at most ``n`` per group
    survive, and the rows are joined to them. Nulls rank last when descending and
    first when ascending. ``values`` may give the groups' values from a smaller table
    that holds them all, so that the rows are read once.
    """
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    w = Window.partitionBy(*keys).orderBy(order)
    levels = (df if values is None else values).select(*keys, by).distinct()
    levels = levels.withColumn(rank, F.dense_rank().over(w)).where(F.col(rank) <= n)
    levels = levels.select(*(F.col(c).alias(f"_{c}") for c in (*keys, by)), rank)
    on = F.lit(True)
    for c in (*keys, by):
        on = on & df[c].eqNullSafe(levels[f"_{c}"])
    return df.join(levels, on).select(*df.columns, rank)
