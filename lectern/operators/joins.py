"""Joins on an id plus the website, and picks of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known(df: DataFrame, *ids: str) -> DataFrame:
    """Rows whose ids are known; 0 stands for one that was missing or unreadable.

    Taken on one side of a join, it keeps broken records from meeting each other.
    """
    for name in ids:
        df = df.where(F.col(name) != 0)
    return df


# what is sent to every executor, by the size of the files it is read from; in memory, and the
# driver holds it too, rows take some 20 times that
SMALL = 8 << 20


def stored_bytes(df: DataFrame) -> int:
    """Size that the planner reckons from the listing of the files; no job runs for it.

    A join in the plan multiplies the sizes of its sides, and rows that come from
    Python have no size, so both count as large.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def if_small(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """The frame with a broadcast hint, if its files are within the limit; else as it is.

    So a small side is broadcast in sessions with other thresholds too, and one that has
    grown is joined as Spark chooses.
    """
    return F.broadcast(df) if stored_bytes(df) <= limit else df


def growing(df: DataFrame) -> DataFrame:
    """A side that grows with the data, joined by sort and merge, never sent whole.

    The planner knows a table by its files. Compressed ids and texts of millions of rows
    look small there, and would pass through the driver.
    """
    return df.hint("merge")


def small_or_growing(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """A side for rows that are in files themselves: these are not sent in its place either."""
    return F.broadcast(df) if stored_bytes(df) <= limit else growing(df)


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), copies: str | None = None
) -> DataFrame:
    """The first row of every key by ``order``, then by the remaining columns.

    ``copies`` names a column for the number of rows the key had, counted in the same pass.
    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key with very many rows stays cheap. Rows are sorted by key in
    each task for it, which spills; a minimum of rows cannot be hashed.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *(c for c in rest if c not in order)]
    counted = [] if copies is None else [F.count(F.lit(1)).alias(copies)]
    if not ordered:
        return df.groupBy(*keys).agg(*counted) if counted else df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"), *counted)
    fields = (F.col("_row").getField(c).alias(c) for c in rest)
    return picked.select(*keys, *fields, *([] if copies is None else [copies]))
