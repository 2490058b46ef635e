"""Grouped reports: counts, averages, extremes, two-sided rates, member lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import WHOLE


# a row may stand for several; this column, where there is one, says for how many
COPIES = "copies"


def _weight(df: DataFrame) -> Column:
    return F.col(COPIES) if COPIES in df.columns else F.lit(1)


def count_by(df: DataFrame, keys: Sequence[str], counted: str, name: str = "num") -> DataFrame:
    """Rows with a non-null ``counted`` per group. Counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def averages(
    df: DataFrame,
    keys: Sequence[str],
    outputs: dict[str, tuple[str, str]],
    of_sums: dict[str, tuple[str, str, str]] | None = None,
) -> DataFrame:
    """``{output: (column, type)}`` averages per group, over the copies of each row.

    ``of_sums`` has those kept as sums: ``{output: (total, how many, type)}``.
    """
    if COPIES not in df.columns:
        means = {c: F.avg(c) for c, _ in outputs.values()}
    else:
        means = {c: _weighted_mean(df, c) for c, _ in outputs.values()}
    return df.groupBy(*keys).agg(
        *(means[c].try_cast(t).alias(name) for name, (c, t) in outputs.items()),
        *(
            (F.sum(total).cast("double") / F.sum(times)).try_cast(t).alias(name)
            for name, (total, times, t) in (of_sums or {}).items()
        ),
    )


def _weighted_mean(df: DataFrame, column: str) -> Column:
    """What avg gives over the copies: four more decimals for a decimal, else a double."""
    times = F.sum(F.when(F.col(column).isNotNull(), _weight(df)))
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DecimalType):
        return F.sum(F.col(column).cast(WHOLE) * _weight(df)).cast("double") / times
    total = F.sum(F.col(column) * _weight(df))
    return F.round(total.cast(T.DecimalType(28, kind.scale)) / times, kind.scale + 4)


def extremes(
    df: DataFrame, keys: Sequence[str], column: str, high: str, low: str, data_type: str
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.max(column).try_cast(data_type).alias(high),
        F.min(column).try_cast(data_type).alias(low),
    )


def two_sided(
    df: DataFrame,
    keys: Sequence[str],
    first: tuple[str, Column],
    second: tuple[str, Column],
    rate_of: str,
    shared: Sequence[str] | None = None,
    required: Sequence[str] = (),
    keep_one_sided: bool = False,
) -> DataFrame:
    """Count two kinds of rows per group, and the share of one of them.

    One pass with conditional counts. With ``shared`` (a subset of ``keys``) the
    second count is taken over those keys only, as when its side of a join is
    grouped more coarsely. Groups with an empty side are dropped unless
    ``keep_one_sided``, those with a null in ``required`` always.
    """
    (a, a_test), (b, b_test) = first, second
    rows = df.where(a_test | b_test)
    for k in required:
        rows = rows.where(F.col(k).isNotNull())
    sums = [
        F.coalesce(F.sum(F.when(test, _weight(df))), F.lit(0)).cast("long").alias(name)
        for name, test in (first, second)
    ]
    out = rows.groupBy(*keys).agg(*sums)
    if shared is not None:
        # the input here is one row per group, not one per record
        out = out.withColumn(b, F.sum(b).over(Window.partitionBy(*shared)))
    if not keep_one_sided:
        out = out.where((F.col(a) > 0) & (F.col(b) > 0))
    share = F.col(rate_of) / (F.col(a) + F.col(b))
    return out.withColumn("rate", share.try_cast("decimal(4,2)"))


# copies of one member that stay together in a list
PIECE = 1000


def member_counts(
    df: DataFrame, keys: Sequence[str], member: str, copies: str = "copies"
) -> DataFrame:
    """One row per group and member with the number of its rows; a null member is none.

    The form of a member list to store: a group of any size is as many rows, and
    a member that occurs often is one.
    """
    rows = df.where(F.col(member).isNotNull()).groupBy(*keys, member)
    return rows.agg(F.sum(_weight(df)).cast("long").alias(copies))


def member_lists(
    df: DataFrame, keys: Sequence[str], member: str, name: str, buckets: int
) -> DataFrame:
    """Comma-separated members of every group, whole, in rows numbered by ``part``.

    A member's part is a hash of the member and of the piece of its copies, below
    ``buckets``. It depends on nothing else, so no row moves when a group grows; choose
    ``buckets`` so that the largest group divided by it fits a row. Copies of a hot
    member are dealt in pieces. A group without any member has one empty list.
    """
    times = F.when(F.col(member).isNotNull(), _weight(df)).otherwise(0)
    counted = df.groupBy(*keys, member).agg(F.sum(times).cast("long").alias("_n"))
    last = F.greatest(F.floor((F.col("_n") - 1) / PIECE), F.lit(0)).cast("long")
    pieces = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    copies = F.least(F.lit(PIECE).cast("long"), F.col("_n") - F.col("_piece") * PIECE).cast("int")
    dealt = F.md5(F.concat_ws(":", F.col(member).cast("string"), F.col("_piece").cast("string")))
    part = F.conv(F.substring(dealt, 1, 8), 16, 10).cast("long") % buckets
    lists = (
        pieces.where("_n > 0")
        .withColumn("part", part.cast("int"))
        .groupBy(*keys, "part")
        .agg(F.flatten(F.collect_list(F.array_repeat(F.col(member), copies))).alias("_all"))
    )
    text = F.array_join(F.array_sort("_all").cast("array<string>"), ",")
    empty = (
        counted.groupBy(*keys)
        .agg(F.sum("_n").alias("_n"))
        .where("_n = 0")
        .select(*keys, F.lit(0).alias("part"), F.lit("").alias(name))
    )
    return lists.select(*keys, "part", text.alias(name)).unionByName(empty)


# ids alike but for their last bits share a slice: a window never holds more rows than that
SLICE_BITS = 12


def packed_lists(
    df: DataFrame, keys: Sequence[str], member: str, name: str, max_bytes: int = 1 << 20
) -> DataFrame:
    """Comma-separated members of every group in ascending order, in rows of ``max_bytes`` or little more.

    A copy lies in the row that its place falls in: the bytes of all copies before it,
    divided by ``max_bytes``. Places come from running sums in two levels, over the ids
    of a slice and over the slices of a group, so no task sorts a whole group, and
    rows are as many as the group needs. Copies of a hot member are cut by reckoning,
    without being laid out first. Members are whole numbers. A group without any has one
    empty list.
    """
    times = F.when(F.col(member).isNotNull(), _weight(df)).otherwise(0)
    counted = df.groupBy(*keys, member).agg(F.sum(times).cast("long").alias("_n"))
    some = counted.where("_n > 0").select(
        *keys,
        F.col(member).alias("_m"),
        "_n",
        (F.octet_length(F.col(member).cast("string")) + 1).cast("long").alias("_w"),
        F.shiftright(F.col(member), SLICE_BITS).alias("_slice"),
    )
    bytes_, before = F.col("_n") * F.col("_w"), (Window.unboundedPreceding, -1)
    own = Window.partitionBy(*keys, "_slice").orderBy("_m").rowsBetween(*before)
    some = some.withColumn("_own", F.coalesce(F.sum(bytes_).over(own), F.lit(0)))
    slices = some.groupBy(*keys, "_slice").agg(F.sum(bytes_).alias("_bytes"))
    upto = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*before)
    slices = slices.select(
        *(F.col(k).alias(f"_{k}") for k in keys),
        F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_bytes").over(upto), F.lit(0)).alias("_first"),
    )
    same = F.col("_slice") == F.col("_of")
    for k in keys:
        same = same & some[k].eqNullSafe(F.col(f"_{k}"))
    placed = some.join(slices, same).withColumn("_at", F.col("_first") + F.col("_own"))

    size = F.lit(max_bytes)
    last = F.expr(f"(_at + (_n - 1) * _w) div {max_bytes}")
    pieces = placed.withColumn("_p", F.explode(F.sequence(F.expr(f"_at div {max_bytes}"), last)))
    # the first copy at or after a byte, among those of the member
    low = F.greatest(F.lit(0), F.ceil((F.col("_p") * size - F.col("_at")) / F.col("_w")))
    high = F.least(F.col("_n"), F.ceil(((F.col("_p") + 1) * size - F.col("_at")) / F.col("_w")))
    lists = (
        pieces.withColumn("_copies", (high - low).cast("int"))
        .groupBy(*keys, F.col("_p").cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("_m", "_copies"))).alias("_all"))
    )
    repeated = F.transform("_all", lambda e: F.array_repeat(e["_m"].cast("string"), e["_copies"]))
    text = F.array_join(F.flatten(repeated), ",")
    empty = (
        counted.groupBy(*keys)
        .agg(F.sum("_n").alias("_n"))
        .where("_n = 0")
        .select(*keys, F.lit(0).alias("part"), F.lit("").alias(name))
    )
    return lists.select(*keys, "part", text.alias(name)).unionByName(empty)
