"""Versioned history of a changing value (slowly changing dimension, type 2).

A version is valid in ``[start_time, end_time)``; the open one ends on
9999-12-31. ``paymoney`` is cumulative over a key's versions, ``vip_level`` is
that of the day the version started.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY_SUM, OPEN_END, iso_date, money

KEYS = ("uid", "dn")
COLUMNS = ("uid", "paymoney", "vip_level", "start_time", "end_time", "dn")


def day_increment(payments: DataFrame, vip: DataFrame, dt: str) -> DataFrame:
    """One open version per (uid, dn) from the payments of a day.

    Payments are summed per level before the join, so the join sees one row per
    member and level. A payment that cannot be read adds nothing.
    """
    paid = (
        payments.where(F.col("dt") == F.lit(dt))
        .groupBy("uid", "dn", "vip_id")
        .agg(F.sum(money(F.col("paymoney"))).alias("_paid"))
    )
    joined = paid.join(vip.select("vip_id", "dn", "vip_level"), ["vip_id", "dn"])
    per_member = joined.groupBy("uid", "dn").agg(
        F.coalesce(F.sum("_paid"), F.lit(0)).cast(MONEY_SUM).alias("paymoney"),
        F.max("vip_level").alias("vip_level"),
    )
    return per_member.withColumns(
        {"start_time": iso_date(F.lit(dt)), "end_time": F.lit(OPEN_END)}
    ).select(*COLUMNS)


def merge_day(versions: DataFrame, day: DataFrame) -> DataFrame:
    """Merge a day into versions: close those it replaces, add the new ones.

    The end is part of the join key, so only open versions meet the day, at most
    one per key, and no key is hot. Closed versions pass through; a history that
    stores them apart gives the open ones alone.
    """
    old, new = versions.alias("old"), day.alias("new")
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in KEYS]
    both = old.join(new, [*same, F.col("old.end_time") == F.col("new.end_time")], "full")

    had = F.col("old.start_time").isNotNull()
    got = F.col("new.start_time").isNotNull()
    zero = F.lit(0)
    total = F.coalesce("new.paymoney", zero) + F.coalesce("old.paymoney", zero)
    closed = F.when(
        had & got, _version("old", F.col("old.paymoney"), F.col("new.start_time"))
    )
    current = (
        F.when(had & got, _version("new", total, F.lit(OPEN_END)))
        .when(got, _version("new", F.col("new.paymoney"), F.lit(OPEN_END)))
        .otherwise(_version("old", F.col("old.paymoney"), F.col("old.end_time")))
    )
    return both.select(F.inline(F.array_compact(F.array(closed, current))))


def latest(opened: DataFrame) -> DataFrame:
    """Of all versions that were opened, the last of each key: the one that is open.

    A new version closes the one before it, so the closed ones need not be read. Copies
    of a version, as a snapshot and a day may both hold it, count once.
    """
    rest = [c for c in COLUMNS if c not in (*KEYS, "start_time")]
    picked = opened.groupBy(*KEYS).agg(F.max(F.struct("start_time", *rest)).alias("_last"))
    return picked.select(*(F.col(c) if c in KEYS else F.col(f"_last.{c}") for c in COLUMNS))


def touched(versions: DataFrame, day: DataFrame) -> DataFrame:
    """The versions of the keys that have an increment on the day."""
    old, new = versions.alias("old"), day.select(*KEYS).alias("new")
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in KEYS]
    return old.join(new, same, "left_semi")


def _version(side: str, paymoney: Column, end_time: Column) -> Column:
    return F.struct(
        F.col(f"{side}.uid").alias("uid"),
        paymoney.cast(MONEY_SUM).alias("paymoney"),
        F.col(f"{side}.vip_level").alias("vip_level"),
        F.col(f"{side}.start_time").alias("start_time"),
        end_time.alias("end_time"),
        F.col(f"{side}.dn").alias("dn"),
    )


def undo_day(history: DataFrame, dt: str) -> DataFrame:
    """Take a day back: drop the versions it started, reopen those it closed."""
    day = iso_date(F.lit(dt))
    reopened = F.when(F.col("end_time") == day, OPEN_END).otherwise(F.col("end_time"))
    return history.where(F.col("start_time") != day).withColumn("end_time", reopened)


def merge_history(history: DataFrame, day: DataFrame, dt: str) -> DataFrame:
    """A whole history after a day. Merging the same day again changes nothing."""
    return merge_day(undo_day(history, dt), day)


def close_versions(versions: DataFrame) -> DataFrame:
    """Close the second-last version of every key if it is open.

    The direct form over a union of history and increment: windows over each
    key's versions, at most one per day.
    """
    by_start = Window.partitionBy(*KEYS).orderBy("start_time")
    whole = Window.partitionBy(*KEYS)
    numbered = (
        versions.withColumn("_n", F.count(F.lit(1)).over(whole))
        .withColumn("_rn", F.row_number().over(by_start))
        .withColumn("_before_end", F.lag("end_time").over(by_start))
        .withColumn("_before_paid", F.lag("paymoney").over(by_start))
        .withColumn("_after_start", F.lead("start_time").over(by_start))
    )
    last = (F.col("_rn") == F.col("_n")) & (F.col("_before_end") == OPEN_END)
    second = (F.col("_rn") == F.col("_n") - 1) & (F.col("end_time") == OPEN_END)
    paid = F.when(last, F.coalesce("paymoney", F.lit(0)) + F.coalesce("_before_paid", F.lit(0)))
    return numbered.select(
        "uid",
        paid.otherwise(F.col("paymoney")).cast(MONEY_SUM).alias("paymoney"),
        "vip_level",
        "start_time",
        F.when(second, F.col("_after_start")).otherwise(F.col("end_time")).alias("end_time"),
        "dn",
    )
