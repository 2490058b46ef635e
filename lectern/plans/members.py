"""Member area: the wide member table and its reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY_SUM
from ..operators.joins import if_small, known, one_per_key
from ..operators.ranking import top_rows
from ..operators.rollups import count_by
from ..sources.reads import read

Load = Callable[[str], DataFrame]

# Columns of the wide member table and of the top-payer report
WIDE_COLUMNS = (
    "uid ad_id fullname iconurl lastlogin mailaddr memberlevel password paymoney phone qq"
    " register regupdatetime unitname userip zipcode appkey appregurl bdp_uuid reg_createtime"
    " domain isranreg regsource regsourcename adname siteid sitename siteurl site_delete"
    " site_createtime site_creator vip_id vip_level vip_start_time vip_end_time"
    " vip_last_modify_time vip_max_free vip_min_free vip_next_level vip_operator dt dn"
).split()
TOP_PAYER_COLUMNS = (
    "uid memberlevel register appregurl regsourcename adname sitename vip_level paymoney"
    " rownum dt dn"
).split()
COUNT_REPORTS = {
    "ads_register_appregurlnum": "appregurl",
    "ads_register_sitenamenum": "sitename",
    "ads_register_regsourcenamenum": "regsourcename",
    "ads_register_adnamenum": "adname",
    "ads_register_memberlevelnum": "memberlevel",
    "ads_register_viplevelnum": "vip_level",
}


def member_rows(load: Load, dt: str) -> DataFrame:
    """Members of a day left-joined to all they refer to.

    One row per registration and VIP level paid for: payments are summed per
    level before the join, so a member with many of both does not get them all
    against each other.
    """
    member = read(load, "member").where(F.col("dt") == F.lit(dt))
    paid = (
        known(read(load, "payments"), "uid")
        .groupBy("uid", "dn", "vip_id")
        .agg(F.sum("paymoney").cast(MONEY_SUM).alias("paymoney"))
    )
    return (
        member.join(known(read(load, "member_regtype"), "uid"), ["uid", "dn"], "left")
        .join(paid, ["uid", "dn"], "left")
        .join(if_small(known(read(load, "base_ad"), "ad_id")), ["ad_id", "dn"], "left")
        .join(if_small(known(read(load, "base_website"), "siteid")), ["siteid", "dn"], "left")
        .join(if_small(known(read(load, "vip_level"), "vip_id")), ["vip_id", "dn"], "left")
        .select(*WIDE_COLUMNS)
    )


def member_wide(load: Load, dt: str, fan_out: bool = False) -> DataFrame:
    """One row per member of a day.

    Registrations and payments are reduced to one row per (uid, dn) before they
    are joined, so nothing multiplies and the three inputs keep one partitioning
    from the aggregates through the joins. ``fan_out`` scales the paid sum as a
    sum over the joined rows would, without making those rows.
    """
    member = read(load, "member").where(F.col("dt") == F.lit(dt)).drop("dt", "email")
    reg = known(read(load, "member_regtype"), "uid")
    ads = known(read(load, "base_ad"), "ad_id")
    sites = known(read(load, "base_website"), "siteid")

    wide = (
        one_per_key(member, ["uid", "dn"], ["register"])
        .join(one_per_key(reg, ["uid", "dn"], ["reg_createtime"]), ["uid", "dn"], "left")
        .join(_paid(load, fan_out), ["uid", "dn"], "left")
    )
    if fan_out:
        copies = _copies(member, ads, "ad_id", "_members")
        visits = _copies(reg, sites, "siteid", "_visits")
        times = F.col("_members") * F.coalesce("_visits", F.lit(1))
        wide = (
            wide.join(copies, ["uid", "dn"], "left")
            .join(visits, ["uid", "dn"], "left")
            .withColumn("paymoney", (F.col("paymoney") * times).cast(MONEY_SUM))
        )
    wide = wide.join(if_small(one_per_key(ads, ["ad_id", "dn"])), ["ad_id", "dn"], "left")
    # a site that is not in the base table stays null
    listed = one_per_key(sites, ["siteid", "dn"]).withColumn("_known", F.col("siteid"))
    wide = wide.join(if_small(listed), ["siteid", "dn"], "left").withColumn("siteid", F.col("_known"))
    return wide.withColumn("dt", F.lit(dt)).select(*WIDE_COLUMNS)


def _paid(load: Load, fan_out: bool) -> DataFrame:
    """Payments with their VIP level, one row per (uid, dn)."""
    keys = ["vip_id", "dn"]
    vip = known(read(load, "vip_level"), "vip_id")
    one = one_per_key(vip, keys).withColumn("_vip", F.col("vip_id"))
    payments = known(read(load, "payments"), "uid")
    paid = payments.groupBy("uid", *keys).agg(F.sum("paymoney").alias("_paid"))
    rows = paid.join(if_small(one), keys, "left")
    if fan_out:
        times = vip.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
        rows = rows.join(times, keys, "left").withColumn(
            "_paid", F.col("_paid") * F.coalesce("_times", F.lit(1))
        )
    picked = F.struct("_vip", "vip_max_free", "vip_min_free", "vip_operator")
    out = rows.groupBy("uid", "dn").agg(
        F.sum("_paid").cast(MONEY_SUM).alias("paymoney"),
        F.max("vip_level").alias("vip_level"),
        F.min("vip_start_time").alias("vip_start_time"),
        F.max("vip_end_time").alias("vip_end_time"),
        F.max("vip_last_modify_time").alias("vip_last_modify_time"),
        F.max("vip_next_level").alias("vip_next_level"),
        F.min(F.when(F.col("_vip").isNotNull(), picked)).alias("_pick"),
    )
    return out.select(
        "*",
        F.col("_pick._vip").alias("vip_id"),
        F.col("_pick.vip_max_free").alias("vip_max_free"),
        F.col("_pick.vip_min_free").alias("vip_min_free"),
        F.col("_pick.vip_operator").alias("vip_operator"),
    ).drop("_pick")


def _copies(rows: DataFrame, side: DataFrame, key: str, name: str) -> DataFrame:
    """Rows a left join of ``rows`` to ``side`` gives per (uid, dn)."""
    mine = rows.groupBy("uid", "dn", key).agg(F.count(F.lit(1)).alias("_mine"))
    theirs = side.groupBy(key, "dn").agg(F.count(F.lit(1)).alias("_theirs"))
    pairs = F.col("_mine") * F.coalesce("_theirs", F.lit(1))
    return (
        mine.join(theirs, [key, "dn"], "left").groupBy("uid", "dn").agg(F.sum(pairs).alias(name))
    )


def report_rows(load: Load, dt: str) -> DataFrame:
    """The columns of the wide table the member reports use."""
    return read(load, "member_report").where(F.col("dt") == F.lit(dt))


def registrations_by(rows: DataFrame, column: str) -> DataFrame:
    return count_by(rows, [column, "dn", "dt"], "uid").select(column, "num", "dt", "dn")


def top_payers(
    rows: DataFrame, n: int = 3, columns: Sequence[str] = TOP_PAYER_COLUMNS
) -> DataFrame:
    """The members who paid most, per website and member level."""
    best = top_rows(rows, ["dn", "memberlevel"], [F.desc_nulls_last("paymoney"), "uid"], n)
    return best.select(*columns).orderBy("memberlevel", "rownum", "dn")
