import random
from decimal import Decimal

import pytest

from lectern.plans import members
from lectern.sources import CLEANED

DT = "20190722"


def table(spark, name, rows):
    """Rows given by some of a table's columns; the rest are null."""
    spec = CLEANED[name]
    data = [tuple(r.get(c) for c in spec.columns) for r in rows]
    return spark.createDataFrame(data, spec.schema)


@pytest.fixture
def load(spark):
    r = random.Random(11)
    member, reg, pay = [], [], []
    for uid in range(1, 12):
        for dn in ("a", "b"):
            # some members occur twice, some on one website or another day only
            for _ in range(r.choice([0, 1, 1, 2])):
                member.append(
                    {
                        "uid": uid, "ad_id": r.choice([1, 2, 3, 99]), "memberlevel": "m",
                        "register": f"2019-0{r.randrange(1, 9)}", "fullname": f"n{uid}",
                        "dt": DT if uid != 11 else "20190721", "dn": dn,
                    }
                )
            for i in range(r.choice([0, 1, 1, 3])):
                reg.append(
                    {
                        "uid": uid, "appregurl": f"u{i}", "createtime": f"2019-{r.randrange(10, 12)}",
                        "websiteid": r.choice([1, 2, 77]), "dt": DT, "dn": dn,
                    }
                )
            for _ in range(r.choice([0, 1, 2, 4])):
                pay.append(
                    {
                        "uid": uid, "paymoney": str(r.randrange(1, 9999) / 100),
                        "vip_id": r.choice([1, 2, 88]), "dt": DT, "dn": dn,
                    }
                )
    pay.append({"uid": 1, "paymoney": "not money", "vip_id": 1, "dt": DT, "dn": "a"})
    # broken records of all kinds, which must not meet each other
    for _ in range(3):
        member.append({"uid": 0, "ad_id": 0, "memberlevel": "m", "register": "2019-01", "dt": DT, "dn": "a"})
        reg.append({"uid": 0, "appregurl": "lost", "createtime": "2019-01", "websiteid": 0, "dt": DT, "dn": "a"})
        pay.append({"uid": 0, "paymoney": "5", "vip_id": 0, "dt": DT, "dn": "a"})
    both = ("a", "b")
    tables = {
        "dwd_member": member,
        "dwd_member_regtype": reg,
        "dwd_pcentermempaymoney": pay,
        # ad 3 and site 2 have two rows, and so has level 2
        "dwd_base_ad": [{"adid": i, "adname": f"ad{i}{v}", "dn": d} for d in both
                        for i, v in [(1, ""), (2, ""), (3, "x"), (3, "y")]],
        "dwd_base_website": [{"siteid": i, "sitename": f"s{i}{v}", "dn": d} for d in both
                             for i, v in [(1, ""), (2, "x"), (2, "y")]],
        "dwd_vip_level": [{"vip_id": i, "vip_level": f"L{i}{v}", "start_time": v, "end_time": v,
                           "dn": d} for d in both for i, v in [(1, "x"), (2, "y"), (2, "z")]],
    }
    frames = {name: table(spark, name, rows) for name, rows in tables.items()}
    return frames.__getitem__


def test_fan_out_equals_the_joined_rows(spark, rows, load):
    got = members.member_wide(load, DT, fan_out=True)
    joined = members.member_rows(load, DT).groupBy("uid", "dn").agg({"paymoney": "sum"})
    assert rows(got, "uid", "dn", "paymoney") == [
        (u, d, m) for u, d, m in rows(joined)
    ]


def test_wide_has_one_row_per_member_and_true_sums(spark, rows, load):
    wide = members.member_wide(load, DT)
    assert wide.columns == members.WIDE_COLUMNS and len(wide.columns) == 42
    keys = load("dwd_member").where(f"dt = '{DT}'").select("uid", "dn").distinct()
    assert rows(wide, "uid", "dn") == rows(keys)
    paid = {}
    for p in load("dwd_pcentermempaymoney").collect():
        if p.paymoney != "not money" and p.uid:
            paid[p.uid, p.dn] = paid.get((p.uid, p.dn), Decimal(0)) + Decimal(p.paymoney)
    regs = {}
    for g in load("dwd_member_regtype").where("uid <> 0").collect():
        key = (g.createtime, g.appregurl)
        regs.setdefault((g.uid, g.dn), []).append((key, g.appregurl, g.websiteid))
    for r in wide.collect():
        assert r.paymoney == paid.get((r.uid, r.dn))
        picked = min(regs.get((r.uid, r.dn), [(None, None, None)]))
        assert r.appregurl == picked[1]
        assert r.siteid == (picked[2] if picked[2] in (1, 2) else None)


def test_levels(spark, load):
    pay = {}
    for p in load("dwd_pcentermempaymoney").where("uid <> 0").collect():
        pay.setdefault((p.uid, p.dn), set()).add(p.vip_id)
    for r in members.member_wide(load, DT).collect():
        known = sorted(pay.get((r.uid, r.dn), set()) - {88})
        assert r.vip_id == (known[0] if known else None)


def test_member_inputs_keep_one_partitioning(spark, load):
    """The uid joins add no exchange to those of the aggregates under them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = members.member_wide(load, DT)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # member, registrations, payments by level and by member, levels, ads, sites;
    # and the join sides that change key: level, ad, site
    assert plan.count("Exchange hashpartitioning(uid") == 4


def test_broken_records_do_not_multiply(spark, load):
    assert members.member_rows(load, DT).where("uid = 0").count() == 3


def test_counts_keep_odd_labels(spark, rows):
    df = spark.createDataFrame(
        [(1, "a_b", "w", DT), (2, "a_b", "w", DT), (3, None, "w", DT), (4, "a", "w_x", DT)],
        "uid int, adname string, dn string, dt string",
    )
    assert rows(members.registrations_by(df, "adname")) == [
        ("a", 1, DT, "w_x"), ("a_b", 2, DT, "w"), (None, 1, DT, "w"),
    ]


def test_top_payers(spark):
    rows_in = [(i, "gold", Decimal(10 if i < 5 else 1), "w") for i in range(6)]
    rows_in += [(9, "tin", None, "w"), (1, "gold", Decimal(3), "v")]
    rows_in += [(7, "big", Decimal(999_999), "w"), (8, "big", Decimal("5707855.14"), "w")]
    df = spark.createDataFrame(
        rows_in, "uid int, memberlevel string, paymoney decimal(38,4), dn string"
    )
    got = members.top_payers(df, columns=["memberlevel", "rownum", "dn", "uid"]).collect()
    assert [tuple(r) for r in got if r.memberlevel == "big"] == [
        ("big", 1, "w", 8), ("big", 2, "w", 7),
    ]
    assert [tuple(r) for r in got if r.memberlevel != "big"] == [
        ("gold", 1, "v", 1), ("gold", 1, "w", 0), ("gold", 2, "w", 1), ("gold", 3, "w", 2),
        ("tin", 1, "w", 9),
    ]
