import pytest

from lectern.plans import jobs
from lectern.sources import CLEANED, Lake
from lectern.sources.jsonlines import json_objects
from tests.test_history import DAYS, OPEN

PAY = "dwd_pcentermempaymoney"


def lake_of(spark, tmp_path, days):
    """A lake with payments (uid, money) per day, and its history built day by day."""
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.createDataFrame([(1, "L1", "a")], "vip_id int, vip_level string, dn string"), "dwd_vip_level", ["dn"])
    for dt, rows in days.items():
        put(spark, lake, dt, rows)
        jobs.build_history(lake, dt)
    return lake


def put(spark, lake, dt, rows):
    spec = CLEANED[PAY]
    full = [dict(zip(spec.columns, [None] * len(spec.columns))) | {"uid": u, "paymoney": m, "vip_id": 1, "dt": dt, "dn": "a"} for u, m in rows]
    df = spark.createDataFrame([tuple(r[c] for c in spec.columns) for r in full], spec.schema)
    lake.replace_day(df, PAY, dt)


def versions(lake, dt):
    rows = jobs.history(lake, dt).collect()
    end = lambda t: "open" if t == OPEN else t[-2:]
    return sorted((r.uid, r.start_time[-2:], end(r.end_time), int(r.paymoney)) for r in rows)




def test_a_corrected_day_leaves_no_stale_version(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    lake = lake_of(spark, tmp_path, {DAYS[0]: [(1, "10")], DAYS[1]: [(1, "5")]})
    assert versions(lake, DAYS[1]) == [(1, "20", "21", 10), (1, "21", "open", 15)]
    put(spark, lake, DAYS[1], [(2, "7")])
    jobs.build_history(lake, DAYS[1])
    assert versions(lake, DAYS[1]) == [(1, "20", "open", 10), (2, "21", "open", 7)]
    assert lake.days(jobs.ZIPPER) == DAYS[:2]


def test_an_unreadable_payment_adds_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    lake = lake_of(spark, tmp_path, {DAYS[0]: [(1, "10")], DAYS[1]: [(1, "x")], DAYS[2]: [(1, "5")]})
    assert [v[3] for v in versions(lake, DAYS[2])] == [10, 10, 15]


def stored_rows(lake, table):
    """(dt, uid, state) of all stored rows."""
    rows = lake.read(table, jobs.ZIPPER_SCHEMA).collect()
    return sorted((r.dt, r.uid, r.state) for r in rows)


def test_a_day_writes_only_what_it_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    many = [(u, "10") for u in range(1, 301)]
    lake = lake_of(spark, tmp_path, {DAYS[0]: many, DAYS[1]: [(1, "5"), (999, "2")], DAYS[2]: []})
    changed = [r for r in stored_rows(lake, jobs.ZIPPER) if r[0] > DAYS[0]]
    assert changed == [(DAYS[1], 1, "closed"), (DAYS[1], 1, "open"), (DAYS[1], 999, "open")]
    assert len(versions(lake, DAYS[2])) == 302


def test_snapshots_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    paid = {d: [(1, "1"), (k + 2, "3")] for k, d in enumerate(DAYS)}
    lake = lake_of(spark, tmp_path / "plain", paid)
    want = {d: versions(lake, d) for d in DAYS}
    other = Lake(spark, str(tmp_path / "snapshots"))
    lake.spark.read.parquet(lake.path("dwd_vip_level")).write.parquet(other.path("dwd_vip_level"))
    for dt, rows in paid.items():
        put(spark, other, dt, rows)
        jobs.build_history(other, dt, snapshot_every=1)
    assert {d: versions(other, d) for d in DAYS} == want
    # the two newest are kept, and hold all that is open after their day
    assert other.days(jobs.SNAPSHOT) == DAYS[-2:]
    assert len([r for r in stored_rows(other, jobs.SNAPSHOT) if r[0] == DAYS[-1]]) == 1 + len(DAYS)
    # the days before the snapshot aren't read to add one
    scans = jobs.opened(other, DAYS[-1])._jdf.queryExecution().executedPlan().toString()
    pruned = [x for x in scans.split("FileScan") if "PartitionFilters" in x]
    assert len(pruned) == 2 and f"> {DAYS[-2]}" in pruned[0].split("PartitionFilters")[1].split("]")[0]


def test_a_past_day_run_again_drops_later_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    paid = {d: [(1, "1")] for d in DAYS}
    lake = lake_of(spark, tmp_path, paid)
    jobs.snapshot_history(lake, DAYS[1])
    jobs.snapshot_history(lake, DAYS[2])
    put(spark, lake, DAYS[1], [(1, "5"), (2, "7")])
    for dt in DAYS[1:]:
        jobs.build_history(lake, dt)
    assert lake.days(jobs.SNAPSHOT) == []
    assert [v for v in versions(lake, DAYS[-1]) if v[2] == "open"] == [(1, "23", "open", 8), (2, "21", "open", 7)]
    assert [v[3] for v in versions(lake, DAYS[-1]) if v[0] == 1] == [1, 6, 7, 8]


def test_days_stored_whole_are_read(spark, tmp_path, monkeypatch):
    """A day that holds all versions open after it, as they were stored once, counts each once."""
    monkeypatch.setattr(jobs, "loader", plain_loader)
    lake = lake_of(spark, tmp_path, {DAYS[0]: [(1, "1"), (2, "1")], DAYS[1]: [(1, "1")]})
    want = versions(lake, DAYS[1])
    whole = jobs.latest(jobs.opened(lake, DAYS[1], with_day=True)).selectExpr("*", "'open' AS state")
    closed = lake.read(jobs.ZIPPER, jobs.ZIPPER_SCHEMA).where(f"dt = '{DAYS[1]}' AND state = 'closed'").drop("dt")
    jobs._write_history(whole.unionByName(closed), lake, jobs.ZIPPER, DAYS[1])
    assert versions(lake, DAYS[1]) == want
    put(spark, lake, DAYS[2], [(2, "4")])
    jobs.build_history(lake, DAYS[2])
    assert versions(lake, DAYS[2]) == [(1, "20", "21", 1), (1, "21", "open", 2), (2, "20", "22", 1), (2, "22", "open", 5)]


def test_a_day_is_scanned_from_few_files(spark, tmp_path, monkeypatch):
    """However many parts a shuffle has; what is written to be read twice is gone afterwards."""
    monkeypatch.setattr(jobs, "loader", plain_loader)
    plans, write = [], jobs._write_history

    def look(rows, lake, table, dt):
        if table == jobs.ZIPPER:
            steps = [f for f in rows.inputFiles() if "/_steps/" in f]
            plans.append((len(steps), rows._jdf.queryExecution().executedPlan().toString()))
        write(rows, lake, table, dt)

    monkeypatch.setattr(jobs, "_write_history", look)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        lake = lake_of(spark, tmp_path, {d: [(u, "1") for u in range(300)] for d in DAYS[:2]})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(plans) == 2
    for files, plan in plans:
        assert 1 <= files <= 8
        assert "InMemoryTableScan" not in plan
    assert list((tmp_path / "_steps").iterdir()) == []
    assert [v[3] for v in versions(lake, DAYS[1]) if v[2] == "open"] == [2] * 300


def test_a_step_left_by_a_job_that_died_is_replaced(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "loader", plain_loader)
    lake = lake_of(spark, tmp_path, {DAYS[0]: [(1, "10"), (None, "3")]})
    step = f"_steps/{jobs.ZIPPER}-{DAYS[1]}"
    spark.range(5).write.parquet(lake.path(step))
    put(spark, lake, DAYS[1], [(1, "5"), (None, "4")])
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "_write_history", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.build_history(lake, DAYS[1])
    assert list((tmp_path / "_steps").iterdir()) == [] and lake.days(jobs.ZIPPER) == DAYS[:1]
    spark.range(5).write.parquet(lake.path(step))
    jobs.build_history(lake, DAYS[1])
    got = sorted((r.uid or 0, r.end_time[-2:], int(r.paymoney)) for r in jobs.history(lake, DAYS[1]).collect())
    assert got == [(0, "21", 3), (0, "31", 7), (1, "21", 10), (1, "31", 15)]


def plain_loader(lake):
    return lambda t: lake.read(t, CLEANED[t].schema if t == PAY else None)


def test_a_rerun_drops_what_the_day_no_longer_has(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    two = spark.createDataFrame([(1, "20190722", "a"), (2, "20190722", "b")], "v int, dt string, dn string")
    lake.replace_day(two, "t", "20190722")
    lake.replace_day(two.where("dn = 'a'").withColumn("dt", two.dt), "t", "20190721")
    lake.replace_day(two.where("dn = 'a'"), "t", "20190722")
    got = sorted((r.v, r.dt, r.dn) for r in lake.read("t", two.schema).collect())
    assert got == [(1, "20190721", "a"), (1, "20190722", "a")]
    lake.replace_day(two.where("false"), "t", "20190722")
    assert lake.read("t", two.schema).count() == 1


GOOD = ['{"uid":1}', ' {"uid":1}', "{uid:1}", "{'uid':1}", "{}", '{"uid":1,"_end_of_line":"x"}']
BAD = [
    "", "null", "junk", "7", '"s"', "[1]", '[{"uid":1}]', '{"uid":1', '{"uid":1]]', '{"uid":1} trailing', '{"uid":1}{"uid":2}',
    '{"uid":1},{"uid":2}', '{"uid":1}],"end":1,"o":[{"uid":2}', '{"uid":4}],"x":[{"uid":5}',
    '{"uid":1}],[{"_end_of_line":"x"}]]', '{"uid":1}],[{"_end_of_line":"x"}],[{"uid":9}',
]


def test_only_whole_objects_pass(spark):
    lines = spark.createDataFrame([(x,) for x in GOOD + BAD], "value string")
    assert json_objects(lines, ["uid"]).count() == len(GOOD)
    for line in GOOD:
        assert json_objects(lines.where(lines.value == line), ["uid"]).count() == 1, line
    assert json_objects(lines, ["uid"], strict=False).count() == len(GOOD + BAD)
