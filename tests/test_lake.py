from pathlib import Path

import pytest

from lectern.checks.logs import write_log
from lectern.sources import Lake
from lectern.sources import lake as lake_files
from lectern.sources.reads import READS


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def frame(spark, rows):
    return spark.createDataFrame(rows, "x int, dt string, dn string")


def test_only_touched_partitions_are_replaced(spark, lake, rows):
    lake.write(frame(spark, [(1, "20190721", "a"), (2, "20190722", "a"), (3, "20190722", "b")]), "t")
    lake.write(frame(spark, [(9, "20190722", "a")]), "t")
    assert rows(lake.read("t"), "x", "dt", "dn") == [
        (1, "20190721", "a"), (3, "20190722", "b"), (9, "20190722", "a"),
    ]


def test_append_keeps_what_is_there(spark, lake):
    for _ in range(2):
        lake.write(frame(spark, [(1, "20190722", "a")]), "t", append=True)
    assert lake.read("t").count() == 2


def test_days_stay_text_and_prune(spark, lake):
    lake.write(frame(spark, [(1, "20190721", "01"), (2, "20190722", "a")]), "t")
    df = lake.read("t")
    assert dict(df.dtypes) == {"x": "int", "dt": "string", "dn": "string"}
    assert {r.dn for r in df.collect()} == {"01", "a"}
    plan = df.where("dt = '20190722'")._jdf.queryExecution().executedPlan().toString()
    assert "(dt#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_null_partition_values_come_back_null(spark, lake, rows):
    lake.write(frame(spark, [(1, "20190722", None)]), "t")
    assert rows(lake.read("t"), "x", "dn") == [(1, None)]


def test_files(spark, lake):
    df = spark.range(0, 4000, 1, 8).selectExpr("cast(id as int) x", "'20190722' dt", "'a' dn")
    lake.write(df, "few")
    files = list(Path(lake.path("few")).rglob("*.parquet"))
    assert len(files) == 1 and files[0].name.endswith(".snappy.parquet")
    lake.write(df, "many", max_records=1000)
    assert len(list(Path(lake.path("many")).rglob("*.parquet"))) == 4
    lake.write(df, "scanned", rebalance=False)
    assert len(list(Path(lake.path("scanned")).rglob("*.parquet"))) == 8


def test_there_are_29_reads():
    assert len(READS) == 29


def test_a_batch_sent_twice_counts_once(spark, lake, rows):
    batch = frame(spark, [(1, "20190722", "a"), (2, "20190722", "b")])
    assert lake.append_batch(batch, "t", "a/b 1")
    assert not lake.append_batch(batch, "t", "a/b 1")
    assert lake.append_batch(frame(spark, [(3, "20190722", "a")]), "t", "2")
    assert rows(lake.read("t"), "x", "dn") == [(1, "a"), (2, "b"), (3, "a")]
    assert lake.append_batch(frame(spark, []), "t", "none") and not lake.append_batch(batch, "t", "none")


def test_a_batch_that_broke_off_is_finished(spark, lake, rows, monkeypatch):
    batch = frame(spark, [(1, "20190722", "a"), (2, "20190722", "b"), (3, "20190721", "b")])
    rename, left = lake_files._rename, [1]

    def dies(files, source, target):
        if not left:
            raise OSError("gone")
        left.pop()
        rename(files, source, target)

    monkeypatch.setattr(lake_files, "_rename", dies)
    with pytest.raises(OSError):
        lake.append_batch(batch, "t", "1")
    assert lake.read("t").count() == 1
    monkeypatch.setattr(lake_files, "_rename", rename)
    assert lake.append_batch(batch, "t", "1")
    assert rows(lake.read("t"), "x") == [(1,), (2,), (3,)]
    # a batch that broke off while it was written leaves nothing
    (lake_files._file_system(spark, lake.root)[0]).mkdirs(lake_files._file_system(spark, lake.root)[1](lake.path("t") + "/_staged/batch-2"))
    assert lake.append_batch(frame(spark, [(4, "20190721", "b")]), "t", "2")
    assert rows(lake.read("t"), "x") == [(1,), (2,), (3,), (4,)]


@pytest.mark.parametrize("stop", [0, 1])
def test_a_day_is_whole_whenever_its_replacement_stops(spark, lake, rows, monkeypatch, stop):
    lake.replace_day(frame(spark, [(1, "20190721", "a")]), "t", "20190721")
    lake.replace_day(frame(spark, [(1, "20190722", "a"), (2, "20190722", "b")]), "t", "20190722")
    rename, done = lake_files._rename, []

    def dies(files, source, target):
        if len(done) == stop:
            raise OSError("gone")
        done.append(1)
        rename(files, source, target)

    monkeypatch.setattr(lake_files, "_rename", dies)
    with pytest.raises(OSError):
        lake.replace_day(frame(spark, [(9, "20190722", "a")]), "t", "20190722")
    if stop == 0:
        assert rows(lake.read("t"), "x") == [(1,), (1,), (2,)]
    monkeypatch.setattr(lake_files, "_rename", rename)
    lake.recover("t")
    assert rows(lake.read("t"), "x", "dn") == [(1, "a"), (9, "a")]
    assert lake.days("t") == ["20190721", "20190722"]
    lake.recover("t")
    assert rows(lake.read("t"), "x", "dn") == [(1, "a"), (9, "a")]


def test_a_replacement_that_is_not_whole_is_dropped(spark, lake, rows):
    lake.replace_day(frame(spark, [(1, "20190722", "a")]), "t", "20190722")
    frame(spark, [(9, "20190722", "a")]).drop("dt").write.parquet(lake.path("t") + "/_staged/dt=20190722")
    assert rows(lake.read("t"), "x") == [(1,)]
    lake.recover("t")
    assert rows(lake.read("t"), "x") == [(1,)] and not Path(lake.path("t") + "/_staged/dt=20190722").exists()


def test_a_day_may_be_replaced_by_what_is_read_from_it(spark, lake, rows):
    lake.replace_day(frame(spark, [(1, "20190722", "a"), (2, "20190722", "b")]), "t", "20190722")
    schema = frame(spark, []).schema
    lake.replace_day(lake.read("t", schema).where("x = 2"), "t", "20190722")
    assert rows(lake.read("t"), "x", "dn") == [(2, "b")]


def test_logs_are_compressed_and_dropped(spark, tmp_path):
    root = tmp_path / "lake"
    lines = [f'{{"uid":{k}}}' for k in range(25)]
    log = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    write_log(log, f"{root}/raw/a.log", max_lines=10)
    names = [p.name for p in (root / "raw/a.log").glob("part-*")]
    assert len(names) == 3 and all(n.endswith(".txt.gz") for n in names)
    assert sorted(r[0] for r in spark.read.text(f"{root}/raw/a.log").collect()) == sorted(lines)
    lake = Lake(spark, str(root))
    lake.drop("raw")
    lake.drop("raw")
    assert not (root / "raw").exists()
