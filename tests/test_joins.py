import pytest

from lectern.operators.joins import if_small, stored_bytes
from lectern.plans import members
from lectern.sources import CLEANED, Lake

SIDES = ("dwd_base_ad", "dwd_base_website", "dwd_vip_level")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_threshold(spark):
    """A session that broadcasts nothing by itself."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def test_the_size_of_the_files_decides(no_threshold, tmp_path):
    spark = no_threshold
    spark.range(5000).write.parquet(str(tmp_path / "t"))
    small, big = spark.read.parquet(str(tmp_path / "t")), spark.range(10).selectExpr("id", "id AS v")
    size = stored_bytes(small)
    assert 0 < size < 1 << 20
    assert "BroadcastHashJoin" in plan(big.join(if_small(small, size), "id"))
    assert "BroadcastHashJoin" not in plan(big.join(if_small(small, size - 1), "id"))


def test_sides_of_unknown_size_are_not_sent(no_threshold):
    spark = no_threshold
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "id long")
    assert "BroadcastHashJoin" not in plan(spark.range(9).join(if_small(rows), "id"))


def test_member_sides_are_broadcast_in_any_session(no_threshold, tmp_path):
    spark = no_threshold
    lake = Lake(spark, str(tmp_path))
    for table in ("dwd_member", "dwd_member_regtype", "dwd_pcentermempaymoney", *SIDES):
        path = lake.path(table)
        spark.createDataFrame([], CLEANED[table].schema).write.parquet(path)
    load = lambda t: lake.read(t, CLEANED[t].schema)
    assert plan(members.member_rows(load, "20190722")).count("BroadcastHashJoin") == 3
    assert plan(members.member_wide(load, "20190722")).count("BroadcastHashJoin") == 3
