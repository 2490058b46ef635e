"""Declared schemas: rows are checked by them, and days of an older form are read by them."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.plans import exams, jobs, members
from lectern.plans.tables import DETAIL, checked, schema_of
from lectern.sources import CLEANED, Lake

DT = "20190722"
BIG = 3_000_000_000


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def test_every_stored_table_has_a_schema(spark):
    derived = [
        *exams.DIMENSIONS, *members.COUNT_REPORTS, jobs.TOP_PAYERS, "dws_member", DETAIL, jobs.ZIPPER, jobs.SUMMARY,
        "ads_paper_avgtimeandscore", "ads_paper_maxdetail", "ads_user_paper_detail", "ads_top3_userdetail",
        "ads_low3_userdetail", "ads_paper_scoresegment_member", "ads_paper_scoresegment_user", "ads_user_question_detail",
    ]
    for table in [*CLEANED, *derived]:
        kinds = {f.name: f.dataType for f in schema_of(spark, table)}
        assert kinds["dn"] == T.StringType(), table
        ids = [n for n in kinds if n in ("uid", "userid", "paperviewid", "questionid")]
        assert all(kinds[n] == T.LongType() for n in ids), table
    assert len(schema_of(spark, DETAIL)) == 120
    with pytest.raises(KeyError):
        schema_of(spark, "dws_nothing")


def test_rows_are_checked_by_name_and_type(spark):
    good = spark.createDataFrame([], schema_of(spark, "ads_register_adnamenum"))
    assert checked(good.select("dn", "num", "adname", "dt"), "ads_register_adnamenum").columns[0] == "dn"
    assert checked(good.drop("dt"), "ads_register_adnamenum")
    for bad in (
        good.drop("num"),
        good.withColumn("num", F.col("num").cast("int")),
        good.withColumn("more", F.lit(1)),
        good.select("*", "num"),
    ):
        with pytest.raises(ValueError, match="ads_register_adnamenum"):
            checked(bad, "ads_register_adnamenum")


def test_days_of_an_older_form(spark, lake, rows):
    """Stored before ids were long and before a column was there; read with today's schema."""
    table = "dwd_pcentermempaymoney"
    spark.createDataFrame([(7, 2, "20190720", "a")], "uid int, vip_id int, dt string, dn string").write.partitionBy(
        "dt", "dn"
    ).parquet(lake.path(table))
    new = spark.createDataFrame(
        [(7, "1.5", 1, 2, DT, "a"), (BIG + 7, "2.5", 1, 2, DT, "a"), (BIG + 7 - 2**32, "9", 1, 2, DT, "a")],
        CLEANED[table].schema,
    )
    lake.write(new, table)
    load = jobs.loader(lake)
    assert rows(load(table), "uid", "paymoney", "dt") == [
        (BIG + 7 - 2**32, "9", DT), (BIG + 7, "2.5", DT), (7, "1.5", DT), (7, None, "20190720"),
    ]
    # pushed down to files of both widths
    assert load(table).where(F.col("uid") == BIG + 7).count() == 1
    assert load(table).where(F.col("uid") == 7).count() == 2
    assert load(table).where(F.col("uid") != 0).count() == 4


def test_an_old_day_of_a_derived_table(spark, lake, rows):
    """A wide member table stored with int ids and without a column that came later."""
    schema = schema_of(spark, "dws_member")
    old = spark.range(1).select(
        *(F.lit(5).alias(f.name) if f.name == "uid" else F.lit(None).cast(f.dataType).alias(f.name)
          for f in schema if f.name not in ("vip_operator", "dt", "dn")),
        F.lit("a").alias("dn"),
    )
    lake.replace_day(old, "dws_member", "20190721")
    today = spark.range(1).select(
        *(F.lit({"uid": BIG, "vip_operator": "o", "dn": "a", "dt": DT}.get(f.name)).cast(f.dataType).alias(f.name)
          for f in schema)
    )
    jobs.store(lake, today, "dws_member", DT)
    assert rows(jobs.loader(lake)("dws_member"), "uid", "vip_operator", "dt") == [(BIG, "o", DT), (5, None, "20190721")]


def test_the_loader_opens_no_file(spark, lake):
    """A folder without a readable file still has its declared columns."""
    path = Path(lake.path("ads_paper_maxdetail")) / f"dt={DT}" / "dn=a"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_bytes(b"no parquet")
    assert jobs.loader(lake)("ads_paper_maxdetail").columns == schema_of(spark, "ads_paper_maxdetail").fieldNames()
