"""What stored steps leave on disk."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.checks import layers
from lectern.llm import simhash
from lectern.plans import exams, jobs
from lectern.sources import CLEANED, Lake
from lectern.sources.steps import Relay, Steps, store
from tests.test_exams import DT, load  # noqa: F401

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {Path(f).name for f in files.mkString("\n").splitlines() if Path(f).name.startswith("shuffle_")}


def counted(spark, rows=1000):
    return spark.range(rows).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_a_stored_step_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, None)
    stored = store(counted(spark))
    assert shuffle_files(spark) <= before
    assert stored.agg(F.sum("n")).first()[0] == 1000
    assert spark.conf.get(name, None) == setting


def test_near_dedup_leaves_no_shuffle_files(spark):
    docs = store(spark.createDataFrame([(k, f"a b c d e f {k % 3} g h") for k in range(30)], "doc_id long, text string"))
    before = shuffle_files(spark)
    kept = simhash.keep_one(docs)
    # those of the small counts on the way; every stored step has dropped its own
    left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    assert not left
    assert kept.count() == 3


def test_a_relay_keeps_the_last_step_only(spark):
    step = Relay(spark)
    first = step(counted(spark))
    path = Path(step.last.removeprefix("file:"))
    assert path.exists()
    second = step(first.where("k > 2"))
    assert not path.exists() and second.count() == 4


def test_steps_are_dropped_together(spark):
    with Steps(spark) as step:
        step(counted(spark)).count()
        assert Path(step.root.removeprefix("file:"), "1").exists()
    assert not Path(step.root.removeprefix("file:")).exists()


@pytest.mark.parametrize("answer_grain", [False, True])
def test_whole_answers_are_joined_in_steps(spark, load, rows, answer_grain):  # noqa: F811
    plain = exams.answer_wide(load, DT, answer_grain)
    stored = []
    relay = Relay(spark)

    def step(df):
        stored.append(relay(df))
        return stored[-1]

    before = shuffle_files(spark)
    wide = exams.answer_wide(load, DT, answer_grain, cut_first=True, step=step)
    assert shuffle_files(spark) <= before
    assert wide.columns == plain.columns and rows(wide) == rows(plain) != []
    # questions, courses, papers; chapters and majors are left to the query
    assert len(stored) == 3 and stored[-1].count() == 2
    assert "papername" in stored[-1].columns and "chaptername" not in stored[-1].columns


@pytest.mark.parametrize("name", ["wide_answer", "wide_answer_per_answer"])
def test_wide_answers_leave_one_step(spark, load, rows, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(layers, "_layers", lambda spark, d: load)
    before = shuffle_files(spark)
    wide = layers.QUERIES[name](spark, "")
    assert shuffle_files(spark) <= before
    # of 17 tables the answers and those of questions, courses and papers are in the step
    assert wide._jdf.queryExecution().optimizedPlan().toString().count(f"= {DT})") == 7
    assert rows(wide) == rows(exams.answer_wide(load, DT, name.endswith("per_answer")))


@pytest.mark.parametrize(
    "name, sides", [("dws_qz_chapter", 1), ("dws_qz_course", 0), ("dws_qz_paper", 1), ("dws_qz_question", 1)]
)
def test_sides_that_grow_are_not_broadcast(spark, tmp_path, name, sides):
    """However small their files are: only chapter lists, centers and question types are sent whole."""
    lake = Lake(spark, str(tmp_path))
    for table, spec in CLEANED.items():
        spark.createDataFrame([], spec.schema).write.parquet(lake.path(table))
    plan = exams.DIMENSIONS[name](jobs.loader(lake), DT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == sides


def test_stored_answers_are_not_broadcast(spark, load):  # noqa: F811
    """Files of few bytes can hold very many rows, so a step is never the side that is sent."""
    wide = exams.answer_wide(load, DT, answer_grain=True, cut_first=True, step=Relay(spark))
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "strategy=merge" in plan


def test_reports_keep_rows_in_memory_only(spark):
    with jobs.shared(spark.range(10)) as rows:
        assert rows.count() == 10 and not rows.storageLevel.useDisk and rows.storageLevel.useMemory


def test_lake_writes_leave_no_shuffle_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    before = shuffle_files(spark)
    rows = counted(spark).withColumns({"dt": F.lit(DT), "dn": F.lit("a")})
    lake.write(rows, "t")
    lake.replace_day(rows, "u", DT)
    assert shuffle_files(spark) <= before
    assert lake.read("t").count() == lake.read("u").count() == 7


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
def test_one_raw_log_at_a_time(spark, monkeypatch):
    seen, ingest = [], jobs.ingest

    def watched(lake, raw, tables=None, **options):
        seen.append(len([p for p in Path(raw.removeprefix("file:")).iterdir()]))
        return ingest(lake, raw, tables, **options)

    monkeypatch.setattr(jobs, "ingest", watched)
    assert layers.reports_from_lake(spark, SF).count() > 0
    assert seen == [1] * len(layers.RAW)
