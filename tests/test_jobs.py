"""The three layers end to end on logs derived from the driver's smallest tables."""

from pathlib import Path

import pytest

from lectern.checks import layers
from lectern.checks.logs import DAYS, DT, RAW, log_lines
from lectern.plans import jobs
from lectern.sources import CLEANED, Lake
from parity import _rows, _types, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw = root / "raw"
    for name in RAW:
        lines = log_lines(spark, SF, name)
        junk = spark.createDataFrame([('{"uid":',), ("plain",), ("[1]",), ("",)], "value string")
        lines.unionAll(junk).write.text(str(raw / CLEANED[name].log))
    run = ["--lake", str(root / "lake")]
    # each layer twice: a rerun must not change anything
    for _ in range(2):
        jobs.main(["ingest", *run, "--raw", str(raw)])
    lake = Lake(spark, str(root / "lake"))
    for dt in DAYS[:-1]:
        jobs.build_history(lake, dt)
    for _ in range(2):
        jobs.main(["warehouse", *run, "--dt", DT])
        jobs.main(["reports", *run, "--dt", DT])
    return lake


REPORTS = {
    **{t: f"registrations_by_{c}" for t, c in jobs.members.COUNT_REPORTS.items()},
    "ads_register_top3memberpay": "top3_payers",
    "ads_paper_avgtimeandscore": "paper_averages",
    "ads_paper_maxdetail": "paper_extremes",
    "ads_top3_userdetail": "top3_answers",
    "ads_low3_userdetail": "low3_answers",
    "ads_paper_scoresegment_member": "score_segment_users",
    "dws_paper_score": "score_summary",
    "ads_user_paper_detail": "paper_pass_rate_service",
    "ads_user_question_detail": "question_error_rate",
    "dws_member": "wide_member",
    "dws_user_paper_detail": "wide_answer_per_answer",
    **{t: f"dim_{t[7:]}" for t in jobs.exams.DIMENSIONS},
    **{t: f"ingest_{t}" for t in RAW},
}


@pytest.mark.parametrize("stored", REPORTS)
def test_stored_tables(lake, stored):
    got = jobs.loader(lake)(stored).toArrow()
    want = connect(SF).sql(layers.SQL[REPORTS[stored]]).to_arrow_table()
    assert _types(got.schema) == _types(want.schema)
    assert _rows(got) == _rows(want)


def test_stored_history(lake):
    got = jobs.history(lake, DT).toArrow()
    want = connect(SF).sql(layers.SQL["history_merge"]).to_arrow_table()
    assert _rows(got) == _rows(want)


def test_score_segments(lake):
    """The text form fits rows of a mebibyte: the members of each group in one row."""
    whole = lake.read("ads_paper_scoresegment_user").collect()
    users = lake.read("ads_paper_scoresegment_member").collect()
    want = {}
    for r in users:
        want.setdefault((r.paperviewid, r.paperviewname, r.score_segment, r.dn), []).extend([r.userid] * r.copies)
    got = {(r.paperviewid, r.paperviewname, r.score_segment, r.dn): list(map(int, r.userids.split(","))) for r in whole}
    assert got == {k: sorted(v) for k, v in want.items()} and all(r.part == 0 for r in whole)


def test_reports_scan_the_wide_table_once(lake):
    load = jobs.loader(lake)
    wide = jobs.exams.of_day(load("dws_user_paper_detail"), DT).select(*jobs.exams.REPORT_COLUMNS)
    summary = jobs.exams.of_day(load(jobs.SUMMARY), DT)
    points = jobs.read(load, "chapter_dim", DT)
    with jobs.shared(wide) as rows:
        reports = jobs.exams.day_reports(rows, summary, points)
        assert len(reports) == 8
        for table, report in reports.items():
            plan = report._jdf.queryExecution().optimizedPlan()
            leaves = plan.collectLeaves().mkString("|")
            # from the kept columns or the histogram, never from the files of the wide table
            assert "user_question_answer" not in leaves or "InMemoryRelation" in leaves, table
            assert not any("user_question_answer" in x for x in leaves.split("|") if x.startswith("Relation")), table


def test_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["reports", "--lake", "x"])
