"""Exam area: five dimensions, the wide answer table and its reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import SCORE, SCORE_EDGES, WHOLE, band
from ..operators.joins import growing, if_small, known, one_per_key, small_or_growing
from ..operators.ranking import top_levels
from ..operators.rollups import (
    averages,
    extremes,
    member_counts,
    member_lists,
    packed_lists,
    two_sided,
)
from ..sources.reads import read

Load = Callable[[str], DataFrame]

# Columns of the ranking reports
RANKED_COLUMNS = (
    "userid paperviewid paperviewname chaptername pointname sitecoursename coursename"
    " majorname shortname papername score dt dn"
).split()
PAPER_KEYS = ("paperviewid", "paperviewname", "dt", "dn")


# dimensions


def chapter_dim(load: Load, dt: str) -> DataFrame:
    """Chapter x point x question."""
    return (
        read(load, "chapter", dt)
        .join(known(read(load, "chapter_list", dt), "chapterlistid"), ["chapterlistid", "dn"])
        .join(growing(known(read(load, "point", dt), "chapterid")), ["chapterid", "dn"])
        .join(growing(known(read(load, "point_question", dt), "pointid")), ["pointid", "dn"])
    )


def course_dim(load: Load, dt: str) -> DataFrame:
    """Site course x subject. All three inputs are taken from the day."""
    return (
        read(load, "site_course", dt)
        .join(growing(known(read(load, "course", dt), "courseid")), ["courseid", "dn"])
        .join(growing(known(read(load, "course_edusubject", dt), "courseid")), ["courseid", "dn"])
    )


def major_dim(load: Load, dt: str) -> DataFrame:
    website = read(load, "website", dt).drop("creator", "createtime")
    return (
        read(load, "major", dt)
        .join(known(website, "siteid"), ["siteid", "dn"])
        .join(known(read(load, "business", dt), "businessid"), ["businessid", "dn"])
    )


def paper_dim(load: Load, dt: str) -> DataFrame:
    """Paper views with their paper, and their centers if any."""
    view = read(load, "paper_view", dt).drop("papertype", "downurl")
    # the inner join comes first: it only removes rows, the left joins only add
    return (
        view.join(growing(known(read(load, "paper", dt).drop("chapter"), "paperid")), ["paperid", "dn"])
        .join(growing(known(read(load, "center_paper", dt), "paperviewid")), ["paperviewid", "dn"], "left")
        .join(known(read(load, "center", dt).drop("centerparam"), "centerid"), ["centerid", "dn"], "left")
    )


def question_dim(load: Load, dt: str) -> DataFrame:
    """Questions with the texts of their type, its description included."""
    types = known(read(load, "question_type", dt), "questypeid")
    return read(load, "question", dt).join(types, ["questypeid", "dn"])


DIMENSIONS = {
    "dws_qz_chapter": chapter_dim,
    "dws_qz_course": course_dim,
    "dws_qz_major": major_dim,
    "dws_qz_paper": paper_dim,
    "dws_qz_question": question_dim,
}


# wide answer table


def answer_wide(
    load: Load,
    dt: str,
    answer_grain: bool = False,
    cut_first: bool = False,
    step: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Answers of a day joined to all five dimensions (119 columns).

    The chapter dimension has a row per point and question, so each answer
    appears once per such row. ``answer_grain``, the form that is stored, keeps one
    row per answer, with the first of the points, and ``copies``, the number of
    rows it stands for; the reports count it as that many. ``cut_first`` drops answers
    without a point before any column is added to them, which reads the ids of the chapter
    dimension once more; it is for whole rows, where every shuffle of an answer costs.
    ``step`` stores rows and gives them back: with it the joins with questions, courses and papers
    are a step each, so that no more than one shuffle of whole answers is on disk at a time.
    """
    answers = (
        read(load, "answer", dt)
        .drop("paperid")
        .withColumnRenamed("question_answer", "user_question_answer")
    )
    course = (
        read(load, "course_dim", dt)
        .drop("majorid", "chapterlistid", "pointlistid")
        .withColumnsRenamed(
            {
                "sitecourse_creator": "course_creator",
                "sitecourse_createtime": "course_createtime",
            }
        )
    )
    question = read(load, "question_dim", dt).drop("question_score")
    chapter = read(load, "chapter_dim", dt).drop(
        "chapter_sequence", "chapter_status", "chapter_courseid"
    )
    if answer_grain:
        chapter = one_per_key(chapter, ["chapterid", "dn"], ["pointid"], copies="copies")
    major = read(load, "major_dim", dt)
    paper = read(load, "paper_dim", dt).drop("courseid")
    # what a join adds is moved again by every later one: chapters, which multiply rows, come
    # last, unless there is one row of each, which only removes answers. Courses may be too
    # many to broadcast, so they are met before rows multiply
    papers, chapters = known(paper, "paperviewid"), known(chapter, "chapterid")
    questions, courses = known(question, "questionid"), known(course, "sitecourseid")
    majors = ("majorid", if_small(known(major, "majorid")))
    wide = answers
    if cut_first:
        wide = wide.join(chapters.select("chapterid", "dn"), ["chapterid", "dn"], "left_semi")
    if step is not None:
        # papers, which have the most columns, come last: they are moved once, in their own
        # order, so that answers to one paper lie together and pack well
        for key, side in [
            ("questionid", growing(questions)),
            ("sitecourseid", small_or_growing(courses)),
            ("paperviewid", growing(papers)),
        ]:
            wide = step(wide.join(side, [key, "dn"]))
        sides = [("chapterid", growing(chapters)), majors]
    else:
        sides = [("paperviewid", papers), ("questionid", questions), ("sitecourseid", if_small(courses)), majors]
        sides.insert(0 if answer_grain and not cut_first else 3, ("chapterid", chapters))
    for key, side in sides:
        wide = wide.join(side, [key, "dn"])
    ids = ["majorid", "dn", "sitecourseid", "chapterid", "questionid", "paperviewid"]
    parts = (answers, paper, question, chapter, course, major)
    return wide.select(*dict.fromkeys([*ids, *(c for part in parts for c in part.columns)]))


# reports over the wide answer table


def of_day(wide: DataFrame, dt: str) -> DataFrame:
    return wide.where(F.col("dt") == F.lit(dt))


def score_summary(rows: DataFrame) -> DataFrame:
    """Score histogram per paper view: rows of one score each, how many answers, and their time.

    As every row stands for its ``copies``, averages, extremes and rates of scores, and the
    distinct scores to rank, are those of the answers; it has as many rows as scores differ.
    """
    weight = F.col("copies") if "copies" in rows.columns else F.lit(1)
    return rows.groupBy(*PAPER_KEYS, "score").agg(
        F.sum(weight).cast("long").alias("copies"),
        F.sum(F.col("spendtime").cast(WHOLE) * weight).cast("decimal(38,0)").alias("spend_total"),
        F.sum(F.when(F.col("spendtime").isNotNull(), weight)).cast("long").alias("spend_times"),
    )


def averages_of_summary(summary: DataFrame) -> DataFrame:
    """The rows of ``paper_averages`` from the histogram."""
    return averages(
        summary,
        PAPER_KEYS,
        {"avgscore": ("score", SCORE)},
        {"avgspendtime": ("spend_total", "spend_times", "decimal(12,2)")},
    ).select("paperviewid", "paperviewname", "avgscore", "avgspendtime", "dt", "dn")


def paper_averages(rows: DataFrame, ordered: bool = False) -> DataFrame:
    out = averages(
        rows,
        PAPER_KEYS,
        {"avgscore": ("score", SCORE), "avgspendtime": ("spendtime", "decimal(12,2)")},
    ).select("paperviewid", "paperviewname", "avgscore", "avgspendtime", "dt", "dn")
    return out.orderBy(F.desc("avgscore"), F.desc("avgspendtime")) if ordered else out


def paper_extremes(rows: DataFrame) -> DataFrame:
    return extremes(rows, PAPER_KEYS, "score", "maxscore", "minscore", SCORE).select(
        "paperviewid", "paperviewname", "maxscore", "minscore", "dt", "dn"
    )


def ranked(
    rows: DataFrame,
    best: bool = True,
    n: int = 3,
    by_website: bool = False,
    columns: Sequence[str] = RANKED_COLUMNS,
    points: DataFrame | None = None,
    values: DataFrame | None = None,
) -> DataFrame:
    """Answers with the ``n`` best (or worst) distinct scores of every paper view.

    Rows of one answer each are ranked as they are, and only those that are left
    meet the points of their chapters, read from the chapter dimension. ``values`` is
    the score summary, where there is one.
    """
    keys = ["paperviewid", "dn"] if by_website else ["paperviewid"]
    own = [c for c in columns if points is None or c != "pointname"]
    link = [] if points is None else ["chapterid", "dn"]
    out = top_levels(
        rows.select(*dict.fromkeys([*own, *keys, *link, "score"])), keys, "score", n, best, values=values
    )
    if points is not None:
        out = out.join(known(points.select(*link, "pointname"), "chapterid"), link)
    head = [c for c in columns if c not in ("dt", "dn")]
    return out.select(*head, "rk", *(c for c in ("dt", "dn") if c in columns))


SEGMENT_KEYS = ["paperviewid", "paperviewname", "score_segment", "dt", "dn"]


def banded(rows: DataFrame) -> DataFrame:
    """Rows with their score band; scores outside all bands are in a null band."""
    return rows.withColumn("score_segment", band(F.col("score"), SCORE_EDGES))


def segment_users(rows: DataFrame) -> DataFrame:
    """Users per paper view and score band, one row each, with the number of their answers."""
    return member_counts(banded(rows), SEGMENT_KEYS, "userid").select(
        "paperviewid", "paperviewname", "score_segment", "userid", "copies", "dt", "dn"
    )


def score_segments(rows: DataFrame, buckets: int = 16) -> DataFrame:
    """User ids per paper view and score band as text, in up to ``buckets`` rows a group."""
    lists = member_lists(banded(rows), SEGMENT_KEYS, "userid", "userids", buckets)
    return lists.select(
        "paperviewid", "paperviewname", "score_segment", "part", "userids", "dt", "dn"
    ).orderBy("paperviewid", "score_segment", "dn", "part")


def score_segments_packed(rows: DataFrame, max_bytes: int = 1 << 20) -> DataFrame:
    """User ids per paper view and score band as text, in as many rows of bounded size as it takes."""
    lists = packed_lists(banded(rows), SEGMENT_KEYS, "userid", "userids", max_bytes)
    return lists.select(
        "paperviewid", "paperviewname", "score_segment", "part", "userids", "dt", "dn"
    ).orderBy("paperviewid", "score_segment", "dn", "part")


def pass_rates(
    rows: DataFrame, boundary: str = "service", keep_one_sided: bool = False
) -> DataFrame:
    """Fails, passes and pass rate per paper view.

    ``service``: 0-59 fails, 60 and more passes. ``dao``: 0-60 fails, more than
    60 passes. ``closed``: 0 to below 60 fails, so that no score lies between.
    """
    score = F.col("score")
    failed, passed = {
        "service": (score.between(0, 59), score >= 60),
        "dao": (score.between(0, 60), score > 60),
        "closed": ((score >= 0) & (score < 60), score >= 60),
    }[boundary]
    return two_sided(
        rows,
        PAPER_KEYS,
        ("unpasscount", failed),
        ("passcount", passed),
        rate_of="passcount",
        shared=["paperviewid", "dn"],
        required=["paperviewid", "dn"],
        keep_one_sided=keep_one_sided,
    ).select("paperviewid", "paperviewname", "unpasscount", "passcount", "rate", "dt", "dn")


def question_errors(rows: DataFrame, keep_one_sided: bool = False) -> DataFrame:
    """Wrong and right answers and error rate per question, most errors first."""
    answer = F.col("user_question_answer")
    return (
        two_sided(
            rows,
            ["questionid", "dt", "dn"],
            ("errcount", answer == 0),
            ("rightcount", answer == 1),
            rate_of="errcount",
            required=["questionid", "dn"],
            keep_one_sided=keep_one_sided,
        )
        .select("questionid", "errcount", "rightcount", "rate", "dt", "dn")
        .orderBy(F.desc("errcount"), "questionid", "dn")
    )


# what the reports over the wide answer table read of it
REPORT_COLUMNS = list(
    dict.fromkeys(
        [
            *(c for c in RANKED_COLUMNS if c != "pointname"),
            *("chapterid", "spendtime", "questionid", "user_question_answer", "copies"),
        ]
    )
)


def day_reports(rows: DataFrame, summary: DataFrame, points: DataFrame) -> dict[str, DataFrame]:
    """The reports of a day by table: from the score summary, and from rows of one answer each."""
    return {
        "ads_paper_avgtimeandscore": averages_of_summary(summary),
        "ads_paper_maxdetail": paper_extremes(summary),
        "ads_user_paper_detail": pass_rates(summary),
        "ads_top3_userdetail": ranked(rows, points=points, values=summary),
        "ads_low3_userdetail": ranked(rows, best=False, points=points, values=summary),
        "ads_paper_scoresegment_member": segment_users(rows),
        "ads_paper_scoresegment_user": score_segments_packed(rows),
        "ads_user_question_detail": question_errors(rows),
    }
