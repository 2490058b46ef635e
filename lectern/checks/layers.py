"""The layer jobs over tables ingested from derived logs, and their SQL twins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import close_versions, day_increment, merge_day, merge_history
from ..plans import exams, jobs, members
from ..plans.ingest import members_from_json
from ..session import scratch_dir
from ..sources.jsonlines import rejected
from ..sources.lake import Lake, write_table
from ..sources.reads import READS, read
from ..sources.specs import CLEANED
from ..sources.steps import Relay, store
from .basics import parts_sql, rate_sql
from .logs import (
    DAYS,
    DT,
    RAW,
    SITES,
    cleaned_sql,
    derived_tables,
    dirty_log,
    ingested,
    log_lines,
    write_log,
)

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _layers(spark, sf_dir):
    """Cleaned tables from logs; dimensions and wide tables from those."""
    base = derived_tables(spark, sf_dir)

    def load(table: str) -> DataFrame:
        if table in exams.DIMENSIONS:
            return exams.DIMENSIONS[table](load, DT)
        if table == "dws_member":
            return members.member_wide(load, DT)
        return base(table)

    return load


def _with(sql: str, *tables: str, **ctes: str) -> str:
    """Prefix a query with the cleaned tables it reads and further named queries."""
    named = {t: cleaned_sql(t) for t in tables} | ctes
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in named.items()) + "\n" + sql


def _on(alias: str, other: str, *keys: str) -> str:
    ids = "".join(f" AND {other}.{k} <> 0" for k in keys)
    return " AND ".join(f"{alias}.{k} = {other}.{k}" for k in (*keys, "dn")) + ids


# ingest: one query per cleaned table


def _ingest(table):
    return lambda spark, d: ingested(spark, d, table)


for _table in RAW:
    QUERIES[f"ingest_{_table}"] = _ingest(_table)
    SQL[f"ingest_{_table}"] = cleaned_sql(_table)


def ingest_member_typed(spark, d):
    """The member log written as text and read back through the JSON source."""
    path = scratch_dir(spark)
    log_lines(spark, d, "dwd_member").write.text(path)
    return members_from_json(spark, path)


QUERIES["ingest_member_typed"] = ingest_member_typed
SQL["ingest_member_typed"] = """
    SELECT CAST(c_custkey + 3000000000 AS VARCHAR) AS uid, CAST(c_nationkey + 2 AS VARCHAR) AS ad_id,
        'CXX' AS fullname, c_mktsegment AS memberlevel, '******' AS password,
        '1' || SUBSTR(LPAD(CAST(c_custkey AS VARCHAR), 10, '0'), 1, 2) || '*****'
            || SUBSTR(LPAD(CAST(c_custkey AS VARCHAR), 10, '0'), 8) AS phone,
        '20190722' AS dt, 'web' || CAST(c_custkey % 2 AS VARCHAR) AS dn, """ + ", ".join(
    f"'{k} ' || CAST(c_custkey AS VARCHAR) AS {k}"
    for k in (
        "birthday email iconurl lastlogin mailaddr paymoney qq register regupdatetime"
        " unitname userip zipcode"
    ).split()
) + " FROM customer"


# a line of the answer log in five forms, by the day of the answer: whole, or broken in one of four ways
_BROKEN = {
    "malformed": "SUBSTR(value, 1, LENGTH(value) - 1)",
    "more than one": "value || value",
    "no object": "'[' || value || ']'",
    "blank": "'  '",
}


def rejected_by_reason(spark, d):
    """Lines of the answer log that are no records, by reason; each day of the month breaks them in its way."""
    lines = log_lines(spark, d, "dwd_qz_member_paper_question").withColumn(
        "day", F.expr("CAST(SUBSTR(GET_JSON_OBJECT(value, '$.lasttime'), 9, 2) AS INT)")
    )
    cases = " ".join(f"WHEN day = {k + 1} THEN {x}" for k, x in enumerate(_BROKEN.values()))
    broken = lines.selectExpr(f"CASE {cases} ELSE value END AS value")
    return rejected(broken).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


QUERIES["rejected_by_reason"] = rejected_by_reason
SQL["rejected_by_reason"] = " UNION ALL ".join(
    f"""SELECT '{reason}' AS reason, COUNT(*) AS n FROM lineitem
    WHERE EXTRACT(DAY FROM CAST(l_shipdate AS DATE)) = {k + 1} HAVING COUNT(*) > 0"""
    for k, reason in enumerate(_BROKEN)
)

# sinks


def _partitioned(name: str, append: bool):
    """Store payments by day and website, then store the last day again."""

    def run(spark, d):
        spec = CLEANED["dwd_pcentermempaymoney"]
        rows = derived_tables(spark, d)(spec.name)
        lake = Lake(spark, scratch_dir(spark))
        lake.write(rows, spec.name, rebalance=False)
        lake.write(rows.where(rows.dt == DT), spec.name, append=append)
        return lake.read(spec.name, spec.schema)

    return run


QUERIES["sink_overwrite_touched"] = _partitioned("sink_overwrite_touched", append=False)
SQL["sink_overwrite_touched"] = cleaned_sql("dwd_pcentermempaymoney")
QUERIES["sink_append"] = _partitioned("sink_append", append=True)
SQL["sink_append"] = _with(
    f"SELECT * FROM p UNION ALL SELECT * FROM p WHERE dt = '{DT}'",
    p=cleaned_sql("dwd_pcentermempaymoney"),
)


def sink_append_twice(spark, d):
    """All payments stored, then the last day added as a batch that is sent twice."""
    spec = CLEANED["dwd_pcentermempaymoney"]
    rows = derived_tables(spark, d)(spec.name)
    lake = Lake(spark, scratch_dir(spark))
    lake.append_batch(rows, spec.name, "all days", rebalance=False)
    for _ in range(2):
        lake.append_batch(exams.of_day(rows, DT), spec.name, "last day")
    return lake.read(spec.name, spec.schema)


QUERIES["sink_append_twice"] = sink_append_twice
SQL["sink_append_twice"] = SQL["sink_append"]


def sink_rerun_drops_site(spark, d):
    """All days stored, then the last one again without one of its websites."""
    spec = CLEANED["dwd_pcentermempaymoney"]
    rows = derived_tables(spark, d)(spec.name)
    lake = Lake(spark, scratch_dir(spark))
    for day in DAYS:
        lake.replace_day(exams.of_day(rows, day), spec.name, day)
    lake.replace_day(exams.of_day(rows, DT).where(F.col("dn") == SITES[0]), spec.name, DT)
    return lake.read(spec.name, spec.schema)


QUERIES["sink_rerun_drops_site"] = sink_rerun_drops_site
SQL["sink_rerun_drops_site"] = _with(
    f"SELECT * FROM p WHERE dt <> '{DT}' OR dn = '{SITES[0]}'",
    p=cleaned_sql("dwd_pcentermempaymoney"),
)


def day_filter(spark, d):
    """One day of a stored table; the filter reads only that day's folder."""
    spec = CLEANED["dwd_pcentermempaymoney"]
    path = scratch_dir(spark)
    write_table(derived_tables(spark, d)(spec.name), path)
    return exams.of_day(Lake(spark, path).read("", spec.schema), DT)


QUERIES["day_filter"] = day_filter
SQL["day_filter"] = _with(
    f"SELECT * FROM p WHERE dt = '{DT}'", p=cleaned_sql("dwd_pcentermempaymoney")
)

# dimensions

_CHAPTER = (
    f"""SELECT c.* EXCLUDE (creator, createtime, courseid), c.creator AS chapter_creator,
        c.createtime AS chapter_createtime, c.courseid AS chapter_courseid,
        l.chapterlistname, l.chapterallnum, p.pointid, p.pointname, p.pointyear, p.chapter,
        p.excisenum, p.pointlistid, p.pointdescribe, p.pointlevel, p.typelist,
        p.score AS point_score, p.thought, p.remid, p.pointnamelist, p.typelistids, p.pointlist,
        q.questionid, q.questype
    FROM dwd_qz_chapter c JOIN dwd_qz_chapter_list l ON {_on('c', 'l', 'chapterlistid')}
    JOIN dwd_qz_point p ON {_on('c', 'p', 'chapterid')}
    JOIN dwd_qz_point_question q ON {_on('p', 'q', 'pointid')}"""
)
_COURSE = f"""SELECT s.* EXCLUDE (creator, createtime), s.creator AS sitecourse_creator,
        s.createtime AS sitecourse_createtime, c.majorid, c.coursename, c.isadvc,
        c.chapterlistid, c.pointlistid, e.courseeduid, e.edusubjectid
    FROM dwd_qz_site_course s JOIN dwd_qz_course c ON {_on('s', 'c', 'courseid')}
    JOIN dwd_qz_course_edusubject e ON {_on('c', 'e', 'courseid')}"""
_MAJOR = f"""SELECT m.* EXCLUDE (creator, createtime, columm_sitetype),
        m.creator AS major_creator, m.createtime AS major_createtime, b.businessname,
        w.sitename, w.domain, w.multicastserver, w.templateserver, w.multicastgateway,
        w.multicastport
    FROM dwd_qz_major m JOIN dwd_qz_website w ON {_on('m', 'w', 'siteid')}
    JOIN dwd_qz_business b ON {_on('m', 'b', 'businessid')}"""
_PAPER = f"""SELECT v.* EXCLUDE (creator, createtime, papertype, downurl),
        v.creator AS paper_view_creator, v.createtime AS paper_view_createtime,
        cp.centerid, cp.sequence, c.centername, c.centeryear, c.centertype, c.provideuser,
        c.centerviewtype, c.stage, p.papercatid, p.courseid, p.paperyear, p.suitnum, p.papername,
        p.totalscore, p.chapterid, p.chapterlistid
    FROM dwd_qz_paper_view v LEFT JOIN dwd_qz_center_paper cp ON {_on('v', 'cp', 'paperviewid')}
    LEFT JOIN dwd_qz_center c ON {_on('cp', 'c', 'centerid')}
    JOIN dwd_qz_paper p ON {_on('v', 'p', 'paperid')}"""
_QUESTION = f"""SELECT q.*, t.viewtypename, t.description, t.papertypename, t.remark,
        t.splitscoretype
    FROM dwd_qz_question q JOIN dwd_qz_question_type t ON {_on('q', 't', 'questypeid')}"""

_DIM_SQL = {
    "dws_qz_chapter": (_CHAPTER, "chapter", "chapter_list", "point", "point_question"),
    "dws_qz_course": (_COURSE, "site_course", "course", "course_edusubject"),
    "dws_qz_major": (_MAJOR, "major", "website", "business"),
    "dws_qz_paper": (_PAPER, "paper_view", "center_paper", "center", "paper"),
    "dws_qz_question": (_QUESTION, "question", "question_type"),
}
_INPUTS = {t: [f"dwd_qz_{n}" for n in names] for t, (_, *names) in _DIM_SQL.items()}


def _dim(table):
    return lambda spark, d: _layers(spark, d)(table)


for _table, (_sql, *_names) in _DIM_SQL.items():
    QUERIES[f"dim_{_table[7:]}"] = _dim(_table)
    SQL[f"dim_{_table[7:]}"] = _with(_sql, *_INPUTS[_table])

# wide member table

_MEMBER_INPUTS = (
    "dwd_member", "dwd_member_regtype", "dwd_base_ad", "dwd_base_website",
    "dwd_pcentermempaymoney", "dwd_vip_level",
)
_MEMBER_COLUMNS = """a.ad_id, a.fullname, a.iconurl, a.lastlogin, a.mailaddr, a.memberlevel,
    a.password, a.phone, a.qq, a.register, a.regupdatetime, a.unitname, a.userip, a.zipcode,
    b.appkey, b.appregurl, b.bdp_uuid, b.createtime AS reg_createtime, b.domain, b.isranreg,
    b.regsource, b.regsourcename, c.adname"""
_SITE_COLUMNS = """d.sitename, d.siteurl, d."delete" AS site_delete,
    d.createtime AS site_createtime, d.creator AS site_creator"""
_MEMBER_JOINS = f"""LEFT JOIN dwd_base_ad c ON a.ad_id = c.adid AND a.dn = c.dn
    LEFT JOIN dwd_base_website d ON b.websiteid = d.siteid AND b.dn = d.dn"""
_FIRST_REG = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY uid, dn
    ORDER BY createtime, appkey, appregurl, bdp_uuid) AS rn FROM dwd_member_regtype) WHERE rn = 1"""
_PAID = """SELECT e.uid, e.dn,
        CAST(SUM(CAST(e.paymoney AS DECIMAL(20,4))) AS DECIMAL(38,4)) AS paymoney,
        MIN(f.vip_id) AS vip_id, MAX(f.vip_level) AS vip_level, MIN(f.start_time) AS vip_start_time,
        MAX(f.end_time) AS vip_end_time, MAX(f.last_modify_time) AS vip_last_modify_time,
        ARG_MIN(f.max_free, f.vip_id) AS vip_max_free,
        ARG_MIN(f.min_free, f.vip_id) AS vip_min_free, MAX(f.next_level) AS vip_next_level,
        ARG_MIN(f.operator, f.vip_id) AS vip_operator
    FROM dwd_pcentermempaymoney e
    LEFT JOIN dwd_vip_level f ON e.vip_id = f.vip_id AND e.dn = f.dn GROUP BY e.uid, e.dn"""


def _member_wide_sql(paymoney: str, more: str = "") -> str:
    return f"""SELECT a.uid, a.dt, a.dn, {_MEMBER_COLUMNS}, d.siteid, {_SITE_COLUMNS},
        {paymoney} AS paymoney, e.* EXCLUDE (uid, dn, paymoney)
    FROM dwd_member a LEFT JOIN reg b ON {_on('a', 'b', 'uid')}
    LEFT JOIN paid e ON {_on('a', 'e', 'uid')} {_MEMBER_JOINS} {more}"""


_MEMBER_WIDE = _member_wide_sql("e.paymoney")

QUERIES["wide_member"] = lambda spark, d: members.member_wide(_layers(spark, d), DT)
SQL["wide_member"] = _with(_MEMBER_WIDE, *_MEMBER_INPUTS, reg=_FIRST_REG, paid=_PAID)

QUERIES["wide_member_fan_out"] = lambda spark, d: members.member_wide(
    _layers(spark, d), DT, fan_out=True
)
SQL["wide_member_fan_out"] = _with(
    _member_wide_sql("s.paymoney", f"LEFT JOIN summed s ON {_on('a', 's', 'uid')}"),
    *_MEMBER_INPUTS,
    reg=_FIRST_REG,
    paid=_PAID,
    # the sum over rows that are really joined
    summed=f"""SELECT a.uid, a.dn,
            CAST(SUM(CAST(e.paymoney AS DECIMAL(20,4))) AS DECIMAL(38,4)) AS paymoney
        FROM dwd_member a LEFT JOIN dwd_member_regtype b ON {_on('a', 'b', 'uid')}
        LEFT JOIN dwd_pcentermempaymoney e ON {_on('a', 'e', 'uid')} {_MEMBER_JOINS}
        LEFT JOIN dwd_vip_level f ON e.vip_id = f.vip_id AND e.dn = f.dn GROUP BY a.uid, a.dn""",
)

QUERIES["wide_member_rows"] = lambda spark, d: members.member_rows(_layers(spark, d), DT)
SQL["wide_member_rows"] = _with(
    f"""SELECT a.uid, a.dt, a.dn, {_MEMBER_COLUMNS}, b.websiteid AS siteid, {_SITE_COLUMNS},
        e.paymoney, e.vip_id, f.vip_level,
        f.start_time AS vip_start_time, f.end_time AS vip_end_time,
        f.last_modify_time AS vip_last_modify_time, f.max_free AS vip_max_free,
        f.min_free AS vip_min_free, f.next_level AS vip_next_level, f.operator AS vip_operator
    FROM dwd_member a LEFT JOIN dwd_member_regtype b ON {_on('a', 'b', 'uid')}
    LEFT JOIN e ON {_on('a', 'e', 'uid')} {_MEMBER_JOINS}
    LEFT JOIN dwd_vip_level f ON e.vip_id = f.vip_id AND e.dn = f.dn""",
    *_MEMBER_INPUTS,
    e="""SELECT uid, dn, vip_id,
            CAST(SUM(CAST(paymoney AS DECIMAL(20,4))) AS DECIMAL(38,4)) AS paymoney
        FROM dwd_pcentermempaymoney GROUP BY uid, dn, vip_id""",
)

# member reports

_REPORT_ROWS = {"reg": _FIRST_REG, "paid": _PAID, "w": _MEMBER_WIDE}


def _member_report(plan):
    return lambda spark, d: plan(members.report_rows(_layers(spark, d), DT))


def _registrations(column):
    return _member_report(lambda rows: members.registrations_by(rows, column))


for _column in members.COUNT_REPORTS.values():
    QUERIES[f"registrations_by_{_column}"] = _registrations(_column)
    SQL[f"registrations_by_{_column}"] = _with(
        f"SELECT {_column}, COUNT(uid) AS num, dt, dn FROM w GROUP BY {_column}, dn, dt",
        *_MEMBER_INPUTS,
        **_REPORT_ROWS,
    )



def _top_payers_sql(columns: str) -> str:
    return _with(
        f"""SELECT * FROM (SELECT {columns}, dn,
            paymoney,
            CAST(ROW_NUMBER() OVER (PARTITION BY dn, memberlevel
                ORDER BY paymoney DESC NULLS LAST, uid)
                AS INTEGER) AS rownum
        FROM w) WHERE rownum < 4""",
        *_MEMBER_INPUTS,
        **_REPORT_ROWS,
    )


QUERIES["top3_payers"] = _member_report(members.top_payers)
SQL["top3_payers"] = _top_payers_sql(
    "uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level, dt"
)
# the wider form of the report
_WIDER = (
    "uid ad_id memberlevel register appregurl regsource regsourcename adname siteid sitename"
    " vip_level"
).split()
QUERIES["top3_payers_wider"] = _member_report(
    lambda rows: members.top_payers(rows, columns=[*_WIDER, "paymoney", "rownum", "dn"])
)
SQL["top3_payers_wider"] = _top_payers_sql(", ".join(_WIDER))

# history of payments

_MONEY = "CAST(SUM(CAST(e.paymoney AS DECIMAL(20,4))) AS DECIMAL(38,4))"
_DAY = "SUBSTR(e.dt, 1, 4) || '-' || SUBSTR(e.dt, 5, 2) || '-' || SUBSTR(e.dt, 7, 2)"
_INCREMENTS = f"""SELECT e.uid, e.dn, {_MONEY} AS paymoney, MAX(f.vip_level) AS vip_level,
        {_DAY} AS start_time
    FROM dwd_pcentermempaymoney e JOIN dwd_vip_level f ON e.vip_id = f.vip_id AND e.dn = f.dn
    GROUP BY e.uid, e.dn, e.dt"""
_HISTORY_SQL = _with(
    """SELECT uid, CAST(SUM(paymoney) OVER v AS DECIMAL(38,4)) AS paymoney, vip_level, start_time,
        COALESCE(LEAD(start_time) OVER v, '9999-12-31') AS end_time, dn
    FROM i WINDOW v AS (PARTITION BY uid, dn ORDER BY start_time)""",
    "dwd_pcentermempaymoney",
    "dwd_vip_level",
    i=_INCREMENTS,
)


def _increments(spark, d):
    load = derived_tables(spark, d)
    payments, vip = load("dwd_pcentermempaymoney"), load("dwd_vip_level")
    return {dt: day_increment(payments, vip, dt) for dt in DAYS}


def history_merge(spark, d):
    """Three days merged one after another."""
    first, *later = _increments(spark, d).items()
    return reduce(lambda h, day: merge_history(h, day[1], day[0]), later, first[1])


def history_rerun(spark, d):
    """The same, with the last day merged a second time."""
    days = _increments(spark, d)
    return merge_history(history_merge(spark, d), days[DT], DT)


def history_window(spark, d):
    """The same through windows over all versions of a key."""
    first, *later = _increments(spark, d).values()
    return reduce(lambda h, day: close_versions(h.unionByName(day)), later, first)


def history_from_empty(spark, d):
    """The first day of a history: nothing is open before it."""
    day = _increments(spark, d)[DT]
    return merge_day(spark.createDataFrame([], day.schema), day)


for _name, _query in {
    "history_merge": history_merge,
    "history_rerun": history_rerun,
    "history_window": history_window,
}.items():
    QUERIES[_name] = _query
    SQL[_name] = _HISTORY_SQL



def history_null_payment(spark, d):
    """Three days, with unreadable payments among those of the second."""
    load = derived_tables(spark, d)
    bad = (F.col("dt") == DAYS[1]) & (F.col("uid") % 3 == 0)
    payments = load("dwd_pcentermempaymoney").withColumn(
        "paymoney", F.when(bad, "n/a").otherwise(F.col("paymoney"))
    )
    merged = spark.createDataFrame([], day_increment(payments, load("dwd_vip_level"), DT).schema)
    for day in DAYS:
        merged = merge_history(merged, day_increment(payments, load("dwd_vip_level"), day), day)
    return merged


QUERIES["history_null_payment"] = history_null_payment
SQL["history_null_payment"] = _HISTORY_SQL.replace(
    "CAST(SUM(CAST(e.paymoney AS DECIMAL(20,4))) AS DECIMAL(38,4))",
    f"""CAST(COALESCE(SUM(CASE WHEN e.dt = '{DAYS[1]}' AND e.uid % 3 = 0 THEN NULL
        ELSE CAST(e.paymoney AS DECIMAL(20,4)) END), 0) AS DECIMAL(38,4))""",
)


def history_corrected_day(spark, d):
    """The stored history after the second day was run with wrong payments and put right."""
    load = derived_tables(spark, d)
    table = "dwd_pcentermempaymoney"
    lake = Lake(spark, scratch_dir(spark))
    lake.write(load("dwd_vip_level"), "dwd_vip_level", CLEANED["dwd_vip_level"].partitions)
    payments = load(table)
    # a large log, written without a shuffle as the ingest job does
    lake.write(payments, table, rebalance=False)
    wrong = exams.of_day(payments, DAYS[1]).withColumn("uid", F.col("uid") + 1)
    lake.replace_day(wrong, table, DAYS[1])
    for day in DAYS:
        jobs.build_history(lake, day)
    lake.replace_day(exams.of_day(payments, DAYS[1]), table, DAYS[1])
    for day in DAYS[1:]:
        jobs.build_history(lake, day)
    return jobs.history(lake, DT)


def history_snapshots(spark, d):
    """The stored history with a snapshot after each day, of which the last day is run again."""
    load = derived_tables(spark, d)
    lake = Lake(spark, scratch_dir(spark))
    lake.write(load("dwd_vip_level"), "dwd_vip_level", CLEANED["dwd_vip_level"].partitions)
    # a large log, written without a shuffle as the ingest job does
    lake.write(load("dwd_pcentermempaymoney"), "dwd_pcentermempaymoney", rebalance=False)
    for day in [*DAYS, DAYS[-1]]:
        jobs.build_history(lake, day, snapshot_every=1)
    return jobs.history(lake, DT)


QUERIES["history_snapshots"] = history_snapshots
SQL["history_snapshots"] = _HISTORY_SQL
QUERIES["history_corrected_day"] = history_corrected_day
SQL["history_corrected_day"] = _HISTORY_SQL

_DAY_SQL = _with(
    """SELECT uid, paymoney, vip_level, start_time, '9999-12-31' AS end_time, dn FROM i
    WHERE start_time = '2019-07-22'""",
    "dwd_pcentermempaymoney",
    "dwd_vip_level",
    i=_INCREMENTS,
)
QUERIES["history_day"] = lambda spark, d: _increments(spark, d)[DT]
SQL["history_day"] = _DAY_SQL
QUERIES["history_from_empty"] = history_from_empty
SQL["history_from_empty"] = _DAY_SQL

# wide answer table

_ANSWER_INPUTS = ("dwd_qz_member_paper_question", *dict.fromkeys(sum(_INPUTS.values(), [])))
_DIM_CTES = {t: sql for t, (sql, *_) in _DIM_SQL.items()}


def _answers_sql(chapter: str) -> str:
    return f"""SELECT a.* EXCLUDE (paperid, question_answer),
        a.question_answer AS user_question_answer,
        s.* EXCLUDE (sitecourseid, sequence, status, sitecourse_creator, sitecourse_createtime,
            majorid, chapterlistid, pointlistid, dt, dn),
        s.sequence AS course_sequence, s.status AS course_status,
        s.sitecourse_creator AS course_creator, s.sitecourse_createtime AS course_createtime,
        m.* EXCLUDE (majorid, siteid, sequence, status, dt, dn),
        m.sequence AS major_sequence, m.status AS major_status,
        p.* EXCLUDE (paperviewid, sequence, status, stage, paperdifficult, paperuseshow, chapterid,
            chapterlistid, courseid, dt, dn),
        p.sequence AS paper_sequence, p.status AS paper_status, p.stage AS paper_stage,
        q.questypeid, q.quesviewtype, q.splitscore, q.lecture, q.quesskill, q.vdeoaddr,
        q.parentid AS question_parentid, q.content AS question_content,
        q.answer AS question_answer, q.analysis AS question_analysis,
        q.limitminute AS question_limitminute, q.creator AS question_creator,
        q.createtime AS question_createtime, q.modifystatus AS question_modifystatus,
        q.attanswer AS question_attanswer, q.questag AS question_questag,
        q.vanalysisaddr AS question_vanalysisaddr, q.difficulty AS question_difficulty,
        q.description AS question_description, q.splitscoretype AS question_splitscoretype,
        c.* EXCLUDE (chapterid, sequence, status, showstatus, chapter_creator, chapter_createtime,
            chapter_courseid, questionid, dt, dn)
    FROM dwd_qz_member_paper_question a
    JOIN dws_qz_course s ON {_on('a', 's', 'sitecourseid')}
    JOIN dws_qz_major m ON {_on('a', 'm', 'majorid')}
    JOIN dws_qz_paper p ON {_on('a', 'p', 'paperviewid')}
    JOIN dws_qz_question q ON {_on('a', 'q', 'questionid')}
    JOIN {chapter} c ON {_on('a', 'c', 'chapterid')}"""


QUERIES["wide_answer"] = lambda spark, d: exams.answer_wide(
    _layers(spark, d), DT, cut_first=True, step=Relay(spark)
)
SQL["wide_answer"] = _with(_answers_sql("dws_qz_chapter"), *_ANSWER_INPUTS, **_DIM_CTES)

QUERIES["wide_answer_per_answer"] = lambda spark, d: exams.answer_wide(
    _layers(spark, d), DT, answer_grain=True, cut_first=True, step=Relay(spark)
)
SQL["wide_answer_per_answer"] = _with(
    _answers_sql("one_chapter"),
    *_ANSWER_INPUTS,
    **_DIM_CTES,
    one_chapter="""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY chapterid, dn ORDER BY pointid) AS rn,
        COUNT(*) OVER (PARTITION BY chapterid, dn) AS copies FROM dws_qz_chapter) WHERE rn = 1""",
)

# exam reports


def _exam_report(plan):
    """A report over rows of one answer each, as stored; its SQL reads all copies."""
    return lambda spark, d: plan(exams.answer_wide(_layers(spark, d), DT, answer_grain=True))


def _stored_answers(spark, load, columns: Sequence[str]) -> DataFrame:
    """Rows of one answer each, stored with the columns that a report reads, as it reads them twice."""
    return store(exams.answer_wide(load, DT, answer_grain=True).select(*columns))


def _ranked(**options):
    def run(spark, d):
        load = _layers(spark, d)
        points = read(load, "chapter_dim", DT)
        columns = options.get("columns", exams.RANKED_COLUMNS)
        read_ = [*(c for c in columns if c != "pointname"), "paperviewid", "dn", "chapterid", "score"]
        rows = _stored_answers(spark, load, list(dict.fromkeys(read_)))
        return exams.ranked(rows, points=points, **options)

    return run


def _exam_sql(sql: str, **ctes: str) -> str:
    return _with(
        sql, *_ANSWER_INPUTS, **_DIM_CTES, w=_answers_sql("dws_qz_chapter"), **ctes
    )


_AVERAGES = _exam_sql(
    """SELECT paperviewid, paperviewname,
        -- five decimals first, as an average of one-decimal scores is kept, then one
        CAST(((SUM(CAST(score * 10 AS BIGINT))::BIGINT * 20000 + COUNT(score))
            // (2 * COUNT(score)) + 5000) // 10000 / 10.0 AS DECIMAL(22,1)) AS avgscore,
        CAST((SUM(spendtime)::BIGINT * 200 + COUNT(*)) // (2 * COUNT(*)) / 100.0
            AS DECIMAL(12,2)) AS avgspendtime, dt, dn
    FROM w GROUP BY paperviewid, paperviewname, dt, dn"""
)
QUERIES["paper_averages"] = _exam_report(exams.paper_averages)
SQL["paper_averages"] = _AVERAGES
QUERIES["paper_averages_sorted"] = _exam_report(lambda w: exams.paper_averages(w, ordered=True))
SQL["paper_averages_sorted"] = _AVERAGES

QUERIES["paper_extremes"] = _exam_report(exams.paper_extremes)
SQL["paper_extremes"] = _exam_sql(
    """SELECT paperviewid, paperviewname, CAST(MAX(score) AS DECIMAL(22,1)) AS maxscore,
        CAST(MIN(score) AS DECIMAL(22,1)) AS minscore, dt, dn
    FROM w GROUP BY paperviewid, paperviewname, dt, dn"""
)


def _ranked_sql(
    order: str, keys: str = "paperviewid", columns: Sequence[str] = exams.RANKED_COLUMNS
) -> str:
    return _exam_sql(
        f"""SELECT * FROM (SELECT {', '.join(columns)},
            CAST(DENSE_RANK() OVER (PARTITION BY {keys} ORDER BY score {order}) AS INTEGER) AS rk
        FROM w) WHERE rk < 4"""
    )


QUERIES["top3_answers"] = _ranked()
SQL["top3_answers"] = _ranked_sql("DESC NULLS LAST")
QUERIES["low3_answers"] = _ranked(best=False)
SQL["low3_answers"] = _ranked_sql("ASC NULLS FIRST")
QUERIES["top3_answers_by_website"] = _ranked(by_website=True)
SQL["top3_answers_by_website"] = _ranked_sql("DESC NULLS LAST", "paperviewid, dn")
# the form of the report that names the site and not the paper view
_WITH_SITE = [c for c in exams.RANKED_COLUMNS if c != "paperviewid"] + ["sitename"]
QUERIES["low3_answers_with_site"] = _ranked(best=False, columns=_WITH_SITE)
SQL["low3_answers_with_site"] = _ranked_sql("ASC NULLS FIRST", columns=_WITH_SITE)

_BANDED = """SELECT paperviewid, paperviewname, userid, dt, dn, CASE
        WHEN score >= 0 AND score <= 20 THEN '0-20' WHEN score > 20 AND score <= 40 THEN '20-40'
        WHEN score > 40 AND score <= 60 THEN '40-60' WHEN score > 60 AND score <= 80 THEN '60-80'
        WHEN score > 80 AND score <= 100 THEN '80-100' END AS score_segment FROM w"""


def _segments(buckets):
    return _exam_report(lambda w: exams.score_segments(w, buckets))


QUERIES["score_segment_users"] = _exam_report(exams.segment_users)
SQL["score_segment_users"] = _exam_sql(
    f"""SELECT paperviewid, paperviewname, score_segment, userid, COUNT(*) AS copies, dt, dn
    FROM ({_BANDED}) GROUP BY paperviewid, paperviewname, score_segment, userid, dt, dn"""
)
for _name, _size in {"score_segments": 16, "score_segments_parts": 3}.items():
    QUERIES[_name] = _segments(_size)
    SQL[_name] = _exam_sql(
        parts_sql(
            _BANDED, "paperviewid, paperviewname, score_segment, dt, dn", "userid", "userids", _size
        )
    )

_SEGMENT = "paperviewid, paperviewname, score_segment, dt, dn"
SEGMENT_BYTES = 256

QUERIES["score_segments_packed"] = _exam_report(
    lambda w: exams.score_segments_packed(w, SEGMENT_BYTES)
)
SQL["score_segments_packed"] = _exam_sql(
    f"""SELECT * FROM filled UNION ALL BY NAME
    SELECT {_SEGMENT}, CAST(0 AS INTEGER) AS part, '' AS userids
    FROM banded GROUP BY {_SEGMENT} HAVING COUNT(userid) = 0""",
    banded=_BANDED,
    counted=f"""SELECT {_SEGMENT}, userid, COUNT(*) AS n, LENGTH(CAST(userid AS VARCHAR)) + 1 AS size
        FROM banded WHERE userid IS NOT NULL GROUP BY {_SEGMENT}, userid""",
    places=f"""SELECT *, COALESCE(SUM(n * size) OVER (PARTITION BY {_SEGMENT} ORDER BY userid
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM counted""",
    every="SELECT *, UNNEST(GENERATE_SERIES(0, n - 1)) AS k FROM places",
    filled=f"""SELECT {_SEGMENT}, CAST((start + k * size) // {SEGMENT_BYTES} AS INTEGER) AS part,
        STRING_AGG(CAST(userid AS VARCHAR), ',' ORDER BY userid) AS userids
        FROM every GROUP BY ALL""",
)

# the score histogram, and the reports that come from it

QUERIES["score_summary"] = _exam_report(exams.score_summary)
SQL["score_summary"] = _exam_sql(
    """SELECT paperviewid, paperviewname, dt, dn, score, COUNT(*) AS copies,
        CAST(SUM(spendtime) AS DECIMAL(38,0)) AS spend_total, CAST(COUNT(spendtime) AS BIGINT) AS spend_times
    FROM w GROUP BY paperviewid, paperviewname, dt, dn, score"""
)


def _of_summary(plan):
    return _exam_report(lambda w: plan(exams.score_summary(w)))


QUERIES["paper_averages_summary"] = _of_summary(exams.averages_of_summary)
SQL["paper_averages_summary"] = _AVERAGES
QUERIES["paper_extremes_summary"] = _of_summary(exams.paper_extremes)
SQL["paper_extremes_summary"] = SQL["paper_extremes"]


def top3_answers_summary(spark, d):
    load = _layers(spark, d)
    rows = _stored_answers(spark, load, exams.REPORT_COLUMNS)
    points = read(load, "chapter_dim", DT)
    return exams.ranked(rows, points=points, values=exams.score_summary(rows))


QUERIES["top3_answers_summary"] = top3_answers_summary
SQL["top3_answers_summary"] = SQL["top3_answers"]

_FAIL_PASS = {
    "service": ("score BETWEEN 0 AND 59", "score >= 60"),
    "dao": ("score BETWEEN 0 AND 60", "score > 60"),
    "closed": ("score >= 0 AND score < 60", "score >= 60"),
}


def _pass_rates(boundary):
    return _exam_report(lambda w: exams.pass_rates(w, boundary))


QUERIES["paper_pass_rate_summary"] = _of_summary(exams.pass_rates)
for _name, (_low, _high) in _FAIL_PASS.items():
    QUERIES[f"paper_pass_rate_{_name}"] = _pass_rates(_name)
    SQL[f"paper_pass_rate_{_name}"] = _exam_sql(
        f"""SELECT paperviewid, paperviewname, unpasscount, passcount,
            {rate_sql('passcount', 'unpasscount + passcount')} AS rate, dt, dn
        FROM (SELECT paperviewid, paperviewname, COUNT(*) AS unpasscount, dt, dn FROM w
            WHERE {_low} GROUP BY paperviewid, paperviewname, dt, dn)
        JOIN (SELECT paperviewid, COUNT(*) AS passcount, dn FROM w WHERE {_high}
            GROUP BY paperviewid, dn) USING (paperviewid, dn)"""
    )

SQL["paper_pass_rate_summary"] = SQL["paper_pass_rate_service"]

QUERIES["question_error_rate"] = _exam_report(exams.question_errors)
SQL["question_error_rate"] = _exam_sql(
    f"""SELECT questionid, errcount, rightcount,
        {rate_sql('errcount', 'errcount + rightcount')} AS rate, dt, dn
    FROM (SELECT questionid, COUNT(*) AS errcount, dt, dn FROM w
        WHERE user_question_answer = 0 GROUP BY questionid, dt, dn)
    JOIN (SELECT questionid, COUNT(*) AS rightcount, dn FROM w
        WHERE user_question_answer = 1 GROUP BY questionid, dn) USING (questionid, dn)"""
)
QUERIES["question_error_rate_all"] = _exam_report(
    lambda w: exams.question_errors(w, keep_one_sided=True)
)
SQL["question_error_rate_all"] = _exam_sql(
    f"""SELECT *, {rate_sql('errcount', 'errcount + rightcount')} AS rate
    FROM (SELECT questionid, COUNT(*) FILTER (user_question_answer = 0) AS errcount,
            COUNT(*) FILTER (user_question_answer = 1) AS rightcount, dt, dn FROM w
        WHERE user_question_answer IN (0, 1) GROUP BY questionid, dt, dn)"""
)



def reports_from_lake(spark, d):
    """From raw logs through the stored layers to the pass rates, as the jobs run.

    Each log is dropped once its table is stored, so that one of them is on disk at a time.
    """
    lake = Lake(spark, scratch_dir(spark))
    raw = f"{lake.root}/raw"
    for table in RAW:
        write_log(dirty_log(spark, d, table), f"{raw}/{CLEANED[table].log}")
        jobs.ingest(lake, raw, [table])
        lake.drop("raw")
    jobs.build_dimensions(lake, DT)
    jobs.build_answers(lake, DT)
    jobs.exam_reports(lake, DT)
    return jobs.loader(lake)("ads_user_paper_detail")


QUERIES["reports_from_lake"] = reports_from_lake
SQL["reports_from_lake"] = SQL["paper_pass_rate_service"]

# reads: every narrow read over its derived table

_SOURCE_SQL = {
    **{t: ([], cleaned_sql(t)) for t in RAW},
    **{t: (_INPUTS[t], sql) for t, sql in _DIM_CTES.items()},
}


def _named_read(name):
    return lambda spark, d: read(_layers(spark, d), name, DT)


def _read_sql(name: str) -> str:
    spec = READS[name]
    names = dict(spec.rename)
    for head, cols in spec.prefix.items():
        names.update({c: head + c for c in cols.split()})
    if spec.keep:
        cols = ", ".join(
            f'CAST({c} AS DECIMAL(20,4)) AS {c}' if c == spec.money
            else f'"{c}" AS {names.get(c, c)}'
            for c in spec.keep.split()
        )
    else:
        gone = [*spec.drop.split(), *names]
        star = f"* EXCLUDE ({', '.join(chr(34) + c + chr(34) for c in gone)})" if gone else "*"
        cols = ", ".join([star, *(f'"{c}" AS {n}' for c, n in names.items())])
    if spec.table == "dws_member":
        return _with(
            f"SELECT {cols} FROM w",
            *_MEMBER_INPUTS,
            **_REPORT_ROWS,
        )
    inputs, sql = _SOURCE_SQL[spec.table]
    return _with(f"SELECT {cols} FROM source", *inputs, source=sql)


for _name in READS:
    QUERIES[f"read_{_name}"] = _named_read(_name)
    SQL[f"read_{_name}"] = _read_sql(_name)
