"""Narrow, renamed reads of the stored tables.

A read keeps a table's columns except ``drop`` (or only ``keep``), renames some,
and, where the table has days, filters one day before anything else so that the
filter prunes partitions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money


@dataclass(frozen=True)
class Read:
    table: str
    keep: str = ""
    drop: str = ""
    rename: dict[str, str] = field(default_factory=dict)
    # prefix -> columns that get it
    prefix: dict[str, str] = field(default_factory=dict)
    money: str = ""
    by_day: bool = True

    def apply(self, df: DataFrame, dt: str | None = None) -> DataFrame:
        if self.by_day and dt is not None:
            df = df.where(F.col("dt") == F.lit(dt))
        names = dict(self.rename)
        for head, cols in self.prefix.items():
            names.update({c: f"{head}{c}" for c in cols.split()})
        drop = self.drop.split()
        cols = self.keep.split() or [c for c in df.columns if c not in drop]
        out = df.selectExpr(*(f"`{c}` AS `{names[c]}`" if c in names else f"`{c}`" for c in cols))
        return out.withColumn(self.money, money(F.col(self.money))) if self.money else out


# The columns each read keeps and their new names
READS: dict[str, Read] = {
    # member area
    "member": Read("dwd_member", drop="birthday paymoney", by_day=False),
    "member_regtype": Read(
        "dwd_member_regtype",
        drop="dt",
        rename={"createtime": "reg_createtime", "websiteid": "siteid"},
        by_day=False,
    ),
    "base_ad": Read("dwd_base_ad", rename={"adid": "ad_id"}, by_day=False),
    "base_website": Read(
        "dwd_base_website", prefix={"site_": "delete createtime creator"}, by_day=False
    ),
    "vip_level": Read(
        "dwd_vip_level",
        prefix={
            "vip_": "start_time end_time last_modify_time max_free min_free next_level operator"
        },
        by_day=False,
    ),
    "payments": Read(
        "dwd_pcentermempaymoney", keep="uid paymoney vip_id dn", money="paymoney", by_day=False
    ),
    "member_report": Read(
        "dws_member",
        keep="uid ad_id memberlevel register appregurl regsource regsourcename adname siteid"
        " sitename vip_level paymoney dt dn",
        by_day=False,
    ),
    # exam area, cleaned tables
    "chapter": Read("dwd_qz_chapter", prefix={"chapter_": "creator createtime courseid"}),
    "chapter_list": Read(
        "dwd_qz_chapter_list", keep="chapterlistid chapterlistname chapterallnum dn"
    ),
    "point": Read(
        "dwd_qz_point",
        drop="courseid creator createtime status modifystatus sequence dt",
        prefix={"point_": "score"},
    ),
    "point_question": Read("dwd_qz_point_question", keep="pointid questionid questype dn"),
    "site_course": Read("dwd_qz_site_course", prefix={"sitecourse_": "creator createtime"}),
    "course": Read(
        "dwd_qz_course", keep="courseid majorid coursename isadvc chapterlistid pointlistid dn"
    ),
    "course_edusubject": Read(
        "dwd_qz_course_edusubject", keep="courseeduid edusubjectid courseid dn"
    ),
    "major": Read(
        "dwd_qz_major", drop="columm_sitetype", prefix={"major_": "creator createtime"}
    ),
    "website": Read("dwd_qz_website", drop="sequence status dt"),
    "business": Read("dwd_qz_business", keep="businessid businessname dn"),
    "paper_view": Read("dwd_qz_paper_view", prefix={"paper_view_": "creator createtime"}),
    "center_paper": Read("dwd_qz_center_paper", keep="paperviewid sequence centerid dn"),
    "paper": Read("dwd_qz_paper", drop="status creator createtime dt"),
    "center": Read("dwd_qz_center", drop="openstatus description creator createtime sequence dt"),
    "question": Read("dwd_qz_question"),
    "question_type": Read(
        "dwd_qz_question_type",
        keep="questypeid viewtypename description papertypename remark splitscoretype dn",
    ),
    "answer": Read("dwd_qz_member_paper_question"),
    # exam area, dimensions
    "chapter_dim": Read(
        "dws_qz_chapter",
        drop="showstatus chapter_creator chapter_createtime questionid dt",
        prefix={"chapter_": "sequence status"},
    ),
    "course_dim": Read("dws_qz_course", drop="dt", prefix={"course_": "sequence status"}),
    "major_dim": Read("dws_qz_major", drop="siteid dt", prefix={"major_": "sequence status"}),
    "paper_dim": Read(
        "dws_qz_paper",
        drop="paperdifficult paperuseshow chapterid chapterlistid dt",
        prefix={"paper_": "sequence status stage"},
    ),
    "question_dim": Read(
        "dws_qz_question",
        drop="status optnum viewtypename papertypename remark dt",
        prefix={
            "question_": "parentid content answer analysis limitminute score creator createtime"
            " modifystatus attanswer questag vanalysisaddr difficulty description splitscoretype"
        },
    ),
}


def read(load: Callable[[str], DataFrame], name: str, dt: str | None = None) -> DataFrame:
    """A named read; ``load`` gives the stored table."""
    spec = READS[name]
    return spec.apply(load(spec.table), dt)
