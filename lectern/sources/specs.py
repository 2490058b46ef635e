"""Table specs: the columns of every stored table and how a raw log fills them.

A field is written ``name:kind`` or ``rawkey>name:kind``. Kinds of raw fields:
``i`` whole number (missing becomes 0), ``s`` text, ``d1`` score with one
decimal place, ``name`` / ``phone`` / ``secret`` masked text, ``platform`` a
label derived from a code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {"i": T.LongType(), "d1": T.DecimalType(22, 1)}


@dataclass(frozen=True)
class Field:
    key: str
    name: str
    kind: str

    @classmethod
    def parse(cls, text: str) -> Field:
        left, kind = text.rsplit(":", 1)
        key, _, name = left.partition(">")
        return cls(key, name or key, kind)

    @property
    def data_type(self) -> T.DataType:
        return TYPES.get(self.kind, T.StringType())


@dataclass(frozen=True)
class TableSpec:
    name: str
    log: str
    fields: tuple[Field, ...]
    partitions: tuple[str, ...] = ("dt", "dn")
    # True for a log whose volume grows with use; it is written as scanned
    large: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type) for f in self.fields])

    @property
    def raw_keys(self) -> list[str]:
        return list(dict.fromkeys(f.key for f in self.fields))


def _spec(name: str, log: str, text: str, **kw) -> TableSpec:
    return TableSpec(name, log, tuple(Field.parse(w) for w in text.split()), **kw)


# Table names, log names and columns
_ALL = [
    _spec(
        "dwd_member", "member.log",
        "uid:i ad_id:i birthday:s email:s fullname:name iconurl:s lastlogin:s mailaddr:s"
        " memberlevel:s password:secret paymoney:s phone:phone qq:s register:s"
        " regupdatetime:s unitname:s userip:s zipcode:s dt:s dn:s",
        large=True,
    ),
    _spec("dwd_base_ad", "baseadlog.log", "adid:i adname:s dn:s", partitions=("dn",)),
    _spec(
        "dwd_base_website", "baswewebsite.log",
        "siteid:i sitename:s siteurl:s delete:i createtime:s creator:s dn:s",
        partitions=("dn",),
    ),
    _spec(
        "dwd_member_regtype", "memberRegtype.log",
        "uid:i appkey:s appregurl:s bdp_uuid:s createtime:s webA>domain:s isranreg:s"
        " regsource:s regsource>regsourcename:platform websiteid:i dt:s dn:s",
        large=True,
    ),
    _spec(
        "dwd_pcentermempaymoney", "pcentermempaymoney.log",
        "uid:i paymoney:s siteid>site_id:i vip_id:i dt:s dn:s",
        large=True,
    ),
    _spec(
        "dwd_vip_level", "pcenterMemViplevel.log",
        "vip_id:i vip_level:s start_time:s end_time:s last_modify_time:s max_free:s"
        " min_free:s next_level:s operator:s dn:s",
        partitions=("dn",),
    ),
    _spec(
        "dwd_qz_website", "QzWebsite.log",
        "siteid:i sitename:s domain:s sequence:s multicastserver:s templateserver:s"
        " status:s creator:s createtime:s multicastgateway:s multicastport:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_site_course", "QzSiteCourse.log",
        "sitecourseid:i siteid:i courseid:i sitecoursename:s coursechapter:s sequence:s"
        " status:s creator:s createtime:s helppaperstatus:s servertype:s boardid:i"
        " showstatus:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_question_type", "QzQuestionType.log",
        "quesviewtype:i viewtypename:s questypeid:i description:s status:s creator:s"
        " createtime:s papertypename:s sequence:s remark:s splitscoretype:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_question", "QzQuestion.log",
        "questionid:i parentid:i questypeid:i quesviewtype:i content:s answer:s analysis:s"
        " limitminute:s score:d1 splitscore:d1 status:s optnum:i lecture:s creator:s"
        " createtime:s modifystatus:s attanswer:s questag:s vanalysisaddr:s difficulty:s"
        " quesskill:s vdeoaddr:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_point_question", "QzPointQuestion.log",
        "pointid:i questionid:i questtype>questype:i creator:s createtime:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_point", "QzPoint.log",
        "pointid:i courseid:i pointname:s pointyear:s chapter:s creator:s createtime:s"
        " status:s modifystatus:s excisenum:i pointlistid:i chapterid:i sequence:s"
        " pointdescribe:s pointlevel:s typelist:s score:d1 thought:s remid:s"
        " pointnamelist:s typelistids:s pointlist:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_paper_view", "QzPaperView.log",
        "paperviewid:i paperid:i paperviewname:s paperparam:s openstatus:s explainurl:s"
        " iscontest:s contesttime:s conteststarttime:s contestendtime:s contesttimelimit:s"
        " dayiid:i status:s creator:s createtime:s paperviewcatid:i modifystatus:s"
        " description:s papertype:s downurl:s paperuse:s paperdifficult:s testreport:s"
        " paperuseshow:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_paper", "QzPaper.log",
        "paperid:i papercatid:i courseid:i paperyear:s chapter:s suitnum:s papername:s"
        " status:s creator:s createtime:s totalscore:d1 chapterid:i chapterlistid:i dt:s dn:s",
    ),
    _spec(
        "dwd_qz_member_paper_question", "QzMemberPaperQuestion.log",
        "userid:i paperviewid:i chapterid:i sitecourseid:i questionid:i majorid:i"
        " useranswer:s istrue:s lasttime:s opertype:s paperid:i spendtime:i score:d1"
        " question_answer:i dt:s dn:s",
        large=True,
    ),
    _spec(
        "dwd_qz_major", "QzMajor.log",
        "majorid:i businessid:i siteid:i majorname:s shortname:s status:s sequence:s"
        " creator:s createtime:s columm_sitetype:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_course_edusubject", "QzCourseEduSubject.log",
        "courseeduid:i edusubjectid:i courseid:i creator:s createtime:s majorid:i dt:s dn:s",
    ),
    _spec(
        "dwd_qz_course", "QzCourse.log",
        "courseid:i majorid:i coursename:s coursechapter:s sequnece>sequence:s isadvc:s"
        " creator:s createtime:s status:s chapterlistid:i pointlistid:i dt:s dn:s",
    ),
    _spec(
        "dwd_qz_chapter_list", "QzChapterList.log",
        "chapterlistid:i chapterlistname:s courseid:i chapterallnum:i sequence:s status:s"
        " creator:s createtime:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_chapter", "QzChapter.log",
        "chapterid:i chapterlistid:i chaptername:s sequence:s showstatus:s status:s"
        " creator:s createtime:s courseid:i chapternum:i outchapterid:i dt:s dn:s",
    ),
    _spec(
        "dwd_qz_center_paper", "QzCenterPaper.log",
        "paperviewid:i centerid:i openstatus:s sequence:s creator:s createtime:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_center", "QzCenter.log",
        "centerid:i centername:s centeryear:s centertype:s openstatus:s centerparam:s"
        " description:s creator:s createtime:s sequence:s provideuser:s centerviewtype:s"
        " stage:s dt:s dn:s",
    ),
    _spec(
        "dwd_qz_business", "QzBusiness.log",
        "businessid:i businessname:s sequence:s status:s creator:s createtime:s siteid:i"
        " dt:s dn:s",
    ),
]

CLEANED: dict[str, TableSpec] = {s.name: s for s in _ALL}
