"""Raw logs derived from the driver's tables.

Every log line is a JSON object built by Spark from one row of a whole table.
``RAW`` gives, per cleaned table, the base table, an id column, and an SQL
expression for each raw key that the joins and reports depend on; it is plain
SQL that Spark and DuckDB both accept. A key without an expression gets
``<key> <id>`` when text and the id when a number.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.jsonlines import clean, typed
from ..sources.specs import CLEANED, TableSpec

DT = "20190722"
DAYS = ("20190720", "20190721", "20190722")
SITES = ("web0", "web1")


@dataclass(frozen=True)
class Raw:
    base: str
    id: str
    keys: dict[str, str] = field(default_factory=dict)
    # repeat every row once per website; otherwise ``dn`` is given in keys
    per_site: bool = True

    def expr(self, spec: TableSpec, key: str) -> str:
        if key in self.keys:
            return self.keys[key]
        if key == "dt":
            return f"'{DT}'"
        if key == "dn":
            return "dn"
        kinds = {f.kind for f in spec.fields if f.key == key}
        if kinds & {"i", "d1"}:
            return self.id
        return f"'{key} ' || CAST({self.id} AS STRING)"


# member ids lie beyond the range of int
_UID = "{} + 3000000000"
_MEMBER_SITE = "'web' || CAST({} % 2 AS STRING)"
_SCORE = "CAST(l_quantity * 2 AS DECIMAL(10,2)) - CAST(l_discount * 5 AS DECIMAL(10,2))"

RAW: dict[str, Raw] = {
    "dwd_member": Raw(
        "customer",
        "c_custkey",
        {
            "uid": _UID.format("c_custkey"),
            "ad_id": "CAST(c_nationkey + 2 AS STRING)",
            "fullname": "c_name",
            "memberlevel": "c_mktsegment",
            "phone": "'1' || LPAD(CAST(c_custkey AS STRING), 10, '0')",
            "dn": _MEMBER_SITE.format("c_custkey"),
        },
        per_site=False,
    ),
    "dwd_base_ad": Raw("nation", "n_nationkey + 1", {"adname": "n_name"}),
    "dwd_base_website": Raw(
        "nation", "n_nationkey + 1", {"sitename": "n_name", "delete": "n_regionkey"}
    ),
    "dwd_member_regtype": Raw(
        "orders",
        "o_orderkey",
        {
            "uid": _UID.format("o_custkey"),
            "appregurl": "'url ' || o_orderstatus",
            "createtime": "CAST(o_orderdate AS STRING)",
            "regsource": "SUBSTR(o_orderpriority, 1, 1)",
            "websiteid": "o_custkey % 30 + 1",
            "dn": _MEMBER_SITE.format("o_custkey"),
        },
        per_site=False,
    ),
    "dwd_pcentermempaymoney": Raw(
        "orders",
        "o_orderkey",
        {
            "uid": _UID.format("o_custkey"),
            "paymoney": "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)",
            "vip_id": "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END",
            "dt": "CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN '20190720'"
            " WHEN '2' THEN '20190721' ELSE '20190722' END",
            "dn": _MEMBER_SITE.format("o_custkey"),
        },
        per_site=False,
    ),
    "dwd_vip_level": Raw("region", "r_regionkey + 1", {"vip_level": "r_name"}),
    "dwd_qz_website": Raw("nation", "n_nationkey + 1", {"sitename": "n_name"}),
    "dwd_qz_site_course": Raw("supplier", "s_suppkey", {"sitecoursename": "s_name"}),
    "dwd_qz_question_type": Raw(
        "nation", "n_nationkey + 1", {"questypeid": "n_nationkey + 1", "viewtypename": "n_name"}
    ),
    "dwd_qz_question": Raw(
        "part",
        "p_partkey",
        {
            "questypeid": "p_size % 30 + 1",
            "content": "p_name",
            "score": "CAST(p_retailprice AS DECIMAL(12,2)) / CAST(8 AS DECIMAL(2,0))",
            "splitscore": "CAST(NULL AS DECIMAL(5,2))",
            "difficulty": "p_type",
        },
    ),
    "dwd_qz_point_question": Raw("part", "p_partkey", {"questtype": "p_size"}),
    "dwd_qz_point": Raw(
        "part",
        "p_partkey",
        {
            # two points in each of the lower half of the chapters, none in the rest
            "chapterid": "CAST(FLOOR(p_partkey / 2) AS INT)",
            "pointname": "p_name",
            "score": "CAST(p_retailprice AS DECIMAL(12,2)) - CAST(0.05 AS DECIMAL(4,2))",
        },
    ),
    "dwd_qz_paper_view": Raw(
        "customer",
        "c_custkey",
        {
            "paperid": "CASE WHEN c_acctbal < 0 THEN -1 ELSE c_custkey END",
            "paperviewname": "c_name",
        },
    ),
    "dwd_qz_paper": Raw(
        "customer",
        "c_custkey",
        {"totalscore": "CAST(c_acctbal AS DECIMAL(12,2)) / CAST(8 AS DECIMAL(2,0))"},
    ),
    "dwd_qz_member_paper_question": Raw(
        "lineitem",
        "l_orderkey",
        {
            "userid": _UID.format("l_orderkey"),
            "paperviewid": "l_suppkey",
            "chapterid": "l_partkey",
            "sitecourseid": "l_suppkey",
            "questionid": "l_partkey",
            "majorid": "l_linenumber",
            "useranswer": "l_returnflag",
            "lasttime": "CAST(l_shipdate AS STRING)",
            "paperid": "l_suppkey",
            "spendtime": "l_linenumber * 100 + l_suppkey % 60",
            "score": _SCORE,
            "question_answer": "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END",
            "dn": "CASE l_linestatus WHEN 'O' THEN 'web0' ELSE 'web1' END",
        },
        per_site=False,
    ),
    "dwd_qz_major": Raw(
        "nation", "n_nationkey + 1", {"businessid": "n_regionkey + 1", "majorname": "n_name"}
    ),
    "dwd_qz_course_edusubject": Raw("supplier", "s_suppkey"),
    "dwd_qz_course": Raw("supplier", "s_suppkey", {"coursename": "s_name"}),
    "dwd_qz_chapter_list": Raw("region", "r_regionkey + 1", {"chapterlistname": "r_name"}),
    "dwd_qz_chapter": Raw(
        "part", "p_partkey", {"chapterlistid": "p_partkey % 5 + 1", "chaptername": "p_name"}
    ),
    "dwd_qz_center_paper": Raw("supplier", "s_suppkey", {"centerid": "s_nationkey + 1"}),
    "dwd_qz_center": Raw("nation", "n_nationkey + 1", {"centername": "n_name"}),
    "dwd_qz_business": Raw("region", "r_regionkey + 1", {"businessname": "r_name"}),
}


def _rows(base: DataFrame, table: str) -> DataFrame:
    """The rows behind a log, with its website in the column ``dn``."""
    if not RAW[table].per_site:
        return base
    return base.withColumn("dn", F.explode(F.array(*(F.lit(s) for s in SITES))))


def log_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw log behind a cleaned table. A null key is left out of its line."""
    spec, raw = CLEANED[table], RAW[table]
    rows = _rows(spark.read.parquet(f"{sf_dir}/{raw.base}.parquet"), table)
    keys = rows.selectExpr(*(f"{raw.expr(spec, k)} AS `{k}`" for k in spec.raw_keys))
    return keys.select(F.to_json(F.struct("*")).alias("value"))


# lines that are no JSON object, or more than one; the last two look whole inside a wrapper
DIRTY = (
    '{"uid":1',
    "plain text",
    "",
    "null",
    "[1]",
    '[{"uid":1}]',
    '{"uid":1} {"uid":2}',
    '{"uid":1} trailing',
    '{"uid":1}],"end":1,"o":[{"uid":2}',
    '{"uid":4}],"x":[{"uid":5}',
)


def dirty_log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw log with malformed lines among the good ones."""
    lines = F.explode(F.array(*(F.lit(x) for x in DIRTY))).alias("value")
    return log_lines(spark, sf_dir, table).unionAll(spark.range(1).select(lines))


def write_log(lines: DataFrame, path: str, max_lines: int = 250_000) -> None:
    """Store a log as compressed text, in files of bounded length, as one such file is read by one task."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", max_lines).text(path)


def ingested(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A cleaned table, parsed from the lines of its log."""
    return clean(dirty_log(spark, sf_dir, table), CLEANED[table])


def derived_tables(spark: SparkSession, sf_dir: str):
    """A loader of cleaned tables for the later layers.

    It gives what ``ingested`` gives without writing and parsing text, so that
    pruned columns reach the scan as they do over stored cleaned tables.
    """
    base = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    def load(table: str) -> DataFrame:
        spec, raw = CLEANED[table], RAW[table]
        numbers = [
            f"coalesce(try_cast({raw.expr(spec, f.key)} AS BIGINT), 0) AS `{f.name}`"
            for f in spec.fields
            if f.kind == "i"
        ]
        texts = dict.fromkeys(f.key for f in spec.fields if f.kind != "i")
        texts = [f"CAST({raw.expr(spec, k)} AS STRING) AS `{k}`" for k in texts]
        rows = _rows(base(raw.base), table).selectExpr(*numbers, *texts)
        return typed(rows, spec, ready=("i",))

    return load


_EXPECTED = {
    "i": "COALESCE(TRY_CAST({} AS BIGINT), 0)",
    "s": "CAST({} AS VARCHAR)",
    "d1": "CAST(ROUND(CAST({} AS DECIMAL(28,10)), 1) AS DECIMAL(22,1))",
    "name": "SUBSTR({}, 1, 1) || 'XX'",
    "phone": "SUBSTR({0}, 1, 3) || '*****' || SUBSTR({0}, 8, 4)",
    "secret": "'******'",
    "platform": (
        "CASE {} WHEN '1' THEN 'PC' WHEN '2' THEN 'Mobile' WHEN '3' THEN 'App'"
        " WHEN '4' THEN 'WeChat' ELSE 'other' END"
    ),
}


def cleaned_sql(table: str) -> str:
    """The rows of a cleaned table as DuckDB SQL over the driver's tables."""
    spec, raw = CLEANED[table], RAW[table]
    source = raw.base
    if raw.per_site:
        sites = ", ".join(f"'{s}'" for s in SITES)
        source = f"(SELECT *, UNNEST([{sites}]) AS dn FROM {raw.base})"
    cols = ", ".join(
        _EXPECTED[f.kind].format(f"({raw.expr(spec, f.key)})") + f' AS "{f.name}"'
        for f in spec.fields
    )
    return f"SELECT {cols} FROM {source}"
