"""The operators on the driver's own columns: Spark queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import band, label, mask_name, mask_phone, round_score, whole_number
from ..functions.columns import PASSWORD_MASK
from ..operators.ranking import top_levels, top_rows
from ..operators.rollups import averages, count_by, extremes, member_lists, two_sided
from ..sources.jsonlines import json_objects

EVENT_LABELS = {"signup": "Join", "purchase": "Pay", "error": "Fail"}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingest_json(spark, d):
    """Event properties among lines that are no JSON objects."""
    lines = _t(spark, d, "events").select(F.col("props").alias("value")).unionAll(
        _t(spark, d, "documents").select("text")
    )
    return json_objects(lines, ["k"]).select(whole_number("k"))


def mask_person(spark, d):
    name = F.col("c_name")
    return _t(spark, d, "customer").select(
        "c_custkey",
        mask_name(name).alias("name"),
        mask_phone(name).alias("phone"),
        mask_phone(name, "tail").alias("phone_tail"),
        F.lit(PASSWORD_MASK).alias("password"),
    )


def label_codes(spark, d):
    return _t(spark, d, "events").select(
        "event_id", label(F.col("event_type"), EVENT_LABELS, "other").alias("label")
    )


def rounded_prices(spark, d):
    return _t(spark, d, "orders").select(
        "o_orderkey", round_score(F.col("o_totalprice") / 100).alias("score")
    )


def _price(c):
    return F.col(c).cast("decimal(12,2)")


def wide_left(spark, d):
    spent = _t(spark, d, "orders").groupBy("o_custkey").agg(
        F.sum(_price("o_totalprice")).alias("spent"),
        F.max("o_orderpriority").alias("top_priority"),
        F.min("o_orderdate").alias("first_order"),
    )
    customer = _t(spark, d, "customer")
    nation = _t(spark, d, "nation")
    region = _t(spark, d, "region")
    return (
        customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey", "c_name", "n_name", "r_name",
            F.col("spent").cast("decimal(22,2)").alias("spent"), "top_priority", "first_order",
        )
    )


def dim_inner(spark, d):
    return (
        _t(spark, d, "supplier")
        .join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )


def dim_mixed(spark, d):
    """Line items with their part, and their supplier if its balance is positive."""
    paid = _t(spark, d, "supplier").withColumn(
        "s_suppkey", F.when(F.col("s_acctbal") > 0, F.col("s_suppkey"))
    )
    return (
        _t(spark, d, "lineitem")
        .join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(paid, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name", "n_name")
    )


def star_wide(spark, d):
    return (
        _t(spark, d, "lineitem")
        .join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "p_name", "s_name", "c_name",
            "o_orderpriority", "l_quantity",
        )
    )


_COUNTS = {
    "count_by_segment": ("customer", "c_mktsegment", "c_custkey"),
    "count_by_nation": ("customer", "c_nationkey", "c_custkey"),
    "count_by_priority": ("orders", "o_orderpriority", "o_orderkey"),
    "count_by_status": ("orders", "o_orderstatus", "o_orderkey"),
    "count_by_event_type": ("events", "event_type", "event_id"),
    "count_by_flag": ("lineitem", "l_returnflag", "l_orderkey"),
}


def _count(table, key, counted):
    return lambda spark, d: count_by(_t(spark, d, table), [key], counted)


def avg_per_group(spark, d):
    items = _t(spark, d, "lineitem").select(
        "l_suppkey", "l_quantity", _price("l_extendedprice").alias("price")
    )
    return averages(
        items,
        ["l_suppkey"],
        {"avg_quantity": ("l_quantity", "decimal(4,1)"), "avg_price": ("price", "decimal(10,2)")},
    )


def extremes_per_group(spark, d):
    return extremes(
        _t(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "max_qty", "min_qty", "decimal(4,1)"
    )


def top3_rownum(spark, d):
    best = top_rows(
        _t(spark, d, "customer"), ["c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"], 3
    )
    return best.select("c_mktsegment", "rownum", "c_custkey", "c_acctbal").orderBy(
        "c_mktsegment", "rownum"
    )


def _dense(descending):
    def run(spark, d):
        orders = _t(spark, d, "orders").select(
            "o_orderkey", "o_orderpriority", _price("o_totalprice").alias("price")
        )
        return top_levels(orders, ["o_orderpriority"], "price", 3, descending)

    return run


def segment_members(spark, d):
    """Customers per order status and price band; a band holds 100,000 of price."""
    orders = _t(spark, d, "orders").withColumn(
        "segment", band(F.col("o_totalprice") / 5000, (0, 20, 40, 60, 80, 100))
    )
    return member_lists(orders, ["o_orderstatus", "segment"], "o_custkey", "custkeys", 16)


_BOUNDS = {
    "service": ("BETWEEN 0 AND 59", ">= 60"),
    "dao": ("BETWEEN 0 AND 60", "> 60"),
    "closed": (">= 0 AND {0} < 60", ">= 60"),
}


def _pass_rate(boundary):
    low, high = _BOUNDS[boundary]
    score = "(l_quantity * 2)"
    low = low.format(score)

    def run(spark, d):
        return two_sided(
            _t(spark, d, "lineitem"),
            ["l_suppkey"],
            ("unpasscount", F.expr(f"{score} {low}")),
            ("passcount", F.expr(f"{score} {high}")),
            rate_of="passcount",
        )

    sql = f"""
        SELECT l_suppkey, unpasscount, passcount, {rate_sql('passcount', 'unpasscount + passcount')}
            AS rate
        FROM (SELECT l_suppkey, COUNT(*) AS unpasscount FROM lineitem WHERE {score} {low}
              GROUP BY l_suppkey) a
        JOIN (SELECT l_suppkey, COUNT(*) AS passcount FROM lineitem WHERE {score} {high}
              GROUP BY l_suppkey) b USING (l_suppkey)"""
    return run, sql


def error_rate(spark, d):
    judged = _t(spark, d, "labels").join(_t(spark, d, "documents"), "doc_id")
    return two_sided(
        judged,
        ["source"],
        ("errcount", F.col("quality") == 0),
        ("rightcount", F.col("quality") == 1),
        rate_of="errcount",
    )


# SQL twins. Rates and averages are rounded half up in whole numbers.


def rate_sql(part: str, whole: str) -> str:
    return f"CAST((({part}) * 200 + ({whole})) // (2 * ({whole})) / 100.0 AS DECIMAL(4,2))"


def parts_sql(source: str, keys: str, member: str, name: str, buckets: int) -> str:
    """Member lists in parts, from ``source`` with columns ``keys`` and ``member``."""
    return f"""
        SELECT {keys}, part, STRING_AGG(CAST({member} AS VARCHAR), ',' ORDER BY {member}) AS {name}
        FROM (
            SELECT {keys}, {member}, UNNEST(RANGE(LEAST(1000, n - piece * 1000))),
                CAST(CAST('0x' || SUBSTR(MD5({member} || ':' || piece), 1, 8) AS BIGINT)
                    % {buckets} AS INTEGER) AS part
            FROM (
                SELECT *, UNNEST(RANGE((n - 1) // 1000 + 1)) AS piece
                FROM (
                    SELECT {keys}, CAST({member} AS BIGINT) AS {member}, COUNT(*) AS n
                    FROM ({source}) WHERE {member} IS NOT NULL GROUP BY {keys}, {member}
                )
            )
        ) GROUP BY {keys}, part
        UNION ALL
        SELECT {keys}, 0, '' FROM ({source}) GROUP BY {keys} HAVING COUNT({member}) = 0"""


def _dense_sql(order: str) -> str:
    return f"""
        SELECT o_orderkey, o_orderpriority, price, rk FROM (
            SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
                CAST(DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY
                    CAST(o_totalprice AS DECIMAL(12,2)) {order}) AS INTEGER) AS rk
            FROM orders) WHERE rk < 4"""


_CENTS = "SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT))::BIGINT"

SQL = {
    "ingest_json": """
        SELECT COALESCE(TRY_CAST(JSON_EXTRACT_STRING(props, '$.k') AS BIGINT), 0) AS k FROM events
        UNION ALL
        SELECT COALESCE(TRY_CAST(JSON_EXTRACT_STRING(text, '$.k') AS BIGINT), 0) FROM documents
        WHERE CASE WHEN JSON_VALID(text) THEN JSON_TYPE(text) = 'OBJECT' ELSE FALSE END""",
    "mask_person": """
        SELECT c_custkey, SUBSTR(c_name, 1, 1) || 'XX' AS name,
            SUBSTR(c_name, 1, 3) || '*****' || SUBSTR(c_name, 8, 4) AS phone,
            SUBSTR(c_name, 1, 3) || '*****' || SUBSTR(c_name, 9) AS phone_tail,
            '******' AS password
        FROM customer""",
    "label_codes": """
        SELECT event_id, CASE event_type WHEN 'signup' THEN 'Join' WHEN 'purchase' THEN 'Pay'
            WHEN 'error' THEN 'Fail' ELSE 'other' END AS label
        FROM events""",
    "round_score": """
        SELECT o_orderkey, CAST(ROUND(CAST(o_totalprice / 100 AS DECIMAL(20,10)), 1)
            AS DECIMAL(22,1)) AS score
        FROM orders""",
    "wide_left": """
        SELECT c_custkey, c_name, n_name, r_name, spent, top_priority, first_order
        FROM customer
        LEFT JOIN (SELECT o_custkey,
                CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS spent,
                MAX(o_orderpriority) AS top_priority, MIN(o_orderdate) AS first_order
            FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_inner": """
        SELECT s_suppkey, s_name, n_name, r_name FROM supplier
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim_mixed": """
        SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name, n_name FROM lineitem
        JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
        LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "star_wide": """
        SELECT l_orderkey, l_linenumber, l_partkey, p_name, s_name, c_name, o_orderpriority,
            l_quantity
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "avg_per_group": f"""
        SELECT l_suppkey,
            CAST((CAST(SUM(l_quantity) AS BIGINT) * 20 + COUNT(*)) // (2 * COUNT(*)) / 10.0
                AS DECIMAL(4,1)) AS avg_quantity,
            -- six decimals first, as an average of cents is kept, then two
            CAST((({_CENTS} * 20000 + COUNT(*)) // (2 * COUNT(*)) + 5000) // 10000 / 100.0
                AS DECIMAL(10,2)) AS avg_price
        FROM lineitem GROUP BY l_suppkey""",
    "extremes_per_group": """
        SELECT l_suppkey, CAST(MAX(l_quantity) AS DECIMAL(4,1)) AS max_qty,
            CAST(MIN(l_quantity) AS DECIMAL(4,1)) AS min_qty
        FROM lineitem GROUP BY l_suppkey""",
    "top3_rownum": """
        SELECT c_mktsegment, rownum, c_custkey, c_acctbal FROM (
            SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY c_mktsegment
                ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rownum
            FROM customer) WHERE rownum < 4""",
    "top3_dense": _dense_sql("DESC"),
    "low3_dense": _dense_sql("ASC"),
    "segment_members": parts_sql(
        """SELECT o_orderstatus, o_custkey, CASE
                WHEN o_totalprice / 5000 BETWEEN 0 AND 20 THEN '0-20'
                WHEN o_totalprice / 5000 > 20 AND o_totalprice / 5000 <= 40 THEN '20-40'
                WHEN o_totalprice / 5000 > 40 AND o_totalprice / 5000 <= 60 THEN '40-60'
                WHEN o_totalprice / 5000 > 60 AND o_totalprice / 5000 <= 80 THEN '60-80'
                WHEN o_totalprice / 5000 > 80 AND o_totalprice / 5000 <= 100 THEN '80-100'
            END AS segment FROM orders""",
        "o_orderstatus, segment", "o_custkey", "custkeys", 16,
    ),
    "error_rate": f"""
        SELECT source, errcount, rightcount, {rate_sql('errcount', 'errcount + rightcount')} AS rate
        FROM (SELECT source, COUNT(*) FILTER (quality = 0) AS errcount,
                COUNT(*) FILTER (quality = 1) AS rightcount
            FROM labels JOIN documents USING (doc_id) GROUP BY source)
        WHERE errcount > 0 AND rightcount > 0""",
}
SQL.update(
    {
        name: f"SELECT {key}, COUNT({counted}) AS num FROM {table} GROUP BY {key}"
        for name, (table, key, counted) in _COUNTS.items()
    }
)

QUERIES = {
    "ingest_json": ingest_json,
    "mask_person": mask_person,
    "label_codes": label_codes,
    "round_score": rounded_prices,
    "wide_left": wide_left,
    "dim_inner": dim_inner,
    "dim_mixed": dim_mixed,
    "star_wide": star_wide,
    **{name: _count(*args) for name, args in _COUNTS.items()},
    "avg_per_group": avg_per_group,
    "extremes_per_group": extremes_per_group,
    "top3_rownum": top3_rownum,
    "top3_dense": _dense(True),
    "low3_dense": _dense(False),
    "segment_members": segment_members,
    "error_rate": error_rate,
}
for _name in _BOUNDS:
    QUERIES[f"pass_rate_{_name}"], SQL[f"pass_rate_{_name}"] = _pass_rate(_name)
