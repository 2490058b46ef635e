import pytest
from pyspark.sql import functions as F

from lectern.llm import sharding
from lectern.llm.common import store


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 16, 17, 100, 1021])
def test_a_permutation(spark, rows):
    places = spark.range(rows).select(sharding.permute(F.col("id"), rows)).collect()
    assert sorted(r[0] for r in places) == list(range(rows))


def test_shards_and_slots(spark):
    rows = [(k % 50, f"t{k % 7}", "x") for k in range(101)] + [(None, None, "y")] * 3
    df = store(spark.createDataFrame(rows, "doc_id long, text string, shard string"))
    got = sharding.shard(df, 8, ["doc_id", "text"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(x) for x in by.values()]
    assert sorted(by) == list(range(8)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    # another layout of the same rows gives the same result, up to rows that are alike
    again = sharding.shard(store(df.repartition(7, "text")), 8, ["doc_id", "text"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_other_columns_follow_their_rows(spark):
    rows = [(k % 50, f"t{k}", k) for k in range(101)] + [(None, None, None)]
    df = store(spark.createDataFrame(rows, "doc_id long, text string, row long"))
    narrow = sharding.shard(df.drop("row"), 8, ["doc_id", "text"]).collect()
    wide = sharding.shard(df, 8, ["doc_id", "text"])
    assert wide.columns == ["doc_id", "text", "row", "shard", "slot"]
    got = wide.collect()
    assert sorted((r["text"] or "", r["shard"], r["slot"]) for r in got) == sorted(
        (r["text"] or "", r["shard"], r["slot"]) for r in narrow
    )
    assert all(r["row"] is None or r["text"] == f"t{r['row']}" for r in got)
    again = sharding.shard(store(df.repartition(5)), 8, ["doc_id", "text"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = sharding.shard(store(df), 8, ["doc_id", "text"], seed=7).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(1,)], "doc_id long")
    assert [(r["shard"], r["slot"]) for r in sharding.shard(one, 16).collect()] == [(0, 0)]
    assert sharding.shard(one.where("false"), 16).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(one, 0)


def test_no_python_in_the_plan(spark):
    plan = sharding.op4_sharding(spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow"))
