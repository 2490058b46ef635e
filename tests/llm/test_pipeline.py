from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from lectern.llm import langid, queries
from lectern.llm.common import store
from tests.llm.test_similar import brute as groups
from tests.llm.test_winnowing import brute as passages

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())


@pytest.fixture(scope="module")
def kept(spark):
    """The documents after each stage but the last, as lists of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10_000, None), (10_001, ""), (10_002, "123 !!"), (10_003, "the one of the")]
    more = spark.createDataFrame([(*r, None, None, 0) for r in odd], docs.schema)
    out = [store(docs.unionByName(more))]
    for _, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF)))
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def texts(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def test_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])


def test_language_stage(kept):
    letters = [i for i, t in texts(kept[0]) if any(c.isalpha() for c in t or "")]
    assert ids(kept[1]) == sorted(letters)
    assert langid.UNKNOWN == "und"


def test_dedup_stage(kept):
    assert ids(kept[2]) == groups(texts(kept[1]))


def test_decontamination_stage(spark, kept):
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [i for i, n, hit, _ in passages(texts(kept[2]), items) if not (hit and 20 * hit >= n)]
    assert ids(kept[3]) == sorted(clean)


def test_mixing_stage(kept):
    times = Counter(ids(kept[4]))
    assert set(times) <= set(ids(kept[3])) and max(times.values()) <= 2
    size = {i: len((t or "").split()) for i, t in texts(kept[3])}
    assert sum(size[i] * n for i, n in times.items()) == pytest.approx(1.5 * sum(size.values()), rel=0.1)


def test_sharding_stage(kept):
    assert ids(kept[5]) == ids(kept[4])
    sizes = [r["count"] for r in kept[5].groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    slots = kept[5].groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.count_distinct("slot").alias("n"), F.count("*").alias("m"))
    assert all(r["a"] == 0 and r["b"] + 1 == r["n"] == r["m"] for r in slots.collect())


