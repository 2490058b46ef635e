import itertools

import pytest
from pyspark.sql import functions as F

from lectern.llm import mixing


def test_targets_share_and_stop():
    sizes = {"a": 100, "b": 1000, "c": 1000, None: 10}
    weights = mixing.cycling(list(sizes))
    assert weights == {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}
    got = mixing.targets(sizes, weights, 1.5 * 2110, 2)
    assert got["a"] == 200 and got[None] == 20
    # what they leave is shared 2 to 1
    assert got["b"] == pytest.approx(2945 * 2 / 3) and got["c"] == pytest.approx(2945 / 3)
    assert mixing.targets({}, {}, 0, 2) == {}


def plain_flow(patterns, wanted, repeats):
    """Largest number of words that can be routed: least cut over the sets of sources."""
    best = None
    sources = list(wanted)
    for n in range(len(sources) + 1):
        for cut in itertools.combinations(sources, n):
            rest = [s for s in sources if s not in cut]
            cost = sum(wanted[s] for s in cut)
            cost += sum(size * repeats for m, size in patterns.values() if any(s in rest for s in m))
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("wanted", [(10, 10, 10), (90, 5, 5), (40, 70, 30), (500, 500, 500), (0, 0, 7)])
def test_flow_is_largest_and_spread(wanted):
    patterns = {"a": (["x"], 20), "ab": (["x", "y"], 30), "abc": (["x", "y", "z"], 8), "c": (["z"], 5), "0": (["y"], 0)}
    need = dict(zip("xyz", wanted))
    flow = mixing.route(patterns, need, 2)
    for p, (members, size) in patterns.items():
        assert set(flow[p]) == set(members) and sum(flow[p].values()) <= 2 * size
        assert all(v >= 0 for v in flow[p].values())
    given = {s: sum(f.get(s, 0) for f in flow.values()) for s in need}
    assert all(given[s] <= need[s] for s in need)
    assert sum(given.values()) == plain_flow(patterns, need, 2)


def test_nothing_repeats_while_fresh_words_do():
    patterns = {"a": (["x"], 100), "ab": (["x", "y"], 100)}
    flow = mixing.route(patterns, {"x": 100, "y": 100}, 2)
    assert sum(flow["a"].values()) == 100 and sum(flow["ab"].values()) == 100


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, "w " * (1 + k % 9), f"s{k % 4}" if k % 11 else None, "x") for k in range(400)]
    rows += [(900, None, "s1", "x"), (901, "", "s1", "x"), (902, "w", "", "x"), (902, "w", "", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_mix(spark, docs):
    rows, report = mixing.mix(docs, F.array("source"))
    got = rows.collect()
    assert len(got) == docs.count()
    assert all(0 <= r["copies"] <= 2 for r in got)
    taken = {}
    for r in got:
        taken[r["pattern"]] = taken.get(r["pattern"], 0) + r["copies"] * r["size"]
    for r in report.withColumn("p", F.to_json(F.array("source"))).collect():
        assert abs(taken.get(r["p"], 0) - r["target"]) <= 2, r
    again, _ = mixing.mix(docs, F.array("source"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got))


def test_overlapping_sources(spark):
    rows = [(k, "w w w", ["a", "b"] if k < 50 else ["a"] if k < 90 else []) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    got, report = mixing.mix(docs, F.col("of"), weigh=lambda s: dict.fromkeys(s, 1.0), share=0.5)
    given = {r["source"]: (r["target"], r["given"]) for r in report.collect()}
    assert given["a"][1] == pytest.approx(given["a"][0], abs=1)
    assert given["b"][1] == pytest.approx(given["b"][0], abs=1)
    assert all(r["copies"] == 0 for r in got.where("pattern = '[]'").collect())


def test_rows_of_the_mix(spark, docs):
    rows, _ = mixing.mix(docs, F.array("source"))
    out = mixing.mixed(docs, F.array("source"))
    assert out.columns == docs.columns
    assert out.count() == rows.agg(F.sum("copies")).first()[0]


def test_empty(spark, docs):
    rows, report = mixing.mix(docs.where("false"), F.array("source"))
    assert rows.count() == 0 and report.count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, F.array("source"), max_patterns=2)


def test_long_document_leaves_no_gap(spark):
    """A document too long for what is left must not end the draw, however many short ones follow."""
    rows = [(k, "w " * 100, "s") for k in range(3000)] + [(3000, "w " * 200_000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # an order in which the long one comes soon after the middle
    place = F.pmod(F.xxhash64(F.col("id").cast("int"), F.lit(3000).cast("long"), F.lit(200_000).cast("long")), F.lit(mixing.BUCKETS))
    seed = spark.range(200).where(place.between(2150, 2600)).first()[0]
    taken, _ = mixing.mix(docs, F.array("source"), share=0.7, seed=seed)
    got = {r["id"]: r["copies"] for r in taken.collect()}
    assert got[3000] == 0 and all(got[k] == 1 for k in range(3000))
