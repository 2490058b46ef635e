import random

import pytest

from lectern.llm import simhash
from lectern.llm.common import store
from lectern.llm.components import components
from lectern.llm.similar import shingles


def brute(rows):
    """Smallest id reachable over fingerprints at most four bits apart, by trying all pairs."""
    found = [(i, simhash.fingerprint(t)) for i, t in rows]
    parent = list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(found)):
        for b in range(a):
            if (found[a][1] ^ found[b][1]).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(found):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((repr(i), fp, least.get(root(k))) for k, (i, fp) in enumerate(found))


def texts(seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(60):
        base = rng.choices(words, k=rng.choice([3, 8, 60, 400]))
        rows.append((k * 10, " ".join(base)))
        for c in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            if c:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k * 10 + c + 1, " ".join(copy)))
    return rows


EDGES = [
    (9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "ONE"), (9006, "a b c"),
    (None, "a b c"), (9006, "a b c"), (9007, "é ß 語"), (9008, "x " * 30000),
]


@pytest.mark.parametrize("long_list", [1024, 1])
def test_against_all_pairs(spark, long_list):
    rows = texts() + EDGES
    # a column of the input that has the name of one of the result
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component long")
    got = simhash.near_duplicates(docs, long_list=long_list).collect()
    assert sorted((repr(r[0]), r[1] % (1 << 64), r[2]) for r in got) == brute(rows)


def test_no_pair_is_missed(spark):
    """Any four of the eight positions hold a triple, so four flipped bits are always found."""
    rng = random.Random(2)
    fps = []
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 4):
            y ^= 1 << bit
        fps += [x, y]
    rows = [(k, x - (1 << 64) if x >> 63 else x) for k, x in enumerate(fps)]
    edges = simhash.links(spark.createDataFrame(rows, "id long, fp long"))
    found = {(r["a"]["value"], r["b"]["value"]) for r in edges.collect()}
    pairs = {frozenset(p) for p in found}
    assert all(frozenset((rows[k][1], rows[k + 1][1])) in pairs for k in range(0, 600, 2))


def test_one_row_stays(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "x y z u v"), (3, None), (4, "")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, row string")
    kept = simhash.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted(r[0] for r in kept.collect()) == [3, 5, 7]


def test_large_ids_stay_exact_beside_nulls(spark):
    big = 2**62 + 1
    docs = spark.createDataFrame([(big, "a b c"), (None, "x y z"), (big + 1, "q")], "doc_id long, text string")
    got = {r[0] for r in simhash.near_duplicates(docs).collect()}
    assert got == {big, big + 1, None}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(300, 301), (301, 300), (5, 5), (None, 3)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), 300: 300, 301: 300}


def test_groups_of_both_links_are_joined(spark):
    linked = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 3), (4, 3), (5, 5)], "row long, component long")
    similar = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (5, 5)], "row long, `group` long")
    got = {r["row"]: r["group"] for r in simhash.joined_groups(linked, similar).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}


def test_keep_one_links_by_fingerprints(spark):
    """Repeated shingles weigh in a fingerprint; the exact check counts them once and keeps both texts apart."""
    texts = ["a b c d e f g " * 200 + " ".join(f"{end}{k}" for k in range(20)) for end in "xy"]
    assert (simhash.fingerprint(texts[0]) ^ simhash.fingerprint(texts[1])).bit_count() <= 4
    first, second = (set(shingles(t)) for t in texts)
    assert len(first & second) < 0.8 * len(first | second)
    docs = store(spark.createDataFrame([(2, texts[0]), (1, texts[1]), (3, "ten")], "doc_id long, text string"))
    assert sorted(r[0] for r in simhash.keep_one(docs).select("doc_id").collect()) == [1, 3]
