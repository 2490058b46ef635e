import random

from lectern.llm import similar, simhash


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """The smallest id of each component over similarities of 0.8 or more, by trying all pairs."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [y if r == x else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(i, least.get(r, i))
    return sorted(least.values())


def corpus():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(500)]
    line = rng.choices(words, k=30)
    rows = [(0, None), (1, " "), (2, "one two"), (3, "One  TWO"), (4, "one")]
    for k in range(40):
        base = rng.choices(words, k=rng.choice([40, 100, 300])) + (line if k % 2 else [])
        for c in range(6):
            copy = list(base)
            for _ in range(c * len(base) // 110):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((100 + 10 * k + c, " ".join(copy)))
    return rows


def test_keeps_one_of_each_group_from_0_8_up(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len(want) < len(rows) - 60
    assert sorted(r[0] for r in simhash.keep_one(docs).collect()) == want
    # the order of the shingles changes nothing
    monkeypatch.setattr(similar, "COMMON", 10**9)
    assert sorted(r[0] for r in simhash.keep_one(docs).collect()) == want


def test_similarity_of_exactly_0_8(spark):
    """Eight of ten shingles shared: far more than four bits apart, and just near enough."""
    words = [f"v{k}" for k in range(30)]
    rows = [(1, " ".join(words[:13])), (2, " ".join(words[:12])), (3, " ".join(words[:14] + words[20:24]))]
    rows += [(4, " ".join(words[20:29])), (5, " ".join(words[20:28]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r[0] for r in simhash.keep_one(docs).collect()) == brute(rows) == [1, 3, 4]
