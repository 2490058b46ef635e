import random

import pytest

from lectern.llm import winnowing


def words_of(text):
    return (text or "").encode().translate(winnowing._TABLE).split()


def brute(docs, items):
    """Words inside occurring windows, by comparing all positions."""
    out = []
    windows = {}
    for name, text in items:
        w = words_of(text)
        n = min(len(w), 13)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(name)
    for doc_id, text in docs:
        w = words_of(text)
        hit, names = set(), set()
        for n in range(1, 14):
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    hit.update(range(k, k + n))
                    names.update(found)
        out.append((doc_id, len(w), len(hit), sorted(x for x in names if x is not None)))
    return sorted(out, key=repr)


def data(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["Ä", "é1", "Z"]
    items = [(str(k), " ".join(rng.choices(vocab, k=rng.choice([1, 4, 12, 13, 14, 40])))) for k in range(25)]
    items += [(None, "alpha beta gamma"), ("n", None), ("e", "-- !!"), ("0", "again an item with this id")]
    docs = []
    for k in range(40):
        w = rng.choices(vocab, k=rng.choice([0, 5, 200]))
        for _ in range(3):
            _, text = rng.choice(items)
            part = (text or "").split()
            cut = rng.randrange(len(part) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in part[cut:] + part[:cut]] if rng.random() < 0.5 else part
        docs.append((k, ", ".join(w)))
    return [*docs, (90, None), (90, ""), (None, "alpha BETA-gamma"), (91, "x " * 50000)], items


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_against_all_positions(spark, block_words):
    docs, items = data(3)
    got = winnowing.shared_windows(
        spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, row int"),
        spark.createDataFrame(items, "item_id string, text string"),
        block_words=block_words,
    ).collect()
    found = [(r["id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in got]
    assert sorted(found, key=repr) == brute(docs, items)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_rule_and_columns(spark):
    passage = " ".join(f"p{k}" for k in range(13))
    docs = [(1, passage + " x" * 247), (2, passage + " x" * 248), (3, "x"), (4, None)]
    docs = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, row string")
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    kept = winnowing.decontaminate(docs, items)
    assert kept.columns == docs.columns
    # 13 of 260 words are a twentieth
    assert sorted(r[0] for r in kept.collect()) == [2, 3, 4]


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in winnowing.shared_windows(docs, none).collect()] == [0]
    assert winnowing.shared_windows(docs.where("false"), none).count() == 0
