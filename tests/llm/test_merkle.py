import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """The root, and for each leaf its siblings as (whether they stand left, digest)."""
    proofs = [[] for _ in leaves]
    at, level = list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, node in enumerate(at):
            other = node ^ 1
            proofs[k].append((node % 2 == 1, level[other] if other < len(level) else ""))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [node // 2 for node in at]
    return level[0], proofs


def brute(rows):
    """(lang, id, leaf) to (lang, id, leaf, subroot, root, path) by plain trees."""
    langs = sorted({r[0] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by_lang = {g: sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for g in langs}
    trees = {g: tree([r[2] for r in by_lang[g]]) for g in langs}
    root, last = tree([trees[g][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for r, proof in zip(by_lang[g], trees[g][1], strict=True):
            path = [("L" if left else "R") + s for left, s in proof + last[k]]
            out.append((*r, trees[g][0], root, path))
    return sorted(out, key=repr)


def leaves(counts, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, n in counts.items():
        rows += [(lang, rng.choice([None, *range(3 * n)]), sha(f"{lang}{k}")) for k in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "counts,levels",
    [({"en": 1}, 8), ({"en": 37, "de": 1, None: 5, "": 2, "é": 4}, 3), ({k: 1 for k in "abcdefghi"}, 2), ({"a": 8}, 1)],
)
def test_against_plain_trees(spark, counts, levels):
    rows = leaves(counts)
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, doc_id long, leaf string, root string")
    got = merkle.manifest(df, "lang", ["doc_id", "leaf"], levels)
    assert got.columns == ["lang", "doc_id", "leaf", "subroot", "root", "path"]
    folded = got.select("*", merkle.fold(F.col("leaf"), F.col("path")).alias("f")).collect()
    assert sorted((tuple(r)[:-1] for r in folded), key=repr) == brute(rows)
    assert all(r["f"] == r["root"] for r in folded)
    # any other leaf leads elsewhere
    bad = got.select("root", merkle.fold(F.lit(sha("other")), F.col("path")).alias("f")).collect()
    assert all(r["f"] != r["root"] for r in bad)


def test_several_storeys(spark):
    rows = [("en", k, sha(str(k))) for k in range(600)]
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").repartition(7)
    got = merkle.manifest(df, "lang", ["doc_id", "leaf"]).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_query_rows(spark, tmp_path):
    rows = [
        (1, "a b", "en", "s", 3), (2, None, None, None, None), (None, "", "en", "s", 0), (3, "é" * 5000, "fr", None, 5000),
        (1, "a b", "en", "s", 3), (1, "a c", "en", "s", 3), *((k, "x", "de", "t", 1) for k in range(20, 60)),
    ]
    docs = spark.createDataFrame([(*r, "m") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op13_merkle(spark, str(tmp_path)).collect()

    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, more=0):
        n = r[4] if r[4] is None else r[4] + more
        return sha("".join(map(part, (r[0], r[3], r[2], n, r[1]))))

    want = brute([(r[2], r[0], leaf(r)) for r in rows])
    assert sorted(map(repr, ((r["doc_id"], r["leaf"], r["subroot"], r["root"]) for r in got))) == sorted(
        map(repr, ((w[1], *w[2:5]) for w in want))
    )
    proofs = sorted(sha("".join(s[1:] for s in w[5])) for w in want)
    assert sorted(r["proof_sha256"] for r in got) == proofs
    import zlib

    changed = {leaf(r) for r in rows if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 0 and r[4] is not None}
    assert changed and {r["leaf"] for r in got if not r["verified"]} == changed
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, doc_id long, leaf string")
    assert merkle.manifest(df, "lang", ["doc_id"]).count() == 0
