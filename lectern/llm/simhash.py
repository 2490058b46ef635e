"""Near duplicates by SimHash, with a byte-position inverted index and count filtering.

A fingerprint of 64 bits has eight bytes, each with its position. Two
fingerprints that differ in at most four bits share at least four positional
bytes. Posting lists of single bytes would hold 1/256 of all fingerprints each,
so a list is kept per three positional bytes instead: the twenty triples below
are a Turan system, every four positions hold one of them, so no pair that
shares four bytes is missed. In a list the shared bytes of each pair are
tallied, pairs under four are dropped, and the rest is verified bit by bit.

Lists with more than LONG_LIST fingerprints are never paired. Their
fingerprints are linked through midpoints: two fingerprints differ in at most
four bits exactly if some value differs from both in at most two, so joining
each fingerprint to all 2,081 values around it gives the same components with
work in proportion to the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import Steps, for_pandas, free_name, from_pandas, small_batches, store
from lectern.llm.components import components
from lectern.llm.similar import similar_groups

SEED = 42
SHINGLE = 4
MAX_BITS = 4
MIN_BYTES = 4
LONG_LIST = 1024


def _triples() -> list[tuple[int, int, int]]:
    """Three groups of positions; a triple lies in one group, or two thirds in one, one in the next."""
    groups = ((0, 1, 2), (3, 4, 5), (6, 7))
    found = [t for g in groups for t in combinations(g, 3)]
    for k, group in enumerate(groups):
        found += [(*pair, x) for pair in combinations(group, 2) for x in groups[(k + 1) % 3]]
    return found


TRIPLES = _triples()
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _first_triple() -> np.ndarray:
    """For each set of shared bytes (bit k: position k) the first triple within it, or -1."""
    first = np.full(256, -1, dtype=np.int16)
    for shared in range(256):
        for k, triple in enumerate(TRIPLES):
            if all(shared >> p & 1 for p in triple):
                first[shared] = k
                break
    return first


_FIRST = _first_triple()


def fingerprint(text: str | None) -> int:
    """SimHash of the text's word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        grams = zip(words, words[1:], words[2:], words[3:], strict=False)
        hashes = [digest(b"%b %b %b %b" % g, SEED) for g in grams]
    # bit counts of 255 hashes at a time fit in bytes
    packed = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(packed), 1 << 14):
        counts += np.unpackbits(packed[at : at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long of the same bits."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": fps.view(np.int64)})

    sent, kind = for_pandas(narrow, "id")
    return from_pandas(sent.mapInPandas(run, f"id {kind}, fp long"), "id", narrow)


def _posting_keys(fp) -> F.Column:
    """The twenty keys of a fingerprint: number of the triple, then its three bytes."""
    byte = [F.shiftrightunsigned(fp, 56 - 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    return F.array(
        *(
            F.lit(k << 24) + byte[a] * F.lit(65536) + byte[b] * F.lit(256) + byte[c]
            for k, (a, b, c) in enumerate(TRIPLES)
        )
    )


def _pairs_of(key: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of one posting list, each pair only in the first list it shares."""
    left, right = np.triu_indices(len(fps), 1)
    other = fps[left] ^ fps[right]
    shared = np.zeros(len(other), dtype=np.uint8)
    for p in range(8):
        same = (other >> np.uint64(56 - 8 * p)) & np.uint64(255) == 0
        shared |= same.astype(np.uint8) << p
    keep = np.bitwise_count(shared) >= MIN_BYTES
    keep &= _FIRST[shared] == key >> 24
    keep &= np.bitwise_count(other) <= MAX_BITS
    return fps[left[keep]], fps[right[keep]]


def links(fps: DataFrame, long_list: int = LONG_LIST, step: Steps | None = None) -> DataFrame:
    """Edges (a, b) whose components are those of the link graph of the distinct values fp.

    An end may also be a midpoint; those are marked by tag 1, fingerprints by 0. ``step``
    stores what is read on the way; by default it stays.
    """
    step = step or store
    posts = step(
        fps.select("fp").distinct().select("fp", F.explode(_posting_keys(F.col("fp"))).alias("key"))
    )
    # lists with one entry, nearly all of them, end here
    sizes = step(posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    lists = (
        posts.join(sizes.where(F.col("n") <= long_list), "key")
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, values in zip(batch["key"], batch["fps"], strict=True):
                a, b = _pairs_of(key, np.asarray(values, dtype=np.int64).view(np.uint64))
                if len(a):
                    yield pd.DataFrame({"x": a.view(np.int64), "y": b.view(np.int64)})

    pairs = lists.mapInPandas(run, "x long, y long")
    short = pairs.select(_node(0, "x").alias("a"), _node(0, "y").alias("b"))
    dense = posts.join(sizes.where(F.col("n") > long_list), "key").select("fp").distinct()

    one = [1 << k for k in range(64)]
    around = [0, *one, *(x | y for x, y in combinations(one, 2))]
    masks = np.array(around, dtype=np.uint64).view(np.int64)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for fp in batch["fp"]:
                yield pd.DataFrame({"x": np.full(len(masks), fp), "y": masks ^ fp})

    long = dense.mapInPandas(spread, "x long, y long")
    return short.unionByName(long.select(_node(0, "x").alias("a"), _node(1, "y").alias("b")))


def _node(tag: int, column: str) -> F.Column:
    return F.struct(F.lit(tag).alias("tag"), F.col(column).alias("value"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_list: int = LONG_LIST,
) -> DataFrame:
    """(id_col, fp, component): the smallest id reachable over fingerprints at most 4 bits apart.

    One row per input row, repeated rows and rows with equal ids included. A text
    that is null, empty or blank has fingerprint 0, which is linked like any
    other. A null id never names a component unless it has no other id. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = store(fingerprints(docs, id_col, text_col))
    with Steps(docs.sparkSession) as step:
        least = step(rows.groupBy("fp").agg(F.min("id").alias("least")))
        found = components(links(least, long_list, step)).where("node.tag = 0")
        roots = found.select(F.col("node.value").alias("fp"), "root")
        # the smallest id of each component, then of each fingerprint in it
        of_root = roots.join(least, "fp").groupBy("root").agg(F.min("least").alias("component"))
        joined = roots.join(of_root, "root").select("fp", F.col("component").alias("linked"))
        names = store(
            least.join(joined, "fp", "left").select(
                "fp", F.coalesce("linked", "least").alias("component")
            )
        )
    # copies share a fingerprint: adaptive execution splits the hot ones
    return rows.join(names, "fp").select(F.col("id").alias(id_col), "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of near duplicates: the one with the smallest id.

    Documents are linked by their fingerprints, as ``near_duplicates`` links them, at four
    bits or fewer, if an exact check bears the link out: a document and the first one of its
    fingerprint or component share 0.8 or more of their five-word shingles, with repeats
    counted as a fingerprint counts them. To these come all pairs that share 0.8 or more of
    their distinct shingles (Jaccard), which four bits miss for many. A
    group is what links of either kind connect. Of rows with equal ids, and of rows
    without an id, the first in the order of
    the table counts as smallest; a null id comes after all others. docs must be a
    stored table, whose rows can be numbered alike twice. Columns are those of the
    input.
    """
    row = free_name(docs.columns, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    texts = numbered.select(F.col(row).alias("row"), F.col(text_col).cast("string").alias("text"))
    ids = numbered.select(
        F.col(row).alias("row"),
        F.struct(
            F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(row).alias("row")
        ).alias("id"),
    )
    with Steps(docs.sparkSession) as step:
        groups = similar_groups(texts, step(_first_rows(near_duplicates(texts, "row", "text"))))
        chosen = store(
            groups.join(ids, "row")
            .groupBy("group")
            .agg(F.min("id").alias("id"))
            .select(F.col("id.row").alias(row))
        )
    return numbered.join(chosen.hint("merge"), row, "left_semi").select(*docs.columns)


def _first_rows(linked: DataFrame) -> DataFrame:
    """(row, first): each row with the first one of its fingerprint, and of its component."""
    of_fp = linked.groupBy("fp").agg(F.min("row").alias("first"), F.first("component").alias("component"))
    return (
        linked.select("row", "fp")
        .join(of_fp.hint("merge"), "fp")
        .select("row", F.explode(F.array_distinct(F.array("first", "component"))).alias("first"))
        .where("row <> first")
    )


def joined_groups(linked: DataFrame, similar: DataFrame) -> DataFrame:
    """(row, group): what the components of ``linked`` and the groups of ``similar`` connect.

    Both name a group by one of its rows, so a row ties its component to its group.
    """
    both = store(linked.join(similar.hint("merge"), "row"))
    found = components(both.select(F.col("component").alias("a"), F.col("group").alias("b")))
    ends = found.select(F.col("node").alias("group"), "root")
    return both.join(ends, "group", "left").select("row", F.coalesce("root", "group").alias("group"))


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
