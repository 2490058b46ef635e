"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words of a benchmark item; a shorter item is one
window. Of every GUARD consecutive K-grams the one with the smallest hash is
kept, in items and in documents alike. K + GUARD - 1 = WINDOW, so each shared
window holds one such group of K-grams whole and both sides keep the same one:
no shared window is missed. Each kept K-gram of a document that an item kept
too is extended to all windows around it, which are compared word by word with
the windows of the items. For items shorter than a window, of n words, every
n-gram counts as kept.

The benchmark goes to the tasks in blocks of a bounded number of words; the
documents are read once per block, and hits are merged when there is more than
one. Documents are never shuffled for one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import for_pandas, free_name, from_pandas, small_batches, store

WINDOW = 13
K = 8
GUARD = WINDOW - K + 1
# most words of the benchmark that are sent to the tasks at once; an item is never split
BLOCK_WORDS = 2_000_000
# words handled at once in a task; a longer document is handled alone
CHUNK_WORDS = 200_000
MIN_SHARE = 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)
# the same words for JVM-side counts
ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def word_ids(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    size = max(0, len(ids) - n + 1)
    h = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        h = h * _MULTIPLIER + ids[k : k + size]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest hash, the last of equal ones, in each window of the given width."""
    size = len(hashes) - width + 1
    if size <= 0:
        return np.zeros(0, dtype=np.int64)
    at = np.arange(size)
    best, where = hashes[:size].copy(), at.copy()
    for k in range(1, width):
        ahead = hashes[k : k + size]
        take = ahead <= best
        best[take] = ahead[take]
        where[take] = at[take] + k
    return where[np.concatenate(([True], where[1:] != where[:-1]))]


class ItemIndex:
    """Kept fingerprints and all windows of a block of items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, k: int):
        self.window, self.k = window, k
        self.names = [name for name, _ in items]
        kept: list[np.ndarray] = []
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for number, (_, text) in enumerate(items):
            ids = word_ids(text)
            if len(ids) >= window:
                grams = gram_hashes(ids, k)
                kept.append(grams[winnow(grams, window - k + 1)])
                by_length.setdefault(window, []).append((number, ids))
            elif len(ids):
                by_length.setdefault(len(ids), []).append((number, ids))
        self.kept = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[self.kept >> np.uint64(42)] = True
        self.windows = {n: self._table(rows, n) for n, rows in by_length.items()}

    @staticmethod
    def _table(rows: list[tuple[int, np.ndarray]], n: int):
        """Sorted hashes of the distinct windows, their words, and the items of each."""
        hashes = np.concatenate([gram_hashes(ids, n) for _, ids in rows])
        words = np.concatenate([np.lib.stride_tricks.sliding_window_view(ids, n) for _, ids in rows])
        owner = np.concatenate([np.full(len(ids) - n + 1, number) for number, ids in rows])
        order = np.lexsort((owner, hashes))
        hashes, words, owner = hashes[order], words[order], owner[order]
        unique, first = np.unique(hashes, return_index=True)
        return unique, words[first], np.append(first, len(hashes)), owner

    def _lookup(self, ids: np.ndarray, starts: np.ndarray, n: int):
        """(start, row of the window table) for the starts at which a window occurs."""
        unique, words, _, _ = self.windows[n]
        grams = ids[starts[:, None] + np.arange(n)]
        h = np.zeros(len(starts), dtype=np.uint64)
        for k in range(n):
            h = h * _MULTIPLIER + grams[:, k]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        row = np.minimum(np.searchsorted(unique, h), len(unique) - 1)
        found = unique[row] == h
        starts, row, grams = starts[found], row[found], grams[found]
        same = (words[row] == grams).all(axis=1)
        return starts[same], row[same]

    def hits(self, ids: np.ndarray, room: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window length n: n, starts of occurring windows, their rows.

        room: for each word the number of words to the end of its document.
        """
        for n in self.windows:
            if n < self.window:
                # short items are few in kind: every n-gram is looked up
                h = gram_hashes(ids, n)
                starts = np.flatnonzero(np.isin(h, self.windows[n][0]))
            else:
                h = gram_hashes(ids, self.k)
                at = winnow(h, self.window - self.k + 1)
                at = at[self.filter[h[at] >> np.uint64(42)]]
                at = at[np.isin(h[at], self.kept)]
                around = at[:, None] - np.arange(self.window - self.k + 1)
                starts = np.unique(around[around >= 0])
            starts = starts[room[starts] >= n] if len(starts) else starts
            if len(starts):
                starts, rows = self._lookup(ids, starts, n)
                yield n, starts, rows

    def items_of(self, n: int, row: int) -> np.ndarray:
        _, _, bounds, owner = self.windows[n]
        return owner[bounds[row] : bounds[row + 1]]


def _chunks(texts: list[str | None]) -> Iterator[list[np.ndarray]]:
    chunk, size = [], 0
    for text in texts:
        ids = word_ids(text)
        if chunk and size + len(ids) > CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
        chunk.append(ids)
        size += len(ids)
    if chunk:
        yield chunk


def find_hits(index: ItemIndex, texts: list[str | None]) -> Iterator[tuple[int, list, list, list]]:
    """For each text: number of words, starts and ends of the merged hit runs, item names."""
    for chunk in _chunks(texts):
        sizes = np.array([len(x) for x in chunk], dtype=np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        ids = np.concatenate(chunk)
        room = np.repeat(ends, sizes) - np.arange(len(ids))
        step = np.zeros(len(ids) + 1, dtype=np.int64)
        named: dict[int, set[str]] = {}
        for n, starts, rows in index.hits(ids, room):
            np.add.at(step, starts, 1)
            np.add.at(step, starts + n, -1)
            of = np.searchsorted(ends, starts, side="right")
            for doc, row in np.unique(np.stack([of, rows], axis=1), axis=0):
                names = named.setdefault(int(doc), set())
                names.update(index.names[x] for x in index.items_of(n, row))
        hit = np.cumsum(step[:-1]) > 0
        for doc in range(len(chunk)):
            if doc not in named:
                yield int(sizes[doc]), [], [], []
                continue
            own = np.concatenate(([0], hit[begins[doc] : ends[doc]].astype(np.int8), [0]))
            turn = np.diff(own)
            yield (
                int(sizes[doc]),
                np.flatnonzero(turn == 1).tolist(),
                np.flatnonzero(turn == -1).tolist(),
                sorted(x for x in named[doc] if x is not None),
            )


_INDEXES: dict[int, ItemIndex] = {}


def _scan(docs: DataFrame, items: list[tuple[str | None, str | None]], window: int, k: int):
    """(id, row, n_words, starts, ends, items) of each row of (id, row, text) for one block."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    key = sent._jbroadcast.id() if sent._jbroadcast is not None else id(sent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[key] = ItemIndex(sent.value, window, k)
        for batch in batches:
            found = list(find_hits(_INDEXES[key], list(batch["text"])))
            n, starts, ends, names = zip(*found, strict=True) if found else ((), (), (), ())
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "row": batch["row"],
                    "n_words": np.array(n, dtype=np.int64),
                    "starts": list(starts),
                    "ends": list(ends),
                    "items": list(names),
                }
            )

    narrow, kind = for_pandas(docs, "id")
    found = narrow.mapInPandas(
        run,
        f"id {kind}, row long, n_words long, starts array<long>, ends array<long>,"
        " items array<string>",
    )
    return from_pandas(found, "id", docs)


def _merge(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Union of the runs of a document, as (starts, ends)."""
    out = []
    for a, b in zip(starts, ends, strict=True):
        runs: list[list[int]] = []
        for x, y in sorted(zip(a, b, strict=True)):
            if runs and x <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], y)
            else:
                runs.append([x, y])
        out.append([[x for x, _ in runs], [y for _, y in runs]])
    return pd.Series(out)


def shared_windows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(id, row, n_words, n_hit, spans, items) for each document.

    spans: runs of hit words as [start, end) word positions, ascending and apart;
    items: ids, as text and sorted, of the items with a window in the document.
    A null text, of a document or an item, has no words. Equal ids and repeated
    rows are rows of their own; of items with equal ids one name is listed; an
    item without id hits words, but is not listed. An empty benchmark hits
    nothing; an empty table gives an empty result. row numbers the rows of docs as
    stored; other columns are ignored.
    """
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and window")
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).cast("string").alias("text"),
    )
    bench = items.select(
        F.col(item_id_col).cast("string").alias("name"), F.col(item_text_col).alias("text")
    ).where(F.col("text").isNotNull())
    words = bench.agg(F.sum(F.regexp_count("text", F.lit(ITEM_WORD)))).first()[0] or 0
    blocks = -(-words // block_words) or 1
    parts = []
    for block in range(blocks):
        own = bench.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)
        rows = sorted({(r["name"], r["text"]) for r in own.toLocalIterator()}, key=repr)
        parts.append(_scan(narrow, rows, window, k))
    found = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        merge = F.pandas_udf(_merge, "array<array<long>>")
        found = (
            found.groupBy("row")
            .agg(
                F.first("id").alias("id"),
                F.max("n_words").alias("n_words"),
                F.flatten(F.collect_list("starts")).alias("starts"),
                F.flatten(F.collect_list("ends")).alias("ends"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            )
            .withColumn("runs", merge("starts", "ends"))
            .withColumn("starts", F.col("runs")[0])
            .withColumn("ends", F.col("runs")[1])
        )
    total = "aggregate(zip_with(starts, ends, (s, e) -> e - s), 0L, (a, x) -> a + x)"
    return found.select(
        "id",
        "row",
        "n_words",
        F.expr(total).alias("n_hit"),
        F.expr("zip_with(starts, ends, (s, e) -> struct(s as start, e as end))").alias("spans"),
        "items",
    )


def _contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (F.lit(MIN_SHARE) * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The documents without those in which hit words are a twentieth of the words or more.

    docs must be a stored table, whose rows can be numbered alike twice; its
    columns stay as they are.
    """
    bad = store(shared_windows(docs, items, **names).where(_contaminated()).select("row"))
    row = free_name(docs.columns, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(bad.withColumnRenamed("row", row), row, "left_anti").select(*docs.columns)


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return shared_windows(docs, items).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
    )


def digest(names: list[str]) -> str:
    """What the query gives for a list of items; for tests."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
