"""Best-two-fit packing of token sequences, planned on counts of lengths.

Documents become token ids with an end mark, and those longer than a sequence
are cut. A piece matters to the packing by its length only, so the plan is made
on how many pieces there are of each length, at most as many counts as a
sequence has tokens, whatever the number of documents.

A bin is filled greedily, the longest piece that fits first. If a gap is left,
its smallest piece makes room for two unpacked pieces that fill the widened gap
more tightly, if there are such. A bin that lengths still allow is repeated, so
one step of the plan stands for as many equal bins as the counts hold, and each
step leaves a length with fewer pieces than a bin of its kind needs.

Pieces are dealt to the plan by their rank among those of their length. Ranks
are given while pieces are written: their place in their task, after those of
the tasks before. A step takes a run of ranks, so each piece finds its sequence
and its offset by a search in the plan.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import for_pandas, from_pandas, small_batches, store

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
END = 0
RANKS = "byte_bpe_50k.tiktoken"

# characters whose class all versions of Unicode agree on: Latin, and common punctuation
_LATIN = re.compile("[\x00-\u024f\u2010-\u2027\u20ac]*")


# token ids


class Encoder:
    """Ids of whole texts as the `tokenizers` library gives them for a vocabulary file.

    Where the same vocabulary is at hand as ranks too, texts of Latin letters without
    an added token of the file are merged by tiktoken, which gives the same ids in a
    quarter of the time; all others go through `tokenizers`.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        # executors give a task one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.merge = _merger(ranks) if ranks else None

    def encode(self, text: str) -> np.ndarray:
        if self.merge and _LATIN.fullmatch(text) and not self.added.search(text):
            return np.array(self.merge(text), dtype="<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _merger(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=1)
def encoder(path: str, ranks: str | None) -> Encoder:
    """One encoder per worker."""
    return Encoder(path, ranks)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, after a first one that may be shorter."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], length], strict=True)], strict=True))


def pieces(
    docs: DataFrame,
    path: str,
    ranks: str | None,
    id_col: str,
    text_col: str,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, place), written once: place is the rank of its length in its task."""
    small_batches(docs.sparkSession, 200)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sent, kind = for_pandas(narrow, "id")
    end = np.array([END], dtype="<u4")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task = encoder(path, ranks).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            out = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                ids = np.concatenate((encode(text or ""), end))
                for number, (start, length) in enumerate(cuts(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((key, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "place"]
            yield pd.DataFrame(out, columns=names)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, place long"
    return store(from_pandas(sent.mapInPandas(run, schema), "id", narrow))


# the plan


def best_pair(counts: np.ndarray, least: int, most: int) -> tuple[int, int] | None:
    """Two lengths with pieces left whose sum is largest in least + 1 to most; of equal sums the most uneven."""
    lengths = np.flatnonzero(counts[: most + 1])
    if not len(lengths):
        return None
    # for each length the longest partner that still fits
    at = np.searchsorted(lengths, most - lengths, side="right") - 1
    partner = np.where(at >= 0, lengths[np.maximum(at, 0)], -1)
    # a length needs a second piece to be its own partner
    alone = (partner == lengths) & (counts[lengths] < 2)
    partner = np.where(alone, np.where(at > 0, lengths[np.maximum(at - 1, 0)], -1), partner)
    sums = np.where(partner > 0, lengths + partner, -1)
    best = int(sums.argmax())
    if sums[best] <= least:
        return None
    return int(lengths[best]), int(partner[best])


def fill(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The next bin, as pieces taken per length: greedy, then two for the smallest where that is tighter."""
    left, gap, taken = counts.copy(), capacity, {}
    while gap:
        fitting = np.flatnonzero(left[: gap + 1])
        if not len(fitting):
            break
        length = int(fitting[-1])
        many = min(int(left[length]), gap // length)
        taken[length] = many
        left[length] -= many
        gap -= many * length
    if gap and sum(taken.values()) > 1:
        smallest = min(taken)
        pair = best_pair(left, smallest, gap + smallest)
        if pair:
            taken[smallest] -= 1
            for length in pair:
                taken[length] = taken.get(length, 0) + 1
    return {length: many for length, many in taken.items() if many}


class Plan:
    """Runs of ranks per length: from which rank, in which bins, how many to a bin, at which offset."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            left[length] = n
        self.bins = 0
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {length: [] for length in counts}
        given = np.zeros(capacity + 1, dtype=np.int64)
        while left.any():
            taken = fill(left, capacity)
            times = min(int(left[length]) // many for length, many in taken.items())
            offset = 0
            for length in sorted(taken, reverse=True):
                many = taken[length]
                self.runs[length].append((int(given[length]), self.bins, many, offset))
                given[length] += many * times
                left[length] -= many * times
                offset += many * length
            self.bins += times
        self.starts = {length: [r[0] for r in runs] for length, runs in self.runs.items()}

    def place(self, length: int, rank: int) -> tuple[int, int]:
        """(sequence, offset) of the piece with a rank among those of its length."""
        start, base, many, offset = self.runs[length][bisect_right(self.starts[length], rank) - 1]
        number, within = divmod(rank - start, many)
        return base + number, offset + within * length


def pack(
    docs: DataFrame,
    path: str,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    A document's ids end with id 0, so a null, empty or repeated text is a piece
    like any other. Only longer documents are cut; then all pieces but the first
    are whole sequences. Offsets of a sequence have no gaps. Repeated rows and null
    ids are packed one by one; an empty table gives an empty result; other columns
    are ignored. A text is encoded whole, whatever its length. path is a vocabulary of
    the `tokenizers` library, ranks the same vocabulary for tiktoken, if there is one.
    """
    rows = pieces(docs, path, ranks, id_col, text_col, capacity)
    tasks = store(rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    # one row per task in a window, never the pieces
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = tasks.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = Plan({r["length"]: r["n"] for r in counts}, capacity)
    ranked = rows.join(first, ["length", "task"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank")
    )
    sent, kind = for_pandas(ranked, "id")
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.place(n, r) for n, r in zip(batch["length"], batch["rank"], strict=True)]
            batch["sequence_id"] = np.array([f[0] for f in found], dtype=np.int64)
            batch["offset"] = np.array([f[1] for f in found], dtype=np.int64)
            yield batch.drop(columns="rank")

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = from_pandas(sent.mapInPandas(run, schema), "id", ranked)
    return placed.withColumnRenamed("id", id_col)


def op12_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS))
