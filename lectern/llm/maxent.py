"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

Each word has a class: the commonest words and the end mark have their own, all
others are put together by their last two characters. The probability of a word
is that of its class in context times its share of the class:
P(class | context) is a softmax over groups of classes times one over the classes
of the group, whose weights are summed from hashed features of the context (the word before, the pair of classes before, the
word two back, the pair of classes three and four back), and the share is
(count + 1) over the same sum for the class, which holds one more for all words
never seen. The share has no features: words within a class have no context.

Counts cover all training texts. Weights are trained by gradient steps on the
executors: each task goes through its part of the texts in small batches, and
the tables of all tasks are averaged, each row by how often the task met it; the
next round starts from the average with other texts. Every training text is used
in one round, whole.

Words with large counts, HEAD at most, go to the tasks; for the others scoring
leaves (row, word, how often) behind, which is joined with the stored counts.
So nothing that grows with the input is broadcast.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import for_pandas, from_pandas, remainder, small_batches, store

# most words whose counts are sent to the tasks
HEAD = 1 << 17
CLASSES = 64
# classes of single words: the end mark, then the commonest words
SINGLE = 16
# rows of the weight table: words, words two back, pairs of classes twice
WORD_ROWS, SKIP_ROWS, PAIR_ROWS = 1 << 14, 1 << 13, CLASSES * CLASSES
ROWS = WORD_ROWS + SKIP_ROWS + 2 * PAIR_ROWS
# the softmax over the classes has two levels: WIDTH groups, then the classes of the group;
# a row of the table has a slot for the groups and one for the classes of each group
WIDTH = 8
SLOTS = 1 + CLASSES // WIDTH
ROUNDS = 2
RATE = 0.15
# largest logit, either way
BOUND = 60.0
# tokens of a gradient step and of a scoring step
STEP = 1 << 15
# words a task counts before it hands them on
COUNTED = 300_000
# characters of texts that are encoded together; a longer text is a chunk of its own
CHUNK = 1 << 22
# rows of the weight table that are averaged together, and tasks merged at once
BLOCK = 512
MERGED = 64
# no word has a blank in it
END = " "
PAD = 4

def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, one text after the other, and how many each has."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    lists = pc.ascii_split_whitespace(trimmed)
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # a text without words is split into one empty word
    blank = pc.equal(trimmed, "").to_numpy(False)
    if blank.any():
        words = words.filter(pc.not_equal(words, ""))
    return words, np.where(blank, 0, sizes)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of (text), stored; every text has one end mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _counts(pa.array([], pa.large_string()), 0)
        for batch in batches:
            words, _ = words_of(batch.column("text"))
            held = pa.concat_tables([held, _counts(words, batch.num_rows)])
            if held.num_rows > 2 * COUNTED:
                held = _merged(held)
                if held.num_rows > COUNTED:
                    yield from held.to_batches()
                    held = held.slice(0, 0)
        yield from _merged(held).to_batches()

    def _counts(words: pa.Array, ends: int) -> pa.Table:
        found = words.value_counts()
        word = pa.concat_arrays([found.field(0).cast(pa.string()), pa.array([END])])
        return pa.table({"word": word, "n": pa.concat_arrays([found.field(1), pa.array([ends], pa.int64())])})

    def _merged(held: pa.Table) -> pa.Table:
        return held.group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    counted = texts.mapInArrow(run, "word string, n long")
    return store(counted.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")))


def suffix_class(column) -> F.Column:
    """Class of a word without a class of its own, from its last two characters."""
    return SINGLE + F.pmod(F.xxhash64(F.substring(column, -2, 2)), F.lit(CLASSES - SINGLE))


def suffix_class_of(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word.decode("utf-8", "replace")[-2:].encode(), 42)
    return SINGLE + (value - (1 << 64 if value >> 63 else 0)) % (CLASSES - SINGLE)


class Model:
    """Head words with counts and classes, class sizes, and weights."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, kinds: int):
        order = sorted(range(len(words)), key=lambda k: (words[k] != END.encode(), -counts[k], words[k]))
        self.words = pa.array([words[k].decode() for k in order], pa.large_string())
        self.counts = np.array([counts[k] for k in order], dtype=np.int64)
        self.classes = np.array(
            [r if r < SINGLE else suffix_class_of(words[k]) for r, k in enumerate(order)],
            dtype=np.int64,
        )
        self.end = 0
        self.total, self.kinds = total, kinds
        self.weights = np.zeros((ROWS, SLOTS, WIDTH), dtype=np.float32)

    def set_sizes(self, tail: dict[int, int]) -> None:
        """Sizes of the classes: counts plus one for each word, and one for all unseen."""
        sizes = np.bincount(self.classes, weights=self.counts + 1, minlength=CLASSES) + 1
        for k, n in tail.items():
            sizes[k] += n
        self.sizes = sizes
        grouped = sizes.reshape(-1, WIDTH)
        self.group_bias = np.log(grouped.sum(axis=1) / sizes.sum()).astype(np.float32)
        self.class_bias = np.log(grouped / grouped.sum(axis=1, keepdims=True)).astype(np.float32)

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple]:
        """Chunks of texts as arrays: ids, classes, places and words beyond the head, lengths.

        Each text begins with PAD end marks and ends with one; ids beyond the head are negative.
        """
        held: list[str | None] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size > CHUNK:
                yield self._arrays(*words_of(pa.array(held, pa.large_string())))
                held, size = [], 0
        if held:
            yield self._arrays(*words_of(pa.array(held, pa.large_string())))

    def _arrays(self, flat: pa.Array, sizes: np.ndarray):
        at_rank = pc.index_in(flat, value_set=self.words)
        found = pc.fill_null(at_rank, -1).to_numpy().astype(np.int64)
        kinds = self.classes[np.maximum(found, 0)]
        beyond = np.flatnonzero(found < 0)
        others = flat.take(pa.array(beyond)).cast(pa.large_binary()).to_pylist()
        # two characters are two bytes if those are ASCII, eight at most otherwise
        suffixes = [w[-2:] if w[-2:].isascii() else w[-8:] for w in others]
        memo = {x: suffix_class_of(x) for x in set(suffixes)}
        kinds[beyond] = [memo[x] for x in suffixes]
        found[beyond] = [-1 - zlib.crc32(w) for w in others]
        # words move behind the marks of their own text and of those before
        place = np.arange(len(flat)) + np.repeat((PAD + 1) * np.arange(len(sizes)) + PAD, sizes)
        size = len(flat) + (PAD + 1) * len(sizes)
        ids = np.full(size, self.end, dtype=np.int64)
        classes = np.full(size, self.classes[self.end], dtype=np.int64)
        ids[place], classes[place] = found, kinds
        return ids, classes, (beyond, others), sizes

    @staticmethod
    def features(ids: np.ndarray, classes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of the weight table for the contexts of the positions, one row of four each."""
        mix = np.uint64(0x9E3779B97F4A7C15)

        def hashed(x: np.ndarray, bits: int) -> np.ndarray:
            return ((x.astype(np.uint64) * mix) >> np.uint64(64 - bits)).astype(np.int64)

        return np.stack(
            [
                hashed(ids[at - 1], 14),
                WORD_ROWS + hashed(ids[at - 2], 13),
                WORD_ROWS + SKIP_ROWS + classes[at - 1] * CLASSES + classes[at - 2],
                WORD_ROWS + SKIP_ROWS + PAIR_ROWS + classes[at - 3] * CLASSES + classes[at - 4],
            ],
            axis=1,
        )

    @staticmethod
    def positions(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words and ends of the texts lie, and where each text begins among them."""
        lengths = sizes + 1
        begins = np.cumsum(lengths) - lengths
        shift = PAD * (np.arange(len(sizes)) + 1)
        return np.arange(lengths.sum()) + np.repeat(shift, lengths), begins

    def logits(self, rows: np.ndarray, classes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the groups, and of the classes within the group of each position's class.

        Bounded, so that their exponentials need no shift.
        """
        slots = weights.reshape(-1, WIDTH)
        out = []
        for base, bias in ((0, self.group_bias), (1 + classes // WIDTH, self.class_bias[classes // WIDTH])):
            at = rows * SLOTS + (base if isinstance(base, int) else base[:, None])
            # take copies whole rows, several times faster than an index does
            logit = slots.take(at[:, 0], axis=0)
            for k in range(1, at.shape[1]):
                logit += slots.take(at[:, k], axis=0)
            logit += bias
            out.append(np.clip(logit, -BOUND, BOUND, out=logit))
        return out[0], out[1]

    def train(self, weights: np.ndarray, squares: np.ndarray, met: np.ndarray, texts) -> None:
        """Gradient steps over the texts; changes the three tables."""
        ones, each = np.ones(WIDTH, np.float32), np.arange(WIDTH)
        for ids, classes, _, sizes in self.encode(texts):
            where, _ = self.positions(sizes)
            for k in range(0, len(where), STEP):
                at = where[k : k + STEP]
                own = classes[at]
                rows = self.features(ids, classes, at)
                errors = []
                for error, target in zip(self.logits(rows, own, weights), (own // WIDTH, own % WIDTH), strict=True):
                    np.exp(error, out=error)
                    error *= (1.0 / (error @ ones))[:, None]
                    error[np.arange(len(at)), target] -= 1.0
                    errors.append(error.ravel())
                for column in range(rows.shape[1]):
                    # row by number among those met; sixteen bits are sorted in linear time
                    order = np.argsort(rows[:, column].astype(np.uint16), kind="stable")
                    sorted_ = rows[order, column]
                    new = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
                    row = sorted_[new]
                    number = np.empty(len(order), np.int64)
                    number[order] = np.cumsum(new) - 1
                    slot = number * WIDTH + own // WIDTH
                    size = len(row) * WIDTH
                    step = np.empty((len(row), SLOTS, WIDTH), np.float32)
                    step[:, 0] = np.bincount(
                        (number[:, None] * WIDTH + each).ravel(), errors[0], size
                    ).reshape(len(row), WIDTH)
                    step[:, 1:] = np.bincount(
                        (slot[:, None] * WIDTH + each).ravel(), errors[1], size * WIDTH
                    ).reshape(len(row), WIDTH, WIDTH)
                    seen = np.bincount(slot, minlength=size).reshape(len(row), WIDTH)
                    met[row, 0] += seen.sum(axis=1)
                    met[row, 1:] += seen
                    total = squares[row] + np.einsum("ijk,ijk->ij", step, step) / WIDTH
                    squares[row] = total
                    step *= (RATE / np.sqrt(total + 1e-3))[:, :, None]
                    weights[row] -= step

    def score(self, texts):
        """For each text: tokens, known head tokens, log10 sums of head counts and of the model,
        and the other words."""
        ones = np.ones(WIDTH, np.float32)
        head_base = np.log10(self.counts + 1)
        head_share = head_base - np.log10(self.sizes[self.classes])
        for ids, classes, (beyond, others), sizes in self.encode(texts):
            where, begins = self.positions(sizes)
            part = np.zeros(len(where))
            for k in range(0, len(where), STEP):
                at = where[k : k + STEP]
                own = classes[at]
                logits = self.logits(self.features(ids, classes, at), own, self.weights)
                for logit, target in zip(logits, (own // WIDTH, own % WIDTH), strict=True):
                    part[k : k + STEP] += logit[np.arange(len(at)), target]
                    np.exp(logit, out=logit)
                    part[k : k + STEP] -= np.log(logit @ ones)
            part /= np.log(10)
            own = ids[where]
            known = own >= 0
            base = np.where(known, head_base[np.maximum(own, 0)], 0.0)
            share = np.where(known, head_share[np.maximum(own, 0)], 0.0)
            share[~known] = -np.log10(self.sizes[classes[where[~known]]])
            known &= self.counts[np.maximum(own, 0)] > 0
            sums = [np.add.reduceat(x, begins) for x in (known.astype(np.int64), base, part + share)]
            # the other words of a text lie together
            cuts = np.searchsorted(beyond, np.cumsum(sizes)).tolist()
            for k, (a, b) in enumerate(zip([0, *cuts], cuts, strict=False)):
                yield int(sizes[k]) + 1, *(x[k] for x in sums), Counter(others[a:b])


def _head(counts: DataFrame) -> tuple[list[bytes], list[int], int]:
    """The words with the largest counts, at most HEAD, and the least count among them.

    The limit is found from a histogram of the logarithm of the counts, whose size
    does not depend on the number of words; words alike in that are in together.
    The end mark always belongs to them, also with no text at all.
    """
    ends = counts.where(F.col("word") == END).collect()
    counts = counts.where(F.col("word") != END)
    step = F.floor(F.log2("n") * 64).cast("int")
    bars = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n"))
    least, held = None, 0
    for bar in sorted(bars.collect(), key=lambda r: -r["step"]):
        held += bar["m"]
        if held >= HEAD:
            break
        least = bar["n"]
    rows = counts.where(F.col("n") >= least).collect() if least is not None else []
    words = [END.encode(), *(r["word"].encode() for r in rows)]
    numbers = [ends[0]["n"] if ends else 0, *(r["n"] for r in rows)]
    return words, numbers, 1 << 62 if least is None else least


def fit(texts: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and the stored counts of the words beyond its head, from rows of (text, part).

    part, from 0 to rounds - 1, says in which round a text is learned.
    """
    spark = texts.sparkSession
    counts = count_words(texts.select("text"))
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    words, numbers, least = _head(counts)
    model = Model(words, numbers, whole[0], whole[1])
    tail = counts.where((F.col("n") < least) & (F.col("word") != END))
    sizes = tail.groupBy(suffix_class(F.col("word")).alias("k")).agg(F.sum(F.col("n") + 1).alias("n"))
    model.set_sizes({r["k"]: r["n"] for r in sizes.collect()})
    if whole[0]:
        for k in range(rounds):
            model.weights = _round(model, texts.where(F.col("part") == k).select("text"), spark)
    return model, tail


def _round(model: Model, texts: DataFrame, spark) -> np.ndarray:
    """Weights after all tasks have gone through their texts, averaged row by row."""
    sent = spark.sparkContext.broadcast(model)
    blocks = ROWS // BLOCK
    schema = "block int, task long, weights binary, met binary"

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own = sent.value
        weights = own.weights.copy()
        squares, met = np.zeros((ROWS, SLOTS), np.float32), np.zeros((ROWS, SLOTS), np.int64)
        for batch in batches:
            own.train(weights, squares, met, batch["text"])
        for k in range(blocks):
            part = slice(k * BLOCK, (k + 1) * BLOCK)
            if met[part].any():
                yield pd.DataFrame(
                    {
                        "block": [k], "task": [TaskContext.get().partitionId()],
                        "weights": [weights[part].tobytes()],
                        "met": [met[part].astype(np.float64).tobytes()],
                    }
                )

    def average(rows: pd.DataFrame) -> pd.DataFrame:
        total, met = np.zeros((BLOCK, SLOTS, WIDTH)), np.zeros((BLOCK, SLOTS))
        # a fixed order, so that reruns round alike
        for _, row in rows.sort_values("task").iterrows():
            n = np.frombuffer(row["met"]).reshape(BLOCK, SLOTS)
            new = np.frombuffer(row["weights"], np.float32).reshape(BLOCK, SLOTS, WIDTH)
            total += new * n[:, :, None]
            met += n
        mean = (total / np.maximum(met, 1.0)[:, :, None]).astype(np.float32)
        return pd.DataFrame(
            {
                "block": [int(rows["block"].iloc[0])], "task": [int(rows["task"].min()) // MERGED],
                "weights": [mean.tobytes()], "met": [met.tobytes()],
            }
        )

    found = texts.mapInPandas(train, schema)
    # MERGED tasks at a time, then as many of what has come of those; the few that are
    # left, one for some 4,000 tasks, meet in the end
    for _ in range(2):
        group = F.floor(F.col("task") / MERGED).alias("group")
        found = found.groupBy("block", group).applyInPandas(average, schema)
    weights = model.weights.copy()
    for row in found.groupBy("block").applyInPandas(average, schema).collect():
        own = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
        n = np.frombuffer(row["met"]).reshape(BLOCK, SLOTS) > 0
        new = np.frombuffer(row["weights"], np.float32).reshape(BLOCK, SLOTS, WIDTH)
        weights[own][n] = new[n]
    return weights


def score(docs: DataFrame, train: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score), a row per input row.

    Learns from the rows for which train holds, scores all. A null text is empty:
    one end mark. Equal ids and repeated rows are rows of their own. Without
    training rows nothing is known, and the model has but one class mass per class.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    part = F.pmod(F.xxhash64("id", F.length("text")), F.lit(ROUNDS)).cast("int").alias("part")
    model, tail = fit(rows.where("train").select("text", part))
    sent = spark.sparkContext.broadcast(model)
    narrow, kind = for_pandas(rows, "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(sent.value.score(list(batch["text"])))
            n, known, base, own, other = zip(*found, strict=True) if found else ((),) * 5
            yield pd.DataFrame(
                {
                    "row": batch["row"], "id": batch["id"], "train": batch["train"],
                    "n": np.array(n, np.int64), "known": np.array(known, np.int64),
                    "base": np.array(base, float), "own": np.array(own, float),
                    "words": [[w.decode("utf-8", "replace") for w in x] for x in other],
                    "times": [list(x.values()) for x in other],
                }
            )

    scored = (
        narrow.mapInPandas(
            run,
            f"row long, id {kind}, train boolean, n long, known long, base double, own double,"
            " words array<string>, times array<long>",
        )
    )
    partly = store(from_pandas(scored, "id", rows))
    single = partly.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    # unseen words have no row in the counts and add log10(1)
    beyond = (
        single.join(tail, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    )
    below = float(np.log10(model.total + model.kinds + 1))
    logs = F.coalesce("logs", F.lit(0.0))
    return (
        partly.drop("words", "times")
        .join(beyond, "row", "left")
        .select(
            "id",
            "train",
            F.col("n").alias("n_tokens"),
            (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(model.total).cast("long").alias("train_tokens"),
            (F.col("base") + logs - F.col("n") * F.lit(below)).alias("base_score"),
            (F.col("own") + logs).alias("score"),
        )
    )


def op6_maxent(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = score(docs, remainder(F.col("doc_id"), 7) != 2)
    return found.select(
        F.col("id").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
