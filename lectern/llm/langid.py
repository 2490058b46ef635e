"""Language identification by rank-order profiles.

The profile of a language is its most frequent character n-grams in rank order,
counted over all labelled training texts. A document is compared by its own most
frequent n-grams: the distance to a language is the sum over them of how far out
of place each is in the profile, and PROFILE for one that is not there. The
nearest language wins.

n-grams have one to three characters of a lower-cased word with a blank on
either side; whatever is no letter separates words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import remainder, small_batches

# n-grams of a profile, and most n-grams of a document
PROFILE = 400
UNKNOWN = "und"
# characters handled at once while counting
CHUNK_CHARS = 1_000_000

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTERS.append(table)
    return _LETTERS[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, as numbers in ascending order, and their counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.concatenate(([32], np.where(_letters()[points], points, 32), [32])).astype(np.int64)
    keep = points != 32
    keep[1:] |= points[:-1] != 32
    keep[0] = True
    points = points[keep]
    if len(points) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    grams = np.concatenate(
        (
            points[points != 32],
            points[:-1] << 21 | points[1:],
            (a << 42 | b << 21 | c)[b != 32],
        )
    )
    return np.unique(grams, return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, best first, ties to the smaller number."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


def _add(total, more):
    grams = np.concatenate((total[0], more[0]))
    counts = np.concatenate((total[1], more[1]))
    unique, at = np.unique(grams, return_inverse=True)
    return unique, np.bincount(at, weights=counts, minlength=len(unique)).astype(np.int64)


def profiles(labelled: DataFrame, lang_col: str, text_col: str, size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank from 0) over all rows with a language and a text."""
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                total = totals.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                waiting: list[str] = []
                for text in texts:
                    waiting.append(text)
                    if sum(map(len, waiting)) > CHUNK_CHARS:
                        total = _add(total, ngrams("\n".join(waiting)))
                        waiting = []
                totals[lang] = _add(total, ngrams("\n".join(waiting)))
        for lang, (grams, counts) in totals.items():
            yield pd.DataFrame({"lang": lang, "gram": grams, "n": counts})

    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counted = (
        rows.mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the rank is filtered as it is, so that Spark cuts each task to it before the shuffle
    best = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return best.select("lang", "gram", (F.col("place") - 1).alias("rank"))


class Identifier:
    """All profiles as one table of ranks; size languages x PROFILE n-grams."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], dtype=np.int64))
        # one row more for n-grams that no profile has
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, dtype=np.int32)
        for lang, gram, rank in rows:
            at = np.searchsorted(self.grams, gram)
            self.ranks[at, self.langs.index(lang)] = rank

    def identify(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and its distance as a share of the largest, taken from 1."""
        grams, counts = ngrams(text or "")
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(grams, counts, self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at[self.grams[at] != own] = len(self.grams)
        ranks = self.ranks[at]
        away = np.abs(ranks - np.arange(len(own))[:, None])
        away = np.where(ranks < 0, self.size, away).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(own))


def train(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE
) -> Identifier:
    """Profiles of all languages; what comes to the driver is size n-grams per language."""
    rows = profiles(labelled, lang_col, text_col, size).collect()
    return Identifier([(r["lang"], r["gram"], r["rank"]) for r in rows], size)


def identify(model: Identifier, text, spark) -> F.Column:
    """struct(lang, score) of a text column.

    A text that is null or has no letter is `und` with score 0; so is every text
    if nothing was learned. Ties go to the language that sorts first. Whole texts
    are counted, whatever their length.
    """
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [sent.value.identify(t) for t in texts]
            yield pd.DataFrame(found, columns=["lang", "score"])

    # the module's annotations are text; pandas_udf reads types
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang string, score double")(text)


def train_split(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: three of four by the checksum of their id."""
    return docs.where((remainder(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull())


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language can be told; the others have no letter, or no text."""
    model = train(train_split(docs))
    marked = identify(model, F.col("text"), docs.sparkSession)["lang"]
    return docs.where(marked != UNKNOWN)


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(train_split(docs))
    found = docs.select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        identify(model, F.col("text"), spark).alias("found"),
    )
    return found.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score")
    )
