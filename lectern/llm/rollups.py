"""Token counts by source, language and tokenizer version, kept up by signed deltas.

A change is a number of documents and tokens with a sign: an insert adds, a
delete takes away what the document had, a revision does both. Changes of a batch
are summed per key before they are stored, in a folder of the batch. Totals are
the sum over all batches, so nothing is ever updated in place.

A batch counts from the moment its folder holds Spark's success marker. A second
commit under the same id finds the marker and does nothing; one that broke off
before has no marker, is not read, and is written anew. Compaction sums batches
into a new base that lists them; readers take the newest complete base and the
batches it does not list, so a compaction that breaks off changes nothing either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import small_batches, store, word_count
from lectern.session import scratch_dir

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
# runs of ASCII letters and digits, runs beyond ASCII, single marks
PIECE = r"[0-9A-Za-z]+|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


def piece_count(column) -> F.Column:
    """Number of pieces; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(PIECE)), F.lit(0)).cast("long")


TOKENIZERS: dict[str, Callable] = {"words-1": word_count, "pieces-1": piece_count}


def vocabulary_counter(path: str, spark: SparkSession) -> Callable:
    """A counter for TOKENIZERS by a public tokenizer file (tokenizer.json) at a path all executors have."""
    small_batches(spark)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        for texts in batches:
            whole = tokenizer.encode_batch(texts.fillna("").tolist(), add_special_tokens=False)
            yield pd.Series([len(x.ids) for x in whole], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")


def counted(
    docs: DataFrame,
    tokenizers: dict[str, Callable] | None = None,
    source_col: str = "source",
    lang_col: str = "lang",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(source, lang, tokenizer, docs = 1, tokens, *keep): a row for each document and tokenizer.

    Null texts have no tokens and count as documents; null sources and languages
    are keys of their own.
    """
    counts = [
        F.struct(F.lit(name).alias("tokenizer"), count(F.col(text_col)).alias("tokens"))
        for name, count in sorted((tokenizers or TOKENIZERS).items())
    ]
    return docs.select(
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        *keep,
        F.explode(F.array(*counts)).alias("c"),
    ).select("source", "lang", "c.tokenizer", F.lit(1).cast("long").alias("docs"), "c.tokens", *keep)


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """The rows as inserts (1) or deletes (-1)."""
    return rows.select(*KEYS, (F.col("docs") * sign).alias("docs"), (F.col("tokens") * sign).alias("tokens"))


def revision(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of revised documents: the old ones taken away, the new ones added."""
    return signed(old, -1).unionByName(signed(new, 1))


def _sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
    )


class Rollup:
    """Totals in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or scratch_dir(spark)

    def _files(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(conf), where

    def _complete(self, path: str) -> bool:
        files, where = self._files(f"{path}/_SUCCESS")
        return files.exists(where)

    def _names(self, kind: str) -> list[str]:
        """Complete folders of a kind; one per batch since the last compaction, or per base."""
        files, where = self._files(f"{self.folder}/{kind}")
        if not files.exists(where):
            return []
        names = [unquote(s.getPath().getName()) for s in files.listStatus(where)]
        return sorted(n for n in names if self._complete(f"{self.folder}/{kind}/{quote(n, safe='')}"))

    def _base(self) -> tuple[str | None, DataFrame]:
        """The newest base and the batches it holds, as a stored table."""
        bases = self._names("base")
        if not bases:
            return None, self.spark.createDataFrame([], "batch string")
        return bases[-1], self.spark.read.schema("batch string").parquet(f"{self.folder}/lists/{bases[-1]}")

    def _open(self, listed: DataFrame) -> list[str]:
        """Batches with a folder that the base does not hold."""
        there = self.spark.createDataFrame([(n,) for n in self._names("batches")], "batch string")
        return sorted(r["batch"] for r in there.join(listed, "batch", "left_anti").collect())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store the changes of a batch, once; False if the batch was there already."""
        path = f"{self.folder}/batches/{quote(batch, safe='')}"
        if self._complete(path) or not self._base()[1].where(F.col("batch") == batch).isEmpty():
            return False
        _sum(changes).where("docs <> 0 or tokens <> 0").write.mode("overwrite").parquet(path)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all batches; keys that come to 0 are gone."""
        base, listed = self._base()
        return self._totals(base, self._open(listed))

    def _totals(self, base: str | None, batches: list[str]) -> DataFrame:
        paths = [f"{self.folder}/base/{base}"] if base else []
        paths += [f"{self.folder}/batches/{quote(b, safe='')}" for b in batches]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*paths)
        return _sum(rows).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Sum all batches into a new base; one compaction at a time.

        What is summed is what is listed: a batch committed meanwhile stays a batch of
        its own. Old folders may be deleted by ``clean`` when no reader uses them.
        """
        base, listed = self._base()
        batches = self._open(listed)
        name = f"{int(base) + 1 if base else 0:08d}"
        rows = self._totals(base, batches)
        new = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        listed.unionByName(new).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/lists/{name}")
        # the base's own marker comes last and makes both count
        rows.write.mode("overwrite").parquet(f"{self.folder}/base/{name}")

    def clean(self) -> None:
        """Delete the folders of batches that the newest base holds, and older bases with their lists."""
        base, listed = self._base()
        there = set(self._names("batches"))
        gone = [f"batches/{quote(b, safe='')}" for b in there.difference(self._open(listed))]
        for old in self._names("base"):
            gone += [f"{kind}/{old}" for kind in ("base", "lists") if old != base]
        for name in gone:
            files, where = self._files(f"{self.folder}/{name}")
            files.delete(where, True)


def without_digits(text) -> F.Column:
    """The revision of the query: runs of digits go."""
    return F.regexp_replace(text, "[0-9]+", "")


def op8_rollup(spark, sf_dir: str) -> DataFrame:
    """All documents come in, toxic ones go, low-quality ones come back without digits.

    The removal is sent twice, as after a broken connection, and counts once; a
    compaction lies between.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before = store(counted(docs, keep=("doc_id",)))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    low = labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    removal = signed(before.join(toxic, "doc_id", "left_semi"), -1)
    # counted where the texts are: to join first would move whole texts, and counts are small
    revised = docs.withColumn("text", without_digits(F.col("text")))
    after = store(counted(revised, keep=("doc_id",))).join(low, "doc_id", "left_semi")

    rollup = Rollup(spark)
    rollup.commit("load", signed(before, 1))
    rollup.commit("toxic", removal)
    rollup.compact()
    rollup.clean()
    rollup.commit("toxic", removal)
    rollup.commit("low quality", revision(before.join(low, "doc_id", "left_semi"), after))
    return rollup.totals()
