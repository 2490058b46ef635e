"""What several operators share: stored steps (of ``sources/steps.py``), batches, ids in tasks, column names, words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.sources.steps import Steps, store  # noqa: F401

# a word of the contracts: everything but the six ASCII blanks
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows per Arrow batch, so that a batch of long texts fits beside its copies in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def for_pandas(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """The frame with a whole-number column as text, and the column's type for the result.

    pandas makes floats of whole numbers with nulls among them, which cannot hold large
    ids. Cast back with ``from_pandas``.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return df.withColumn(column, F.col(column).cast("string")), "string"
    return df, kind.simpleString()


def from_pandas(df: DataFrame, column: str, like: DataFrame) -> DataFrame:
    """A column that went out as text in the type it had before."""
    kind = like.schema[column].dataType
    same = not isinstance(kind, T.IntegralType)
    return df if same else df.withColumn(column, F.col(column).cast(kind))


def free_name(taken: Iterable[str], wish: str) -> str:
    """A column name near the wish that the table does not have, whatever its case."""
    used = {x.lower() for x in taken}
    name, k = wish, 0
    while name.lower() in used:
        k += 1
        name = f"{wish}_{k}"
    return name


def word_count(column) -> F.Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id, divisor: int) -> F.Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
