"""Steps of a query that are stored and read back, and what is left on disk by them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block a query drops its shuffle files when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many
    steps holds the files of all of them at once.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def store(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a step to the shared folder and read it back.

    Cuts lineage: what follows reads files that survive a lost executor, and
    the step is computed once however often it is used. The shuffle files it took go.
    """
    path = path or scratch_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Steps:
    """Stored steps that are dropped together, once what reads them is written.

    ``with Steps(spark) as step:`` then ``step(df)`` in place of ``store(df)``; what
    leaves the block must be stored outside of it.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.number = spark, scratch_dir(spark), 0

    def __enter__(self) -> Steps:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        self.number += 1
        return store(df, f"{self.root}/{self.number}")

    def __exit__(self, *_) -> None:
        drop(self.spark, self.root)


class Relay:
    """Stored steps of which each is read by the next one alone, and dropped once that is written.

    The last one stays, as what is left of the query reads it; as a context, it goes at the end.
    ``root`` is a folder for them; by default they lie in the shared folder.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root, self.number = spark, root or scratch_dir(spark), 0

    def __enter__(self) -> Relay:
        return self

    @property
    def last(self) -> str:
        return f"{self.root}/{self.number}"

    def __call__(self, df: DataFrame) -> DataFrame:
        before = self.last
        self.number += 1
        out = store(df, self.last)
        drop(self.spark, before)
        return out

    def __exit__(self, *_) -> None:
        drop(self.spark, self.root)
