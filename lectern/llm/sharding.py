"""Shards by a Feistel permutation over global row numbers. Built-in functions only.

Rows are numbered 0 to N - 1 in the order of a key. A Feistel network permutes
the numbers 0 to A * B - 1, where A * B is the least such product of nearly
equal factors that is N or more; a number that leaves 0 to N - 1 is sent through
the network again until it is back (cycle walking). The permuted number p gives
shard p mod S and slot p div S, so shards differ by one row at most, and shard
and slot of any row can be computed from its number, the seed and N alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import free_name, store

ROUNDS = 4
SEED = 42
SHARDS = 16
# neighbouring rows that are moved together, as a power of two
RUN_BITS = 6
# bits that monotonically_increasing_id gives to the row within its partition
_WITHIN = (1 << 33) - 1


def factors(rows: int) -> tuple[int, int]:
    """A and B with A * B >= rows, and fewer than A numbers to spare."""
    a = math.isqrt(max(0, rows - 1)) + 1
    return a, max(1, -(-rows // a))


def _round(right, number: int, seed: int) -> F.Column:
    """48 pseudo-random bits of one half; md5, so that SQL elsewhere can compute them."""
    text = F.concat(F.lit(f"{seed}:{number}:"), right.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def _step(number: int, size: int, seed: int):
    """A round: the halves change places, and one is shifted by a hash of the other."""

    def step(s):
        shifted = F.pmod(s["l"] + _round(s["r"], number, seed), F.lit(size))
        return F.struct(s["r"].alias("l"), shifted.alias("r"))

    return step


def _network(x, rows: int, seed: int) -> F.Column:
    """One pass of the network over 0 to A * B - 1, as nested steps over (left, right)."""
    a, b = factors(rows)
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    state = F.struct(left.alias("l"), right.alias("r"))
    for number in range(ROUNDS):
        step = _step(number, a if number % 2 == 0 else b, seed)
        # a one-element transform binds the state, so that it is computed once
        state = F.transform(F.array(state), step)[0]
    return F.transform(F.array(state), lambda s: s["l"] * F.lit(b) + s["r"])[0]


def permute(x, rows: int, seed: int = SEED) -> F.Column:
    """The place of row number x of `rows` rows.

    At most A * B - rows numbers lie outside, and a walk meets each of them once
    at most, so that many steps always suffice; a share of about one in A of the
    rows takes any.
    """
    a, b = factors(rows)
    first = _network(x, rows, seed)
    if a * b == rows:
        return first
    spare = F.sequence(F.lit(1), F.lit(a * b - rows))
    return F.transform(
        F.array(first),
        lambda y: F.when(y < rows, y).otherwise(
            F.aggregate(
                spare, y, lambda z, _: F.when(z < rows, z).otherwise(_network(z, rows, seed))
            )
        ),
    )[0]


def number_rows(df: DataFrame, order_by: list[str]) -> tuple[DataFrame, str, int]:
    """The rows with a global number in the order of the columns, its name, and how many there are.

    Range partitions are written once; a row's number is its place in its
    partition after the sizes of the partitions before. Only those sizes come to
    the driver. Rows alike in all columns of the order may lie in several
    partitions, so many of them don't meet in one task; which of them has which
    number is then open, so give columns that tell rows apart.
    """
    spark = df.sparkSession
    spread = free_name(df.columns, "spread")
    place = free_name(df.columns, "row_number")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = store(
        df.withColumn(spread, F.monotonically_increasing_id())
        .repartitionByRange(parts, *order_by, spread)
        .sortWithinPartitions(*order_by, spread)
        .drop(spread)
        .withColumn(place, F.monotonically_increasing_id())
    )
    part = F.shiftright(place, 33)
    sizes = store(stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")))
    total = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    # one row per range partition, so this window and the broadcast are as small as that
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sizes.select("_part", (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"))
    numbered = stored.join(F.broadcast(before), part == F.col("_part"))
    number = F.col("_before") + F.col(place).bitwiseAND(F.lit(_WITHIN))
    return numbered.withColumn(place, number).drop("_part", "_before"), place, total


def shard(
    df: DataFrame,
    shards: int = SHARDS,
    order_by: list[str] | None = None,
    seed: int = SEED,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """The rows with their shard (int) and their slot in it (long, from 0, without gaps).

    Shards differ by one row at most. order_by, all columns by default, fixes the
    row numbers: the same rows in another order or layout get the same result.
    Nulls count as smallest. Rows alike in those columns share their set of places
    among them. An empty table gives an empty result. Columns of the input with
    the names of the new ones are replaced.

    Only the columns of the order are sorted. Where there are others, rows find
    their place by their number in the table, in one join, so df must be a stored
    table then, whose rows can be numbered alike twice.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    order_by = order_by or df.columns
    others = [c for c in df.columns if c not in order_by and c not in (shard_col, slot_col)]
    if not others:
        return _placed(df.select(*order_by), shards, order_by, seed, shard_col, slot_col)
    row = free_name(df.columns, "row")
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    placed = _placed(numbered.select(*order_by, row), shards, order_by, seed, shard_col, slot_col)
    # rows travel in runs of 64 neighbours, so that copies stay together and pack well
    run, places = free_name(df.columns, "run"), free_name(df.columns, "places")
    of_run = F.shiftright(row, RUN_BITS).alias(run)
    place = F.struct(F.col(shard_col).alias("shard"), F.col(slot_col).alias("slot"))
    listed = placed.groupBy(of_run).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(row), place))).alias(places)
    )
    found = numbered.drop(shard_col, slot_col).withColumn(run, F.shiftright(row, RUN_BITS))
    at = F.element_at(places, F.col(row))
    return found.join(store(listed), run).select(
        *(c for c in df.columns if c not in (shard_col, slot_col)),
        at["shard"].alias(shard_col),
        at["slot"].alias(slot_col),
    )


def _placed(
    df: DataFrame, shards: int, order_by: list[str], seed: int, shard_col: str, slot_col: str
) -> DataFrame:
    numbered, place, total = number_rows(df, order_by)
    at = free_name(numbered.columns, "at")
    placed = numbered.withColumn(at, permute(F.col(place), total, seed))
    return (
        placed.withColumn(shard_col, F.pmod(at, F.lit(shards)).cast("int"))
        .withColumn(slot_col, F.floor(F.col(at) / shards).cast("long"))
        .drop(place, at)
    )


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dealt = shard(narrow, SHARDS, ["doc_id", "size", "text_crc32"])
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
