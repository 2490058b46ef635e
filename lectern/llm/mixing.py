"""Mix overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong
to. A network routes words: each pattern offers its words once per repetition,
in steps whose cost rises with every step, each source draws up to its target
from the patterns that hold it. Costs depend on the step alone, so cheapest
augmenting paths are found step by step: all patterns get the capacity of the
next step, and a maximum flow is carried on until targets are met or the
repetitions are used up. Repeats are thus spread evenly, and nothing is repeated
while fresh words would do.

The flow gives each pattern a number of words. Whole passes over the pattern are
taken first; the rest is drawn document by document in an order seeded by a hash.
The place where the rest ends is found from sums over hash buckets, so no task
sees more of a large pattern than one bucket. What the last document leaves open is
drawn for again from all documents that fit in it, until none does.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import free_name, store, word_count

SEED = 42
SHARE = 1.5
MAX_REPEAT = 2
WEIGHTS = (5.0, 2.0, 1.0)
# steps of rising cost in one pass over a pattern
STEPS = 8
# hash buckets in which sums are kept per pattern
BUCKETS = 4096
# most membership patterns the driver routes; more are refused, not cut
MAX_PATTERNS = 100_000


def cycling(sources: list[str | None]) -> dict[str | None, float]:
    """Weights 5, 2, 1, repeating, over the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(ordered)}


def targets(
    sizes: dict[str | None, int], weights: dict[str | None, float], total: float, most: float
) -> dict[str | None, float]:
    """Shares of total by weight, none above `most` times its source; excess goes to the others."""
    capped: dict[str | None, float] = {}
    while True:
        left = total - sum(capped.values())
        open_ = [s for s in sizes if s not in capped]
        weight = sum(weights[s] for s in open_)
        if not open_ or weight <= 0:
            return {s: capped.get(s, 0.0) for s in sizes}
        share = {s: left * weights[s] / weight for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return {s: capped[s] if s in capped else share[s] for s in sizes}
        capped.update({s: float(most * sizes[s]) for s in above})


def route(
    patterns: dict[str, tuple[list[str | None], int]],
    wanted: dict[str | None, int],
    repeats: int,
    steps: int = STEPS,
) -> dict[str, dict[str | None, int]]:
    """Words from each pattern to each source: a maximum flow of least repetition cost."""
    flow = {p: dict.fromkeys(members, 0) for p, (members, _) in patterns.items()}
    holders: dict[str | None, list[str]] = {}
    for p, (members, _) in patterns.items():
        for s in members:
            holders.setdefault(s, []).append(p)
    need = dict(wanted)
    room = dict.fromkeys(patterns, 0)
    for step in range(repeats * steps):
        for p, (_, size) in patterns.items():
            room[p] += size * (step + 1) // steps - size * step // steps
        # direct arcs first, then paths that move earlier flow to another source
        for p in sorted(patterns):
            for s in patterns[p][0]:
                moved = min(room[p], need.get(s, 0))
                flow[p][s] += moved
                room[p] -= moved
                need[s] = need.get(s, 0) - moved
        while any(need.values()):
            path = _augment(patterns, holders, flow, room, need)
            if path is None:
                break
    return flow


def _augment(patterns, holders, flow, room, need) -> list | None:
    """Send words along one path from a pattern with room to a source in need, if there is one.

    A source already served may pass on: a pattern that serves it serves another
    of its sources instead. Searched backwards from the sources in need.
    """
    parent: dict = {("s", s): None for s, n in need.items() if n > 0}
    queue = deque(parent)
    while queue:
        node = queue.popleft()
        kind, name = node
        if kind == "s":
            for p in holders.get(name, []):
                if ("p", p) in parent:
                    continue
                parent["p", p] = node
                if room[p] > 0:
                    return _apply(("p", p), parent, flow, room, need)
                queue.append(("p", p))
        else:
            for s, words in flow[name].items():
                if words > 0 and ("s", s) not in parent:
                    parent["s", s] = node
                    queue.append(("s", s))
    return None


def _apply(start, parent, flow, room, need) -> list:
    path = [start]
    while parent[path[-1]] is not None:
        path.append(parent[path[-1]])
    amount = min(room[start[1]], need[path[-1][1]])
    for a, b in zip(path, path[1:], strict=False):
        if a[0] == "s":
            amount = min(amount, flow[b[1]][a[1]])
    for a, b in zip(path, path[1:], strict=False):
        if a[0] == "p":
            flow[a[1]][b[1]] += amount
        else:
            flow[b[1]][a[1]] -= amount
    room[start[1]] -= amount
    need[path[-1][1]] -= amount
    return path


def mix(
    docs: DataFrame,
    sources: F.Column,
    weigh: Callable[[list], dict] = cycling,
    share: float = SHARE,
    repeats: int = MAX_REPEAT,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_patterns: int = MAX_PATTERNS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, report): how often each document is taken, and what each source wants and gets.

    sources: an array of the sources of a document; null entries are a source of
    their own, an empty or null array belongs to none and is never taken. rows has
    (row, id, size, pattern, copies), one per document; row numbers the rows of
    docs, a stored table. report has (source, source_size, target, given).
    Targets share `share` times all words by weight and stop at `repeats` times the
    source. A pattern's words are never exceeded, and missed by less than the smallest
    of its documents that are not drawn. A null or
    blank text has size 0 and counts as taken whole passes only. Equal ids and
    repeated rows are documents of their own; the result depends on ids, sizes and
    the seed, and for equal ids on the order of the table. An empty table gives
    empty results. Other columns are ignored.
    """
    spark = docs.sparkSession
    kept = F.array_sort(F.array_distinct(sources.cast("array<string>")))
    rows = store(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            word_count(F.col(text_col)).alias("size"),
            F.to_json(kept).alias("pattern"),
        ).withColumn("order", F.xxhash64(F.lit(seed), "id", "size"))
    ).withColumn("bucket", F.pmod("order", F.lit(BUCKETS)).cast("int"))
    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(max_patterns + 1)
    found = found.collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {
        r["pattern"]: (json.loads(r["pattern"]), r["size"]) for r in found if r["pattern"] is not None
    }
    sizes: dict[str | None, int] = {}
    for members, size in patterns.values():
        for s in members:
            sizes[s] = sizes.get(s, 0) + size
    total = share * sum(r["size"] for r in found)
    wanted = targets(sizes, weigh(list(sizes)), total, repeats)
    flow = route(patterns, {s: round(t) for s, t in wanted.items()}, repeats)
    given = {s: sum(f.get(s, 0) for f in flow.values()) for s in sizes}
    quotas = []
    for p, (_, size) in patterns.items():
        words = sum(flow[p].values())
        full = words // size if size else 0
        quotas.append((p, full, words - full * size))
    quota = spark.createDataFrame(quotas, "pattern string, full long, rest long")
    report = spark.createDataFrame(
        [(s, sizes[s], float(wanted[s]), given[s]) for s in sizes],
        "source string, source_size long, target double, given long",
    )
    return _draw(rows, quota), report


def _draw(rows: DataFrame, quota: DataFrame) -> DataFrame:
    """Copies of each row: the whole passes of its pattern, and one more for those drawn."""
    # quota has a row per pattern, of which there are MAX_PATTERNS at most
    marked = rows.join(F.broadcast(quota), "pattern", "left").withColumns(
        {"full": F.coalesce("full", F.lit(0)), "gap": F.coalesce("rest", F.lit(0))}
    )
    drawn = store(_in_order(marked))
    # what the draw leaves open is drawn for again from the rows that fit in, until none does;
    # the row that ends a pass is longer than what is left and takes no part in the next
    left, filled = _fitting(drawn), []
    while not left.isEmpty():
        taken = store(_in_order(left))
        filled.append(taken.where("drawn").select("row", F.lit(1).alias("filler")))
        left = _fitting(taken)
    once_more = F.col("drawn").cast("int")
    if filled:
        drawn = drawn.join(reduce(DataFrame.unionByName, filled), "row", "left")
        once_more = F.when(F.col("drawn") | F.col("filler").isNotNull(), 1).otherwise(0)
    return drawn.select(
        "row", "id", "size", "pattern", (F.col("full") + once_more).cast("long").alias("copies")
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows with drawn: whether they come before the sum of sizes passes the gap of their pattern."""
    upto = Window.partitionBy("pattern").orderBy("bucket")
    # a pattern whose rows all fit has no cut; one without a gap gives nothing
    cuts = store(
        rows.where("gap > 0")
        .groupBy("pattern", "bucket")
        .agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        .withColumn("upto", F.sum("words").over(upto))
        .where("upto >= gap and upto - words < gap")
        .select("pattern", F.col("bucket").alias("cut"), (F.col("upto") - F.col("words")).alias("before"))
    )
    marked = rows.join(F.broadcast(cuts), "pattern", "left").withColumn(
        "cut", F.when(F.col("gap") > 0, F.coalesce("cut", F.lit(BUCKETS))).otherwise(-1)
    )
    sure = marked.where("bucket <> cut").withColumn("drawn", F.expr("bucket < cut"))
    # rows of one bucket of each pattern
    order = Window.partitionBy("pattern").orderBy("order", "id", "row")
    border = (
        marked.where("bucket = cut")
        .withColumn("drawn", F.col("before") + F.sum("size").over(order) <= F.col("gap"))
    )
    return sure.unionByName(border).drop("cut", "before")


def _fitting(drawn: DataFrame) -> DataFrame:
    """The rows not drawn that fit in what is left of their pattern's gap, with that as their gap."""
    got = drawn.where("drawn").groupBy("pattern").agg(F.sum("size").alias("got"))
    return store(
        drawn.where("not drawn and size > 0 and gap > 0")
        .join(F.broadcast(got), "pattern", "left")
        .withColumn("gap", F.col("gap") - F.coalesce("got", F.lit(0)))
        .where("size <= gap")
        .select("row", "id", "size", "pattern", "order", "bucket", "gap")
    )


def mixed(docs: DataFrame, sources: F.Column, **options) -> DataFrame:
    """The documents of the mix: each as often as it is taken, with the columns of the input."""
    rows, _ = mix(docs, sources, **options)
    row, copies = free_name(docs.columns, "row"), free_name(docs.columns, "copies")
    taken = rows.where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    repeated = numbered.join(taken, row).withColumn(
        copies, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
    )
    return repeated.select(*docs.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, report = mix(docs, F.array("source"))
    of_source = report.withColumn("pattern", F.to_json(F.array("source")))
    return rows.join(F.broadcast(of_source), "pattern").select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
