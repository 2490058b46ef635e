"""A Merkle manifest of a dataset: leaves, roots and proofs, kept as strings of one level.

Leaves are numbered within their group, and every 256 neighbours form an aligned
block. A block keeps each level as one string of 64-digit digests: fixed-width
substrings of two digests hash to the level above, and the digest flanking a
node in the string is the sibling its proof needs. The last digest of each block
is a leaf of the tree one storey up, which is built the same way, until a group
has one block; the groups' roots, in order, are the leaves of the last tree. So
no task holds more than one block, and the work grows with the rows.

A path is an array of text: per level `L` or `R`, the side on which the sibling
stands, and the sibling's digest, or nothing where the node has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import free_name, remainder, store
from lectern.llm.sharding import number_rows

WIDTH = 64
# levels in a block; its size is two to that power
LEVELS = 8

_PARENTS = f"""
array_join(transform(sequence(0, (length(level) - 1) div {2 * WIDTH}),
                     i -> sha2(substring(level, i * {2 * WIDTH} + 1, {2 * WIDTH}), 256)), '')
"""
# every level of a block, from its leaves to its last digest
_CLIMB = f"""
if(height = 0, array(level0),
   aggregate(sequence(1, height), array(level0),
             (all, k) -> concat(all, transform(slice(all, -1, 1), level -> {_PARENTS}))))
"""
_SIBLING = f"""
concat(if(shiftright(e.at, k) & 1 = 1, 'L', 'R'),
       substring(levels[k], (shiftright(e.at, k) ^ 1) * {WIDTH} + 1, {WIDTH}))
"""
_STEPS = f"if(height = 0, cast(array() as array<string>), transform(sequence(0, height - 1), k -> {_SIBLING}))"


def digest(column: Column) -> Column:
    return F.sha2(column, 256)


def encoded(column: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return digest(F.concat(*(encoded(c) for c in columns)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def step(node: Column, s: Column) -> Column:
        sibling = F.substr(s, F.lit(2))
        return digest(
            F.when(F.left(s, F.lit(1)) == "L", F.concat(sibling, node)).otherwise(
                F.concat(node, sibling)
            )
        )

    return F.aggregate(path, leaf, step)


def siblings(path: Column) -> Column:
    """The siblings of a path, joined from left to right as they come."""
    return F.array_join(F.transform(path, lambda s: F.substr(s, F.lit(2))), "")


def paths(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(group, pos, path, root) of (group, pos, n, node): nodes 0 to n - 1 of each group are its leaves."""
    size = 1 << levels
    member = F.struct(F.pmod("pos", F.lit(size)).cast("int").alias("at"), "pos", "node")
    blocks = nodes.groupBy("group", F.floor(F.col("pos") / size).alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members")
    )
    # a group of one block ends at its root, all others fill their blocks' levels
    height = F.when(F.col("n") > size, levels).otherwise(F.ceil(F.log2("n")).cast("int"))
    blocks = (
        blocks.withColumn("height", height)
        .withColumn("level0", F.array_join(F.transform("members", lambda e: e["node"]), ""))
        .withColumn("levels", F.expr(_CLIMB))
        .drop("level0")
    )
    blocks = store(blocks)
    top = F.element_at("levels", -1)
    steps = F.expr(f"transform(members, e -> struct(e.pos as pos, {_STEPS} as path))")
    inner = blocks.select("group", "block", top.alias("root"), F.inline(steps))
    if blocks.where(F.col("n") > size).isEmpty():
        return inner.select("group", "pos", "path", "root")
    above = blocks.select(
        "group",
        F.col("block").alias("pos"),
        F.ceil(F.col("n") / size).cast("long").alias("n"),
        top.alias("node"),
    )
    upper = paths(above, levels).select(
        "group", F.col("pos").alias("block"), F.col("path").alias("rest"), F.col("root").alias("top")
    )
    return inner.join(upper, ["group", "block"]).select(
        "group", "pos", F.concat("path", "rest").alias("path"), F.col("top").alias("root")
    )


def manifest(leaves: DataFrame, group_col: str, order_by: list[str], levels: int = LEVELS) -> DataFrame:
    """The rows with subroot, root and path; leaves has a digest `leaf`.

    Within a group rows stand in the order of the columns, nulls first; rows alike
    in all of them must have the same leaf, and share their places among them. A
    null group is a group of its own and comes first, the others follow bytewise.
    Columns of the input named subroot, root or path are replaced. An empty table
    gives an empty result.
    """
    kept = [c for c in leaves.columns if c not in ("subroot", "root", "path")]
    group = free_name(kept, "group")
    tag = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    numbered, number, _ = number_rows(leaves.select(*kept, tag.alias(group)), [group, *order_by])
    groups = numbered.groupBy(F.col(group).alias("group")).agg(
        F.min(number).alias("first"), F.count(F.lit(1)).alias("n")
    )
    groups = store(groups)
    nodes = numbered.select(F.col(group).alias("group"), F.col(number).alias("number"), F.col("leaf").alias("node"))
    placed = nodes.join(groups, "group").select(
        "group", (F.col("number") - F.col("first")).alias("pos"), "n", "node"
    )
    found = paths(placed, levels)

    # the groups' roots are the leaves of one more tree
    subroots = found.where("pos = 0").select("group", F.col("root").alias("subroot"))
    ranked, rank, total = number_rows(subroots, ["group"])
    ranked = store(ranked)
    tops = ranked.select(
        F.lit("").alias("group"), F.col(rank).alias("pos"), F.lit(total).cast("long").alias("n"), F.col("subroot").alias("node")
    )
    last = paths(tops, levels).select(F.col("pos").alias(rank), F.col("path").alias("rest"), "root")
    ends = ranked.join(last, rank).join(groups, "group")
    ends = store(ends.select("group", "first", "subroot", "rest", "root"))

    # rows meet their paths by their number
    whole = found.drop("root").join(ends, "group").select(
        (F.col("pos") + F.col("first")).alias(number), "subroot", "root", F.concat("path", "rest").alias("path")
    )
    return numbered.join(whole, number).select(*kept, "subroot", "root", "path")


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """Every seventh id by checksum is tampered with: its n_chars grows by 1 on the way to the proof."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, after = [F.col(c) for c in ("doc_id", "source", "lang")], F.col("text")
    leaf = leaf_of(*before, F.col("n_chars"), after)
    hit = (remainder(F.col("doc_id"), 7) == 0) & F.col("n_chars").isNotNull()
    changed = leaf_of(*before, F.col("n_chars") + 1, after)
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(hit, changed).alias("changed"))
    found = manifest(leaves, "lang", ["doc_id", "leaf"])
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
