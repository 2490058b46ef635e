"""Connected components by contraction.

Each round joins every vertex to its smallest neighbour, follows those links to
their ends, and puts the ends in place of the vertices in the edges. Of two
neighbours at least one is joined to a smaller one, so each round leaves at most
half of the vertices that still have edges: the number of rounds is logarithmic,
also for long chains. Nothing but counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import Steps, store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    edges: columns a, b of one type, in either direction, repeats and loops
    allowed; an edge with a null end is no edge.
    """
    with Steps(edges.sparkSession) as step:
        return store(_contracted(edges, step))


def _contracted(edges: DataFrame, step: Steps) -> DataFrame:
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct()
    edges = step(edges)
    parts = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("b"))
        links = step(least.select(F.col("a").alias("node"), F.col("b").alias("root")))
        links = _to_ends(links, step)
        parts.append(links)
        ends_a = links.select(F.col("node").alias("a"), F.col("root").alias("to_a"))
        ends_b = links.select(F.col("node").alias("b"), F.col("root").alias("to_b"))
        edges = step(
            edges.join(ends_a, "a")
            .join(ends_b, "b")
            .where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    if not parts:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = parts[0]
    for links in parts[1:]:
        after = links.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(after, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")
        )
    return found


def _to_ends(links: DataFrame, step: Steps) -> DataFrame:
    """Follow links, doubling the step each time; links always lead to smaller nodes."""
    while True:
        after = links.select(F.col("node").alias("root"), F.col("root").alias("next"))
        longer = step(
            links.join(after, "root", "left").select(
                "node",
                F.coalesce("next", "root").alias("root"),
                (F.coalesce("next", "root") != F.col("root")).alias("moved"),
            )
        )
        links = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return links
