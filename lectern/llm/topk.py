"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; of each the mean and the standard deviation are
kept, at a coarse and at a fine resolution. For a segment of n components the
squared distance of two vectors is at least
n * ((mean - mean')^2 + (deviation - deviation')^2), and the inner product is
half of what the squared lengths exceed the squared distance by. So a lower
bound on the distance rules a candidate out once it stays under the k-th best
score so far: first coarse, then fine, then the exact score of the survivors.

Queries and candidates are dealt by hash into a grid of groups and slices of
bounded size; each cell is one task's work, and the best k of the slices are
merged per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import store

TOP = 20
SCALE = 64
# rows of a candidate slice and of a query group, on average
SLICE_ROWS = 4096
GROUP_ROWS = 1024
# candidates of a slice handled at once
BLOCK = 512
# components per segment, coarse to fine
SEGMENTS = (16, 4)


def statistics(vectors: np.ndarray, length: int) -> np.ndarray:
    """Means and deviations of the segments, weighted so that a product of two rows bounds theirs."""
    pad = -vectors.shape[1] % length
    parts = np.pad(vectors, ((0, 0), (0, pad))).reshape(len(vectors), -1, length)
    return np.hstack([parts.mean(axis=2), parts.std(axis=2)]) * np.sqrt(length)


def lower_bounds(a: np.ndarray, b: np.ndarray, squares_a, squares_b) -> np.ndarray:
    """Least squared distances of rows of a and b, from the statistics; a little less for rounding."""
    total = squares_a[:, None] + squares_b[None, :]
    return total - 2 * (a @ b.T) - 1e-9 * total - 1e-6


def search(
    queries: np.ndarray, q_rows: np.ndarray, vectors: np.ndarray, v_rows: np.ndarray,
    v_ids: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, candidate number, score): the k best of each query, ties to the smaller id.

    queries and vectors are int64. A candidate with the row of the query is left out.
    """
    order = np.argsort(-np.einsum("ij,ij->i", vectors.astype(float), vectors.astype(float)), kind="stable")
    vectors, v_rows, v_ids = vectors[order], v_rows[order], v_ids[order]
    fq, fv = queries.astype(float), vectors.astype(float)
    sq, sv = np.einsum("ij,ij->i", fq, fq), np.einsum("ij,ij->i", fv, fv)
    levels = [(statistics(fq, n), statistics(fv, n)) for n in SEGMENTS]
    # products are exact in floats as long as no partial sum can leave 53 bits
    largest = (np.abs(fq).max(initial=0) * np.abs(fv).max(initial=0)) * max(1, fq.shape[1])
    exact_floats = largest < 2.0**53
    least = np.full(len(queries), -np.inf)
    best = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),)
    for at in range(0, len(vectors), BLOCK):
        rows, cols = np.arange(len(queries)), np.arange(at, min(at + BLOCK, len(vectors)))
        alive = np.ones((len(rows), len(cols)), dtype=bool)
        for own, other in levels:
            bound = lower_bounds(own[rows], other[cols], sq[rows], sv[cols])
            most = (sq[rows][:, None] + sv[cols][None, :] - bound) / 2
            alive &= most >= least[rows][:, None]
            keep_r, keep_c = alive.any(axis=1), alive.any(axis=0)
            rows, cols, alive = rows[keep_r], cols[keep_c], alive[keep_r][:, keep_c]
            if not len(rows):
                break
        if not len(rows):
            continue
        if exact_floats:
            score = (fq[rows] @ fv[cols].T).astype(np.int64)
        else:
            score = queries[rows] @ vectors[cols].T
        alive &= (score >= least[rows][:, None]) & (q_rows[rows][:, None] != v_rows[cols][None, :])
        i, j = np.nonzero(alive)
        q = np.concatenate((best[0], rows[i]))
        v = np.concatenate((best[1], cols[j]))
        s = np.concatenate((best[2], score[i, j]))
        by = np.lexsort((v_ids[v], -s, q))
        q, v, s = q[by], v[by], s[by]
        first = np.searchsorted(q, np.arange(len(queries)))
        inside = np.arange(len(q)) - first[q] < k
        best = q, v, s = q[inside], v[inside], s[inside]
        full = np.flatnonzero(np.bincount(q, minlength=len(queries)) == k)
        least[full] = s[np.searchsorted(q, full, side="right") - 1]
    return best[0], order[best[1]], best[2]


def _cell(key, left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for size in np.intersect1d(left["vector"].map(len).unique(), right["vector"].map(len).unique()):
        a, b = (x[x["vector"].map(len) == size].reset_index(drop=True) for x in (left, right))
        qv, cv = (np.stack(x["vector"].to_list()).astype(np.int64).reshape(len(x), size) for x in (a, b))
        # candidates without an id come last among equals
        ids = np.where(b["no_id"], np.iinfo(np.int64).max, b["id"])
        q, v, s = search(qv, a["row"].to_numpy(), cv, b["row"].to_numpy(), ids, k)
        out.append(
            pd.DataFrame(
                {
                    "query_row": a["row"].to_numpy()[q],
                    "query_id": a["id"].to_numpy()[q],
                    "vec_id": b["id"].to_numpy()[v],
                    "no_id": b["no_id"].to_numpy()[v],
                    "vec_row": b["row"].to_numpy()[v],
                    "score": s,
                }
            )
        )
    columns = ["query_row", "query_id", "vec_id", "no_id", "vec_row", "score"]
    return pd.concat(out) if out else pd.DataFrame(columns=columns)


def top_k(vectors: DataFrame, is_query: F.Column, k: int = TOP) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k candidates with the largest inner products.

    vectors: id long and vector array<long>, one row per vector, a stored table;
    is_query picks the queries, and every other row is a candidate. Vectors of
    another length than the query's are none; a null vector takes no part. Ties go
    to the smaller id, then to the row that comes first; repeated rows and ids are
    candidates of their own. A query with fewer candidates has all; an empty table
    gives an empty result.
    """
    rows = store(
        vectors.where(F.col("vector").isNotNull()).select(
            F.monotonically_increasing_id().alias("row"),
            # pandas has no whole numbers with nulls
            F.coalesce("id", F.lit(0)).cast("long").alias("id"),
            F.col("id").isNull().alias("no_id"),
            "vector",
            F.coalesce(is_query, F.lit(False)).alias("query"),
        )
    )
    count = rows.agg(F.count(F.lit(1)), F.count_if("query")).first()
    slices, groups = max(1, -(-count[0] // SLICE_ROWS)), max(1, -(-count[1] // GROUP_ROWS))
    spread = F.xxhash64("row")
    candidates = rows.select(
        "row", "id", "no_id", "vector",
        F.pmod(spread, F.lit(slices)).alias("slice"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"),
    )
    # aliases, so that the two sides of the cogroup share no column of the plan
    queries = rows.where("query").select(
        *(F.col(c).alias(c) for c in ("row", "id", "no_id", "vector")),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"),
        F.pmod(spread, F.lit(groups)).alias("grp"),
    )

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _cell(key, left, right, k)

    found = (
        queries.groupBy("slice", "grp")
        .cogroup(candidates.groupBy("slice", "grp"))
        .applyInPandas(
            run,
            "query_row long, query_id long, vec_id long, no_id boolean, vec_row long, score long",
        )
        .withColumn("vec_id", F.when(~F.col("no_id"), F.col("vec_id")))
    )
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row"
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def scaled(column: F.Column, scale: int = SCALE) -> F.Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite."""
    wide = column.cast("array<double>")
    finite = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(wide, lambda x: F.floor(x * F.lit(scale)).cast("long"))
    return F.when(finite, whole)


def op7_topk(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = table.select(
        F.col("vec_id").cast("long").alias("id"), scaled(F.col("embedding")).alias("vector")
    )
    return top_k(vectors, F.col("id") % 20 == 0, TOP)
