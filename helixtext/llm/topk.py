"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors are dealt to blocks by a hash, queries to blocks of their own. For each
pair of blocks a task sorts the vectors' components once for each dimension and
walks the lists downwards (upwards for a negative weight): every vector met is
scored in full, and the walk stops when the bound of all that is unseen, the
weighted sum of the components at the depth reached, cannot beat the k-th score.
The few best of each pair of blocks then meet by query.

Defined cases: vectors that are null, empty or hold a null or non-finite
component take no part; shorter vectors count as if zeros followed; equal scores
go to the smaller id; rows with the same id are candidates one by one, but no
row with the query's own id is; a query without candidates has no rows;
numbers beyond 64 bits count as the largest of those; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors and queries in a block, on average.
BLOCK = 2048
QUERY_BLOCK = 1024
#: Depth of the first walk; each next one doubles what has been walked.
FIRST_DEPTH = 8
SCALE = 256
LARGEST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def threshold_search(vectors: np.ndarray, ids: np.ndarray, orders: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) of the vectors but the query's own, and the depth walked to.

    vectors: n x d; orders: d x n, each dimension's vectors from the highest component down.
    """
    n = len(vectors)
    up = query < 0
    weights = np.abs(query)
    dims = np.flatnonzero(weights)
    seen = np.zeros(n, bool)
    best_scores, best_ids = np.empty(0, vectors.dtype), np.empty(0, np.int64)
    depth, step = 0, FIRST_DEPTH
    if not len(dims):  # every score is 0: the lists say nothing, the smallest ids win
        take = np.sort(ids[ids != own])[:k]
        return [(0, int(i)) for i in take], 0
    while depth < n:
        end = min(n, depth + step)
        met = np.concatenate([orders[d, n - end : n - depth] if up[d] else orders[d, depth:end] for d in dims])
        fresh = np.zeros(n, bool)
        fresh[met] = True
        fresh &= ~seen
        seen |= fresh
        at = np.flatnonzero(fresh)
        at = at[ids[at] != own]
        if len(at):
            best_scores = np.concatenate([best_scores, vectors[at] @ query])
            best_ids = np.concatenate([best_ids, ids[at]])
            if len(best_ids) > k:
                top = np.lexsort((best_ids, -best_scores))[:k]
                best_scores, best_ids = best_scores[top], best_ids[top]
        depth, step = end, end
        if seen.all():
            break
        last = np.array([vectors[orders[d, n - end] if up[d] else orders[d, end - 1], d] for d in dims])
        # nothing unseen scores more; at an equal score a smaller id might come, so only more than the bound will do
        if len(best_ids) >= k and best_scores.min() > (query[dims] * last).sum():
            break
    order = np.lexsort((best_ids, -best_scores))[:k]
    return [(int(best_scores[i]), int(best_ids[i])) for i in order], depth


def _matrix(values: list, width: int) -> np.ndarray:
    """Rows of whole numbers; float64 or 64-bit integers while products are exact, Python's numbers beyond."""
    flat = max((abs(int(x)) for v in values for x in (min(v), max(v))), default=0)
    kind = np.float64 if flat**2 * max(1, width) < 2**53 else np.int64 if flat**2 * max(1, width) < 2**63 else object
    out = np.zeros((len(values), width), kind)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def search_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Best of a block of vectors for each query: query_id, vec_id, score."""
    rows = []
    if len(vectors) and len(queries):
        width = max(map(len, [*vectors["v"], *queries["v"]]))
        both = _matrix([*vectors["v"], *queries["v"]], width)
        m, q = both[: len(vectors)], both[len(vectors) :]
        ids = vectors["vec_id"].to_numpy(np.int64)
        orders = np.stack([np.argsort(-m[:, d], kind="stable") for d in range(width)])
        for own, weights in zip(queries["query_id"].tolist(), q, strict=True):
            rows += [(own, i, max(-LARGEST, min(LARGEST, s))) for s, i in threshold_search(m, ids, orders, weights, own, k)[0]]
    return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; vectors: vec_id, embedding; queries: query_id, embedding."""
    use = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", whole_numbers(F.col("embedding")).alias("v"))
    ask = queries.where(usable(F.col("embedding")) & F.col("query_id").isNotNull()).select("query_id", whole_numbers(F.col("embedding")).alias("v")).dropDuplicates()
    sizes = vectors.agg(F.count("*").alias("n")).first()["n"], queries.agg(F.count("*").alias("n")).first()["n"]
    rows, columns = max(1, math.ceil(sizes[0] / block)), max(1, math.ceil(sizes[1] / query_block))

    def dealt(df: DataFrame, own: str, blocks: int, others: int, mine: str, theirs: str) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(own), own, "v"), F.lit(blocks)).cast("int")
        return df.withColumn(mine, at).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(use, "vec_id", rows, columns, "i", "j")
    right = dealt(ask, "query_id", columns, rows, "j", "i")
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
