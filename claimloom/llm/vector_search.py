"""Nearest vectors by cosine as a block matrix join.

Vectors are dealt into candidate groups and query groups of bounded size; every pair of groups is one
tile of the product matrix.  Inside a tile, unit vectors are quantised to int8.  The product of two int8
blocks gives every cosine up to a proven error: with residuals ``e_q`` and ``e_c`` of the unit vectors,
``|cos - approximation| <= e_q + e_c + e_q * e_c``.  Pairs whose upper bound reaches a query's k-th best
lower bound are recomputed in double precision from the original vectors and merged into the query's
k best.  A window merges the best of all tiles, so results are exact.  A query's own row is searched like any other,
one place more is kept for it, and it is left out in the end; so repeated ids and repeated rows need no care.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import written

CANDIDATES_PER_GROUP = 8_192
QUERIES_PER_GROUP = 2_048
BLOCK = 2_048
EXACT_PAIRS = 32_768
# covers rounding of the float32 products and scales
SLACK = 1e-5
# up to so many components sums of products of int8 codes are exact in float32
FLOAT32_COMPONENTS = 1_040


def _quantised(vectors: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scale and the length of what rounding left over."""
    unit = vectors / norms[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1)


def _length(vectors: np.ndarray) -> np.ndarray:
    # scaled, so that squares of very large or small components stay in range
    top = np.abs(vectors).max(axis=1, keepdims=True)
    return top[:, 0] * np.sqrt(((vectors / top) ** 2).sum(axis=1))


def tile_nearest(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k + 1 best candidates of one tile for each of its queries; ``own`` marks rows like the query's own row."""
    empty = pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": [], "own": []})
    if queries.empty or candidates.empty:
        return empty.astype({"query": "int64", "query_id": "int64", "vec_id": "int64", "own": "bool"})
    q_ids, c_ids = queries["vec_id"].to_numpy(dtype=np.int64), candidates["vec_id"].to_numpy(dtype=np.int64)
    q, c = (np.array(frame["embedding"].tolist(), dtype=np.float64) for frame in (queries, candidates))
    q_norm, c_norm = _length(q), _length(c)
    q_codes, q_scale, q_left = _quantised(q, q_norm)
    c_codes, c_scale, c_left = _quantised(c, c_norm)
    exact = np.float32 if q.shape[1] <= FLOAT32_COMPONENTS else np.float64
    q_wide = q_codes.astype(exact)
    best = None
    reach = np.full(len(q_ids), -np.inf)  # each query's last kept score so far
    for start in range(0, len(c_ids), BLOCK):
        stop = min(start + BLOCK, len(c_ids))
        approx = (q_wide @ c_codes[start:stop].T.astype(exact)).astype(np.float64)
        approx *= q_scale[:, None] * c_scale[None, start:stop]
        bound = q_left[:, None] + c_left[None, start:stop] + q_left[:, None] * c_left[None, start:stop] + SLACK
        floor = reach
        if stop - start > k + 1:
            floor = np.maximum(floor, np.partition(approx - bound, -(k + 1), axis=1)[:, -(k + 1)])
        rows, columns = np.nonzero(approx + bound >= floor[:, None])
        columns = columns + start
        scores = np.empty(len(rows))
        for at in range(0, len(rows), EXACT_PAIRS):
            part = slice(at, at + EXACT_PAIRS)
            left, right = rows[part], columns[part]
            dots = (q[left] / q_norm[left, None] * (c[right] / c_norm[right, None])).sum(axis=1)
            scores[part] = dots
        own = q_ids[rows] == c_ids[columns]
        own[own] = (q[rows[own]] == c[columns[own]]).all(axis=1)
        found = pd.DataFrame({"row": rows, "vec_id": c_ids[columns], "score": scores, "own": own})
        best = found if best is None else pd.concat([best, found])
        best = best.sort_values(["row", "score", "vec_id"], ascending=[True, False, True])
        place = best.groupby("row").cumcount()
        best = best[place <= k]
        full = best[place[place <= k] == k]
        reach[full["row"]] = full["score"]
    numbers = queries["query"].to_numpy(dtype=np.int64)
    return best.assign(query=numbers[best["row"]], query_id=q_ids[best["row"]])[list(empty.columns)]


def nearest_vectors(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest other vectors, ties to the smaller id.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on them.  Vectors that are
    null, empty, zero or hold a null or non-finite component take no part, neither do null ids.  Vectors are
    compared with those of the same number of components.  Every row counts: rows that share a query's id, or
    repeat it, are candidates, and each of several query rows under one id has its own ``k`` result rows.  With
    fewer than ``k`` candidates all are returned; an empty table gives no rows; other columns are ignored.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = (
        vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "_query")
        .filter(
            F.col("vec_id").isNotNull()
            & F.forall("embedding", finite)
            & F.exists("embedding", lambda x: x != 0)
        )
        .withColumn("dim", F.size("embedding"))
    )
    # numbered once, so that a query keeps its number in every tile
    asked = written(usable.filter("_query").drop("_query").withColumn("query", F.monotonically_increasing_id()), "queries")
    groups = max(1, math.ceil(usable.count() / CANDIDATES_PER_GROUP))
    query_groups = max(1, math.ceil(asked.count() / QUERIES_PER_GROUP))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # vectors, as ids may repeat without bound
    dealt = lambda column, n: F.pmod(F.xxhash64(column, "embedding"), F.lit(n)).cast("int")
    candidates = usable.select("dim", dealt("vec_id", groups).alias("c_group"), every(query_groups).alias("q_group"), "vec_id", "embedding")
    queries = asked.select(
        "dim", every(groups).alias("c_group"), dealt("query", query_groups).alias("q_group"), "query", "vec_id", "embedding"
    )
    tile = ["dim", "q_group", "c_group"]
    best = queries.groupBy(*tile).cogroup(candidates.groupBy(*tile)).applyInPandas(
        lambda left, right: tile_nearest(left, right, k), "query long, query_id long, vec_id long, score double, own boolean"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    own_so_far = F.sum(F.col("own").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        best.withColumn("owns", own_so_far)
        .withColumn("rank", (F.row_number().over(order) - F.least("owns", F.lit(1))).cast("int"))
        .filter(~(F.col("own") & (F.col("owns") == 1)) & (F.col("rank") <= k))
        .select("query_id", "rank", "vec_id", "score")
    )
