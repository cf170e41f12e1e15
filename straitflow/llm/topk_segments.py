"""Exact top-k search by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into segments. For segment s of n components with mean m and deviation d, the inner product
of two vectors is at most the sum over s of n * (m * m' + d * d'), by Cauchy and Schwarz on the parts about the
means; in terms of distances, this is the lower bound that segment means and deviations give. Few segments
come first, more of them for what is left, and exact scores for the survivors.

Queries and candidates are dealt in blocks to a grid of cells, so a task holds one block of each; nothing is
broadcast, and each cell returns k rows for a query.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Segments of each level.
LEVELS = (4, 16)

FOUND = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id and vec: the rows with an id whose vector holds numbers only, none of them null or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec")
    )
    return rows.where(F.col("id").isNotNull() & F.coalesce(F.forall("vec", finite), F.lit(False)))


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    query_block: int = 2048,
    candidate_block: int = 4096,
) -> DataFrame:
    """The k highest inner products of each query: query_id, rank (from 1), vec_id, score; ties to smaller vec_id.

    Both inputs have `id` and `vec` as `usable` returns them. Components are floor(scale * x). A candidate with
    the query's own id is left out; vectors of another length than the query's are no candidates for it. Rows
    that repeat an id count one by one as candidates, and equal rows of queries are one query. Fewer candidates
    than k give fewer rows; empty inputs give none. Scores beyond 64 bits are held at the largest long.
    """
    queries = queries.distinct()
    across = max(1, math.ceil(candidates.count() / candidate_block))
    down = max(1, math.ceil(queries.count() / query_block))
    deal = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    asked = queries.select(
        deal(down, 1).alias("row"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("column"), "id", "vec"
    )
    offered = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("row"), deal(across, 2).alias("column"), "id", "vec"
    )
    cells = asked.groupBy("row", "column").cogroup(offered.groupBy("row", "column"))
    found = cells.applyInArrow(_cell(k, scale), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _cell(k: int, scale: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(asked: pa.Table, offered: pa.Table) -> pa.Table:
        rows: list[list[np.ndarray]] = []
        theirs = dict(_by_length(offered, scale))
        for length, (q_ids, q) in _by_length(asked, scale):
            if length in theirs:
                rows.append(search(q_ids, q, *theirs[length], k))
        columns = [np.concatenate(x) if rows else np.zeros(0, np.int64) for x in (zip(*rows) if rows else [[]] * 3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return run


def _by_length(table: pa.Table, scale: float) -> list[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Ids and integer components of a block, by the length of its vectors."""
    ids = table.column("id").to_numpy()
    vectors = table.column("vec").combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, int)
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale) if len(ids) else np.zeros(0)
    ends = np.cumsum(lengths)
    out = []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out.append((int(n), (ids[at], values[(ends[at] - n)[:, None] + np.arange(n)])))
    return out


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment, its mean and its deviation, times the root of its size: their products bound inner products."""
    parts = np.array_split(x, min(segments, max(1, x.shape[1])), axis=1)
    out = []
    for p in parts:
        if p.shape[1]:
            root = math.sqrt(p.shape[1])
            out += [p.mean(axis=1) * root, p.std(axis=1) * root]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 1))


def search(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, rows: int = 256
) -> list[np.ndarray]:
    """query_id, vec_id and score of the k best of one block of candidates for each query of a block."""
    largest = max(1, q.shape[1]) * np.abs(q).max(initial=0) * np.abs(c).max(initial=0)
    exact = largest < 2**53
    feats = [(segment_features(q, n), segment_features(c, n)) for n in LEVELS]
    # Bounds are computed in floating point; the slack is far above what rounding can take off.
    slack = 1e-9 * largest * (1 + q.shape[1]) + 1e-6
    out: list[list[np.ndarray]] = [[], [], []]
    for lo in range(0, len(q_ids), rows):
        part = slice(lo, lo + rows)
        own = q_ids[part, None] == c_ids[None, :]
        bound = feats[0][0][part] @ feats[0][1].T
        bound[own] = -np.inf
        # The exact scores of the k candidates with the highest coarse bounds give a threshold to start from.
        if exact and bound.shape[1] > k:
            first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            seeds = np.einsum("ij,ikj->ik", q[part], c[first])
            seeds[np.take_along_axis(own, first, 1)] = -np.inf
            floor = seeds.min(axis=1)
        else:
            floor = np.full(len(bound), -np.inf)
        left = (bound + slack >= floor[:, None]) & ~own
        for f, g in feats[1:]:
            left &= f[part] @ g.T + slack >= floor[:, None]
        qi, ci = np.nonzero(left)
        score = exact_scores(q[part], c, qi, ci, exact)
        order = np.lexsort((c_ids[ci], -score if exact else [-x for x in score], qi))
        qi, ci, score = qi[order], ci[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = rank < k
        out[0].append(q_ids[part][qi[keep]])
        out[1].append(c_ids[ci[keep]])
        out[2].append(score[keep].astype(np.int64))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def exact_scores(q: np.ndarray, c: np.ndarray, qi: np.ndarray, ci: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the surviving pairs; whole numbers below 2**53 are exact in floating point."""
    if not exact:
        top = 2**63 - 1
        value = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
        return np.array([max(-top, min(top, value(q[i], c[j]))) for i, j in zip(qi, ci, strict=True)], dtype=np.int64)
    if len(qi) * 10 > len(q) * len(c):  # many survive: multiplying the blocks costs less than gathering
        return (q @ c.T)[qi, ci].astype(np.int64)
    return np.concatenate(
        [np.zeros(0, np.int64)]
        + [np.einsum("ij,ij->i", q[qi[s]], c[ci[s]]).astype(np.int64) for s in _chunks(len(qi), 100_000)]
    )


def _chunks(n: int, size: int) -> list[slice]:
    return [slice(i, i + size) for i in range(0, n, size)]
