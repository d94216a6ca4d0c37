"""Exact top-k by multi-resolution segment statistics.

Vectors become integers floor(scale x); the score is their inner product, so the distance is
|q|^2 + |c|^2 - 2 score. Cut into segments with mean m and deviation s, two vectors are at least
sqrt(sum of length ((mq - mc)^2 + (sq - sc)^2)) apart, hence their score is at most
sum of length (mq mc + sq sc). Coarse segments come first: the candidates of highest bound are
scored exactly, which gives each query a score its k-th best has at least; pairs whose bound is
lower are dropped, finer segments drop more, and only survivors are scored.

Queries and candidates are dealt into blocks; each pair of blocks is one task's work and returns at
most k rows per query, and a last ranking over those keeps k. Bounds carry a margin above rounding,
so no true result is lost.

Defined cases: vectors that are NULL, or hold NULL or non-finite components, take no part; shorter
vectors count as padded with zeros; equal scores go to the smaller id; repeated rows of an id are
candidates each, except for the query's own id; an empty table gives no rows. Scores are exact: blocks whose
scores may pass 2^52 are scored in whole numbers of any size, and a best score that 64 bits cannot hold
fails the job with ``ScoreRange``.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import ready, stored

SEGMENTS = (8, 16, 32)
BLOCK = 2048
SCHEMA = "query_id long, vec_id long, score long"


class ScoreRange(ArithmeticError):
    """A score among the best of a query does not fit into 64 bits."""


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors of an Arrow list column as the rows of a matrix, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    counts = np.diff(np.asarray(column.offsets))
    values = np.asarray(column.flatten(), dtype=np.float64)
    width = max(width, int(counts.max(initial=0)))
    out = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(column)), counts)
    at = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[rows, at] = values
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of weighted segment means and deviations, whose inner products bound the scores."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, max(1, x.shape[1])))
    mean = np.stack([x[:, p].mean(axis=1) * math.sqrt(len(p)) for p in parts], axis=1)
    spread = np.stack([x[:, p].std(axis=1) * math.sqrt(len(p)) for p in parts], axis=1)
    return np.concatenate([mean, spread], axis=1)


def best(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int):
    """``(query index, candidate index, score)`` of the k best candidates of each query, ties by id."""
    order = np.argsort(c_ids, kind="stable")
    c, c_ids = c[order], c_ids[order]
    own = q_ids[:, None] == c_ids[None, :]
    bound = statistics(q, SEGMENTS[0]) @ statistics(c, SEGMENTS[0]).T
    bound[own] = -np.inf
    floor = np.full(len(q), -np.inf)
    n = len(c_ids)
    if n > k:
        first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
        scores = np.einsum("qd,qkd->qk", q, c[first])
        scores[np.take_along_axis(own, first, axis=1)] = -np.inf
        floor = scores.min(axis=1)
    margin = 1e-6 * (1 + np.abs(floor, where=np.isfinite(floor), out=np.zeros(len(q))))
    alive = (bound >= (floor - margin)[:, None]) & ~own
    for segments in SEGMENTS[1:]:
        if segments >= q.shape[1] or not alive.any():
            break
        alive &= statistics(q, segments) @ statistics(c, segments).T >= (floor - margin)[:, None]
    rows, cols = np.nonzero(alive)
    if alive.mean() > 0.05:
        scores = (q @ c.T)[rows, cols]
    else:
        scores = np.concatenate([np.einsum("id,id->i", q[rows[a : a + 65536]], c[cols[a : a + 65536]]) for a in range(0, len(rows), 65536)] or [np.zeros(0)])
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    top = place < k
    return rows[top], c_ids[cols[top]], scores[top]


def best_of_large(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int):
    """``best`` where doubles would round: all candidates are scored, in Python's whole numbers."""
    if not (np.isfinite(q).all() and np.isfinite(c).all()):
        raise ScoreRange("a scaled component is beyond double precision")
    whole = np.vectorize(int, otypes=[object])
    scores = whole(q) @ whole(c).T if c.shape[1] else np.zeros((len(q), len(c)), dtype=object)
    rows, cols, found = [], [], []
    for i, own in enumerate(q_ids):
        others = np.flatnonzero(c_ids != own)
        for j in heapq.nsmallest(k, others, key=lambda j: (-scores[i, j], c_ids[j])):
            if not -(2**63) <= scores[i, j] < 2**63:
                raise ScoreRange(f"the score of {own} and {c_ids[j]} does not fit into 64 bits")
            rows.append(i), cols.append(j), found.append(scores[i, j])
    return np.array(rows, dtype=np.int64), c_ids[np.array(cols, dtype=np.int64)], np.array(found, dtype=np.int64)


def clean(vectors: DataFrame, scale: float) -> DataFrame:
    """``vec_id, v`` of the usable vectors, as whole numbers in double precision."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    # From 2^52 on a double is whole, and floor would not fit it into 64 bits.
    floored = F.transform(x, lambda e: F.when(F.abs(e * scale) < 2.0**52, F.floor(e * scale).cast("double")).otherwise(e * scale))
    return vectors.where("embedding is not null and vec_id is not null").where(~bad).select("vec_id", floored.alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each row of ``queries``."""
    ready(vectors.sparkSession)
    candidates = stored(clean(vectors, scale), "topk-candidates")
    asked = stored(clean(queries, scale).dropDuplicates(["vec_id"]), "topk-queries")
    c_blocks = max(1, -(-candidates.count() // block))
    q_blocks = max(1, -(-asked.count() // block))

    def dealt(rows, own, n_own, other, n_other):
        return rows.select(
            F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other), "vec_id", "v",
        )

    c = dealt(candidates, "cb", c_blocks, "qb", q_blocks)
    q = dealt(asked, "qb", q_blocks, "cb", c_blocks)

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        a, b = matrix(left.column("v")), matrix(right.column("v"))
        width = max(a.shape[1], b.shape[1])
        a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
        q_ids, c_ids = np.asarray(left.column("vec_id")), np.asarray(right.column("vec_id"))
        with np.errstate(over="ignore"):
            reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, width)
        search = best if reach < 2.0**52 else best_of_large
        found = [search(a[i : i + 256], q_ids[i : i + 256], b, c_ids, k) for i in range(0, len(a), 256)]
        rows = np.concatenate([x[0] + 256 * i for i, x in enumerate(found)])
        return pa.table({
            "query_id": q_ids[rows],
            "vec_id": np.concatenate([x[1] for x in found]),
            "score": np.concatenate([x[2] if x[2].dtype == np.int64 else x[2].round().astype(np.int64) for x in found]),
        })

    found = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(run, SCHEMA)
    return found.selectExpr(
        "query_id", "row_number() over (partition by query_id order by score desc, vec_id) as rank", "vec_id", "score"
    ).where(F.col("rank") <= k)
