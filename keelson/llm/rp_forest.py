"""Embedding near-dedup with a forest of random-projection trees.

A tree splits the vectors at the median of a random direction, again and again; vectors near a
split go to both sides (spill overlap), so near pairs seldom part. Vectors that share a leaf of any
tree are compared by exact cosine, and links from all trees are united. The upper splits of each
tree come from a bounded sample (``sample`` rows of smallest hashed id) and deal all vectors to
cells; each cell is split further by its own medians and compared by one task.

An overlap is never narrower than 0.9 of the distance of a pair at the cosine. A node that such
overlaps do not split well is dense: nearly all its pairs are close to the cosine, and any cut would
part links. It is compared whole, and where the upper splits find it, in blocks over several tasks.

Cells are dealt out in rounds of bounded size, and a task gives its links away in runs as it finds them, so
neither disk nor memory follows the number of trees or of links.

Equal vectors form one class, which is indexed once and weighs as many links as it has rows, so a
group of copies never meets in one leaf.

Defined cases: vectors that are NULL, all zero, or hold NULL or non-finite components link with
nothing and are kept; vectors of different lengths do not link, each length has its own forest; cosines are
taken of the vectors scaled by their largest component, so any size of components will do, and next to the
bound they are decided in extended precision; repeated ids are separate rows that count as
links of each other when their vectors link; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import components, mix, ready, stored
from keelson.llm.topk import matrix

COSINE = 0.9
TREES = 8
SPILL = 0.08
CELL = 1024
LEAF = 64
SAMPLE = 20_000
OVERLAP = 0.9
WHOLE = 0.65
TRIES = 4
#: Products, and pairs, that a task holds at a time.
HELD = 1 << 18
#: Rows whose way down the forest is found at a time.
ROUTED = 2048
#: Bytes dealt out in a round, if twice the vectors is less, and to a partition of it.
ROUND, PART = 1 << 30, 64 << 20


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def reach(x: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Whether the cosine of the rows ``a`` and ``b`` of ``x``, rounded to double precision, is at least ``cosine``."""
    out = np.empty(len(a), bool)
    for at in range(0, len(a), 8192):
        u, v = (x[side[at : at + 8192]].astype(np.longdouble) for side in (a, b))
        found = (u * v).sum(1) / np.sqrt((u * u).sum(1) * (v * v).sum(1))
        out[at : at + 8192] = found.astype(np.float64) >= cosine
    return out


def directions(seed: int, count: int, width: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((count, width))


def cut(x: np.ndarray, seed: int, spill: float, cosine: float) -> tuple[np.ndarray, float, float]:
    """A direction that splits ``x`` and the borders of its overlap; infinite ones if none splits it well."""
    least = OVERLAP * math.sqrt(2 - 2 * cosine)
    for way in directions(seed, TRIES, x.shape[1]):
        p = x @ way
        if len(p) == 0:
            break
        low, high = np.quantile(p, [0.5 - spill, 0.5 + spill])
        wider = max(0.0, least - (high - low)) / 2
        low, high = low - wider, high + wider
        if max(np.mean(p <= high), np.mean(p >= low)) <= WHOLE:
            return way, low, high
    return np.zeros(x.shape[1]), math.inf, math.inf


def upper_tree(
    sample: np.ndarray, seed: int, depth: int, spill: float, cosine: float
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: one direction per node, and the two borders of its overlap; a dense node goes left whole."""
    levels, nodes = [], [np.arange(len(sample))]
    for level in range(depth):
        cuts = [cut(sample[rows], (seed * 1000 + level) * 1_000_003 + i, spill, cosine) for i, rows in enumerate(nodes)]
        way, low, high = (np.array(part) for part in zip(*cuts))
        levels.append((way, low, high))
        nodes = [
            rows[side] for rows, (w, a, b) in zip(nodes, cuts) for p in [sample[rows] @ w] for side in (p <= b, p >= a)
        ]
    return levels


def route(x: np.ndarray, levels, first: int = 0, last: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """``(row, cell)`` of every cell from ``first`` to ``last`` each row falls into."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for rest, (way, low, high) in zip(range(len(levels) - 1, -1, -1), levels):
        p = np.einsum("ij,ij->i", x[rows], way[node])
        left, right = p <= high[node], p >= low[node]
        rows, node = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
        there = (node + 1 << rest > first) & (node << rest <= last)
        rows, node = rows[there], node[there]
    return rows, node


def leaf_runs(
    given: np.ndarray, seed: int, leaf: int, spill: float, cosine: float, side: np.ndarray | None = None
) -> Iterator[np.ndarray]:
    """Pairs of rows that share a leaf and reach the cosine, in runs of about ``HELD``; only across sides if given.

    A pair of several leaves may come in several runs.
    """
    given = given / np.abs(given).max(axis=1, keepdims=True)
    x = given / np.linalg.norm(given, axis=1, keepdims=True)
    n, found, unsure, held = len(x), [], [], 0

    def decided() -> np.ndarray:
        sure, close = (np.unique(np.concatenate(codes)) for codes in (found, unsure))
        codes = np.concatenate([sure, close[reach(given, close // n, close % n, cosine)]])
        return np.stack([codes // n, codes % n], axis=1)

    todo = [(np.arange(n), 0)]
    while todo:
        rows, level = todo.pop()
        own = x[rows]
        if len(rows) > leaf and level < 40:
            way, low, high = cut(own, seed + 7919 * level + len(todo), spill, cosine)
            if low < math.inf:
                p = own @ way
                todo += [(rows[p <= high], level + 1), (rows[p >= low], level + 1)]
                continue
        step = max(1, min(512, HELD // max(1, len(rows))))
        for at in range(0, len(rows), step):  # a leaf that no direction splits is compared in blocks
            cosines = own[at : at + step] @ own[at:].T
            near = cosines >= cosine - 1e-9
            if side is not None:
                near &= side[rows[at : at + step], None] != side[rows[at:]]
            a, b = np.nonzero(near)
            later = a < b  # rows of a leaf are in order
            a, b = a[later], b[later]
            codes, close = rows[at + a] * n + rows[at + b], cosines[a, b] <= cosine + 2e-9  # the rest is decided
            found.append(codes[~close]), unsure.append(codes[close])
            held += len(codes)
            if held >= HELD:
                yield decided()
                found, unsure, held = [], [], 0
    if held:
        yield decided()


def leaf_pairs(
    given: np.ndarray, seed: int, leaf: int, spill: float, cosine: float, side: np.ndarray | None = None
) -> np.ndarray:
    """All pairs of ``leaf_runs``, each once."""
    n, none = len(given), np.zeros((0, 2), np.int64)
    pairs = np.concatenate([none, *leaf_runs(given, seed, leaf, spill, cosine, side)])
    codes = np.unique(pairs[:, 0] * n + pairs[:, 1])
    return np.stack([codes // max(1, n), codes % max(1, n)], axis=1)


def link_vectors(
    vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, spill: float = SPILL,
    cell: int = CELL, leaf: int = LEAF, sample: int = SAMPLE,
) -> tuple[DataFrame, DataFrame]:
    """``(classes, links)``: ``id, key, v, members, first_id`` per distinct vector, and linked ids ``a, b``."""
    spark = ready(vectors.sparkSession)
    usable = _usable(vectors)
    classes = stored(
        usable.groupBy("key", "v").agg(F.count("*").alias("members"), F.min("vec_id").alias("first_id"))
        .withColumn("id", F.monotonically_increasing_id()),
        "vector-classes",
    )
    widths = classes.groupBy(F.size("v").alias("w")).count().collect()  # a row per length of vectors
    found = [
        links
        for r in sorted(widths)
        for links in _links(classes.where(F.size("v") == r["w"]), r["count"], r["w"], cosine, trees, spill, cell, leaf, sample)
    ]
    if not found:
        return classes, spark.createDataFrame([], "a long, b long")
    return classes, stored(functools.reduce(DataFrame.union, found).distinct(), "vector-links")


def _links(
    usual: DataFrame, n: int, width: int, cosine: float, trees: int, spill: float, cell: int, leaf: int, sample: int
) -> list[DataFrame]:
    """Linked ids ``a, b`` among vectors of one length, by rounds; a pair may come from several trees and rounds."""
    spark = usual.sparkSession
    depth = max(0, math.ceil(math.log2(max(1.0, n / cell)))) if n > cell else 0
    depth = min(depth, max(0, int(math.log2(sample / 16))))
    forest: list = [[] for _ in range(trees)]
    if depth:
        chosen = usual.orderBy(F.xxhash64("key"), "key").limit(sample)
        rows = units(matrix(chosen.select("v").toArrow().column("v"), width))
        forest = [upper_tree(rows, t + 1, depth, spill, cosine) for t in range(trees)]
    forest = spark.sparkContext.broadcast(forest)  # trees x 2^depth <= trees x sample / 16 nodes

    def routed(batches, cells):
        for batch in batches:
            for at in range(0, batch.num_rows, ROUTED):
                some = batch.slice(at, ROUTED)
                x = units(matrix(some.column("v"), width))
                for t, (first, last) in cells.items():
                    yield some, t, *route(x, forest.value[t], first, last)

    def sizes(batches):
        counts = np.zeros((trees, 1 << depth), np.int64)
        for _, t, _, node in routed(batches, everywhere):
            counts[t] += np.bincount(node, minlength=1 << depth)
        t, c = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(c), pa.array(counts[t, c])], names=["tree", "cell", "n"])

    block = 4 * cell
    usual = usual.select("id", "v")
    kind = usual.schema["v"].dataType
    everywhere = {t: (0, (1 << depth) - 1) for t in range(trees)}
    row = width * (4 if kind.elementType.typeName() == "float" else 8) + 64
    rounds, dense = [(everywhere, n * trees * row)], {}
    if depth:
        counted = usual.mapInArrow(sizes, "tree int, cell long, n long").groupBy("tree", "cell").agg(F.sum("n").alias("n"))
        rounds, most = [], max(ROUND, 2 * n * row)
        for t, c, rows in sorted(counted.collect()):  # cells of the upper splits, of which there are few
            if rows > block and forest.value[t][-1][1][c // 2] == math.inf:
                dense[t, c] = -(-rows // block)
            size = rows * dense.get((t, c), 1) * row
            if not rounds or rounds[-1][1] + size > most:
                rounds.append(({}, 0))
            cells, dealt = rounds[-1]
            rounds[-1] = cells | {t: (cells.get(t, (c, c))[0], c)}, dealt + size

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]  # a cell, or two blocks of one
        ids, own = (np.concatenate([np.asarray(batch.column(c)) for batch in held]) for c in ("id", "own"))
        tree, c, low, high = (held[0].column(name)[0].as_py() for name in ("tree", "cell", "low", "high"))
        order = np.argsort(ids)
        ids, own, place = ids[order], own[order], np.argsort(order)
        x, at = np.empty((len(ids), width)), 0
        for batch in held:
            x[place[at : at + batch.num_rows]] = matrix(batch.column("v"), width)
            at += batch.num_rows
        runs = leaf_runs(x, 1_000_003 * (tree + 1) + c, leaf, spill, cosine, own if low < high else None)
        del held, batch, x
        for pairs in runs:
            yield pa.RecordBatch.from_arrays([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"])

    def linked(cells: dict[int, tuple[int, int]], size: int) -> DataFrame:
        blocks = {t: {c: k for (tree, c), k in dense.items() if tree == t} for t in cells}

        def deal(batches):
            for batch, t, row, node in routed(batches, cells):
                ids = np.asarray(batch.column("id"))

                def part(row, node, own, low, high):
                    return pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), t, np.int32)), pa.array(node), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                            pa.array(own.astype(np.int32)), batch.column("id").take(pa.array(row)), batch.column("v").take(pa.array(row)),
                        ],
                        names=["tree", "cell", "low", "high", "own", "id", "v"],
                    )

                count = np.ones(len(node), np.int64)
                for c, k in blocks[t].items():
                    count[node == c] = k
                own = (mix(ids[row].astype(np.uint64)) % count.astype(np.uint64)).astype(np.int64)
                for other in range(int(count.max(initial=0))):  # a block meets every block of its cell
                    at = np.flatnonzero(count > other)
                    yield part(row[at], node[at], own[at], np.minimum(own[at], other), np.maximum(own[at], other))

        dealt = usual.mapInArrow(deal, f"tree int, cell long, low int, high int, own int, id long, v {kind.simpleString()}")
        parts = -(-size // PART)
        if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
            dealt = dealt.repartition(parts, "tree", "cell", "low", "high")
        return dealt.groupBy("tree", "cell", "low", "high").applyInArrow(compare, "a long, b long")

    found = [linked(*part) for part in rounds]
    return found if len(found) == 1 else [stored(links, "vector-links-of-round") for links in found]


def _usable(vectors: DataFrame) -> DataFrame:
    v = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) | ~F.exists(v, lambda e: e != 0)
    # 0.0 + x turns -0.0 into 0.0, so that equal vectors have equal bytes. Single precision, if given, holds all there is.
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    v = F.transform("embedding", lambda e: e.cast(kind) + F.lit(0.0).cast(kind))
    shown = F.array_join(F.transform(v, lambda e: e.cast("double").cast("string")), ",")
    return vectors.where("embedding is not null").where(~bad).select(
        "vec_id", v.alias("v"), F.unhex(F.sha2(shown.cast("binary"), 256)).alias("key")
    )


def near_duplicates(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    classes, links = link_vectors(vectors, **options)
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (
        both.join(classes.select(F.col("id").alias("b"), "members"), "b")
        .groupBy(F.col("a").alias("id")).agg(F.sum("members").alias("n"))
    )
    found = components(links)
    roots = (
        found.join(classes.select("id", "first_id"), "id")
        .groupBy("root").agg(F.min("first_id").alias("component"))
        .join(found, "root").select("id", "component")
    )
    state = (
        classes.join(others, "id", "left").join(roots, "id", "left")
        .select(
            "key", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            F.coalesce("component", "first_id").alias("component_id"),
        )
    )
    rows = vectors.select("vec_id", "embedding")
    usable = _usable(rows).select("vec_id", "key").join(state, "key").select("vec_id", "n_links", "component_id")
    v = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) | ~F.exists(v, lambda e: e != 0)
    rest = rows.where(F.col("embedding").isNull() | F.coalesce(bad, F.lit(True))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return usable.union(rest).select(
        "vec_id", F.col("n_links").cast("long"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
