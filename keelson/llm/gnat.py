"""Hard-negative mining with a geometric near-neighbour access tree (GNAT).

Vectors become integers floor(scale x); a row's score is its inner product with an anchor. A node of
the tree deals rows to the nearest of several split points, far apart from each other (a multiway
hyperplane split). Each split point stores the range of its distances to the rows of every sibling
subtree, and a subtree the range of its norms. The scores an anchor asks for form a window, and with a
subtree's norms a window is an annulus of distances around the anchor. A subtree is eliminated as soon
as one split point's range, met with the anchor's distance to that point, lies outside of all its
annuli. What remains are leaves, scored exactly in whole numbers.

The upper tree comes from a bounded sample (``SAMPLE`` rows of smallest hash); its ranges are then
measured over all rows, so eliminations are exact. Every row is dealt to a cell of it, large cells in
chunks of about ``CHUNK`` rows, and the task of a chunk grows the lower tree over its own rows. An
anchor asks its own cell first. The k-th score found there narrows the window with which it asks the
other cells. First the positives are found so (the best of the anchor's label), then, with a window for
each positive, the negatives (other labels).

Defined cases: rows with a NULL id or label, a NULL vector, or NULL or non-finite components take no
part; shorter vectors count as padded with zeros; equal scores go to the smaller id; repeated rows of an
id are candidates each, except for the anchor's own id; of repeated anchors the one of smallest label and
vector asks; a positive of negative score has an empty window and no negatives; scores are exact as far
as 64 bits hold them, and vectors whose norms could pass that raise ``OverflowError``; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import ready, stored
from keelson.llm.topk import matrix

FANOUT = 16
SAMPLE = 8192
CELL = 2048
CHUNK = 4096
LEAF = 128
BLOCK = 512
MARGIN = 1e-6
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


@dataclass
class Node:
    """``low[i, j]`` to ``high[i, j]`` is the range of distances from split point i to the rows of subtree j."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray
    children: list
    number: int = 0


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def split_points(x: np.ndarray, fanout: int) -> np.ndarray:
    """Points far from each other: each next one is the farthest from those taken, among rows spread over ``x``."""
    spread = np.unique(np.linspace(0, len(x) - 1, 3 * fanout).astype(int))
    some = x[spread]
    taken, away = [0], distances(some, some[:1])[:, 0]
    while len(taken) < fanout and away.max() > 0:
        taken.append(int(away.argmax()))
        away = np.minimum(away, distances(some, some[taken[-1:]])[:, 0])
        away[taken] = 0
    return some[taken]


def ranges(d: np.ndarray, child: np.ndarray, norms: np.ndarray, m: int) -> tuple[np.ndarray, ...]:
    """``low, high, least, most`` over rows of which row r is at ``d[r]`` from the points and in subtree ``child[r]``."""
    low, high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    least, most = np.full(m, np.inf), np.full(m, -np.inf)
    for j in np.unique(child):
        mine = child == j
        low[:, j], high[:, j] = d[mine].min(0), d[mine].max(0)
        least[j], most[j] = norms[mine].min(), norms[mine].max()
    return low, high, least, most


def grow(x: np.ndarray, rows: np.ndarray, splits, fanout: int):
    """A tree over ``x[rows]`` whose leaves are arrays of rows; nodes for which ``splits(size)`` holds are split."""
    if not splits(len(rows)):
        return rows
    points = split_points(x[rows], fanout)
    if len(points) < 2:  # all rows looked at are equal
        return rows
    d = distances(x[rows], points)
    child = d.argmin(1)
    if child.max() == child.min():
        return rows
    found = ranges(d, child, np.sqrt((x[rows] ** 2).sum(1)), len(points))
    return Node(points, *found, [grow(x, rows[child == j], splits, fanout) for j in range(len(points))])


def upper_tree(sample: np.ndarray, share: float, cell: int, fanout: int) -> tuple[list[Node], int]:
    """Nodes and number of cells of a tree whose cells hold about ``cell`` rows of a table of which ``sample`` is ``share``.

    A node is numbered by its place in the list, its children are node numbers, or -1 - c for cell c.
    """
    tree = grow(sample, np.arange(len(sample)), lambda n: n > cell * share and n >= 8 * fanout, fanout)
    nodes: list[Node] = []
    cells = 0

    def number(at):
        nonlocal cells
        if not isinstance(at, Node):
            cells += 1
            return -cells
        at.number = len(nodes)
        nodes.append(at)
        at.children = [number(child) for child in at.children]
        m = len(at.points)
        at.low, at.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        at.least, at.most = np.full(m, np.inf), np.full(m, -np.inf)
        return at.number

    number(tree)
    return nodes, cells


def route(nodes: list[Node], x: np.ndarray, seen=None) -> np.ndarray:
    """The cell of each row; ``seen(node, d, child, rows)`` is told every split on the way."""
    cells = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        number, rows = todo.pop()
        if not len(rows):
            continue
        node = nodes[number]
        d = distances(x[rows], node.points)
        child = d.argmin(1)
        if seen is not None:
            seen(node, d, child, rows)
        for j, to in enumerate(node.children):
            mine = rows[child == j]
            if to < 0:
                cells[mine] = -1 - to
            else:
                todo.append((to, mine))
    return cells


def survivors(node: Node, a: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which subtrees hold rows whose scores may lie in one of the windows ``low..high`` of each anchor."""
    d = distances(a, node.points)
    slack = MARGIN * (1 + norms[:, None] + np.where(np.isfinite(node.most), node.most, 0))
    near = np.maximum(d[:, :, None] - node.high[None], node.low[None] - d[:, :, None]).max(1)
    far = (d[:, :, None] + node.high[None]).min(1)
    near, far = np.maximum(0, near - slack), np.maximum(0, far + slack)
    filled = np.isfinite(node.most)
    most, least = np.where(filled, node.most, 0), np.where(filled, node.least, 0)
    near, far = np.where(filled, near, 0), np.where(filled, far, 0)
    square = norms[:, None] ** 2
    rounding = slack * slack + MARGIN
    top = np.minimum((square + most**2 - near**2) / 2, norms[:, None] * most) + rounding
    bottom = np.maximum((square + least**2 - far**2) / 2, -norms[:, None] * most) - rounding
    meets = (top[:, :, None] >= low[:, None, :]) & (bottom[:, :, None] <= high[:, None, :]) & (low <= high)[:, None, :]
    return meets.any(2) & filled


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    limit = np.sqrt((a * a).sum(1)).max(initial=0) * np.sqrt((x * x).sum(1)).max(initial=0)
    if limit < 2**52:
        return (a @ x.T).astype(np.int64)
    if limit < 2**62:
        return a.astype(np.int64) @ x.astype(np.int64).T
    raise OverflowError("scores of these vectors do not fit in 64 bits")


def search(
    x: np.ndarray, ids: np.ndarray, labels: np.ndarray, a: np.ndarray, a_ids: np.ndarray, a_labels: np.ndarray,
    low: np.ndarray, high: np.ndarray, k: int, same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``(anchor, window, row, score)`` of the k best rows in each window, and the number of pairs scored.

    ``low`` and ``high`` have a row per anchor and a column per window.
    """
    order = np.argsort(ids, kind="stable")
    x, ids, labels = x[order], ids[order], labels[order]
    tree = grow(x, np.arange(len(x)), lambda n: n > LEAF, FANOUT)
    norms = np.sqrt((a * a).sum(1))
    found, scored = [], 0
    todo = [(tree, np.arange(len(a)))]
    while todo:
        at, asking = todo.pop()
        if not len(asking):
            continue
        if isinstance(at, Node):
            stays = survivors(at, a[asking], norms[asking], low[asking], high[asking])
            todo += [(child, asking[stays[:, j]]) for j, child in enumerate(at.children)]
            continue
        for begin in range(0, len(at), 1024):
            rows = at[begin : begin + 1024]
            s = scores(a[asking], x[rows])
            scored += s.size
            fits = (labels[rows] == a_labels[asking, None]) == same
            fits &= ids[rows] != a_ids[asking, None]
            for w in range(low.shape[1]):
                inside = fits & (s >= low[asking, w, None]) & (s <= high[asking, w, None])
                if not inside.any():
                    continue
                ranked = np.where(inside, s, _LOWEST + 1)
                best = np.argsort(-ranked, axis=1, kind="stable")[:, :k]
                who, nth = np.nonzero(np.take_along_axis(inside, best, 1))
                what = best[who, nth]
                found.append((asking[who], np.full(len(who), w), rows[what], s[who, what]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, scored
    who, window, row, score = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((ids[row], -score, window, who))
    who, window, row, score = who[order], window[order], row[order], score[order]
    group = who * low.shape[1] + window
    keep = np.arange(len(group)) - np.searchsorted(group, group) < k
    return who[keep], window[keep], ids[row[keep]], score[keep], scored


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, components in double precision."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    kept = vectors.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    return kept.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.alias("v"))


class Tree:
    """The rows of a table dealt to the cells of an upper tree, ready to be asked."""

    def __init__(self, rows: DataFrame, scale: float, cell: int = CELL, chunk: int = CHUNK, sample: int = SAMPLE):
        spark = ready(rows.sparkSession)
        self.spark, self.scale = spark, scale
        some = [r.v for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).select("v").collect()]
        n = rows.count()
        self.width = width = rows.agg(F.max(F.size("v"))).first()[0] or 0
        first = np.zeros((len(some), width))
        for i, v in enumerate(some):
            first[i, : len(v)] = v
        nodes, self.cells = upper_tree(np.floor(scale * first), len(some) / max(1, n), cell, FANOUT) if some else ([], 1)
        shared = spark.sparkContext.broadcast(nodes)  # at most sample / 8 split points

        def deal(batches):
            for batch in batches:
                x = np.floor(scale * matrix(batch.column("v"), width))
                yield pa.RecordBatch.from_arrays([pa.array(route(shared.value, x).astype(np.int32)), *batch.columns], names=["cell", *batch.schema.names])

        # A row number is kept with each row, so that copies of an id are split into chunks like others.
        self.rows = stored(
            rows.mapInArrow(deal, "cell int, vec_id long, label long, v array<double>").withColumn("turn", F.monotonically_increasing_id()),
            "gnat-rows",
        )
        self._measure(nodes, shared)
        self.nodes = spark.sparkContext.broadcast(nodes)
        sizes = self.rows.groupBy("cell").count().collect()  # a row per cell of the upper tree
        self.chunks = spark.createDataFrame([(r["cell"], max(1, -(-r["count"] // chunk))) for r in sizes], "cell int, chunks int")

    def _measure(self, nodes: list[Node], shared) -> None:
        """Fill in the ranges over all rows."""
        scale, width = self.scale, self.width

        def look(batches):
            for batch in batches:
                x = np.floor(scale * matrix(batch.column("v"), width))
                norms = np.sqrt((x * x).sum(1))
                out = []

                def seen(node, d, child, rows):
                    m = len(node.points)
                    low, high, least, most = ranges(d, child, norms[rows], m)
                    i, j = np.nonzero(np.isfinite(low))
                    out.append((np.full(len(i), node.number), i, j, low[i, j], high[i, j], least[j], most[j]))

                route(shared.value, x, seen)
                if out:
                    parts = [np.concatenate(p) for p in zip(*out)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p.astype(np.int32)) for p in parts[:3]] + [pa.array(p) for p in parts[3:]],
                        names=["node", "i", "j", "low", "high", "least", "most"],
                    )

        if not nodes:
            return
        kind = "node int, i int, j int, low double, high double, least double, most double"
        seen = self.rows.select("v").mapInArrow(look, kind).groupBy("node", "i", "j")
        for r in seen.agg(F.min("low"), F.max("high"), F.min("least"), F.max("most")).collect():  # bounded by the upper tree
            node, i, j = nodes[r[0]], r[1], r[2]
            node.low[i, j], node.high[i, j], node.least[j], node.most[j] = r[3:]

    def visits(self, asked: DataFrame, home: bool) -> DataFrame:
        """The anchors with each cell they ask: their own, or else the others that their windows meet."""
        nodes, scale, width = self.nodes, self.scale, self.width

        def run(batches):
            for batch in batches:
                a = np.floor(scale * matrix(batch.column("v"), width))
                own = route(nodes.value, a)
                who, where = np.arange(len(a)), own
                if not home:
                    who, where = others(nodes.value, a, own, *windows(batch))
                yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), *batch.take(pa.array(who)).columns], names=["cell", *batch.schema.names])

        return asked.mapInArrow(run, f"cell int, {_ASKED}")

    def best(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``anchor_id, window, rank, vec_id, score``: the k best rows in each window of the anchors.

        ``asked`` holds ``anchor_id, label, v, low, high`` with a bound per window.
        """
        asked = stored(asked.select("anchor_id", "label", "v", "low", "high"), "gnat-asked")
        own = stored(self._scored(self.visits(asked, True), k, same), "gnat-own")
        found = _ranked(own, k)
        floors = (
            found.where(F.col("rank") == k).groupBy("anchor_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
        )
        narrowed = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("floors", w), x)))
        asked = asked.join(floors, "anchor_id", "left").select("anchor_id", "label", "v", narrowed.alias("low"), "high")
        rest = self._scored(self.visits(asked, False), k, same)
        return _ranked(own.union(rest), k)

    def _scored(self, visits: DataFrame, k: int, same: bool) -> DataFrame:
        visits = stored(visits, "gnat-visits")
        scale, width = self.scale, self.width
        blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(self.chunks, "cell")
        chunk = F.pmod(F.xxhash64("turn"), F.col("chunks")).cast("int").alias("chunk")
        asked = visits.join(blocks, "cell").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int").alias("block"), "anchor_id", "label", "v", "low", "high",
        )
        rows = self.rows.join(blocks, "cell").select(
            "cell", chunk, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "label", "v"
        )

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return _NOTHING
            a, x = (np.floor(scale * matrix(side.column("v"), width)) for side in (left, right))
            a_ids, low_high = np.asarray(left.column("anchor_id")), windows(left)
            who, window, ids, score, _ = search(
                x, np.asarray(right.column("vec_id")), np.asarray(right.column("label")), a, a_ids, np.asarray(left.column("label")),
                *low_high, k, same,
            )
            return pa.table({"anchor_id": a_ids[who], "window": window.astype(np.int32), "vec_id": ids, "score": score})

        key = ["cell", "chunk", "block"]
        return asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(run, _FOUND)


_ASKED = "anchor_id long, label long, v array<double>, low array<long>, high array<long>"
_FOUND = "anchor_id long, window int, vec_id long, score long"
_NOTHING = pa.table({"anchor_id": pa.array([], pa.int64()), "window": pa.array([], pa.int32()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})


def windows(batch) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the windows of each anchor; missing ones are empty windows."""
    out = []
    for name, gap in (("low", _HIGHEST), ("high", _LOWEST)):
        column = batch.column(name)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        counts = np.diff(np.asarray(column.offsets))
        bounds = np.full((len(column), max(1, int(counts.max(initial=0)))), gap, np.int64)
        row = np.repeat(np.arange(len(column)), counts)
        bounds[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = np.asarray(column.flatten())
        out.append(bounds)
    return out[0], out[1]


def others(nodes: list[Node], a: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(anchor, cell)`` of the cells besides its own that an anchor's windows meet."""
    norms = np.sqrt((a * a).sum(1))
    who, where, todo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [(0, np.arange(len(a)))] if nodes else []
    while todo:
        number, asking = todo.pop()
        for at in range(0, len(asking), 1024):
            some = asking[at : at + 1024]
            stays = survivors(nodes[number], a[some], norms[some], low[some], high[some])
            for j, to in enumerate(nodes[number].children):
                if to >= 0:
                    todo.append((to, some[stays[:, j]]))
                else:
                    mine = some[stays[:, j]]
                    mine = mine[own[mine] != -1 - to]
                    who.append(mine)
                    where.append(np.full(len(mine), -1 - to))
    return np.concatenate(who), np.concatenate(where)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return found.selectExpr(
        "anchor_id", "window", "row_number() over (partition by anchor_id, window order by score desc, vec_id) as rank", "vec_id", "score"
    ).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80, scale: float = 256.0, **options
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row of ``anchors`` its first ``positives`` other rows of ``vectors`` with its label, and for
    each of them the first ``negatives`` rows of other labels that score at least ``percent`` % of it and
    no more than it.
    """
    rows = stored(usable(vectors), "gnat-vectors")
    asked = (
        usable(anchors).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "v")).alias("x"))
        .select("anchor_id", "x.label", "x.v")
    )
    asked = stored(asked, "gnat-anchors")
    tree = Tree(rows, scale, **options)
    whole = asked.select("*", F.array(F.lit(_LOWEST)).alias("low"), F.array(F.lit(_HIGHEST)).alias("high"))
    near = stored(tree.best(whole, positives, True), "gnat-positives")
    # The least whole score with 100 score >= percent * positive, without a product that could overflow.
    least = F.expr(f"score - (score div 100) * {100 - percent} - ((score % 100) * {100 - percent}) div 100")
    bounds = near.where("score >= 0").select("anchor_id", "rank", "score", least.alias("least"))
    listed = bounds.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "least", "score"))).alias("w"))
    asked = asked.join(listed, "anchor_id").select("anchor_id", "label", "v", F.col("w.least").alias("low"), F.col("w.score").alias("high"), F.col("w.rank").alias("ranks"))
    far = tree.best(asked, negatives, False)
    # Windows are in the order of the ranks, and ranks run from 1 without a gap.
    return far.join(
        near.selectExpr("anchor_id", "cast(rank - 1 as int) as window", "vec_id as positive_id", "score as positive_score"), ["anchor_id", "window"]
    ).selectExpr("anchor_id", "positive_id", "cast(rank as int) as rank", "vec_id as negative_id", "positive_score", "score as negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """Labels with the planted errors of the task: where the id is divisible by 7, the next of ten."""
    wrong = F.col("vec_id") % 7 == 0
    label = F.when(wrong, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return vectors.select("vec_id", label.alias("label"), "embedding")


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positive p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
