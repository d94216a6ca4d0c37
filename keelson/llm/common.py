"""Helpers the operators share: stored intermediate tables, text buffers, hashing, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import scratch_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let the Python workers of a local session import this package from where it lies.

    A cluster gets the package with the job (``--py-files``), as usual.
    """
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back, which cuts the lineage.

    The shuffle files of the write go when it ends, so steps that move the texts do not add up.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def blocks(documents: DataFrame, size: int) -> int:
    """A prime number of blocks that hold about ``size`` bytes of text each."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(2, -(-total // size))
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def text_or_empty(column: str = "text"):
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array in one buffer, and the offsets of its texts."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_string()), "")
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, which bounds memory."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def word_codes(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of texts in one buffer, runs of bytes that are no ``gap``: dictionary-encoded, with
    the text each is in and its first byte. Words never cross texts."""
    starts = ~gap
    starts[1:] &= gap[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    starts[begin] = ~gap[begin]
    first = np.flatnonzero(starts)
    before = np.cumsum(~gap)
    inside = np.append(before[first] - 1, before[-1] if len(data) else 0).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(inside), pa.py_buffer(data[~gap])])
    return words.dictionary_encode(), np.searchsorted(offsets, first, side="right") - 1, first


def digests(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64 bits of each of some byte strings."""
    return np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in words.to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64-bit numbers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


def lists(values: np.ndarray, offsets: np.ndarray, kind=None) -> pa.Array:
    """An Arrow list column over flat values."""
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values if kind is None else values.astype(kind))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every id of ``edges (a, b)``; ``root`` is the smallest id connected to it.

    Each round every node joins the first of its neighbours and itself, or the node that one joins,
    and the edges are contracted. Even rounds order by id, which gathers stars around their smallest node at once;
    odd rounds order by a hash that changes, so chains shrink by a constant share and the number of
    rounds grows with the logarithm of the longest one. All state is in tables.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        salt = len(moves)

        def ordered(column: str):
            return F.struct((F.xxhash64(column, F.lit(salt)) if salt % 2 else F.lit(0)).alias("p"), F.col(column).alias("id"))

        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(ordered("b")).alias("n"))
        best = best.select(F.col("a").alias("id"), F.least("n", ordered("a")).getField("id").alias("to"))
        best = stored(best.join(best.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")), "moves")
        moves.append(best)
        edges = stored(
            edges.join(best.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
            .join(best.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = moves[0]
    for step in moves[1:]:
        step = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        found = found.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
    roots = found.groupBy("to").agg(F.min("id").alias("root"))
    return stored(found.join(roots, "to").select("id", "root"), "components")


def prefix_members(elements: DataFrame, ids: DataFrame, similarity: float) -> DataFrame:
    """``(bucket, id, n, place, own)`` such that any two of ``ids`` with that similarity share a bucket.

    Prefix filter: with the elements of each set ordered from rare to common, two sets of the given
    Jaccard similarity share one of their first n - ceil(similarity n) + 1 elements; ``place`` is the
    element's. The ``own`` elements that no other set has come first and make no bucket, so sets
    with many of their own drop out.
    """
    rows = elements.join(ids, "id").select("id", F.size("elements").alias("n"), F.explode("elements").alias("bucket"))
    shared = rows.groupBy("bucket").count().where("count > 1")
    return rows.join(shared, "bucket").selectExpr(
        "bucket", "id", "n", "row_number() over (partition by id order by count, bucket) as nth",
        "n - count(*) over (partition by id) as own",
    ).selectExpr("bucket", "id", "n", "nth + own as place", "own").where(f"place <= n - ceil({similarity} * n - 1e-9D) + 1")


def may_reach(similarity: float) -> str:
    """Whether sets ``a`` and ``b`` that first share the elements at their places can be that similar.

    They share no more than this element and what the shorter rest holds; the first common element
    of a linked pair passes, so no link is lost.
    """
    return f"1 + least(a.n - a.place, b.n - b.place) >= {similarity / (1 + similarity)!r}D * (a.n + b.n) - 1e-6D"


def linked(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], refine: Callable[[DataFrame], DataFrame] | None = None,
    fits: str = "true", growth: int = 16,
) -> DataFrame:
    """``(id, root)`` over all ids that ``verify`` links to another one within a bucket.

    ``members (bucket, id)`` has distinct rows; ``verify`` takes distinct pairs ``(a, b)`` and keeps
    the linked ones. First every member is compared with one pivot of its bucket. A bucket whose
    members are then all in one component is done: further links in it cannot change the result.
    The ids of the others get the buckets of ``refine`` (which must lose no link) or keep theirs,
    and members of different components are compared, with ``growth`` times as many pivots in each
    round until every such pair has been: no link between components is lost, and no group is
    squared. Refined members are compared first with the one of fewest ``own`` elements, which
    variants of one original are all near to, and only where ``fits`` holds for ``a`` and ``b`` (it
    must hold in some bucket of each linked pair). Only links found anew are contracted after a round.
    """
    pivots = members.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
    pairs = members.join(pivots, "bucket").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    found = components(verify(pairs).select("a", "b"))
    state = members.select("id").distinct().join(found, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    state, done = stored(state, "roots"), 1
    if refine is not None:
        members, done = stored(refine(_mixed(members, state, 1).select("id").distinct()), "refined"), 0
    else:
        members = members.selectExpr("bucket", "id", "0 as n", "0 as place", "0 as own")
    while True:
        ranked = stored(
            _mixed(members, state, done).selectExpr(
                "bucket", "struct(id, root, n, place) as a", "row_number() over (partition by bucket order by own, id) as turn"
            ),
            "ranked",
        )
        fresh = None
        while fresh is None or fresh.isEmpty():
            if ranked.where(f"turn > {done + 1}").isEmpty():
                groups = state.groupBy("root").count().where("count > 1").select("root")
                return stored(state.join(groups, "root").select("id", "root"), "linked")
            last, done = done, max(1, done * growth)
            if done == 1:
                pairs = ranked.selectExpr("first(a) over (partition by bucket order by turn) as a", "a as b")
            else:
                left = ranked.where(f"turn > {last} and turn <= {done}").selectExpr("bucket", "a", "turn as first")
                right = ranked.selectExpr("bucket", "a as b", "turn")
                pairs = right.join(left, (left["bucket"] == right["bucket"]) & F.expr(f"turn > first and a.root <> b.root and {fits}"))
            pairs = pairs.where(f"a.root <> b.root and {fits}").selectExpr("a.id as a", "b.id as b").distinct()
            fresh = stored(verify(pairs).select("a", "b"), "links")
        ends = fresh.join(state.selectExpr("id as a", "root as x"), "a").join(state.selectExpr("id as b", "root as y"), "b")
        moves = components(ends.selectExpr("x as a", "y as b")).selectExpr("id as root", "root as next")
        state = stored(state.join(moves, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "roots")


def _mixed(members: DataFrame, state: DataFrame, done: int) -> DataFrame:
    """Members with their root, of the buckets with several roots and more than ``done`` members."""
    placed = members.join(state, "id")
    mixed = (
        placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
        .where(f"low <> high and n > {done}").select("bucket")
    )
    return placed.join(mixed, "bucket")
