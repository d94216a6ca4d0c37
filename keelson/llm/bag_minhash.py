"""MinHash near-dedup with BagMinHash signatures of word-shingle multisets.

Every shingle carries a Poisson process of unit rate over time and weight. Weights are counts, so
the weight axis is cut into the intervals [0, 1), [1, 2), [2, 4), [4, 8), ...: one process per
interval, with the interval's length as rate, and its points fall into the unit steps of the
interval. A shingle that occurs c times keeps the points below c. Each point goes to one register,
which keeps the earliest time; two texts agree in a register with probability equal to the weighted
Jaccard similarity. All points come from the shingle's hash, so equal shingles give equal points.
Only points before a time limit are drawn, chosen so that all registers are almost surely filled
(texts that miss one draw again with twice the limit).

Signatures are cut into bands; texts that share a band are compared exactly: the multiset overlap
over the multiset union, which must reach the threshold. Texts with equal multisets form a class
that is banded and compared once. Components of links and classes are the groups.

Defined cases: NULL text is the empty text; a text without words is a group of its own and is kept;
a text of fewer words than a shingle has one shingle of all its words; rows with the same id are
separate rows of one group at least when their texts agree; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import linked, lists, may_reach, mix, prefix_members, ready, slices, stored, text_or_empty
from keelson.llm.shingles import bags, shingles

REGISTERS = 100
BANDS = 20
SIMILARITY = 0.8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, registers: int) -> np.ndarray:
    """``n`` x ``registers`` earliest times; rows of texts without shingles stay infinite."""
    out = np.full((n, registers), np.inf)
    weight = np.bincount(owner, weights=counts, minlength=n)
    has = weight > 0
    limit = np.zeros(n)
    limit[has] = registers * (np.log(registers) + 4) / weight[has]
    todo = np.arange(len(owner))
    while len(todo):
        _draw(out, owner[todo], hashes[todo], counts[todo], limit, registers)
        open_rows = has & np.isinf(out).any(axis=1)
        limit[open_rows] *= 2
        todo = np.flatnonzero(open_rows[owner])
    return out


def _draw(out, owner, hashes, counts, limit, registers) -> None:
    level = 0
    flat = out.reshape(-1)
    while True:
        low, length = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        rows = np.flatnonzero(counts > low)
        if not len(rows):
            return
        at, own, count = mix(hashes[rows] ^ mix(np.array([level + 1], np.uint64))), owner[rows], counts[rows]
        time = np.zeros(len(rows))
        until = limit[own]
        while len(at):
            at = at + _STEP
            bits = mix(at)
            time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
            alive = time <= until
            at, own, count, time, until = at[alive], own[alive], count[alive], time[alive], until[alive]
            bits = mix(bits[alive] + _STEP)
            register = (bits & np.uint64(0xFFFFFFFF)).astype(np.int64) % registers
            if length == 1:
                np.minimum.at(flat, own * registers + register, time)
            else:
                kept = low + (bits >> np.uint64(32)).astype(np.int64) % length < count
                np.minimum.at(flat, own[kept] * registers + register[kept], time[kept])
        level += 1


def band_keys(times: np.ndarray, bands: int) -> np.ndarray:
    """One hash per row and band; the band is part of it."""
    rows = times.shape[1] // bands
    bits = times[:, : rows * bands].view(np.uint64).reshape(len(times), bands, rows)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (len(times), 1))
    for k in range(rows):
        keys = mix(keys ^ bits[:, :, k]) + _STEP
    return keys.view(np.int64)


def _spread(owner, hashes, counts) -> tuple[np.ndarray, np.ndarray]:
    """Each occurrence as an element of its own, so that set overlap is multiset overlap."""
    begins = np.cumsum(counts) - counts
    nth = np.arange(int(counts.sum())) - np.repeat(begins, counts)
    return np.repeat(owner, counts), mix(np.repeat(hashes, counts) + nth.astype(np.uint64) * _STEP)


def _signed(batches, registers: int, bands: int):
    for batch in batches:
        for part in slices(batch, "text"):
            owner, hashes, counts = bags(*shingles(part.column("text")))
            n = part.num_rows
            keys = band_keys(signatures(owner, hashes, counts, n, registers), bands)
            bounds = np.searchsorted(owner, np.arange(n + 1))
            total = np.bincount(owner, weights=counts, minlength=n).astype(np.int64)
            both = np.stack([hashes, counts.astype(np.uint64)], axis=1)
            digest = [
                hashlib.blake2b(both[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(bounds[:-1], bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("row_key"), pa.array(digest, pa.binary()), pa.array(total),
                    lists(keys.reshape(-1), np.arange(n + 1) * bands),
                ],
                names=["doc_id", "row_key", "bag", "shingles", "bands"],
            )


def _elements(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            owner, values = _spread(*bags(*shingles(part.column("text"))))
            offsets = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("bag"), lists(values.view(np.int64), offsets)], names=["bag", "elements"]
            )


def near_groups(
    documents: DataFrame, similarity: float = SIMILARITY, registers: int = REGISTERS, bands: int = BANDS
) -> DataFrame:
    """``doc_id, row_key, class_id, group_id, first`` for every row.

    ``class_id`` and ``group_id`` are the smallest ids of the class (equal multisets) and of the
    group, of the rows that have an id; both are NULL for texts without words and where no row of the
    class or group has an id. ``first`` tells the rows to keep: texts without words, and of each group
    the rows of its smallest id, or one row if none has an id. ``row_key`` is a hash of id and text.
    """
    ready(documents.sparkSession)
    texts = documents.select("doc_id", text_or_empty().alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = stored(
        texts.mapInArrow(
            lambda batches: _signed(batches, registers, bands),
            "doc_id long, row_key long, bag binary, shingles long, bands array<long>",
        ).withColumn("copy", F.monotonically_increasing_id()),
        "minhash-signatures",
    )
    classes = stored(
        signed.where("bag is not null").groupBy("bag")
        .agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row_key", "copy")).alias("one"), F.first("bands").alias("bands")),
        "minhash-classes",
    )
    members = classes.select(F.explode("bands").alias("bucket"), F.col("bag").alias("id"))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    members = stored(members.join(shared, "bucket"), "minhash-members")
    asked = (
        classes.join(members.select(F.col("id").alias("bag")).distinct(), "bag", "left_semi")
        .select("bag", F.col("one.doc_id").alias("i"), F.col("one.row_key").alias("k"))
    )
    elements = stored(
        texts.join(asked, (texts["row_key"] == asked["k"]) & texts["doc_id"].eqNullSafe(asked["i"]))
        .select("bag", "text").mapInArrow(_elements, "bag binary, elements array<long>").dropDuplicates(["bag"]),
        "minhash-bags",
    )

    def verify(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(elements.selectExpr("bag as a", "elements as x"), "a")
            .join(elements.selectExpr("bag as b", "elements as y"), "b")
            .where(f"least(size(x), size(y)) >= {similarity} * greatest(size(x), size(y))")
            .selectExpr("a", "b", "size(x) + size(y) as total", "size(array_intersect(x, y)) as shared")
        )
        return both.where(f"shared >= {similarity} * (total - shared)").select("a", "b")

    def refine(ids: DataFrame) -> DataFrame:
        return prefix_members(elements.withColumnRenamed("bag", "id"), ids, similarity)

    roots = linked(members, verify, refine, may_reach(similarity))
    placed = classes.select("bag", "one", F.col("one.doc_id").alias("class_id")).join(
        roots.withColumnRenamed("id", "bag"), "bag", "left"
    ).select("bag", "one", "class_id", F.coalesce("root", "bag").alias("root"))
    groups = placed.groupBy("root").agg(F.min("one").alias("least"))
    placed = stored(
        placed.join(groups, "root")
        .select("bag", "class_id", F.col("least.doc_id").alias("group_id"), F.col("least.copy").alias("least")),
        "minhash-placed",
    )
    first = F.when(F.col("bag").isNull(), True).when(F.col("group_id").isNull(), F.col("copy") == F.col("least")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("group_id"))
    )
    return signed.select("doc_id", "row_key", "bag", "copy").join(placed, "bag", "left").select(
        "doc_id", "row_key", "class_id", "group_id", first.alias("first")
    )


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """The documents without all but the first (smallest id) of each group; texts without words stay.

    Of a group without any id one row stays.
    """
    found = near_groups(documents, **options)
    gone = found.where("not first").groupBy("doc_id", "row_key").count().select(
        F.col("doc_id").alias("_id"), F.col("row_key").alias("_row"), F.lit(True).alias("_gone")
    )
    spared = found.where("first and doc_id is null and class_id is null and group_id is null").select(F.col("row_key").alias("_spared")).distinct()
    keyed = documents.withColumn("_key", F.xxhash64("doc_id", text_or_empty()))
    on = (F.col("_key") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    kept = keyed.join(gone, on, "left_anti")
    # Equal rows without an id cannot be told apart: where one of them stays, any one does.
    doubtful = (
        keyed.where("doc_id is null").join(gone.where("_id is null"), F.col("_key") == F.col("_row"), "left_semi")
        .join(spared, F.col("_key") == F.col("_spared"), "left_semi").dropDuplicates(["_key"])
    )
    return kept.union(doubtful).drop("_key")
