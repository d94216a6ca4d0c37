"""Sharding by minimax contiguous partition, with DataFrame operations only.

Rows that hold equal texts form an atomic group and share a shard. Groups are ordered by size,
largest first, then by the digest of their text, and cut into contiguous shards. The smallest
capacity with which a greedy pass needs no more than the shards left is found by binary search;
the shard is cut there, and the search goes on for the rest, so one huge group does not leave the
other shards empty.

The greedy pass only needs the sizes in order, and equal sizes are neighbours: the driver gets the
histogram (size, groups), never the groups. Its rows have distinct sizes whose sum is at most all
bytes, so it has at most sqrt(2 x bytes) rows, and in practice far fewer. Cuts that fall between
groups of equal size are placed by digest, looked up with a bounded window.

Defined cases: NULL text is the group of NULL texts with no bytes; an empty table gives no rows;
rows with the same id are separate rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

SHARDS = 40
ROW_BYTES = 16


class _Runs:
    """Runs of (size, groups) in order, with sums before each."""

    def __init__(self, runs: list[tuple[int, int]]):
        self.runs = runs
        self.bytes, self.groups = [0], [0]
        for size, n in runs:
            self.bytes.append(self.bytes[-1] + size * n)
            self.groups.append(self.groups[-1] + n)

    def sum_to(self, group: int) -> int:
        """Bytes of the first ``group`` groups."""
        run = bisect.bisect_right(self.groups, group) - 1
        rest = group - self.groups[run]
        return self.bytes[run] + (self.runs[run][0] * rest if rest else 0)

    def reach(self, base: int, capacity: int) -> int:
        """The most groups, from the first one, whose bytes do not pass ``base + capacity``."""
        limit = base + capacity
        run = bisect.bisect_right(self.bytes, limit) - 1
        if run == len(self.runs):
            return self.groups[-1]
        return self.groups[run] + (limit - self.bytes[run]) // self.runs[run][0]

    def fits(self, start: int, capacity: int, shards: int) -> bool:
        at = start
        for _ in range(shards):
            at = self.reach(self.sum_to(at), capacity)
            if at == self.groups[-1]:
                return True
        return False


def cuts(runs: list[tuple[int, int]], shards: int) -> list[int]:
    """How many groups, counted from the first, lie before the end of each shard but the last."""
    table = _Runs(runs)
    total, at, out = table.bytes[-1], 0, []
    for left in range(shards, 1, -1):
        if at < table.groups[-1]:
            rest = total - table.sum_to(at)
            largest = table.runs[bisect.bisect_right(table.groups, at) - 1][0]
            low, high = max(-(-rest // left), largest), rest
            while low < high:
                middle = (low + high) // 2
                if table.fits(at, middle, left):
                    high = middle
                else:
                    low = middle + 1
            at = table.reach(table.sum_to(at), low)
        out.append(at)
    return out


def assign_shards(documents: DataFrame, shards: int = SHARDS, chunks: int = 256) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps, by hash chunk and id: each of the
    ``chunks`` of a shard is ranked in its own task and starts after the chunks before it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit("-")).otherwise(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    rows = stored(rows, "shard-rows")
    groups = stored(
        rows.groupBy("digest").agg((F.count("*") * F.first("size")).alias("weight")), "shard-groups"
    )
    runs = [(r[0], r[1]) for r in groups.groupBy("weight").count().orderBy(F.desc("weight")).collect()]
    groups = groups.withColumn("shard", _shard(groups, runs, cuts(runs, shards), shards))
    placed = (
        rows.join(groups.select("digest", "shard"), "digest")
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(chunks)).cast("int"))
        .drop("digest")
    )
    starts = (
        placed.groupBy("shard", "chunk").count()
        .selectExpr("shard", "chunk", "sum(count) over (partition by shard order by chunk) - count as start")
    )
    ranked = placed.selectExpr(
        "*", "row_number() over (partition by shard, chunk order by doc_id, text_crc32) - 1 as place"
    )
    return ranked.join(starts, ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _shard(groups: DataFrame, runs: list[tuple[int, int]], ends: list[int], shards: int):
    """The shard of a group as an expression of its weight and digest: cuts at or before it.

    A cut inside a run of equal weights needs the digest of the group it falls before. The run is
    counted by the first four hex digits of the digest, which finds the few groups to rank.
    """
    sums, before = [0], {}
    for _, n in runs:
        sums.append(sums[-1] + n)
    inside = {}
    shard = F.lit(0)
    total = sums[-1]
    for end in ends:
        if end >= total:
            continue
        run = bisect.bisect_right(sums, end) - 1
        weight, place = runs[run][0], end - sums[run]
        if place:
            inside.setdefault(weight, []).append(place)
        before[end] = (weight, place)
    digests = _digests_at(groups, inside) if inside else {}
    for end in ends:
        if end not in before:
            continue
        weight, place = before[end]
        passed = F.col("weight") < weight
        if place:
            passed |= (F.col("weight") == weight) & (F.col("digest") >= digests[weight, place])
        else:
            passed |= F.col("weight") == weight
        shard += passed.cast("int")
    return shard


def _digests_at(groups: DataFrame, inside: dict[int, list[int]]) -> dict[tuple[int, int], str]:
    """The digest of the group at each place of the given runs of equal weight."""
    cut = groups.where(F.col("weight").isin([*inside])).withColumn("head", F.substring("digest", 1, 4))
    heads: dict[int, list[tuple[str, int]]] = {}
    for weight, head, n in cut.groupBy("weight", "head").count().orderBy("weight", "head").collect():
        heads.setdefault(weight, []).append((head, n))
    wanted = {}
    for weight, places in inside.items():
        for place in places:
            at = place
            for head, n in heads[weight]:
                if at < n:
                    wanted[weight, head, at + 1] = (weight, place)
                    break
                at -= n
    few = F.lit(False)
    for weight, head, _ in wanted:
        few |= (F.col("weight") == weight) & (F.col("head") == head)
    ranked = cut.where(few).selectExpr(
        "weight", "head", "digest", "row_number() over (partition by weight, head order by digest) as place"
    )
    hits = F.lit(False)
    for weight, head, place in wanted:
        hits |= (F.col("weight") == weight) & (F.col("head") == head) & (F.col("place") == place)
    return {wanted[r[0], r[1], r[3]]: r[2] for r in ranked.where(hits).collect()}
