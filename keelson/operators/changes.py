"""What changed between two states of a table, found by comparing digests before rows.

A state is summarised by a tree of digests: rows fall by a hash of their key into buckets, and within these into
leaves. Two states are compared from the buckets down, and only the rows of leaves whose digests differ are
looked at. The digests are sums over rows, so making them needs no sort and a hot key costs one row per task.

Rows are compared as a set with repeats: a row that occurs more often in one state is a change of that many
copies. NULL keys are a key. Columns must be comparable (no maps).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import set_digest
from keelson.operators.evolve import conform, merged_schema

CHANGE = "_change"
COPIES = "_copies"
BUCKET = "_bucket"
LEAF = "_leaf"

#: Times to the last digit; the default would cut them to milliseconds.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def placed(rows: DataFrame, key: Sequence[str], buckets: int, leaves: int) -> DataFrame:
    """Rows with their place in the tree."""
    place = F.pmod(F.xxhash64(*key), F.lit(buckets * leaves))
    return rows.withColumns(
        {BUCKET: F.floor(place / leaves).cast("int"), LEAF: (place % leaves).cast("int")}
    )


def _as_text(columns: Sequence[str]) -> Column:
    """A row's columns by name, without those that are NULL: a column that one state lacks and the
    other has only as NULL is no change."""
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(columns))), _TIMES)


def leaf_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_bucket, _leaf, rows, digest``: the lowest level, at most one row per leaf."""
    return rows.groupBy(BUCKET, LEAF).agg(
        F.count("*").alias("rows"), set_digest(_as_text(columns)).alias("digest")
    )


def bucket_digests(leaves: DataFrame) -> DataFrame:
    """``_bucket, digest``: the level above."""
    text = F.concat_ws(":", LEAF, "rows", "digest")
    return leaves.groupBy(BUCKET).agg(set_digest(text).alias("digest"))


def _differing(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    renamed = after.select(*by, F.col("digest").alias("digest_after"))
    both = before.select(*by, "digest").join(renamed, list(by), "full_outer")
    return both.filter(~F.col("digest").eqNullSafe(F.col("digest_after"))).select(*by)


def unequal_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """``_bucket, _leaf`` of the leaves that differ. Leaves of equal buckets are not compared."""
    buckets = _differing(bucket_digests(before), bucket_digests(after), [BUCKET])
    return _differing(
        before.join(buckets, BUCKET, "left_semi"), after.join(buckets, BUCKET, "left_semi"), [BUCKET, LEAF]
    )


def changes(before: DataFrame, after: DataFrame, key: Sequence[str], compared: Sequence[str] | None = None) -> DataFrame:
    """Rows of either state the other lacks, with ``_change`` (``insert``, ``delete``, ``update_before``,
    ``update_after``) and ``_copies``. A key with rows gone and rows come is an update.

    ``compared`` names the columns that count beside the key; rows equal in them are no change, and of rows
    that differ all columns are returned (of copies, the largest of the others). By default all columns count.
    """
    schema = merged_schema(before.schema, after.schema)
    columns = schema.fieldNames()
    counted = [c for c in columns if compared is None or c in compared or c in key]
    others = [c for c in columns if c not in counted]
    signed = [
        conform(rows, schema).select(*columns, F.lit(sign).alias("_sign")) for rows, sign in ((before, -1), (after, 1))
    ]
    # Of the columns that do not count, each side gives the largest it has.
    carried = [
        F.max(F.when(F.col("_sign") == sign, F.struct(*others))).alias(name)
        for sign, name in ((-1, "_gone"), (1, "_come"))
    ] if others else []
    moved = (
        reduce(DataFrame.unionByName, signed)
        .groupBy(*counted)
        .agg(F.sum("_sign").alias("_net"), *carried)
        .filter("_net <> 0")
    )
    if others:
        side = F.when(F.col("_net") > 0, F.col("_come")).otherwise(F.col("_gone"))
        moved = moved.withColumn("_side", side).select(*counted, "_side.*", "_net")
    sides = moved.groupBy(*(F.col(c).alias(f"_key_{c}") for c in key)).agg(
        (F.min("_net") < 0).alias("_has_gone"), (F.max("_net") > 0).alias("_has_come")
    )
    same_key = reduce(Column.__and__, (moved[c].eqNullSafe(sides[f"_key_{c}"]) for c in key))
    updated = F.col("_has_gone") & F.col("_has_come")
    come = F.col("_net") > 0
    kind = (
        F.when(updated & come, "update_after").when(updated, "update_before").when(come, "insert").otherwise("delete")
    )
    joined = moved.join(sides, same_key)
    return joined.select(kind.alias(CHANGE), *columns, F.abs("_net").alias(COPIES))


def applied(state: DataFrame, feed: DataFrame) -> DataFrame:
    """The state after a feed of changes of all columns: what a copy kept elsewhere does with it."""
    come = F.col(CHANGE).isin("insert", "update_after")
    schema = merged_schema(state.schema, feed.drop(CHANGE, COPIES).schema)
    signed = feed.withColumn("_net", F.when(come, F.col(COPIES)).otherwise(-F.col(COPIES))).drop(CHANGE, COPIES)
    both = conform(state, schema).withColumn("_net", F.lit(1).cast("long")).unionByName(signed)
    left = both.groupBy(*schema.fieldNames()).agg(F.sum("_net").alias("_net")).filter("_net > 0")
    return left.select(*schema.fieldNames(), F.explode(F.sequence(F.lit(1), "_net"))).drop("col")
