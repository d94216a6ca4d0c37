"""Upsert that rewrites a row only when its change hash differs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators.evolve import conform, merged_schema


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows; fails at run time if a key occurs twice. The row number needs only the
    hash partitioning and sort the following join on ``key`` needs anyway, and no buffer."""
    seen = F.row_number().over(Window.partitionBy(key).orderBy(key))
    problem = F.raise_error(F.concat(F.lit(f"source repeats {key} "), F.col(key).cast("string")))
    return (
        df.withColumn("_seen", seen)
        .filter(F.when(F.col("_seen") == 1, True).otherwise(problem.cast("boolean")))
        .drop("_seen")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    hash_column: str,
    update_columns: Sequence[str] | None = None,
    unique_source: bool = False,
    order_by: str | None = None,
) -> DataFrame:
    """The target after applying the source: unchanged and target-only rows stay as they are,
    changed rows take ``update_columns`` (default: all but the key) from the source, new keys
    are inserted whole. Columns only one side has are added as NULL first. With ``order_by`` a
    source row older than the target's (NULL is oldest) changes nothing, so an old batch can be
    applied again; a target whose ``update_columns`` leave that column out knows its first time only.

    One full outer join on the key. Both sides hold a key at most once, so no key can be hot;
    pass ``unique_source=True`` when that is already known, e.g. after ``latest_per_key``.
    """
    schema = merged_schema(target.schema, source.schema)
    names = schema.fieldNames()
    if update_columns is None:
        update_columns = [name for name in source.columns if name != key]
    if not unique_source:
        source = require_unique(source, key)

    old = conform(target, schema).withColumn("_in_target", F.lit(True)).alias("t")
    new = conform(source, schema).withColumn("_in_source", F.lit(True)).alias("s")
    both = old.join(new, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")

    inserted = F.col("t._in_target").isNull()
    changed = F.col("s._in_source").isNotNull() & ~F.col(f"t.{hash_column}").eqNullSafe(
        F.col(f"s.{hash_column}")
    )
    if order_by is not None:
        held, given = F.col(f"t.{order_by}"), F.col(f"s.{order_by}")
        changed &= held.isNull() | F.coalesce(given >= held, F.lit(False))
    updatable = set(update_columns)
    return both.select(
        *(
            F.when(inserted | changed if name in updatable else inserted, F.col(f"s.{name}"))
            .otherwise(F.col(f"t.{name}"))
            .alias(name)
            for name in names
        )
    )


def new_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have."""
    return source.join(target.select(key), key, "left_anti").select(source.columns)
