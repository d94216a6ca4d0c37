"""Join of facts with the version that was valid at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from keelson.operators.chunked import CHUNK, CROWD, MONTH, along, bin_of, chunk_of, crowded, key_type
from keelson.operators.scd2 import BUSINESS_KEY, VERSIONING


def join_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    fact_time: str,
    key: str = BUSINESS_KEY,
    start: str = "EffectiveStartDate",
    end: str = "EffectiveEndDate",
    attributes: Sequence[str] | None = None,
    seconds: int = MONTH,
    crowd: int = CROWD,
) -> DataFrame:
    """Every fact once, with the attributes its key had at its time: those of the version with the last
    ``start`` not after the time, if its ``end`` lies behind the time or is open. ``in_dimension`` is false and the
    attributes NULL where there is none, as for facts with a NULL key or time. Of versions with one start
    the one with the greatest attributes counts.

    Facts and versions of a key are dealt out together and put in the order of time, and each fact takes the last
    version before it: one shuffle, no range condition. Keys with far more rows than others (``chunked.crowded``), NULL
    included, are joined in chunks of ``seconds``.
    """
    if attributes is None:
        attributes = [c for c in dimension.columns if c not in (*VERSIONING, "_record_hash")]
    sides = ((facts, fact_key), (dimension, key))
    kind = key_type(*sides)
    names = (fact_key, fact_time, key, start, end, attributes)
    bins = crowded(kind, *sides, crowd=crowd)
    if not bins:
        return _in_one_order(facts, dimension, *names, kind)
    hot_fact, hot_version = (bin_of(k, kind).isin(bins) for k in (fact_key, key))
    few = _in_one_order(facts.where(~hot_fact), dimension.where(~hot_version), *names, kind)
    return few.unionByName(_in_chunks(facts.where(hot_fact), dimension.where(hot_version), *names, seconds))


def _versions(dimension: DataFrame, key: str, start: str, end: str, attributes: Sequence[str]) -> DataFrame:
    return dimension.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(start).alias("_at"),
        F.struct(F.col(start).alias("_from"), F.col(end).alias("_to"), F.struct(*attributes).alias("_a")).alias("v"),
    )


def _in_one_order(
    facts: DataFrame, dimension: DataFrame, fact_key: str, fact_time: str, key: str, start: str, end: str, attributes: Sequence[str], kind: DataType
) -> DataFrame:
    """Facts stay plain columns, so that those nobody reads are not moved; a key of one type is moved once."""
    columns = facts.columns
    by = fact_key if facts.schema[fact_key].dataType == dimension.schema[key].dataType else "_key"
    versions = _versions(dimension, key, start, end, attributes).withColumnRenamed("_key", by)
    asked = facts.withColumns(
        {by: F.col(fact_key).cast(kind), "_at": F.col(fact_time).cast(dimension.schema[start].dataType), "_is_fact": F.lit(True)}
    )
    rows = versions.withColumns({by: F.col(by).cast(kind), "_is_fact": F.lit(False)}).unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy(by).orderBy("_at", "_is_fact", "v")
    found = rows.withColumn("_v", F.last("v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return _picked(found.where("_is_fact"), columns, attributes, F.col("_at"))


def _picked(found: DataFrame, columns: Sequence[str], attributes: Sequence[str], time: Column) -> DataFrame:
    """``_v`` is the last version begun by the time; it counts if it has not ended."""
    valid = F.col("_v").isNotNull() & (F.col("_v._to").isNull() | (time < F.col("_v._to")))
    return found.withColumn("_valid", F.coalesce(valid, F.lit(False))).select(
        *columns, *(F.when(F.col("_valid"), F.col(f"_v._a.{c}")).alias(c) for c in attributes), F.col("_valid").alias("in_dimension")
    )


def _in_chunks(
    facts: DataFrame, dimension: DataFrame, fact_key: str, fact_time: str, key: str, start: str, end: str, attributes: Sequence[str], seconds: int
) -> DataFrame:
    """Time is cut into chunks. The versions that start in a chunk form one array per key and chunk, led by
    the version carried in from the chunk before, so facts are joined by equality on key and chunk and each
    picks its version out of a short array: no range condition, and no fact is compared with versions of other
    chunks. A row of arrays is made only for chunks in which the key has facts or versions. Facts are never
    sorted by time. A hot key is split by its chunks, and a hot chunk by adaptive execution, as it sits on
    the fact side only.
    """
    columns = facts.columns
    facts = facts.withColumn(CHUNK, chunk_of(fact_time, seconds))
    versions = _versions(dimension, key, start, end, attributes).withColumn(CHUNK, chunk_of("_at", seconds))
    own = versions.groupBy("_key", CHUNK).agg(F.array_sort(F.collect_list("v")).alias("vs"))
    asked = (
        facts.where(F.col(fact_key).isNotNull() & F.col(CHUNK).isNotNull())
        .select(F.col(fact_key).alias("_key"), CHUNK).distinct()
        .withColumn("vs", F.lit(None).cast(own.schema["vs"].dataType))
    )
    # Both sides hold a key and chunk once, so the maximum is the array, if there is one.
    chunks = own.unionByName(asked).groupBy("_key", CHUNK).agg(F.max("vs").alias("vs"))
    before = along("_key").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.try_element_at("vs", F.lit(-1)), ignorenulls=True).over(before)
    none = F.array().cast(own.schema["vs"].dataType)
    led = chunks.withColumn("_carried", carried).select(
        "_key", F.col(CHUNK).alias("_at"),
        F.concat(F.when(F.col("_carried").isNotNull(), F.array("_carried")).otherwise(none), F.coalesce("vs", none)).alias("vs"),
    )
    led = led.where(F.size("vs") > 0)
    on = (F.col(fact_key) == F.col("_key")) & (F.col(CHUNK) == F.col("_at"))
    time = F.col(fact_time).cast(own.schema["vs"].dataType.elementType["_from"].dataType)
    begun = F.filter("vs", lambda v: v["_from"] <= time)
    found = facts.join(led, on, "left").withColumn("_v", F.try_element_at(begun, F.lit(-1)))
    return _picked(found, columns, attributes, time)
