"""Ordered work per key in chunks of the order, so that no key is one task's work.

Rows of a key are cut into chunks of time, say a month each. Inside a chunk a window does the
work; what one chunk has to know of those before or after it is one row per key and chunk, over
which a second, small window runs. A key with a third of all rows is so split into its chunks,
and the second window holds as many rows of it as the covered time has chunks, however many rows
the table has.

What chunks tell each other costs as much as the rows themselves where a key has a row or two per
chunk. So only keys that are ``crowded`` are cut; the others are ordered whole, in one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import bucket_of

CHUNK = "_chunk"
MONTH = 30 * 24 * 3600

#: Keys are counted in so many bins. One is crowded that holds more than ``CROWD`` rows and ``UNEVEN`` times the mean.
BINS, CROWD, UNEVEN = 4096, 10_000, 8


def key_type(*keys: tuple[DataFrame, str]) -> T.DataType:
    """The type in which keys of these frames compare."""
    first, *others = (rows.select(F.col(key).alias("_key")) for rows, key in keys)
    for other in others:
        first = first.union(other)
    return first.schema["_key"].dataType


def bin_of(key: str, kind: T.DataType) -> Column:
    return bucket_of(F.col(key).cast(kind), BINS)


def crowded(kind: T.DataType, *keys: tuple[DataFrame, str], crowd: int = CROWD) -> list[int]:
    """Bins whose keys have far more rows than those of other bins: those with a hot key, NULL included. One job over
    the key columns; ``BINS`` numbers reach the driver."""
    first, *others = (rows.select(bin_of(key, kind).alias("bin")) for rows, key in keys)
    for other in others:
        first = first.union(other)
    counts = {r["bin"]: r["rows"] for r in first.groupBy("bin").agg(F.count("*").alias("rows")).collect()}
    most = max(crowd, UNEVEN * sum(counts.values()) / max(1, len(counts)))
    return sorted(b for b, rows in counts.items() if rows > most)


def chunk_of(at: str, seconds: int = MONTH) -> Column:
    """Number of the chunk a time falls into."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


def within(key: str, *order: str) -> Window:
    """A key's rows in one chunk, in order."""
    return Window.partitionBy(key, CHUNK).orderBy(*order)


def along(key: str) -> Window:
    """A key's chunks in order; for tables with a row per key and chunk."""
    return Window.partitionBy(key).orderBy(CHUNK)


def with_neighbours(rows: DataFrame, key: str, at: str, columns: dict[str, Column], seconds: int = MONTH) -> DataFrame:
    """``rows`` with their chunk and, for each name in ``columns``, that value of the key's row
    before it as ``previous_<name>``. Times of a key are distinct."""
    rows = rows.withColumn(CHUNK, chunk_of(at, seconds))
    inside = within(key, at)
    last = rows.groupBy(key, CHUNK).agg(F.max_by(F.struct(*(c.alias(n) for n, c in columns.items())), at).alias("_last"))
    before = last.select(key, CHUNK, F.lag("_last").over(along(key)).alias("_before"))
    return (
        rows.withColumn("_own", F.lag(F.struct(*(c.alias(n) for n, c in columns.items()))).over(inside))
        .join(before, [key, CHUNK])
        .select(*rows.columns, *(F.when(F.col("_own").isNotNull(), F.col(f"_own.{n}")).otherwise(F.col(f"_before.{n}")).alias(f"previous_{n}") for n in columns))
    )


def numbered(rows: DataFrame, key: str, at: str, seconds: int = MONTH, number: str = "nth", then: str = "next") -> DataFrame:
    """``rows`` with their place among the key's rows from 1, and the time of the row after each."""
    rows = rows.withColumn(CHUNK, chunk_of(at, seconds))
    inside = within(key, at)
    sums = rows.groupBy(key, CHUNK).agg(F.count("*").alias("_n"), F.min(at).alias("_first"))
    order = along(key)
    sums = sums.select(
        key, CHUNK, F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(order).alias("_after"),
    )
    return (
        rows.withColumn("_nth", F.row_number().over(inside)).withColumn("_next", F.lead(at).over(inside))
        .join(sums, [key, CHUNK])
        .select(
            *(c for c in rows.columns if c != CHUNK), (F.col("_before") + F.col("_nth")).cast("int").alias(number),
            F.coalesce("_next", "_after").alias(then),
        )
    )
