"""Loads that arrive in any order: one history, whatever came first.

What was delivered is kept as observations: a key's attributes as of a date. The versions of a key
are the islands of equal values along its observations. A delivery that comes late so splits the
version that holds its date, moves a border, or closes a gap between two versions that turn out to be
one, and the result is the same for every order of arrival. The dates of confirmations are needed for
that: A on day 1, A on day 3 and then B on day 2 makes three versions, without day 3 only two.

Only keys that occur in a load are worked on; all others pass through. Observations, versions held and
keys of the load are dealt out by key together and put in order once; a key with far more rows than
others goes the way of ``chunked`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.chunked import CROWD, MONTH, bin_of, crowded, key_type, numbered, with_neighbours
from keelson.operators.dedup import latest_per_key
from keelson.operators.evolve import conform, merged_schema, union_evolving
from keelson.operators.scd2 import BUSINESS_KEY, VERSIONING
from keelson.spec import Run

AT = "_valid_from"
BATCH = "_arrived_in"


def observed(
    observations: DataFrame | None, arrivals: DataFrame, run: Run, key: str = BUSINESS_KEY, tie_break: Sequence[str] = ()
) -> DataFrame:
    """All observations after a load: one per key and date. ``arrivals`` hold the date as
    ``_valid_from``; rows with a NULL key or date are no observations. Of several for one key and date the
    one of the latest batch counts, then the greatest by ``tie_break`` (default: all columns). A hot key is
    summed up by date before it is shuffled."""
    rows = arrivals.where(F.col(key).isNotNull() & F.col(AT).isNotNull()).withColumn(BATCH, F.lit(run.batch_id))
    if observations is not None:
        rows = union_evolving(observations, rows)
    return latest_per_key(rows, [key, AT], BATCH, list(tie_break) or None).select(*rows.columns)


def versions_of(
    observations: DataFrame, key: str = BUSINESS_KEY, hash_column: str = "_record_hash", seconds: int = MONTH
) -> DataFrame:
    """The versions the observations make: islands of equal ``hash_column`` along the dates of a key, with
    the attributes each was first observed with. Audit columns are left to ``apply_late``."""
    seen = with_neighbours(observations, key, AT, {"hash": F.col(hash_column), "date": F.col(AT)}, seconds)
    starts = F.col("previous_date").isNull() | ~F.col("previous_hash").eqNullSafe(F.col(hash_column))
    opened = seen.where(starts).select(*observations.columns)
    rows = numbered(opened, key, AT, seconds, "Version", "EffectiveEndDate")
    attributes = [c for c in observations.columns if c not in (AT, BATCH)]
    return rows.select(
        *attributes,
        "Version",
        F.col("EffectiveEndDate").isNull().alias("IsCurrent"),
        F.col(AT).alias("EffectiveStartDate"),
        "EffectiveEndDate",
    )


def apply_late(
    dimension: DataFrame | None,
    observations: DataFrame,
    arrivals: DataFrame,
    run: Run,
    key: str = BUSINESS_KEY,
    hash_column: str = "_record_hash",
    seconds: int = MONTH,
    crowd: int = CROWD,
) -> DataFrame:
    """The dimension after a load whose dates may lie anywhere. ``observations`` are those after the load
    (``observed``), ``arrivals`` at least the keys of the load.

    The versions of these keys are made anew and compared with those the dimension has: a version that starts
    as before with the same value keeps the batch that inserted it, and notes this run only where its end or
    number changed. Repeating a load changes nothing. ``seconds`` and ``crowd`` are those of ``chunked``."""
    touched = arrivals.select(key).where(F.col(key).isNotNull()).distinct()
    held = [(rows, key) for rows in (observations, dimension) if rows is not None]
    kind = key_type(*held, (touched, key))
    bins = crowded(kind, *held, crowd=crowd)
    if not bins:
        return _in_one_order(dimension, observations, touched, run, key, hash_column)
    hot = bin_of(key, kind).isin(bins)
    few, many = ([None if rows is None else rows.where(side) for rows in (dimension, observations, touched)] for side in (~hot, hot))
    return union_evolving(_in_one_order(*few, run, key, hash_column), _in_chunks(*many, run, key, hash_column, seconds))


#: What a row is, in the order in which rows of one key and date stand.
_TOUCHED, _HELD, _OBSERVED = 0, 1, 2


def _in_one_order(
    dimension: DataFrame | None, observations: DataFrame, touched: DataFrame, run: Run, key: str, hash_column: str
) -> DataFrame:
    """Each key's mark, held versions and observations along their dates: a mark comes first, and a version held
    stands right before the observation of its date. One shuffle and one sort serve all of it."""
    attributes = [f for f in observations.schema.fields if f.name not in (AT, BATCH)]
    date = observations.schema[AT].dataType
    versioning = zip(VERSIONING, (T.IntegerType(), T.BooleanType(), date, date, T.StringType(), T.StringType()))
    schema = T.StructType([*attributes, *(T.StructField(n, t) for n, t in versioning)])
    if dimension is not None:
        schema = merged_schema(dimension.schema, schema)
    given = [f.name for f in attributes if f.name != key]
    names = [n for n in schema.fieldNames() if n != key]
    seen = conform(observations, T.StructType([*(schema[n] for n in (key, *given)), T.StructField(AT, date)]))
    rows = seen.select(F.col(key).alias("_key"), F.col(AT).alias("_at"), F.lit(_OBSERVED).alias("_is"), F.struct(*given).alias("n"))
    marks = touched.select(F.col(key).cast(schema[key].dataType).alias("_key"), F.lit(None).cast(date).alias("_at"), F.lit(_TOUCHED).alias("_is"))
    held = (conform(dimension, schema) if dimension is not None else conform(seen.where(F.lit(False)), schema)).select(
        F.col(key).alias("_key"), F.col("EffectiveStartDate").alias("_at"), F.lit(_HELD).alias("_is"), F.struct(*names).alias("o")
    )
    rows = rows.unionByName(held, allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)

    along = Window.partitionBy("_key").orderBy("_at", "_is")
    is_observed = F.col("_is") == _OBSERVED
    value = F.col(f"n.{hash_column}")
    rows = rows.select(
        "*",
        (F.first("_is").over(along.rowsBetween(Window.unboundedPreceding, 0)) == _TOUCHED).alias("_touched"),
        F.last(F.when(is_observed, F.struct(value.alias("value"))), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_previous"),
        F.lag(F.when(F.col("_is") == _HELD, F.struct("_at", "o"))).over(along).alias("_was"),
    )
    starts = F.col("_previous").isNull() | ~F.col("_previous.value").eqNullSafe(value)
    # Of a key that is touched only observations are left, of others only versions held.
    rows = rows.where((is_observed & F.col("_touched") & starts) | ((F.col("_is") == _HELD) & ~F.col("_touched")))
    rows = rows.select("*", F.row_number().over(along).cast("int").alias("_number"), F.lead("_at").over(along).alias("_until"))

    was = F.when(F.col("_was._at") == F.col("_at"), F.col("_was.o"))
    same: Column = was.isNotNull() & was[hash_column].eqNullSafe(value)
    still = was["Version"].eqNullSafe(F.col("_number")) & was["EffectiveEndDate"].eqNullSafe(F.col("_until"))
    made = {n: F.col(f"n.{n}") for n in given} | {
        "Version": F.col("_number"),
        "IsCurrent": F.col("_until").isNull(),
        "EffectiveStartDate": F.col("_at"),
        "EffectiveEndDate": F.col("_until"),
        "_audit_insert_batch": F.when(same, was["_audit_insert_batch"]).otherwise(F.lit(run.batch_id)),
        "_audit_update_batch": F.when(same & still, was["_audit_update_batch"]).when(same, F.lit(run.batch_id)),
    }
    return rows.select(
        *(F.col("_key").alias(n) if n == key else F.when(is_observed, made.get(n, F.lit(None))).otherwise(F.col(f"o.{n}")).alias(n) for n in schema.fieldNames())
    )


def _in_chunks(
    dimension: DataFrame | None, observations: DataFrame, touched: DataFrame, run: Run, key: str, hash_column: str, seconds: int
) -> DataFrame:
    """The same for keys whose rows are too many for one task."""
    fresh = versions_of(observations.join(touched, key, "left_semi"), key, hash_column, seconds)
    if dimension is None:
        return fresh.select("*", F.lit(run.batch_id).alias("_audit_insert_batch"), F.lit(None).cast("string").alias("_audit_update_batch"))
    mine = dimension.join(touched, key, "left_semi").select(
        F.col(key).alias("_key"), F.col("EffectiveStartDate").alias("_start"), F.struct(*(c for c in VERSIONING if c in dimension.columns), hash_column).alias("o")
    )
    on = (F.col(key) == F.col("_key")) & (F.col("EffectiveStartDate") == F.col("_start"))
    was = fresh.join(mine, on, "left")
    same: Column = F.col("_key").isNotNull() & F.col(f"o.{hash_column}").eqNullSafe(F.col(hash_column))
    still = F.col("o.Version").eqNullSafe(F.col("Version")) & F.col("o.EffectiveEndDate").eqNullSafe(F.col("EffectiveEndDate"))
    made = was.select(
        *fresh.columns,
        F.when(same, F.col("o._audit_insert_batch")).otherwise(F.lit(run.batch_id)).alias("_audit_insert_batch"),
        F.when(same & still, F.col("o._audit_update_batch")).when(same, F.lit(run.batch_id)).alias("_audit_update_batch"),
    )
    return union_evolving(dimension.join(touched, key, "left_anti").select(dimension.columns), made)
