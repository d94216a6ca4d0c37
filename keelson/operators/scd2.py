"""Slowly changing dimension, type 2. Validity is half-open, ``NULL`` end means open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import surrogate_key
from keelson.operators.evolve import conform, merged_schema
from keelson.operators.upsert import require_unique
from keelson.spec import Run

BUSINESS_KEY = "BusinessKey_CustomerID"
VERSIONING = (
    "Version",
    "IsCurrent",
    "EffectiveStartDate",
    "EffectiveEndDate",
    "_audit_insert_batch",
    "_audit_update_batch",
)


def dimension_source(
    silver: DataFrame, key: str = "customer_id", carry: Sequence[str] = ()
) -> DataFrame:
    """Silver rows in the shape of the dimension: hashed key, renamed key, attributes, hash, and
    the columns of ``carry``, such as ones a later delivery brought."""
    return silver.select(
        surrogate_key(key).alias("SurrogateKey"),
        F.col(key).alias(BUSINESS_KEY),
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "customer_region",
        "_record_hash",
        *carry,
    )


def _opened(version: Column, run: Run) -> list[Column]:
    return [
        version.cast("int").alias("Version"),
        F.lit(True).alias("IsCurrent"),
        F.lit(run.as_of).alias("EffectiveStartDate"),
        F.lit(None).cast("timestamp").alias("EffectiveEndDate"),
        F.lit(run.batch_id).alias("_audit_insert_batch"),
        F.lit(None).cast("string").alias("_audit_update_batch"),
    ]


def first_versions(source: DataFrame, run: Run) -> DataFrame:
    """Initial load."""
    return source.select("*", *_opened(F.lit(1), run))


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col("IsCurrent"))


def closed_rows(dimension: DataFrame) -> DataFrame:
    return dimension.filter(~F.col("IsCurrent"))


def history_view(dimension: DataFrame) -> DataFrame:
    return closed_rows(dimension).select(
        BUSINESS_KEY,
        "customer_city",
        "customer_state",
        "Version",
        "IsCurrent",
        "EffectiveStartDate",
        "EffectiveEndDate",
    )


def next_versions(source: DataFrame, dimension: DataFrame, key: str = BUSINESS_KEY) -> DataFrame:
    """Each source row with the version number it would get if it were inserted."""
    latest = current_rows(dimension).select(key, F.col("Version").alias("_current"))
    return (
        source.join(latest, key, "left")
        .withColumn("NewVersion", F.coalesce(F.col("_current") + 1, F.lit(1)))
        .select(*source.columns, "NewVersion")
    )


def changed_rows(
    source: DataFrame,
    dimension: DataFrame,
    key: str = BUSINESS_KEY,
    hash_column: str = "_record_hash",
) -> DataFrame:
    """Source rows whose key is current in the dimension with another hash."""
    known = current_rows(dimension).select(key, hash_column).alias("d")
    differs = ~F.col(f"d.{hash_column}").eqNullSafe(F.col(f"s.{hash_column}"))
    on = (F.col(f"d.{key}") == F.col(f"s.{key}")) & differs
    return source.alias("s").join(known, on, "inner").select("s.*")


def apply_changes(
    dimension: DataFrame | None,
    source: DataFrame,
    run: Run,
    key: str = BUSINESS_KEY,
    hash_column: str = "_record_hash",
    unique_source: bool = False,
    close_absent: bool = False,
) -> DataFrame:
    """The dimension after one load: new keys get version 1, changed keys have their current
    row closed and the next version opened, all other rows stay. Applying the same source again
    changes nothing. The source holds each key once; unless ``unique_source`` says that this is
    known, a key that repeats fails the run.

    A load older than a key's current version does not change that key: see
    ``late.apply_late`` for loads out of order. Columns only the source has are added, NULL in
    older rows, and types widen as in ``evolve``.

    ``close_absent`` is for a source that holds every key there is: current rows whose key it
    lacks are closed without a successor, and a closed key that comes back opens the version after
    its last one, with a gap in between.

    A single full outer join of the current rows with the source; each joined pair yields its
    one or two rows in place. Closed history never enters the shuffle, except that
    ``close_absent`` sums up one number per closed key.
    """
    if not unique_source:
        source = require_unique(source, key)
    if dimension is None:
        return first_versions(source, run)

    added = [f for f in source.schema.fields if f.name not in dimension.columns]
    held = [f for f in dimension.schema.fields if f.name not in VERSIONING]
    attributes = merged_schema(T.StructType(held), source.schema)
    known = merged_schema(T.StructType(dimension.schema.fields + added), source.schema)
    names = known.fieldNames()
    if known != dimension.schema:
        dimension = conform(dimension, known)
    if attributes != source.schema:
        source = conform(source, attributes)
    attributes = attributes.fieldNames()

    # The keys stay plain columns, so that the join can use how the sides are already dealt out.
    old = current_rows(dimension).select(F.col(key).alias("_held"), F.struct(*names).alias("d"))
    new = source.select(F.col(key).alias("_given"), F.struct(*attributes).alias("s"))
    pairs = old.join(new, F.col("_held") == F.col("_given"), "full_outer")
    last = F.col("d.Version")
    if close_absent:
        past = closed_rows(dimension).groupBy(F.col(key).alias("_past")).agg(
            F.max("Version").alias("_last"), F.max("EffectiveEndDate").alias("_until")
        )
        pairs = pairs.join(past, F.col("_given") == F.col("_past"), "left")
        # A load older than the end of a closed key does not open it again.
        pairs = pairs.where(F.col("d").isNotNull() | F.col("_until").isNull() | (F.col("_until") <= F.lit(run.as_of)))
        last = F.coalesce(last, F.col("_last"))

    def row(**changes: Column) -> Column:
        return F.struct(*(changes.get(name, F.col(f"d.{name}")).alias(name) for name in names))

    kept = row()
    closed = row(
        IsCurrent=F.lit(False),
        EffectiveEndDate=F.lit(run.as_of),
        _audit_update_batch=F.lit(run.batch_id),
    )
    opened = F.struct(
        *(F.col(f"s.{name}").alias(name) for name in attributes),
        *_opened(F.coalesce(last + 1, F.lit(1)), run),
    )
    opened = F.struct(*(opened[name].alias(name) for name in names))

    same = F.col(f"d.{hash_column}").eqNullSafe(F.col(f"s.{hash_column}"))
    late = F.lit(run.as_of) < F.col("d.EffectiveStartDate")
    absent = F.col("s").isNull()
    rows = F.when(F.col("d").isNull(), F.array(opened))
    if close_absent:
        rows = rows.when(absent & ~late, F.array(closed))
    rows = rows.when(absent | same | late, F.array(kept)).otherwise(F.array(closed, opened))
    return closed_rows(dimension).unionByName(pairs.select(F.inline(rows)))


def join_facts(facts: DataFrame, dimension: DataFrame, fact_key: str) -> DataFrame:
    """All facts with the attributes current for their key; ``in_dimension`` is false, and the
    attributes NULL, where the dimension has no such key. Versions share the surrogate key, so
    only current rows may be joined. A hot key sits on the fact side only, where adaptive
    execution splits its partition."""
    attributes = current_rows(dimension).drop(*VERSIONING, "_record_hash")
    return facts.join(attributes, F.col(fact_key) == F.col(BUSINESS_KEY), "left").withColumn(
        "in_dimension", F.col(BUSINESS_KEY).isNotNull()
    )
