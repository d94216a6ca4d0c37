"""Reports that read only what is new: their state is sums per source file, which merge.

``summarise`` turns rows into a small table with one row per file, kind and group. Kept in a table
that is replaced by file, like the raw rows are, the state follows every load: new files add their sums, a
file delivered again replaces its own. Each report is then a sum over the state and equals the report over
all raw rows. A load reads its own files once; no report reads raw rows again.

Kinds and what they are grouped by:

``load``       batch, load type, source system; with the first and last ingestion date
``null``       name of the null count
``value``      value of the profiled column
``bad``        value that breaks the format
``key``        batch and key: as many rows as a file has keys, for duplicates may be spread over files
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.spec import NULL_COUNTS

FILE = "_source_file_name"
STATE_SCHEMA = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("group", T.ArrayType(T.StringType())),
        T.StructField("n", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
    ]
)


def summarise(
    rows: DataFrame,
    key: str = "customer_id",
    value: str = "customer_state",
    checked: str = "customer_zip_code_prefix",
    pattern: str = r"^[0-9]+\z",
    nulls: Mapping[str, str] = NULL_COUNTS,
) -> DataFrame:
    """The state of some files: one pass, summed per task before the shuffle."""

    def entry(kind: str, *group: Column) -> Column:
        values = F.array(*group).cast("array<string>")
        return F.struct(F.lit(kind).alias("kind"), values.alias("group"))

    def when(condition: Column, made: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), made)

    entries = F.array(
        entry("load", F.col("_batch_id"), F.col("_load_type"), F.col("_source_system")),
        entry("value", F.col(value)),
        entry("key", F.col("_batch_id"), F.col(key)),
        when(~F.col(checked).rlike(pattern), entry("bad", F.col(checked))),
        *(when(F.col(column).isNull(), entry("null", F.lit(name))) for name, column in nulls.items()),
    )
    made = rows.select(FILE, F.col("_ingestion_date").alias("_date"), F.inline(F.filter(entries, lambda e: e.isNotNull())))
    return made.groupBy(FILE, "kind", "group").agg(
        F.count("*").alias("n"), F.min("_date").alias("first_date"), F.max("_date").alias("last_date")
    )


def _of(state: DataFrame, kind: str, *names: str) -> DataFrame:
    parts = [F.col("group")[i].alias(name) for i, name in enumerate(names)]
    return state.filter(F.col("kind") == kind).select(FILE, *parts, "n", "first_date", "last_date")


def load_profile(state: DataFrame) -> DataFrame:
    loads = _of(state, "load", "batch", "type", "system")
    return loads.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_distinct("batch").alias("total_batches"),
        F.min("first_date").alias("first_ingestion"),
        F.max("last_date").alias("latest_ingestion"),
    )


def null_profile(state: DataFrame, nulls: Mapping[str, str] = NULL_COUNTS) -> DataFrame:
    found = _of(state, "null", "name")
    return found.agg(
        *(F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(name) for name in nulls)
    )


def duplicate_keys(state: DataFrame, key: str = "customer_id", top: int = 20) -> DataFrame:
    counts = _of(state, "key", "_batch_id", key).groupBy("_batch_id", key).agg(F.sum("n").alias("cnt"))
    return (
        counts.filter("cnt > 1").orderBy(F.desc("cnt"), F.asc("_batch_id"), F.asc_nulls_last(key)).limit(top)
    )


def top_values(state: DataFrame, value: str = "customer_state", top: int = 10) -> DataFrame:
    counts = _of(state, "value", value).groupBy(value).agg(F.sum("n").alias("total_customers"))
    total = counts.agg(F.sum("total_customers")).scalar()
    share = F.round(F.col("total_customers") * F.lit(100.0).cast("decimal(4,1)") / total, 2)
    return (
        counts.select(value, "total_customers", share.cast("double").alias("pct"))
        .orderBy(F.desc("total_customers"), F.asc_nulls_last(value))
        .limit(top)
    )


def bad_formats(state: DataFrame, checked: str = "customer_zip_code_prefix", top: int = 20) -> DataFrame:
    counts = _of(state, "bad", checked).groupBy(checked).agg(F.sum("n").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc(checked)).limit(top)


def lineage(state: DataFrame) -> DataFrame:
    loads = _of(state, "load", "_batch_id", "_load_type", "_source_system")
    by = [FILE, "_batch_id", "_load_type", "_source_system"]
    return loads.groupBy(*by).agg(F.sum("n").alias("rows_in_batch")).orderBy(F.desc("_batch_id"), FILE)


def batch_file_counts(state: DataFrame) -> DataFrame:
    by = ["_batch_id", FILE]
    return _of(state, "load", "_batch_id").groupBy(*by).agg(F.sum("n").alias("count")).orderBy(*by)
