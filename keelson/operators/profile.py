"""Validation reports over a loaded table, and row counts by group.

Every report aggregates per task before it shuffles, so hot values cost one row per task, and
every top-k keeps k rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.spec import NULL_COUNTS


def count_by(df: DataFrame, columns: Sequence[str], count_name: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(count_name))


def load_profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("_batch_id").alias("total_batches"),
        F.min("_ingestion_date").alias("first_ingestion"),
        F.max("_ingestion_date").alias("latest_ingestion"),
    )


def null_profile(df: DataFrame, counts: Mapping[str, str] = NULL_COUNTS) -> DataFrame:
    """NULLs per column; ``counts`` maps the name of each count to its column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(name) for name, c in counts.items()))


def duplicate_keys(df: DataFrame, key: str = "customer_id", top: int = 20) -> DataFrame:
    """Keys that occur more than once in one batch, most frequent first."""
    return (
        count_by(df, ["_batch_id", key], "cnt")
        .filter("cnt > 1")
        .orderBy(F.desc("cnt"), F.asc("_batch_id"), F.asc_nulls_last(key))
        .limit(top)
    )


def top_values(df: DataFrame, column: str = "customer_state", top: int = 10) -> DataFrame:
    """Most frequent values with their share of all rows in percent. The total is a scalar
    subquery over the counts, so the rows are read once; a window over all groups would put
    them into one task."""
    counts = count_by(df, [column], "total_customers")
    total = counts.agg(F.sum("total_customers")).scalar()
    share = F.round(F.col("total_customers") * F.lit(100.0).cast("decimal(4,1)") / total, 2)
    return (
        counts.select(column, "total_customers", share.cast("double").alias("pct"))
        .orderBy(F.desc("total_customers"), F.asc_nulls_last(column))
        .limit(top)
    )


def lineage(df: DataFrame) -> DataFrame:
    by = ["_source_file_name", "_batch_id", "_load_type", "_source_system"]
    return count_by(df, by, "rows_in_batch").orderBy(F.desc("_batch_id"), "_source_file_name")


def bad_formats(
    df: DataFrame,
    column: str = "customer_zip_code_prefix",
    pattern: str = r"^[0-9]+\z",
    top: int = 20,
) -> DataFrame:
    """Most frequent values that do not match; NULLs are counted by ``null_profile``."""
    return (
        count_by(df.filter(~F.col(column).rlike(pattern)), [column], "cnt")
        .orderBy(F.desc("cnt"), F.asc(column))
        .limit(top)
    )


def newest_rows(
    df: DataFrame, order_by: str = "_created_at", top: int = 10, tie_break: Sequence[str] = ()
) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in [order_by, *tie_break]]
    return df.orderBy(*order).limit(top)


def batch_file_counts(df: DataFrame) -> DataFrame:
    by = ["_batch_id", "_source_file_name"]
    return count_by(df, by, "count").orderBy(*by)


def region_state_counts(df: DataFrame) -> DataFrame:
    by = ["customer_region", "customer_state"]
    return count_by(df, by, "count").orderBy(
        F.asc("customer_region"), F.desc("count"), F.asc("customer_state")
    )


def version_counts(dimension: DataFrame) -> DataFrame:
    by = ["Version", "IsCurrent"]
    return count_by(dimension, by, "count").orderBy(*by)


VALIDATIONS = {
    "load_profile": load_profile,
    "null_profile": null_profile,
    "duplicate_keys": duplicate_keys,
    "top_values": top_values,
    "lineage": lineage,
    "bad_formats": bad_formats,
    "newest_rows": newest_rows,
}


def validation_report(df: DataFrame) -> dict[str, DataFrame]:
    """The seven validation reports of a raw table, by name."""
    return {name: report(df) for name, report in VALIDATIONS.items()}
