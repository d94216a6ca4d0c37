"""Counters of a run, as one-row DataFrames computed in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import all_pass
from keelson.spec import TableSpec


def run_metrics(prepared: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows read, kept, quarantined, and dropped as duplicates. Counted from the rows rather
    than by accumulators, which count twice when a lost executor's tasks are repeated."""
    passed = all_pass(spec.rules)
    counted = prepared.agg(
        F.count("*").alias("total_read"),
        F.count_distinct(F.when(passed, F.col(spec.key))).alias("valid_records"),
        F.count_if(~passed).alias("quarantined_records"),
    )
    dropped = F.col("total_read") - F.col("valid_records") - F.col("quarantined_records")
    return counted.withColumn("duplicates_dropped", dropped)


def run_row_count(df: DataFrame, run_id: str) -> DataFrame:
    """Rows one run wrote."""
    return df.filter(F.col("_pipeline_run_id") == run_id).agg(F.count("*").alias("inserted_rows"))


def dimension_counts(dimension: DataFrame) -> DataFrame:
    return dimension.agg(
        F.count("*").alias("total_records"),
        F.count_if("IsCurrent").alias("active_records"),
        F.count_if(~F.col("IsCurrent")).alias("history_records"),
    )
