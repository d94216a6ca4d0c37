"""Standardise, classify, and split rows into valid and quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions import all_pass, code_label, failed_rules, record_hash
from keelson.spec import Run, TableSpec

RAW = "_raw"


def standardise(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumns({name: F.expr(rule) for name, rule in spec.standardise.items()})


def add_region(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Reads the standardised code, so it comes after ``standardise``."""
    return df.withColumn(spec.code_map.target, code_label(spec.code_map))


def add_record_hash(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(spec.hash_column, record_hash(spec.tracked, spec.null_safe_hash))


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All row-local work: one projection, no shuffle. The raw values of the columns that are
    standardised in place travel along in a struct; a branch that drops it never reads it twice."""
    raw = F.struct(*spec.standardise).alias(RAW)
    return add_record_hash(add_region(standardise(df.select("*", raw), spec), spec), spec)


def valid_rows(prepared: DataFrame, spec: TableSpec, run: Run) -> DataFrame:
    return (
        prepared.filter(all_pass(spec.rules))
        .drop(RAW)
        .withColumn(spec.updated_at, F.lit(run.as_of))
    )


def quarantined_rows(
    prepared: DataFrame, spec: TableSpec, run: Run, reason: str | None = None
) -> DataFrame:
    """The complement of ``valid_rows`` with raw values restored. ``reason`` replaces the list
    of broken rule ids by one fixed text."""
    why = F.lit(reason) if reason is not None else F.col("_dq_error_reason")
    return (
        prepared.withColumn("_dq_error_reason", failed_rules(spec.rules))
        .filter(~all_pass(spec.rules))
        .withColumns({name: F.col(f"{RAW}.{name}") for name in spec.standardise})
        .withColumns(
            {
                "_dq_error_reason": why,
                "_quarantine_ts": F.lit(run.as_of),
                "_quarantine_run_id": F.lit(run.run_id),
            }
        )
        .drop(RAW, spec.code_map.target, spec.hash_column)
    )
