"""Contract of a CSV drop: not empty, right delimiter, every expected column present."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import file_path
from keelson.spec import Contract


class ContractError(ValueError):
    """A drop that must not be ingested."""


def read_header(spark: SparkSession, path: str, contract: Contract) -> list[str]:
    """Column names of a drop (a file or a folder of part files). Spark reads one line for it,
    the same line it needs to name the columns of a CSV read."""
    return spark.read.options(**contract.csv_options()).csv(path).columns


def check_header(path: str, header: Sequence[str], contract: Contract) -> None:
    """Order and extra columns do not matter; names are compared trimmed and case-sensitive."""
    if not header:
        raise ContractError(f"{path}: empty")
    if len(header) == 1:
        raise ContractError(f"{path}: no delimiter {contract.delimiter!r} in the header")
    names = {name.strip() for name in header}
    missing = [name for name in contract.columns if name not in names]
    if missing:
        raise ContractError(f"{path}: missing columns {missing}")


def checked_headers(
    spark: SparkSession, paths: Sequence[str], contract: Contract
) -> dict[str, tuple[str, ...]]:
    """Header of every drop, or ``ContractError`` for the first bad one. Each takes a job of
    one line, so several run at a time."""
    if not paths:
        raise ContractError("no drops given")
    with ThreadPool(min(8, len(paths))) as pool:
        headers = pool.map(lambda path: tuple(read_header(spark, path, contract)), paths)
    for path, header in zip(paths, headers):
        check_header(path, header, contract)
    return dict(zip(paths, headers))


def feed_report(spark: SparkSession, paths: Sequence[str], contract: Contract) -> DataFrame:
    """One row per file with what is right and wrong about its header; fails on nothing.

    For inspecting a delivery of many files in one distributed pass: the first line of each is
    found next to its data. Files of length zero have no rows, so they are added from the file
    listing Spark made for the read.
    """
    lines = spark.read.text(list(paths))
    listed = spark.createDataFrame([(p,) for p in lines.inputFiles()], "listed string")
    names = listed.select(file_path(F.col("listed")).alias("file_path"))
    first_lines = (
        lines.select(
            "value",
            file_path(F.col("_metadata.file_path")).alias("file_path"),
            "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("position"),
        )
        .filter("file_block_start = 0")
        .groupBy("file_path")
        .agg(F.min_by("value", "position").alias("header"))
    )
    unquoted = F.replace(F.col("header"), F.lit(contract.quote), F.lit(""))
    columns = F.transform(F.split(unquoted, f"\\Q{contract.delimiter}\\E"), lambda c: F.trim(c))
    expected = F.array(*(F.lit(name) for name in contract.columns))
    delimited = F.contains("header", F.lit(contract.delimiter))
    return (
        names.join(first_lines, "file_path", "left")
        .select(
            "file_path",
            F.col("header").isNull().alias("is_empty"),
            F.coalesce(delimited, F.lit(False)).alias("has_delimiter"),
            F.concat_ws(",", F.coalesce(F.array_except(expected, columns), expected)).alias(
                "missing_columns"
            ),
            F.concat_ws(",", F.array_except(columns, expected)).alias("extra_columns"),
        )
        .withColumn(
            "is_valid",
            ~F.col("is_empty") & F.col("has_delimiter") & (F.col("missing_columns") == ""),
        )
    )
