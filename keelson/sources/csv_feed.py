"""CSV scan with audit columns."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from datetime import timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import file_path
from keelson.operators.evolve import union_evolving
from keelson.sources.contract import ContractError, checked_headers
from keelson.spec import Contract, Run


def _scan(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], contract: Contract
) -> DataFrame:
    """All text, contract columns by name and then, if the contract keeps them, the others. Spark checks the header of every file against the
    schema while it reads (``enforceSchema=false``), so a part file with other columns fails
    the read instead of being shifted."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw_name = {name.strip(): name for name in header}
    rows = (
        spark.read.schema(schema)
        .options(**contract.csv_options(), enforceSchema="false")
        .csv(list(paths))
    )
    extra = [name for name in raw_name if contract.keep_extra and name and name not in contract.columns]
    return rows.select(
        *(F.col(f"`{raw_name[name]}`").alias(name) for name in [*contract.columns, *extra]),
        F.col("_metadata.file_path").alias("_encoded_path"),
    )


#: Raw text of a row that does not have the header's columns, or ends inside a quote; else NULL.
RESCUED = "_rescued_row"


def _rescuing_scan(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], contract: Contract
) -> DataFrame:
    """Like ``_scan``, but every line is looked at as delivered: one that is short, long or ends inside a
    quote keeps its whole text in ``_rescued_row``, and its columns are NULL, so none is cut or padded. Blank
    lines are skipped, as the CSV reader does; so are lines that repeat the header. A part file whose first line
    is another header fails the read, in one job for all files."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, "_corrupt"]])
    options = {k: v for k, v in contract.csv_options().items() if k != "header"}
    parsed = F.from_csv("value", _ddl(schema), {**options, "columnNameOfCorruptRecord": "_corrupt"})
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("_encoded_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"), parsed.alias("_row"),
    )
    values = F.array(*(F.col("_row")[name] for name in header))
    names = F.array(*(F.lit(name) for name in header))
    is_header = F.col("_row._corrupt").isNull() & F.coalesce(F.transform(values, lambda v: F.trim(v)) == F.transform(names, lambda v: F.trim(v)), F.lit(False))
    first = lines.filter("_start = 0").groupBy("_encoded_path").agg(F.min_by(is_header, "_place").alias("same"))
    odd = [r[0] for r in first.filter("not same").select("_encoded_path").limit(5).collect()]
    if odd:
        raise ContractError(f"{odd[0]}: its header is not the one of its drop")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(contract.quote), F.lit("")))
    broken = F.col("_row._corrupt").isNotNull() | (quotes % 2 == 1)
    raw_name = {name.strip(): name for name in header}
    extra = [name for name in raw_name if contract.keep_extra and name and name not in contract.columns]
    rows = lines.filter((F.trim("value") != "") & ~is_header)
    return rows.select(
        *(F.when(~broken, F.col("_row")[raw_name[name]]).alias(name) for name in [*contract.columns, *extra]),
        F.when(broken, F.col("value")).alias(RESCUED),
        "_encoded_path",
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


# Which part of the path names the source: the file, or its folder of part files.
SOURCE_PART = {"file": -1, "folder": -2}


def source_name(path: Column, name_from: str) -> Column:
    return F.try_element_at(F.split(file_path(path), "/"), F.lit(SOURCE_PART[name_from]))


def stamped(rows: DataFrame, run: Run, name_from: str = "file") -> DataFrame:
    """The eight audit columns."""
    path = F.col("_encoded_path")
    return rows.select(
        *(F.col(name) for name in rows.columns if name != "_encoded_path"),
        F.lit(run.run_id).alias("_pipeline_run_id"),
        F.lit(run.batch_id).alias("_batch_id"),
        F.lit(run.source_system).alias("_source_system"),
        F.lit(run.load_type).alias("_load_type"),
        F.lit(run.as_of).alias("_created_at"),
        F.lit(run.as_of.astimezone(timezone.utc).date()).alias("_ingestion_date"),
        file_path(path).alias("_source_file_path"),
        source_name(path, name_from).alias("_source_file_name"),
    )


def read_drops(
    spark: SparkSession,
    paths: Sequence[str],
    contract: Contract,
    run: Run,
    name_from: str = "file",
    headers: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows of all drops with audit columns, after checking every drop. Drops with the same
    header are read by one scan, so column order may differ between drops; an extra column that some
    drops lack is NULL there. ``headers`` are those of the paths where they are known and checked."""
    by_header = defaultdict(list)
    if headers is None:
        headers = checked_headers(spark, paths, contract)
    for path, header in headers.items():
        by_header[header].append(path)
    scan = _rescuing_scan if contract.rescue else _scan
    scans = [scan(spark, group, header, contract) for header, group in by_header.items()]
    return stamped(reduce(union_evolving, scans) if contract.keep_extra else reduce(DataFrame.unionByName, scans), run, name_from)
