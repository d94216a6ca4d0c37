"""What has been ingested, so that a delivery is read only where it is new.

The ledger has one row per source (what the raw table replaces by: a file, or a folder of part files) with
what the file listing said of it and what its lines were. A delivery is compared in two steps:

``listed``     sizes and times of all its files, no file opened; sources listed as the ledger has them are skipped
``inspected``  one scan of the others: first line, rows and digest per source; sources that were only copied
               or touched are noted and not ingested again

Both are sums, so a source may have any number of files and a file any number of lines. The digest does not
know the order of lines, as a table does not know that of its rows; the first line is kept apart.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import file_path, set_digest
from keelson.sources.contract import check_header, read_header
from keelson.spec import Contract, Run

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("listing", T.StringType()),
        T.StructField("first_line", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# What of the path is read as one drop, and what of it names the source.
_PARENT = "/[^/]*$"


def literal(path: str) -> str:
    """The path with the characters of glob patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _drop(path: Column, name_from: str) -> Column:
    return path if name_from == "file" else F.regexp_replace(path, _PARENT, "")


def _source(path: Column, name_from: str, replace_key: str) -> Column:
    if replace_key == "_source_file_path":
        return path
    return F.regexp_extract(_drop(path, name_from), "[^/]*$", 0)


def listed(
    spark: SparkSession, paths: Sequence[str], name_from: str = "file", replace_key: str = "_source_file_name"
) -> DataFrame:
    """``source, drops, files, length, listing`` of all files at and below the paths. Only what the
    file system says of them is asked for: the content column is not read. Files of length zero give no
    row, so all names come from the listing Spark made for the read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    names = spark.createDataFrame([(p,) for p in found.inputFiles()], "listed string")
    named = names.select(file_path(F.col("listed")).alias("path"))
    found = named.join(found.select("path", "modificationTime", "length"), "path", "left")
    found = found.fillna(0, ["length"])
    path = F.col("path")
    return (
        found.select(
            _source(path, name_from, replace_key).alias("source"),
            _drop(path, name_from).alias("drop"),
            "length",
            F.struct("path", "length", "modificationTime").alias("entry"),
        )
        .groupBy("source")
        .agg(
            F.collect_set("drop").alias("drops"),
            F.count("*").alias("files"),
            F.sum("length").alias("length"),
            set_digest(F.to_json("entry")).alias("listing"),
        )
    )


def inspected(
    spark: SparkSession, drops: Sequence[str], name_from: str = "file", replace_key: str = "_source_file_name"
) -> DataFrame:
    """``source, first_path, first_line, rows, digest``: one scan of the drops, summed per task. Blank
    lines count for nothing, as in the CSV reader. Sources whose files are all empty have no row."""
    lines = spark.read.option("recursiveFileLookup", "true").text([literal(d) for d in drops])
    path = file_path(F.col("_metadata.file_path"))
    placed = lines.select(
        "value",
        path.alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    ).filter(F.trim("value") != "")
    # The lines of a file's first block are in one task, in order.
    place = F.when(F.col("start") == 0, F.col("place"))
    by_file = placed.groupBy("path").agg(
        F.min_by("value", place).alias("first_line"),
        F.count("*").alias("lines"),
        *(s.alias(n) for n, s in set_digest.sums(F.col("value")).items()),
    )
    by_source = by_file.groupBy(_source(F.col("path"), name_from, replace_key).alias("source"))
    return by_source.agg(
        F.min("path").alias("first_path"),
        F.min_by("first_line", "path").alias("first_line"),
        (F.sum("lines") - F.count("*")).alias("rows"),
        set_digest.text({n: F.sum(n) for n in set_digest.NAMES}).alias("digest"),
    )


def compared(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listing with ``state``: ``new``, ``unchanged`` (listed alike) or ``touched``."""
    known = ledger.select("source", F.col("listing").alias("known_listing"))
    state = (
        F.when(F.col("known_listing").isNull(), "new")
        .when(F.col("known_listing") == F.col("listing"), "unchanged")
        .otherwise("touched")
    )
    return listing.join(known, "source", "left").select(*listing.columns, state.alias("state"))


def entries(listing: DataFrame, content: DataFrame, ledger: DataFrame, run: Run) -> DataFrame:
    """Ledger rows of the sources listed, with ``state`` narrowed by content: a ``touched`` source is
    ``same`` or ``changed``. One with the content it had keeps its batch and time."""
    known = ledger.select(
        "source",
        *(F.col(c).alias(f"known_{c}") for c in ("first_line", "rows", "digest", "batch_id", "ingested_at")),
    )
    same = (F.col("state") == "touched") & (
        F.struct("first_line", "rows", "digest").eqNullSafe(
            F.struct(*(F.col(f"known_{c}").alias(c) for c in ("first_line", "rows", "digest")))
        )
    )
    state = F.when(same, "same").when(F.col("state") == "touched", "changed").otherwise(F.col("state"))
    made = listing.join(content, "source", "left").join(known, "source", "left").withColumn("state", state)
    is_same = F.col("state") == "same"
    return made.select(
        "source", "files", "length", "listing", "first_line", "rows", "digest",
        F.when(is_same, F.col("known_batch_id")).otherwise(F.lit(run.batch_id)).alias("batch_id"),
        F.when(is_same, F.col("known_ingested_at")).otherwise(F.lit(run.as_of)).alias("ingested_at"),
        "state", "drops", "first_path",
    )


def headers_of(spark: SparkSession, found: DataFrame, contract: Contract) -> dict[str, tuple[str, ...]]:
    """Header by drop, or ``ContractError`` for the first bad one. Sources are grouped by the text of
    their first line, and Spark names the columns of one file for each such text."""
    rows = found.select("source", "drops", "first_path", "first_line").orderBy("source").collect()
    parsed: dict[str | None, tuple[str, ...]] = {None: ()}
    headers = {}
    for row in rows:
        if row.first_line not in parsed:
            parsed[row.first_line] = tuple(read_header(spark, literal(row.first_path), contract))
        check_header(row.source, parsed[row.first_line], contract)
        headers |= {literal(drop): parsed[row.first_line] for drop in row.drops}
    return headers
