"""Numbered states of a table with the digests that tell which parts of two of them differ.

``<path>/rows/state=<n>`` holds a state's rows by bucket, each file in order of leaves; ``<path>/leaves/state=<n>``
its digests, one row per leaf, written last: a state without them is unfinished and not read. Its schema is in
``<path>/schema/state=<n>``, as a state without rows has no file that tells it. States are never changed, so a run that dies leaves a folder nobody reads.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import changes as diff
from keelson.operators.evolve import merged_schema
from keelson.sources.tables import empty, list_paths


class StateLog:
    """States of rows known by ``key``. ``buckets`` times ``leaves`` bounds what the driver holds of a
    comparison (numbers of unequal leaves); both are fixed for the log. ``compared`` are the columns that count
    as content beside the key, all of them unless given."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: Sequence[str],
        buckets: int = 64,
        leaves: int = 64,
        compared: Sequence[str] | None = None,
    ):
        self.spark, self.path, self.key = spark, path, list(key)
        self.buckets, self.leaves, self.compared = buckets, leaves, compared

    def _numbers(self, pattern: str) -> list[int]:
        found = list_paths(self.spark, f"{self.path}/{pattern}")
        return sorted(int(re.search(r"/state=(\d+)(/_SUCCESS)?$", p)[1]) for p in found)

    def states(self) -> list[int]:
        """Numbers of the finished states."""
        return self._numbers("leaves/state=*/_SUCCESS")

    def publish(self, rows: DataFrame) -> int:
        """Write the next state; returns its number. Spark splits a bucket that is too large for a task."""
        taken = {diff.BUCKET, diff.LEAF, diff.CHANGE, diff.COPIES} & set(rows.columns)
        if taken:
            raise ValueError(f"reserved columns: {sorted(taken)}")
        number = max(self._numbers("rows/state=*"), default=0) + 1
        dealt = diff.placed(rows, self.key, self.buckets, self.leaves).hint("rebalance", diff.BUCKET)
        text = self.spark.createDataFrame([(dealt.schema.json(),)], "value string")
        text.coalesce(1).write.text(f"{self.path}/schema/state={number}")
        path = f"{self.path}/rows/state={number}"
        dealt.sortWithinPartitions(diff.BUCKET, diff.LEAF).write.partitionBy(diff.BUCKET).parquet(path)
        stored = self.spark.read.schema(dealt.schema).parquet(path)
        counted = [c for c in rows.columns if self.compared is None or c in self.compared or c in self.key]
        leaves = diff.leaf_digests(stored, counted)
        leaves.write.parquet(f"{self.path}/leaves/state={number}")
        return number

    def _rows(self, number: int) -> DataFrame:
        text = self.spark.read.text(f"{self.path}/schema/state={number}", wholetext=True).first()[0]
        schema = T.StructType.fromJson(json.loads(text))
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows/state={number}")

    def _leaves(self, number: int) -> DataFrame:
        if number not in self.states():
            raise ValueError(f"{self.path}: no finished state {number}")
        return self.spark.read.parquet(f"{self.path}/leaves/state={number}")

    def read(self, number: int) -> DataFrame:
        self._leaves(number)
        return self._rows(number).drop(diff.BUCKET, diff.LEAF)

    def unequal(self, before: int, after: int) -> list[tuple[int, int]]:
        """(bucket, leaf) of the leaves in which the states differ."""
        found = diff.unequal_leaves(self._leaves(before), self._leaves(after))
        return sorted((row[0], row[1]) for row in found.collect())

    def parts(self, number: int, places: Sequence[tuple[int, int]]) -> DataFrame:
        """A state's rows in some leaves. Buckets are skipped as folders, leaves by the statistics of files."""
        buckets, leaves = sorted({b for b, _ in places}), sorted({l for _, l in places})
        place = F.col(diff.BUCKET) * self.leaves + F.col(diff.LEAF)
        rows = self._rows(number).filter(F.col(diff.BUCKET).isin(buckets) & F.col(diff.LEAF).isin(leaves))
        rows = rows.filter(place.isin([b * self.leaves + l for b, l in places]))
        return rows.drop(diff.BUCKET, diff.LEAF)

    def changes(self, before: int, after: int) -> DataFrame:
        """The feed of changes that leads from one state to the other, see ``operators.changes``."""
        places = self.unequal(before, after)
        if not places:
            columns = merged_schema(self.read(before).schema, self.read(after).schema)
            rows = empty(self.spark, columns)
            return rows.select(F.lit("").alias(diff.CHANGE), "*", F.lit(0).cast("long").alias(diff.COPIES))
        return diff.changes(self.parts(before, places), self.parts(after, places), self.key, self.compared)
