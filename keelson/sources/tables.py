"""Stored tables: parquet folders with one safe way to change each.

``FileKeyedTable``  rows replaced by source file (raw and quarantine tables)
``SnapshotTable``   every change publishes a whole new snapshot; readers never see half a change
``BucketedTable``   rows kept in key buckets; a change rewrites only the buckets it touches
``CopartitionedTable``  snapshots in the catalog, bucketed so that a join on the key does not move them

All of them take new columns and wider types of a load: rows written before have NULL there, and
are read as the wider type.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import bucket_of
from keelson.operators.evolve import conform, merged_schema, plain, readable_as
from keelson.operators.layout import clustered

Change = Callable[[DataFrame, DataFrame], DataFrame]


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(list_paths(spark, path))


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(text.encode())
    finally:
        out.close()


def claimed(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this run was the one to write the file; another may have been before it."""
    try:
        write_new(spark, path, text)
    except Py4JJavaError:
        if path_exists(spark, path):
            return False
        raise
    return True


def read_whole(spark: SparkSession, path: str) -> str:
    """Text of a small file, without a job."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    file = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace just the partitions that occur in ``df``."""
    (
        df.write.partitionBy(by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    """Plain append. Columns may differ from earlier appends; see ``read_merged``."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read appends with differing columns as the union of their schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


class SchemaError(ValueError):
    """A change of columns the stored files cannot follow."""


class _Evolving:
    """The schema of a table whose files are written by many loads, kept beside it.

    ``<path>.schema/<n>`` holds the schema as of its n-th change. It is written before the rows
    that need it, which leaves the table as it was if the write then fails: a column no file has reads as
    NULL, and narrower files read as the wider type. A widening the parquet reader cannot do (to text) is
    refused; ``rewrite`` does it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType

    def stored_schema(self) -> T.StructType:
        """The declared columns and those loads brought since."""
        found = list_paths(self.spark, f"{self.path}.schema/*")
        if not found:
            return self.schema
        newest = max(found, key=lambda p: int(p.rsplit("/", 1)[1]))
        text = read_whole(self.spark, newest)
        return merged_schema(self.schema, T.StructType.fromJson(json.loads(text)))

    def _note(self, schema: T.StructType) -> None:
        number = len(list_paths(self.spark, f"{self.path}.schema/*")) + 1
        write_new(self.spark, f"{self.path}.schema/{number:06d}", schema.json())

    def admit(self, rows: T.StructType) -> T.StructType:
        """The schema after taking in rows of this one, noted if it is new."""
        before = self.stored_schema()
        after = merged_schema(before, rows)
        if plain(after) == plain(before):
            return before
        for old, new in zip(before.fields, after.fields):
            if not readable_as(old.dataType, new.dataType) and self.exists():
                raise SchemaError(
                    f"{self.path}: {old.name} is stored as {old.dataType.simpleString()} and would become"
                    f" {new.dataType.simpleString()}; rewrite() the table with that type first"
                )
        self._note(after)
        return after

    def rewrite(self, schema: T.StructType) -> None:
        """All rows written anew as the merged schema. They are staged as a whole table first, so a driver
        that dies leaves either the old table or the staged one complete."""
        schema = merged_schema(self.stored_schema(), schema)
        staged = f"{self.path}.staged"
        kept = self._stored()
        wide = conform(kept, T.StructType([*schema.fields, kept.schema[self.PARTITION]]))
        wide.write.partitionBy(self.PARTITION).mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
        again = self.spark.read.schema(wide.schema).parquet(staged)
        again.write.partitionBy(self.PARTITION).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path)
        self._note(schema)


class FileKeyedTable(_Evolving):
    """Partitioned by a hash of the replace key (the source file's name unless told otherwise),
    so writing a file again replaces its rows. A hash, because any file name is then a valid
    folder name and none is mistaken for a number or a date.

    ``gather`` is for a thin slice of a large input, such as its bad rows: they are shuffled
    into files of a useful size first, and Spark splits a source that has too many of them.
    """

    PARTITION = "_file_key"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        replace_key: str = "_source_file_name",
        gather: bool = False,
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.replace_key, self.gather = replace_key, gather

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.stored_schema().fields, T.StructField(self.PARTITION, T.StringType())])
        if not self.exists():
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(self.PARTITION)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        key = F.concat(F.lit("f"), F.md5(self.replace_key))
        keyed = conform(rows, self.admit(rows.schema)).withColumn(self.PARTITION, key)
        return keyed.hint("rebalance", self.PARTITION) if self.gather else keyed

    def replace(self, rows: DataFrame, names: Sequence[str]) -> None:
        """Replace the rows of the sources ``names`` by ``rows``. A source without rows (a file
        that has only its header) writes no partition, so what it had before is cleared.

        Which sources had rows is observed by the write itself: a set stays right when a task
        is repeated, and it is no larger than ``names``.
        """
        had_rows = Observation()
        keyed = self._keyed(rows).observe(had_rows, F.collect_set(self.PARTITION).alias("keys"))
        replace_partitions(keyed, self.path, self.PARTITION)
        asked = {"f" + hashlib.md5(name.encode()).hexdigest() for name in names}
        for key in sorted(asked - set(had_rows.get["keys"])):
            folder = f"{self.path}/{self.PARTITION}={key}"
            if path_exists(self.spark, folder):
                empty(self.spark, self.stored_schema()).write.mode("overwrite").parquet(folder)

    def overwrite(self, rows: DataFrame) -> None:
        """Replace everything."""
        everything = self._keyed(rows).write.partitionBy(self.PARTITION).mode("overwrite")
        # Whatever the session says, old partitions go too.
        everything.option("partitionOverwriteMode", "static").parquet(self.path)


class ConcurrentChange(RuntimeError):
    """Another run changed the table meanwhile; nothing was published."""


class SnapshotTable:
    """``<path>/snapshot=<n>``. Spark cannot overwrite what it is reading, and a reader must not
    see half a rewrite, so each change writes the next snapshot and readers take the published one.

    ``<path>.commits/<m>`` names the snapshot that is the table after its m-th change, and is written last: a run
    that dies leaves a folder nobody reads. Of two runs that start from the same state the second to finish
    fails, so no change is lost. ``<path>.started/<n>`` reserves a snapshot's number for one run. A table
    without commits (written by other means) is its newest finished snapshot. Old snapshots stay until
    ``vacuum``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        cluster_by: Sequence[str] = (),
        spread_by: Sequence[str] = (),
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.cluster_by, self.spread_by = cluster_by, spread_by

    def _numbers(self, pattern: str) -> list[int]:
        found = list_paths(self.spark, f"{self.path}/{pattern}")
        return sorted(int(re.search(r"/snapshot=(\d+)(/_SUCCESS)?$", p)[1]) for p in found)

    def state(self) -> int:
        """How many changes the table has seen; ``publish`` takes it as what rows were computed from."""
        found = list_paths(self.spark, f"{self.path}.commits/*")
        return max((int(p.rsplit("/", 1)[1]) for p in found), default=0)

    def _newest(self) -> int | None:
        """The published snapshot."""
        for change in range(self.state(), 0, -1):
            name = f"{self.path}.commits/{change:09d}"
            text = read_whole(self.spark, name) if path_exists(self.spark, name) else ""
            if text.endswith("\n"):  # else the run died while it wrote this
                return int(text)
        finished = self._numbers("snapshot=*/_SUCCESS")
        return finished[-1] if finished else None

    def exists(self) -> bool:
        return self._newest() is not None

    def read(self) -> DataFrame:
        newest = self._newest()
        if newest is None:
            return empty(self.spark, self.schema)
        stored = self.spark.read.parquet(f"{self.path}/snapshot={newest}")
        return conform(stored, merged_schema(self.schema, stored.schema))

    def publish(self, rows: DataFrame, since: int | None = None) -> None:
        """Write the next snapshot; columns the table did not have are added to it. ``since`` is the state
        the rows were computed from, where that was read before."""
        since = self.state() if since is None else since
        rows = conform(rows, merged_schema(self.schema, rows.schema))
        if self.cluster_by:
            rows = clustered(rows, self.cluster_by, self.spread_by)
        number = max(self._numbers("snapshot=*"), default=0) + 1
        while not claimed(self.spark, f"{self.path}.started/{number:09d}", ""):
            number += 1
        rows.write.parquet(f"{self.path}/snapshot={number}")
        if not claimed(self.spark, f"{self.path}.commits/{since + 1:09d}", f"{number}\n"):
            raise ConcurrentChange(f"{self.path}: changed by another run")

    def merge(self, source: DataFrame, change: Change, keys: DataFrame | None = None) -> None:
        since = self.state()
        self.publish(change(self.read(), source), since)

    def vacuum(self) -> list[str]:
        """Delete all snapshots but the published one; returns their folders. Not while a change or a reader of
        an older state is at work."""
        newest = self._newest()
        old = [p for p in list_paths(self.spark, f"{self.path}/snapshot=*") if not p.endswith(f"/snapshot={newest}")]
        for folder in old:
            delete_path(self.spark, folder)
        return old


class BucketedTable(_Evolving):
    """Partitioned by key bucket, for a table much larger than one load: a change reads and
    rewrites only the buckets its keys fall into. Within a bucket rows are sorted by
    ``cluster_by``, which costs no shuffle.

    A change writes new versions of its buckets beside the old ones. ``<path>.manifest/<n>`` says which
    version of each bucket the table has, and is written last: a run that dies leaves the table as it was, and
    readers never see half a change. Of two runs that change the table at once the second fails. Old versions
    stay until ``vacuum``. Make ``spark.sql.shuffle.partitions`` a multiple of ``buckets``: then a shuffled
    partition holds one bucket.
    """

    PARTITION = "_key_bucket"
    VERSION = "_version"

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        buckets: int,
        cluster_by: Sequence[str] = (),
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.buckets, self.cluster_by = key, buckets, cluster_by

    def _manifests(self) -> list[int]:
        found = list_paths(self.spark, f"{self.path}.manifest/*")
        return sorted(int(p.rsplit("/", 1)[1]) for p in found)

    def _manifest(self) -> dict | None:
        """The newest manifest that was written to its end."""
        for number in reversed(self._manifests()):
            text = read_whole(self.spark, f"{self.path}.manifest/{number:09d}")
            try:
                return json.loads(text)
            except ValueError:  # the run died while it wrote this one
                continue
        return None

    def _live(self) -> dict[int, str] | None:
        """Version by bucket."""
        manifest = self._manifest()
        return None if manifest is None else {int(b): v for b, v in manifest["buckets"].items()}

    def stored_schema(self) -> T.StructType:
        """A rewrite changes files and types at once, so the manifest has its own schema."""
        manifest = self._manifest()
        noted = super().stored_schema()
        return merged_schema(noted, T.StructType.fromJson(manifest["schema"])) if manifest else noted

    def _commit(self, number: int, live: dict[int, str], schema: T.StructType) -> None:
        text = json.dumps({"schema": schema.jsonValue(), "buckets": live})
        if not claimed(self.spark, f"{self.path}.manifest/{number:09d}", text):
            raise ConcurrentChange(f"{self.path}: changed by another run")

    def exists(self) -> bool:
        return self._live() is not None

    def _stored(self, live: dict[int, str] | None = None) -> DataFrame:
        live = self._live() if live is None else live
        bucket = T.StructField(self.PARTITION, T.IntegerType())
        version = T.StructField(self.VERSION, T.StringType())
        schema = T.StructType([*self.stored_schema().fields, bucket, version])
        if not live:
            return empty(self.spark, schema).drop(self.VERSION)
        folders = [self._folder(b, v) for b, v in sorted(live.items())]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).drop(self.VERSION)

    def _folder(self, bucket: int, version: str) -> str:
        return f"{self.path}/{self.PARTITION}={bucket}/{self.VERSION}={version}"

    def read(self) -> DataFrame:
        return self._stored().drop(self.PARTITION)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets the keys fall into: at most ``buckets`` numbers, from one column."""
        bucket = bucket_of(self.key, self.buckets).alias("b")
        return [row.b for row in keys.select(bucket).distinct().collect()]

    def merge(self, source: DataFrame, change: Change, keys: DataFrame | None = None) -> None:
        """``keys`` may be any cheaper frame that holds at least the keys of the source, such as
        the rows the source is computed from. A bucket that has no rows left is dropped."""
        number = max(self._manifests(), default=0) + 1
        live = self._live()
        stored = self._stored(live or {})
        replaced = set()
        if live is not None:
            touched = self.touched(source if keys is None else keys)
            replaced = set(touched)
            stored = stored.filter(F.col(self.PARTITION).isin(touched))
        result = change(stored.drop(self.PARTITION), source)
        result = conform(result, self.admit(result.schema))
        result = result.withColumn(self.PARTITION, bucket_of(self.key, self.buckets))
        self._publish(number, live or {}, replaced, result.sortWithinPartitions(self.PARTITION, *self.cluster_by))

    def _publish(self, number: int, live: dict[int, str], replaced: set[int], rows: DataFrame) -> None:
        """Write new versions and say that they replace the old ones of these buckets."""
        version = f"v{uuid.uuid4().hex}"
        new = rows.withColumn(self.VERSION, F.lit(version))
        new.write.partitionBy(self.PARTITION, self.VERSION).mode("append").parquet(self.path)
        written = list_paths(self.spark, self._folder("*", version))
        kept = {b: v for b, v in live.items() if b not in replaced}
        made = {int(re.search(rf"/{self.PARTITION}=(\d+)/", p)[1]): version for p in written}
        if set(kept) & set(made):
            raise ValueError(f"{self.path}: the change made rows in buckets its keys are not in")
        schema = T.StructType([f for f in rows.schema.fields if f.name != self.PARTITION])
        self._commit(number, kept | made, schema)

    def rewrite(self, schema: T.StructType) -> None:
        number = max(self._manifests(), default=0) + 1
        live = self._live() or {}
        schema = merged_schema(self.stored_schema(), schema)
        kept = self._stored(live)
        wide = conform(kept, T.StructType([*schema.fields, kept.schema[self.PARTITION]]))
        self._publish(number, live, set(live), wide.sortWithinPartitions(self.PARTITION, *self.cluster_by))

    def vacuum(self) -> list[str]:
        """Delete the versions the table no longer has; returns their folders. Not while a change or a
        reader of an older state is at work."""
        live = {self._folder(b, v) for b, v in (self._live() or {}).items()}
        versions = list_paths(self.spark, f"{self.path}/{self.PARTITION}=*/{self.VERSION}=*")
        mine = {"/".join(folder.rsplit("/", 2)[1:]) for folder in live}
        old = [p for p in versions if "/".join(p.rsplit("/", 2)[1:]) not in mine]
        for folder in old:
            delete_path(self.spark, folder)
        return old


class CopartitionedTable:
    """Snapshots ``<name>_<n>`` in the catalog, in ``buckets`` buckets by the hash Spark shuffles on and
    sorted by key. A join on the key leaves the table where it is: only the load is shuffled, into as many
    partitions as there are buckets. The table must hold a key once or so; a bucket is one task's work, so
    give it as many buckets as a shuffle of the table would have.

    ``<name>`` is a view of the newest snapshot. Creating a snapshot and turning the view are separate steps;
    a run that dies between them leaves the view as it was.
    """

    def __init__(
        self, spark: SparkSession, name: str, schema: T.StructType, key: str, buckets: int, location: str
    ):
        self.spark, self.name, self.schema = spark, name, schema
        self.key, self.buckets, self.location = key, buckets, location

    def exists(self) -> bool:
        return self._newest() is not None

    def _numbers(self) -> list[int]:
        found = (re.search(r"/snapshot=(\d+)$", p) for p in list_paths(self.spark, f"{self.location}/snapshot=*"))
        return sorted(int(m[1]) for m in found if m)

    def _newest(self) -> int | None:
        names = {t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}_*")}
        whole = [n for n in self._numbers() if f"{self.name}_{n}" in names and path_exists(self.spark, f"{self.location}/snapshot={n}/_SUCCESS")]
        return whole[-1] if whole else None

    def read(self) -> DataFrame:
        newest = self._newest()
        if newest is None:
            return empty(self.spark, self.schema)
        return self.spark.table(f"{self.name}_{newest}")

    def publish(self, rows: DataFrame) -> None:
        number = max(self._numbers(), default=0) + 1
        rows = conform(rows, merged_schema(self.schema, rows.schema))
        if self.exists():
            # The rows come out of a join on the key in as many partitions as there are buckets.
            dealt = rows
        else:
            dealt = rows.repartition(self.buckets, self.key)
        (
            dealt.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
            .option("path", f"{self.location}/snapshot={number}").saveAsTable(f"{self.name}_{number}")
        )
        self.spark.table(f"{self.name}_{number}").createOrReplaceTempView(self.name)

    def merge(self, source: DataFrame, change: Change, keys: DataFrame | None = None) -> None:
        """The load is dealt out by the table's buckets, so a full outer join finds both sides in place."""
        self.publish(change(self.read(), source.repartition(self.buckets, self.key)))
