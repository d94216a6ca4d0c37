import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.layout import clustered
from keelson.operators.upsert import upsert
from keelson.session import scratch_dir
from keelson.sources.tables import (
    BucketedTable,
    ConcurrentChange,
    FileKeyedTable,
    SnapshotTable,
    append,
    read_merged,
)

SCHEMA = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("h", T.StringType()), T.StructField("v", T.LongType())]
)


def merged(target, source):
    return upsert(target, source, "k", "h")


def frame(spark, numbers, h):
    return numbers.select(
        F.col("id").cast("string").alias("k"), F.lit(h).alias("h"), F.col("id").alias("v")
    )


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    assert not table.exists() and table.read().count() == 0
    table.merge(frame(spark, spark.range(5), "a"), merged)
    before = table.read()
    table.merge(frame(spark, spark.range(3, 8), "b"), merged)
    assert table.read().count() == 8
    assert table.read().filter("h = 'b'").count() == 5
    assert before.count() == 5


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    table.publish(frame(spark, spark.range(5), "a"))
    os.makedirs(tmp_path / "t" / "snapshot=2")
    assert table.read().count() == 5
    table.publish(frame(spark, spark.range(6), "a"))
    assert table.read().count() == 6
    assert (tmp_path / "t" / "snapshot=3" / "_SUCCESS").exists()


def test_failed_change_leaves_the_table_as_it_was(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    table.publish(frame(spark, spark.range(5), "a"))
    source = frame(spark, spark.range(2), "b")
    with pytest.raises(Exception, match="repeats"):
        table.merge(source.union(source), merged)
    assert table.read().filter("h = 'a'").count() == 5


def test_more_than_ten_snapshots_are_ordered_by_number(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    for n in range(1, 12):
        table.publish(frame(spark, spark.range(n), "a"))
    assert table.read().count() == 11


def test_the_second_of_two_snapshots_from_one_state_fails(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    table.merge(frame(spark, spark.range(10), "a"), merged)

    def meanwhile(target, source):
        SnapshotTable(spark, table.path, SCHEMA).merge(frame(spark, spark.range(5), "b"), merged)
        return merged(target, source)

    with pytest.raises(ConcurrentChange, match="another run"):
        table.merge(frame(spark, spark.range(10), "c"), meanwhile)
    assert sorted(r.h for r in table.read().collect()) == ["a"] * 5 + ["b"] * 5
    table.merge(frame(spark, spark.range(10), "c"), merged)
    assert {r.h for r in table.read().collect()} == {"c"}


def test_a_late_finisher_does_not_hide_the_published_snapshot(spark, tmp_path):
    """A run that took its number first and finished last, and one that died while it said so."""
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    since = table.state()
    other = SnapshotTable(spark, table.path, SCHEMA)
    (tmp_path / "t.started").mkdir()
    (tmp_path / "t.started" / "000000001").write_text("")
    other.publish(frame(spark, spark.range(5), "b"))
    assert (tmp_path / "t" / "snapshot=2" / "_SUCCESS").exists()
    frame(spark, spark.range(9), "late").write.parquet(str(tmp_path / "t" / "snapshot=3"))
    with pytest.raises(ConcurrentChange):
        table.publish(frame(spark, spark.range(9), "late"), since)
    (tmp_path / "t.commits" / "000000002").write_text("3")
    assert {r.h for r in table.read().collect()} == {"b"}
    table.merge(frame(spark, spark.range(5), "c"), merged)
    assert {r.h for r in table.read().collect()} == {"c"} and table.state() == 3


def test_snapshots_of_a_table_without_commits_and_old_ones(spark, tmp_path):
    frame(spark, spark.range(5), "a").write.parquet(str(tmp_path / "t" / "snapshot=1"))
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    assert table.exists() and table.vacuum() == []
    table.merge(frame(spark, spark.range(3), "b"), merged)
    assert [p.rsplit("/", 1)[1] for p in table.vacuum()] == ["snapshot=1"]
    assert table.read().filter("h = 'b'").count() == 3 and table.read().count() == 5


def test_bucketed_table_rewrites_only_touched_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 16, ("v",))
    table.merge(frame(spark, spark.range(1000), "a"), merged)
    files = {b: set(os.listdir(b)) for b in glob.glob(str(tmp_path / "t" / "_key_bucket=*"))}
    assert len(files) == 16
    source = frame(spark, spark.range(7, 9), "b").union(frame(spark, spark.range(2000, 2001), "b"))
    touched = table.touched(source)
    table.merge(source, merged)
    after = {b: set(os.listdir(b)) for b in files}
    changed = {int(b.split("=")[-1]) for b in files if after[b] != files[b]}
    assert changed == set(touched) and 0 < len(changed) <= 3
    assert table.read().count() == 1001
    assert sorted(r.v for r in table.read().filter("h = 'b'").collect()) == [7, 8, 2000]


def test_bucketed_scan_prunes_partitions(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    table.merge(frame(spark, spark.range(100), "a"), merged)
    plan = table._stored().filter("_key_bucket in (1)")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(_key_bucket" in plan.toString()


def test_a_run_that_dies_leaves_all_buckets(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    table.merge(frame(spark, spark.range(100), "a"), merged)
    with monkeypatch.context() as broken:
        broken.setattr(BucketedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.merge(frame(spark, spark.range(50), "b"), merged)
    assert table.read().count() == 100 and table.read().filter("h = 'b'").count() == 0
    # Died while the manifest was written.
    (tmp_path / "t.manifest" / "000000002").write_text('{"schema": {')
    (tmp_path / "t.manifest" / "000000003").write_text("")
    assert table.read().count() == 100
    table.merge(frame(spark, spark.range(50), "b"), merged)
    assert table.read().count() == 100 and table.read().filter("h = 'b'").count() == 50


def test_the_second_of_two_changes_at_once_fails(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 2)
    table.merge(frame(spark, spark.range(10), "a"), merged)

    def meanwhile(target, source):
        BucketedTable(spark, table.path, SCHEMA, "k", 2).merge(frame(spark, spark.range(10), "b"), merged)
        return merged(target, source)

    with pytest.raises(ConcurrentChange, match="another run"):
        table.merge(frame(spark, spark.range(10), "c"), meanwhile)
    assert {r.h for r in table.read().collect()} == {"b"}


def test_emptied_buckets_and_old_versions_go(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    table.merge(frame(spark, spark.range(100), "a"), merged)
    before = table.read()
    gone = frame(spark, spark.range(100), "a")
    table.merge(gone.filter("v < 60"), lambda old, new: old.join(new, "k", "left_anti").select("k", "h", "v"))
    assert sorted(r.v for r in table.read().collect()) == list(range(60, 100))
    assert before.count() == 100
    assert len(table.vacuum()) == 4 and table.vacuum() == []
    assert table.read().count() == 40
    table.merge(gone, lambda old, new: old.join(new, "k", "left_anti").select("k", "h", "v"))
    assert table.exists() and table.read().count() == 0
    table.merge(gone, merged)
    assert table.read().count() == 100


def test_rows_outside_the_touched_buckets_are_refused(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), SCHEMA, "k", 16)
    table.merge(frame(spark, spark.range(100), "a"), merged)
    few = frame(spark, spark.range(1), "b")
    with pytest.raises(ValueError, match="buckets its keys are not in"):
        table.merge(few, lambda old, new: frame(spark, spark.range(100), "c"))
    assert table.read().filter("h = 'a'").count() == 100


def test_file_keyed_overwrite(spark, tmp_path):
    table = FileKeyedTable(spark, str(tmp_path / "t"), SCHEMA, replace_key="h")
    table.overwrite(frame(spark, spark.range(3), "a").union(frame(spark, spark.range(2), "1e5")))
    assert sorted(r.h for r in table.read().collect()) == ["1e5", "1e5", "a", "a", "a"]
    table.overwrite(frame(spark, spark.range(1), "b"))
    assert [r.h for r in table.read().collect()] == ["b"]


def test_appends_with_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append(spark.createDataFrame([(1,)], "x int"), path)
    append(spark.createDataFrame([(2, "why")], "x int, reason string"), path)
    rows = {r.x: r.reason for r in read_merged(spark, path).collect()}
    assert rows == {1: None, 2: "why"}


def test_clustered_files_cover_narrow_ranges_even_for_a_hot_value(spark, tmp_path):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "SP").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("g"),
        F.hash("id").alias("k"),
    )
    out = str(tmp_path / "t")
    clustered(df, ["g"], ["k"], files=6).write.parquet(out)
    per_file = (
        spark.read.parquet(out)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min(F.struct("g", "k")).alias("lo"), F.max(F.struct("g", "k")).alias("hi"), F.count("*").alias("n"))
        .orderBy("lo")
        .collect()
    )
    assert sum(r.n for r in per_file) == 9000
    assert len(per_file) == 6 and max(r.n for r in per_file) < 2500
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))


class Session:
    """Just what ``scratch_dir`` looks at."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = conf


def test_scratch_follows_the_shared_folder():
    shared = {"spark.checkpoint.dir": "hdfs://store/scratch/"}
    for master in ("yarn", "local[8]"):
        assert scratch_dir(Session(master, **shared), "x").startswith("hdfs://store/scratch/x-")


def test_no_folder_of_this_machine_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")
    assert scratch_dir(Session("local[8]"), "x") != scratch_dir(Session("local[8]"), "x")
