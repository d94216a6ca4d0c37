"""Feeds of changes between two states."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keelson.operators.changes import CHANGE, COPIES, applied, changes
from keelson.sources.states import StateLog

SCHEMA = "k string, v long, note string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def expected_feed(before, after):
    gone, come = Counter(before) - Counter(after), Counter(after) - Counter(before)
    gone_keys, come_keys = {r[0] for r in gone}, {r[0] for r in come}
    feed = Counter()
    for rows, others, single, paired in (
        (gone, come_keys, "delete", "update_before"), (come, gone_keys, "insert", "update_after")
    ):
        for row, n in rows.items():
            feed[(paired if row[0] in others else single, *row, n)] += 1
    return feed


@pytest.mark.parametrize("seed", range(4))
def test_feeds_equal_brute_force_and_lead_to_the_state_after(spark, tmp_path, seed):
    pick = random.Random(seed)
    keys = [None, "", "a", "b", "c", "d", "e"]

    def state():
        return [
            (pick.choice(keys), pick.choice([None, 1, 2]), pick.choice([None, "", "x"])) for _ in range(pick.choice([0, 5, 40]))
        ]

    log = StateLog(spark, str(tmp_path / "log"), ["k"], buckets=4, leaves=3)
    states = [state() for _ in range(3)]
    for rows in states:
        log.publish(frame(spark, rows))
    assert log.states() == [1, 2, 3]
    for before, after in ((1, 2), (2, 3), (3, 1), (2, 2)):
        feed = log.changes(before, after)
        assert bag(feed) == expected_feed(states[before - 1], states[after - 1])
        assert bag(applied(log.read(before), feed)) == Counter(states[after - 1])


def test_only_unequal_parts_are_read(spark, tmp_path):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("n").alias("note"))
    log = StateLog(spark, str(tmp_path / "log"), ["k"], buckets=16, leaves=16)
    log.publish(rows)
    log.publish(rows.withColumn("v", F.when(F.col("k") == "77", -1).otherwise(F.col("v"))).filter("k <> '4242'"))
    places = log.unequal(1, 2)
    assert len(places) == 2
    feed = log.changes(1, 2)
    assert sorted((r[CHANGE], r.k, r.v, r[COPIES]) for r in feed.collect()) == [
        ("delete", "4242", 4242, 1), ("update_after", "77", -1, 1), ("update_before", "77", 77, 1)
    ]
    part = log.parts(1, places)
    assert part.count() < 20000 / 16
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and "In(_leaf" in plan
    folders = {f.split("_bucket=")[1].split("/")[0] for f in log.parts(1, places).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert folders == {str(b) for b, _ in places}


def test_columns_that_do_not_count(spark, tmp_path):
    before = frame(spark, [("a", 1, "old"), ("b", 1, "old"), ("c", 1, "old")])
    after = frame(spark, [("a", 1, "new"), ("b", 2, "new"), ("d", 1, "new")])
    log = StateLog(spark, str(tmp_path / "log"), ["k"], compared=["v"])
    log.publish(before)
    log.publish(after)
    expected = [("delete", "c", 1, "old", 1), ("insert", "d", 1, "new", 1), ("update_after", "b", 2, "new", 1), ("update_before", "b", 1, "old", 1)]
    assert sorted(tuple(r) for r in log.changes(1, 2).collect()) == expected


def test_a_new_column_and_a_wider_type(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), ["k"], buckets=2, leaves=2)
    log.publish(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    log.publish(spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "k string, v long, note string"))
    assert sorted((tuple(r) for r in log.changes(1, 2).collect()), key=str) == [
        ("update_after", "b", 2, "x", 1), ("update_before", "b", 2, None, 1)
    ]


def test_times_count_to_the_microsecond(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), ["k"])
    for micros in (123456, 123457):
        log.publish(spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 0, 0, micros))], "k string, at timestamp_ntz"))
    assert log.changes(1, 2).count() == 2


def test_an_unfinished_state_is_not_read(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"), ["k"])
    log.publish(frame(spark, [("a", 1, None)]))
    (tmp_path / "log" / "rows" / "state=2").mkdir()
    assert log.states() == [1]
    with pytest.raises(ValueError, match="no finished state 2"):
        log.changes(1, 2)
    assert log.publish(frame(spark, [])) == 3
    assert [r[CHANGE] for r in log.changes(1, 3).collect()] == ["delete"]
    with pytest.raises(ValueError, match="reserved"):
        log.publish(frame(spark, []).withColumn(COPIES, F.lit(1)))


def test_a_key_of_two_columns(spark):
    before, after = frame(spark, [("a", 1, "x"), ("a", 2, "x")]), frame(spark, [("a", 1, "y"), ("a", 3, "x")])
    kinds = sorted((r[CHANGE], r.v) for r in changes(before, after, ["k", "v"]).collect())
    assert kinds == [("delete", 2), ("insert", 3), ("update_after", 1), ("update_before", 1)]
