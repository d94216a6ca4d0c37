import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from keelson.operators import replace
from keelson.operators.evolve import conform, merged_schema, union_evolving
from keelson.operators.replace import delete_where, replace_by
from keelson.operators.upsert import upsert
from pyspark.sql import functions as F

SCHEMA = "k string, h string, a string, b string"


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame(
        [("same", "1", "ta", "tb"), ("changed", "1", "ta", "tb"), ("gone", "1", "ta", "tb")], SCHEMA
    )
    source = spark.createDataFrame(
        [("same", "1", "sa", "sb"), ("changed", "2", "sa", "sb"), ("new", "1", "sa", "sb")], SCHEMA
    )
    return target, source


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_all_branches(frames):
    assert rows(upsert(*frames, "k", "h")) == [
        ("changed", "2", "sa", "sb"),
        ("gone", "1", "ta", "tb"),
        ("new", "1", "sa", "sb"),
        ("same", "1", "ta", "tb"),
    ]


def test_update_columns(frames):
    result = rows(upsert(*frames, "k", "h", update_columns=("h", "a")))
    assert ("changed", "2", "sa", "tb") in result
    assert ("new", "1", "sa", "sb") in result


def test_repeat_changes_nothing(frames):
    target, source = frames
    once = upsert(target, source, "k", "h")
    assert rows(upsert(once, source, "k", "h")) == rows(once)


def test_null_hash_counts_as_changed(spark):
    target = spark.createDataFrame([("1", None, "t", "t"), ("2", None, "t", "t")], SCHEMA)
    source = spark.createDataFrame([("1", "x", "s", "s"), ("2", None, "s", "s")], SCHEMA)
    assert rows(upsert(target, source, "k", "h")) == [("1", "x", "s", "s"), ("2", None, "t", "t")]


def test_repeated_source_key_fails(frames):
    target, source = frames
    with pytest.raises(PySparkException, match="source repeats k"):
        upsert(target, source.union(source), "k", "h").collect()


def test_initial_load_from_empty_target(frames):
    _, source = frames
    assert rows(upsert(source.limit(0), source, "k", "h")) == rows(source)


def test_columns_only_one_side_has(frames):
    target, source = frames
    result = upsert(target.drop("b"), source.drop("a"), "k", "h")
    assert result.columns == ["k", "h", "a", "b"]
    assert sorted(map(str, result.collect())) == sorted(
        str(r)
        for r in result.sparkSession.createDataFrame(
            [
                ("changed", "2", "ta", "sb"),
                ("gone", "1", "ta", None),
                ("new", "1", None, "sb"),
                ("same", "1", "ta", None),
            ],
            SCHEMA,
        ).collect()
    )


def test_union_evolving_and_conform(spark):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    two = spark.createDataFrame([(2.0, 3)], "z double, x int")
    both = union_evolving(one, two)
    assert rows(both.select("x", F.coalesce("y", F.lit("-")), F.coalesce("z", F.lit(0.0)))) == [
        (1, "a", 0.0),
        (3, "-", 2.0),
    ]
    schema = merged_schema(one.schema, two.schema)
    assert schema.fieldNames() == ["x", "y", "z"]
    assert conform(two, schema).schema.fieldNames() == ["x", "y", "z"]
    assert tuple(conform(two, schema).first()) == (3, None, 2.0)


def test_delete_keeps_rows_where_the_predicate_is_null(spark):
    df = spark.createDataFrame([("a",), ("it's",), (None,)], "f string")
    assert {r.f for r in delete_where(df, F.col("f") == "it's").collect()} == {"a", None}


def test_replace_by(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "f string, v int")
    incoming = spark.createDataFrame([("a", 9), ("c", 8)], "f string, v int")
    once = replace_by(stored, incoming, "f")
    assert sorted(r.v for r in once.collect()) == [3, 4, 8, 9]
    assert sorted(r.v for r in replace_by(once, incoming, "f").collect()) == [3, 4, 8, 9]


def test_replace_by_leaves_stored_rows_in_place(spark):
    """Dealt out by file, all rows of a file would go to one task. Without statistics Spark would do so."""
    stored = spark.range(1000).selectExpr("concat('f', id % 3) as f", "id as v")
    incoming = spark.range(3).selectExpr("concat('f', id % 2) as f", "id as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        result = replace_by(stored, incoming, "f")
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan  # the distinct names
        assert result.count() == 333 + 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_replace_by_with_many_values(spark, monkeypatch):
    monkeypatch.setattr(replace, "FEW", 1)
    stored = spark.createDataFrame([("a", 1), ("b", 3), (None, 4)], "f string, v int")
    incoming = spark.createDataFrame([("a", 9), ("c", 8)], "f string, v int")
    assert sorted(r.v for r in replace_by(stored, incoming, "f").collect()) == [3, 4, 8, 9]


contents = st.dictionaries(st.sampled_from("abcdef"), st.sampled_from("xyz"))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(old=contents, new=contents)
def test_against_a_dictionary(spark, old, new):
    def frame(side, values):
        return spark.createDataFrame([(k, h, side, side) for k, h in values.items()], SCHEMA)

    expected = {k: (h, "old") for k, h in old.items()}
    expected |= {k: (h, "new") for k, h in new.items() if old.get(k) != h}
    result = upsert(frame("old", old), frame("new", new), "k", "h").collect()
    assert len(result) == len(expected)
    assert {r.k: (r.h, r.a) for r in result} == expected


def test_an_old_batch_applied_again_changes_nothing(spark):
    target = spark.createDataFrame([(1, "new", 2), (2, "x", None)], "k int, h string, at int")
    old = spark.createDataFrame([(1, "old", 1), (2, "y", 1), (3, "z", None)], "k int, h string, at int")
    rows = upsert(target, old, "k", "h", order_by="at").collect()
    assert sorted((r.k, r.h) for r in rows) == [(1, "new"), (2, "y"), (3, "z")]
