from pyspark.sql import functions as F

from keelson.operators.dedup import latest_per_key
from keelson.operators.upsert import new_keys
from keelson.plans.jobs import cleanse
from keelson.spec import CUSTOMER_SPEC


def test_ties_are_broken_the_same_way_for_any_order_of_rows(raw_rows, run_at):
    tied = [("1", "u", str(z), c, "SP") for z in (10, 20) for c in ("a", None, "b")]
    survivors = set()
    for rows in (tied, tied[::-1], tied[3:] + tied[:3]):
        latest, _ = cleanse(raw_rows(*rows).repartition(3), CUSTOMER_SPEC, run_at(1))
        [row] = latest.collect()
        survivors.add((row.customer_zip_code_prefix, row.customer_city))
    assert survivors == {("20", "B")}


def test_default_tie_break_uses_all_other_columns(spark):
    df = spark.createDataFrame([(1, 5, "a", 2), (1, 5, "b", 1), (1, 4, "z", 9)], "k int, t int, x string, y int")
    assert [tuple(r) for r in latest_per_key(df, "k", "t").collect()] == [(1, 5, "b", 1)]


def test_several_keys_and_null_times(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 1), (1, "a", 3, 2), (1, "b", None, 3)], "k int, g string, t int, v int"
    )
    kept = latest_per_key(df, ["k", "g"], "t").collect()
    assert sorted(r.v for r in kept) == [2, 3]


def test_hot_key_against_brute_force(spark):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"),
        (F.col("id") * 7919 % 10007).alias("t"),
        F.col("id").alias("v"),
    )
    expected = {}
    for r in rows.collect():
        if r.k not in expected or (r.t, r.v) > expected[r.k]:
            expected[r.k] = (r.t, r.v)
    found = {r.k: (r.t, r.v) for r in latest_per_key(rows, "k", "t", ["v"]).collect()}
    assert found == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 as k", "id as t")
    plan = latest_per_key(df, "k", "t")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_new_keys(spark):
    old = spark.createDataFrame([(1,), (2,)], "k int")
    new = spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string")
    assert [tuple(r) for r in new_keys(old, new, "k").collect()] == [(3, "c")]
