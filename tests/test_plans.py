"""Plans have the shape that holds at scale."""

import pytest

from keelson.suite.queries import all_queries

# Queries that are one plan; the others write tables on the way.
WRITING = ("medallion", "ingest", "feed_contract", "silver_copartitioned", "dq_incremental", "feed_rescued")
LAZY = [name for name in all_queries() if not name.startswith(WRITING)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    # As for tables too large to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        return {name: plan_of(all_queries()[name](spark, sf_dir)) for name in LAZY}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_operator_that_cannot_be_distributed(plans, name):
    for operator in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "RDD"):
        assert operator not in plans[name]
    if not name.startswith(("dq_load", "dq_null", "dq_incremental", "run_", "scd2_counts", "dq_top_states")):
        assert "SinglePartition" not in plans[name]


def test_row_local_queries_do_not_shuffle(plans):
    for name in ("standardize", "region_map", "record_hash", "dq_valid", "dq_quarantine",
                 "delete_by_file", "schema_evolve_union"):
        assert "Exchange" not in plans[name]


def test_dedup_is_one_shuffle(plans):
    for name in ("dedup_latest", "dedup_feed"):
        assert plans[name].count("Exchange") == 1
        assert plans[name].count("WindowGroupLimit") == 2


def test_top_k_is_not_a_full_sort(plans):
    for name in ("dq_duplicate_keys", "dq_top_states", "dq_bad_format", "newest_rows"):
        assert "TakeOrderedAndProject" in plans[name]


def test_scans_read_only_needed_columns(plans):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id" in plans["dedup_latest"]
    assert "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice" in plans["fact_dim_join"]
    assert "o_comment" not in plans["fact_dim_join"] + plans["fact_dim_as_of"]
    assert "ReadSchema: struct<>" in plans["run_row_count"] or (
        "o_custkey" not in plans["run_row_count"]
    )


def test_pushed_filters(spark, tmp_path, run_at, raw_rows):
    from keelson.operators.metrics import run_row_count
    from keelson.operators.scd2 import current_rows
    from keelson.sources.tables import FileKeyedTable, SnapshotTable
    from keelson.spec import BRONZE_SCHEMA, GOLD_SCHEMA

    bronze = FileKeyedTable(spark, str(tmp_path / "b"), BRONZE_SCHEMA)
    bronze.replace(raw_rows(("1", "u", "1", "x", "SP")), ["a.csv"])
    plan = plan_of(run_row_count(bronze.read(), "r"))
    assert "EqualTo(_pipeline_run_id,r)" in plan
    assert "ReadSchema: struct<_pipeline_run_id:string>" in plan
    gold = SnapshotTable(spark, str(tmp_path / "g"), GOLD_SCHEMA)
    gold.publish(gold.read())
    assert "EqualTo(IsCurrent,true)" in plan_of(current_rows(gold.read()))


def test_upsert_reuses_the_shuffle_of_the_dedup(spark, tmp_path, run_at, raw_rows):
    from keelson.plans import jobs
    from keelson.spec import CUSTOMER_SPEC

    tables = jobs.Tables.under(spark, str(tmp_path / "lake"))
    tables.bronze.replace(raw_rows(("1", "u", "1", "x", "SP")), ["a.csv"])
    tables.silver.publish(tables.silver.read())
    source, rejected = jobs.cleanse(tables.bronze.read(), CUSTOMER_SPEC, run_at(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(jobs.silver_after(tables.silver.read(), source, CUSTOMER_SPEC))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and plan.count("SortMergeJoin") == 1
    assert "Exchange" not in plan_of(rejected)


def test_dimension_update_is_one_join(spark, tmp_path, run_at):
    from keelson.operators import scd2
    from keelson.sources.tables import SnapshotTable
    from keelson.spec import GOLD_SCHEMA, SILVER_SCHEMA

    gold = SnapshotTable(spark, str(tmp_path / "g"), GOLD_SCHEMA)
    gold.publish(gold.read())
    silver = SnapshotTable(spark, str(tmp_path / "s"), SILVER_SCHEMA)
    silver.publish(silver.read())
    changed = scd2.apply_changes(gold.read(), scd2.dimension_source(silver.read()), run_at(1))
    plan = plan_of(changed)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 2
    assert "_created_at" not in plan


def test_hot_fact_key_is_split(spark, run_at):
    """A customer with a third of the facts: the join splits its partition and loses nothing."""
    from pyspark.sql import functions as F

    from keelson.operators import scd2

    keys = spark.range(600).select(
        F.sha2(F.col("id").cast("string"), 256).alias("SurrogateKey"),
        F.col("id").cast("string").alias(scd2.BUSINESS_KEY),
        *(F.lit("x").alias(c) for c in ("customer_unique_id", "customer_zip_code_prefix",
          "customer_city", "customer_state", "customer_region", "_record_hash")),
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 600).cast("string"))
    facts = spark.range(60000).select("id", hot.alias("customer"), F.md5(hot).alias("note"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = scd2.join_facts(facts, scd2.first_versions(keys, run_at(1)), "customer")
        result = joined.select("id", "note", "SurrogateKey")
        rows = result.collect()
        plan = plan_of(result)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(rows) == len({r.id for r in rows}) == 60000
    assert "skew=true" in plan
