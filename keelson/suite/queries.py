"""Registered queries: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson import functions
from keelson.operators import late, metrics, profile, report_state, scd2
from keelson.operators.as_of import join_as_of
from keelson.operators.cleanse import (
    add_region,
    prepare,
    quarantined_rows,
    standardise,
    valid_rows,
)
from keelson.operators.dedup import latest_per_key
from keelson.operators.evolve import union_evolving
from keelson.operators.layout import clustered, interleaved
from keelson.operators.replace import delete_where, replace_by
from keelson.operators.upsert import new_keys, upsert
from keelson.plans import jobs
from keelson.session import scratch_dir, use_utc
from keelson.sources.contract import feed_report
from keelson.sources.csv_feed import read_drops
from keelson.sources.states import StateLog
from keelson.sources.tables import BucketedTable, CopartitionedTable, FileKeyedTable
from keelson.suite import feed
from keelson.suite.feed import RUNS, table
from keelson.spec import (
    CONTENT_COLUMNS,
    CUSTOMER_COLUMNS,
    CUSTOMER_CONTRACT,
    CUSTOMER_SPEC,
    GOLD_SCHEMA,
    QUARANTINE_SCHEMA,
    RESCUE_RULE,
    SILVER_SCHEMA,
    Run,
)

Query = Callable[[SparkSession, str], DataFrame]

SPEC = CUSTOMER_SPEC
CONTENT_SPEC = replace(CUSTOMER_SPEC, update_columns=CONTENT_COLUMNS)
DELETED_FILE = "orders_1997a.csv"

_queries: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(use_utc(spark), sf_dir)

    _queries[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# --- States of the tables after each run ------------------------------------------------------


def _sources(spark, sf_dir, n) -> list[DataFrame]:
    """Latest valid row per key of runs 1 to ``n``. The batch of a delivery follows from its
    table and date, so the filter on the batch reaches the scans."""
    prepared = prepare(feed.bronze(spark, sf_dir), SPEC)
    return [
        jobs.latest_valid(prepared.filter(F.col("_batch_id") <= run.batch_id), SPEC, run)
        for run in RUNS[:n]
    ]


def _silvers(spark, sf_dir, n, spec=SPEC) -> list[DataFrame]:
    """The silver table after runs 1 to ``n``."""
    states = []
    for source in _sources(spark, sf_dir, n):
        states.append(jobs.silver_after(states[-1] if states else None, source, spec))
    return states


def _source(spark, sf_dir, n) -> DataFrame:
    return _sources(spark, sf_dir, n)[-1]


def _silver(spark, sf_dir, n, spec=SPEC) -> DataFrame:
    return _silvers(spark, sf_dir, n, spec)[-1]


def _last_run(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The silver table of the last run, and the dimension it meets as found on disk.

    The feed is cleansed once, into a table by batch that every run reads its batches of.
    """
    path = scratch_dir(spark, "valid")
    valid = valid_rows(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC, RUNS[0]).drop(SPEC.updated_at)
    valid.write.partitionBy("_batch_id").parquet(path)
    valid = spark.read.schema(valid.schema).parquet(path)

    def source(run: Run) -> DataFrame:
        known = valid.filter(F.col("_batch_id") <= run.batch_id)
        latest = latest_per_key(known, SPEC.key, SPEC.order_by, SPEC.tie_break)
        return latest.withColumn(SPEC.updated_at, F.lit(run.as_of)).select(SILVER_SCHEMA.fieldNames())

    first = _stored(spark, jobs.silver_after(None, source(RUNS[0]), SPEC), "silver")
    second = _stored(spark, jobs.silver_after(first, source(RUNS[1]), SPEC), "silver")
    third = jobs.silver_after(second, source(RUNS[2]), SPEC)
    gold = jobs.gold_after(jobs.gold_after(None, first, RUNS[0]), second, RUNS[1])
    return third, _stored(spark, gold, "gold")


def _gold(spark, sf_dir) -> DataFrame:
    """The dimension after all runs."""
    silver, gold = _last_run(spark, sf_dir)
    return jobs.gold_after(gold, silver, RUNS[-1])


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: the state a run finds on disk."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- Projections and rules --------------------------------------------------------------------


@query
def standardize(spark, sf_dir):
    return standardise(feed.bronze(spark, sf_dir), SPEC).select(
        *CUSTOMER_COLUMNS, "_source_file_name"
    )


@query
def region_map(spark, sf_dir):
    return add_region(standardise(feed.bronze(spark, sf_dir), SPEC), SPEC).select(
        "customer_id", "customer_state", "customer_region"
    )


@query
def record_hash(spark, sf_dir):
    rows = standardise(feed.bronze(spark, sf_dir), SPEC)
    return rows.select(
        "customer_id",
        functions.record_hash(SPEC.tracked).alias("_record_hash"),
        functions.record_hash(SPEC.tracked, null_safe=True).alias("null_safe_hash"),
    )


@query
def surrogate_key(spark, sf_dir):
    return scd2.dimension_source(_source(spark, sf_dir, 3))


@query
def dq_valid(spark, sf_dir):
    return valid_rows(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC, RUNS[2])


@query
def dq_quarantine(spark, sf_dir):
    return quarantined_rows(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC, RUNS[2])


@query
def dq_quarantine_by_rule(spark, sf_dir):
    rejected = quarantined_rows(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC, RUNS[2])
    return profile.count_by(rejected, ["_dq_error_reason"], "rows")


# --- Latest row per key -----------------------------------------------------------------------


@query
def dedup_latest(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts", ["event_id"])


@query
def dedup_feed(spark, sf_dir):
    return _source(spark, sf_dir, 3)


# --- Delete, replace, evolve, lay out ---------------------------------------------------------


@query
def delete_by_file(spark, sf_dir):
    return delete_where(feed.bronze(spark, sf_dir), F.col("_source_file_name") == DELETED_FILE)


@query
def replace_by_file(spark, sf_dir):
    """All files of the last batch are delivered again with a correction."""
    stored = feed.bronze(spark, sf_dir)
    again = feed.order_deliveries(spark, sf_dir).filter(
        F.col("_batch_id") == feed.LAST_ORDERS_BATCH
    )
    corrected = again.withColumns(
        {
            "customer_city": F.coalesce("customer_city", F.lit("unknown")),
            "_pipeline_run_id": F.lit("run-4"),
        }
    )
    return replace_by(stored, corrected, "_source_file_name")


@query
def schema_evolve_union(spark, sf_dir):
    master = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as customer_number", "c_name as customer_name", "c_mktsegment as segment"
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as customer_number", "o_orderpriority as priority"
    )
    return union_evolving(master, orders)


@query
def clustered_rewrite(spark, sf_dir):
    return clustered(
        _source(spark, sf_dir, 3), ["customer_region", "customer_state"], ["customer_id"]
    )


@query
def clustered_interleaved(spark, sf_dir):
    return interleaved(
        _source(spark, sf_dir, 3), ["customer_region", "customer_state"], ["customer_id"]
    )


# --- Upsert -----------------------------------------------------------------------------------


@query
def upsert_initial(spark, sf_dir):
    """The first load, with the whole feed delivered at once."""
    return jobs.silver_after(None, _source(spark, sf_dir, 3), SPEC)


@query
def upsert_changed(spark, sf_dir):
    return _silver(spark, sf_dir, 3, CONTENT_SPEC)


@query
def upsert_all_columns(spark, sf_dir):
    return _silver(spark, sf_dir, 3)


@query
def upsert_new_keys(spark, sf_dir):
    _, second, third = _sources(spark, sf_dir, 3)
    return new_keys(second, third, SPEC.key)


@query
def upsert_rerun(spark, sf_dir):
    """The same source applied twice; it is not known to be unique here, so that is checked."""
    silver = _silver(spark, sf_dir, 3)
    return upsert(silver, _source(spark, sf_dir, 3), SPEC.key, SPEC.hash_column)


@query
def silver_build(spark, sf_dir):
    return _silver(spark, sf_dir, 3)


@query
def silver_copartitioned(spark, sf_dir):
    """All runs over a bucketed table of the catalog, which no merge moves."""
    path = scratch_dir(spark, "silver")
    name = "silver_" + path.rsplit("-", 1)[1]
    table = CopartitionedTable(spark, name, SILVER_SCHEMA, SPEC.key, 8, path)
    for source in _sources(spark, sf_dir, len(RUNS)):
        first = not table.exists()
        table.merge(
            source, lambda target, new: jobs.silver_after(None if first else target, new, SPEC)
        )
    return table.read()


# --- Dimension --------------------------------------------------------------------------------


@query
def scd2_initial(spark, sf_dir):
    """The first load, with the whole feed delivered at once."""
    return jobs.gold_after(None, upsert_initial(spark, sf_dir), RUNS[0])


@query
def next_version(spark, sf_dir):
    silver, gold = _last_run(spark, sf_dir)
    return scd2.next_versions(scd2.dimension_source(silver), gold)


@query
def detect_changes(spark, sf_dir):
    silver, gold = _last_run(spark, sf_dir)
    return scd2.changed_rows(scd2.dimension_source(silver), gold)


@query
def scd2_apply(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def scd2_rerun(spark, sf_dir):
    """Applying a run to the dimension that already holds it changes nothing."""
    silver, gold = _last_run(spark, sf_dir)
    silver = _stored(spark, silver, "silver")
    once = _stored(spark, jobs.gold_after(gold, silver, RUNS[2]), "gold")
    return jobs.gold_after(once, silver, RUNS[2])


@query
def gold_build(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def scd2_current(spark, sf_dir):
    return scd2.current_rows(_gold(spark, sf_dir))


@query
def scd2_history(spark, sf_dir):
    return scd2.history_view(_gold(spark, sf_dir))


@query
def scd2_counts(spark, sf_dir):
    return metrics.dimension_counts(_gold(spark, sf_dir))


@query
def version_counts(spark, sf_dir):
    return profile.version_counts(_gold(spark, sf_dir))


def _orders_with_key(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        F.expr(feed.ORDER_CUSTOMER_KEY).alias("order_customer"),
    )


@query
def fact_dim_join(spark, sf_dir):
    return scd2.join_facts(
        _orders_with_key(spark, sf_dir), _gold(spark, sf_dir), "order_customer"
    )


@query
def fact_dim_totals(spark, sf_dir):
    """Order totals per region, those of customers the dimension lacks apart. Orders are summed per customer before the join, so a customer
    with a third of all orders sends one row per task into the shuffle."""
    totals = (
        _orders_with_key(spark, sf_dir)
        .groupBy("order_customer")
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        )
    )
    joined = scd2.join_facts(totals, _gold(spark, sf_dir), "order_customer")
    return joined.groupBy("customer_region", "in_dimension").agg(
        F.sum("orders").alias("orders"), F.sum("total").cast("double").alias("total")
    )


@query
def fact_dim_as_of(spark, sf_dir):
    """Each order with the customer as known on its date, by the run-dated dimension."""
    return join_as_of(
        _orders_with_key(spark, sf_dir),
        _stored(spark, _gold(spark, sf_dir), "gold"),
        "order_customer",
        "o_orderdate",
        attributes=[*scd2.dimension_source(_source(spark, sf_dir, 1)).columns[:-1], "Version"],
    )


# --- Loads out of order, full loads, loads with other columns --------------------------------


@query
def scd2_late_arrivals(spark, sf_dir):
    """Every valid delivery dates its customer's record. The early orders arrive after the late ones. The surrogate key
    follows from the business key, so it is made at the end and not moved."""
    valid = valid_rows(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC, RUNS[0])
    rows = scd2.dimension_source(valid, carry=["_created_at", "_batch_id"]).withColumnRenamed("_created_at", late.AT)
    rows = rows.drop("SurrogateKey")
    dimension = observations = None
    is_early = F.col("_batch_id") == feed.FIRST_ORDERS_BATCH
    for run, part in ((RUNS[0], rows.filter(~is_early)), (RUNS[1], rows.filter(is_early))):
        arrivals = part.drop("_batch_id")
        found = late.observed(observations, arrivals, run, tie_break=["_record_hash", "customer_unique_id"])
        observations = _stored(spark, found, "observations")
        changed = late.apply_late(dimension, observations, arrivals, run)
        dimension = _stored(spark, changed, "gold") if run is RUNS[0] else changed
    return dimension.select(functions.surrogate_key(scd2.BUSINESS_KEY).alias("SurrogateKey"), "*")


def _by_batch(spark, sf_dir) -> list[DataFrame]:
    """Latest valid row per key of each batch alone."""
    prepared = prepare(feed.bronze(spark, sf_dir), SPEC)
    return [
        jobs.latest_valid(prepared.filter(F.col("_batch_id") == run.batch_id), SPEC, run)
        for run in RUNS
    ]


@query
def scd2_closed_keys(spark, sf_dir):
    """Each batch taken as a full delivery: keys it lacks are closed, and reopened when they return."""
    dimension = None
    for source, run in zip(_by_batch(spark, sf_dir), RUNS):
        changed = scd2.apply_changes(
            dimension, scd2.dimension_source(source), run, unique_source=True, close_absent=True
        )
        dimension = _stored(spark, changed, "gold") if run is not RUNS[-1] else changed
    return dimension


def _widening_loads(spark, sf_dir) -> list[tuple[Run, DataFrame]]:
    """The first two batches; the second has a wider ``account`` and a new column ``priority``."""
    first = table(spark, sf_dir, "customer").selectExpr(
        *feed.selected(feed.MASTER_COLUMNS), f"{feed.MASTER_ACCOUNT} as account"
    )
    second = table(spark, sf_dir, "orders").selectExpr(
        *feed.selected(feed.ORDER_COLUMNS), f"{feed.ORDER_ACCOUNT} as account", "o_orderpriority as priority"
    )
    return [(RUNS[0], first), (RUNS[1], second.filter(F.col("_batch_id") == RUNS[1].batch_id))]


@query
def merge_evolving(spark, sf_dir):
    """Silver and dimension, bucketed, after two loads with differing columns."""
    root = scratch_dir(spark, "lake")
    silver = BucketedTable(spark, f"{root}/silver", SILVER_SCHEMA, SPEC.key, 8)
    gold = BucketedTable(spark, f"{root}/gold", GOLD_SCHEMA, scd2.BUSINESS_KEY, 8)
    for run, bronze in _widening_loads(spark, sf_dir):
        source = jobs.latest_valid(prepare(bronze, SPEC), SPEC, run)
        first = not silver.exists()
        silver.merge(source, lambda old, new: new if first else upsert(old, new, SPEC.key, SPEC.hash_column, unique_source=True))
        changed = silver.read()
        gold.merge(changed.withColumnRenamed(SPEC.key, scd2.BUSINESS_KEY), lambda old, _: jobs.gold_after(None if first else old, changed, run))
    return gold.read()


@query
def quarantine_evolving(spark, sf_dir):
    """The quarantine after two loads with differing columns."""
    store = FileKeyedTable(spark, scratch_dir(spark, "quarantine"), QUARANTINE_SCHEMA, gather=True)
    for run, bronze in _widening_loads(spark, sf_dir):
        names = [row[0] for row in bronze.select("_source_file_name").distinct().collect()]
        store.replace(quarantined_rows(prepare(bronze, SPEC), SPEC, run), names)
    return store.read()


# --- Changes between states -------------------------------------------------------------------


def _changes(spark, before, after, key) -> DataFrame:
    log = StateLog(spark, scratch_dir(spark, "states"), [key], buckets=8, leaves=64)
    return log.changes(log.publish(before), log.publish(after)).drop("_copies")


@query
def silver_changes(spark, sf_dir):
    """What the last run did to the silver table."""
    _, second, third = _silvers(spark, sf_dir, 3)
    return _changes(spark, second, third, SPEC.key)


@query
def load_changes(spark, sf_dir):
    """The last load against the one before: keys that came, went and changed."""
    _, second, third = _by_batch(spark, sf_dir)
    return _changes(spark, second, third, SPEC.key)


# --- Reports ----------------------------------------------------------------------------------


def _named(spark, sf_dir) -> DataFrame:
    """The raw table addressed by name, as the reports' readers do."""
    feed.bronze(spark, sf_dir).createOrReplaceTempView("bronze_customers")
    return spark.table("bronze_customers")


@query
def dq_load_profile(spark, sf_dir):
    return profile.load_profile(_named(spark, sf_dir))


@query
def dq_null_profile(spark, sf_dir):
    return profile.null_profile(_named(spark, sf_dir))


@query
def dq_duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(_named(spark, sf_dir))


@query
def dq_top_states(spark, sf_dir):
    return profile.top_values(_named(spark, sf_dir))


@query
def dq_lineage(spark, sf_dir):
    return profile.lineage(_named(spark, sf_dir))


@query
def dq_bad_format(spark, sf_dir):
    return profile.bad_formats(standardise(_named(spark, sf_dir), SPEC))


@query
def dq_bad_format_raw(spark, sf_dir):
    return profile.bad_formats(_named(spark, sf_dir))


@query
def newest_rows(spark, sf_dir):
    return profile.newest_rows(
        _named(spark, sf_dir), tie_break=[*CUSTOMER_COLUMNS, "_source_file_name"]
    )


@query
def batch_file_counts(spark, sf_dir):
    return profile.batch_file_counts(_named(spark, sf_dir))


@query
def region_state_counts(spark, sf_dir):
    return profile.region_state_counts(_source(spark, sf_dir, 3))


@query
def run_row_count(spark, sf_dir):
    return metrics.run_row_count(feed.bronze(spark, sf_dir), "run-3")


@query
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(prepare(feed.bronze(spark, sf_dir), SPEC), SPEC)


def _report_state(spark, sf_dir) -> DataFrame:
    """The state after every load: each reads its own batch only, and the last one is delivered again."""
    state = FileKeyedTable(spark, scratch_dir(spark, "report-state"), report_state.STATE_SCHEMA)
    rows = feed.bronze(spark, sf_dir)
    for run, names in [*(batches := _batches(spark, sf_dir)), *batches[-1:]]:
        state.replace(report_state.summarise(rows.filter(F.col("_batch_id") == run.batch_id)), names)
    return state.read()


@query
def dq_incremental_load_profile(spark, sf_dir):
    return report_state.load_profile(_report_state(spark, sf_dir))


@query
def dq_incremental_null_profile(spark, sf_dir):
    return report_state.null_profile(_report_state(spark, sf_dir))


@query
def dq_incremental_duplicate_keys(spark, sf_dir):
    return report_state.duplicate_keys(_report_state(spark, sf_dir))


@query
def dq_incremental_top_states(spark, sf_dir):
    return report_state.top_values(_report_state(spark, sf_dir))


@query
def dq_incremental_bad_format(spark, sf_dir):
    return report_state.bad_formats(_report_state(spark, sf_dir))


@query
def dq_incremental_lineage(spark, sf_dir):
    return report_state.lineage(_report_state(spark, sf_dir))


# --- Through files ----------------------------------------------------------------------------


def _delivered(spark, sf_dir) -> tuple[str, list[str]]:
    """The feed as CSV drops, one folder of part files per source file. Each row goes to its
    drop's folder from the task that made it, without a shuffle."""
    root = scratch_dir(spark, "drops")
    rows = feed.bronze(spark, sf_dir).select(*CUSTOMER_COLUMNS, "_source_file_name")
    (
        rows.withColumnRenamed("_source_file_name", "drop")
        .write.partitionBy("drop")
        .options(
            header="true",
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .csv(root)
    )
    return root


def _drops(root: str, *names: str) -> list[str]:
    return [f"{root}/drop={name}" for name in names]


def _batches(spark, sf_dir) -> list[tuple[Run, list[str]]]:
    """Each run with the names of the files delivered for it."""
    rows = feed.bronze(spark, sf_dir).select("_batch_id", "_source_file_name").distinct().collect()
    named = [(run, sorted(name for batch, name in rows if batch == run.batch_id)) for run in RUNS]
    return [(run, names) for run, names in named if names]


@query
def feed_contract(spark, sf_dir):
    """The header report per drop."""
    root = _delivered(spark, sf_dir)
    paths = _drops(root, *(name for _, names in _batches(spark, sf_dir) for name in names))
    report = feed_report(spark, paths, CUSTOMER_CONTRACT)
    drop = F.regexp_extract("file_path", "drop=([^/]+)/", 1)
    return report.groupBy(drop.alias("drop"), "missing_columns", "extra_columns", "is_valid").agg(
        F.bool_and("has_delimiter").alias("has_delimiter"),
        F.bool_or("is_empty").alias("is_empty"),
    )


@query
def feed_rescued_rows(spark, sf_dir):
    """Orders delivered as CSV with damaged lines: what each drop's lines became, rescued ones with their text
    in the quarantine."""
    root = scratch_dir(spark, "drops")
    header = ",".join(CUSTOMER_COLUMNS)
    lines = feed.order_lines(spark, sf_dir)
    drops = [row[0] for row in lines.select("drop").distinct().collect()]
    # The one column is named as the header should read, and no character of the lines is special.
    lines.withColumnRenamed("line", header).write.partitionBy("drop").options(
        header="true", quote="", sep="\u0001", escapeQuotes="false", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(root)
    contract = replace(CUSTOMER_CONTRACT, rescue=True)
    spec = replace(SPEC, rules={**RESCUE_RULE, **SPEC.rules})
    bronze = read_drops(spark, _drops(root, *drops), contract, RUNS[1], name_from="folder")
    rejected = quarantined_rows(prepare(bronze, spec), spec, RUNS[1])
    rescued = rejected.filter(F.col("_rescued_row").isNotNull()).select(
        "_source_file_name", "_rescued_row", F.substring("_dq_error_reason", 1, 5).alias("rule"), F.lit(1).cast("long").alias("lines")
    )
    others = bronze.filter(F.col("_rescued_row").isNull()).groupBy("_source_file_name").agg(F.count("*").alias("lines"))
    return rescued.unionByName(others, allowMissingColumns=True)


def _ingested(spark, sf_dir) -> jobs.Tables:
    """Bronze after three runs over CSV drops, the last of them run twice."""
    root = _delivered(spark, sf_dir)
    tables = jobs.Tables.under(spark, scratch_dir(spark, "lake"))
    batches = _batches(spark, sf_dir)
    for run, names in [*batches, *batches[-1:]]:
        jobs.ingest(spark, _drops(root, *names), tables, run, name_from="folder")
    return tables


def _ledgered(spark, sf_dir) -> jobs.Tables:
    """Bronze after three runs, each of which is given all that was delivered so far."""
    root = _delivered(spark, sf_dir)
    tables = jobs.Tables.under(spark, scratch_dir(spark, "lake"))
    delivered = []
    for run, names in [*(batches := _batches(spark, sf_dir)), *batches[-1:]]:
        delivered += [name for name in names if name not in delivered]
        jobs.ingest_new(spark, _drops(root, *delivered), tables, run, name_from="folder")
    return tables


@query
def ingest_with_ledger(spark, sf_dir):
    return _ledgered(spark, sf_dir).bronze.read().drop("_source_file_path")


@query
def ledger_entries(spark, sf_dir):
    """What the ledger holds in the end, without what differs from run to run."""
    return _ledgered(spark, sf_dir).ledger.read().select("source", "first_line", "rows", "batch_id", "ingested_at")


@query
def ingest_bronze(spark, sf_dir):
    """Without the full path, which differs from run to run."""
    return _ingested(spark, sf_dir).bronze.read().drop("_source_file_path")


def _pipeline(spark, sf_dir, **layout) -> jobs.Tables:
    """All jobs for each of the three batches, over stored tables; the last is run twice."""
    root = _delivered(spark, sf_dir)
    tables = jobs.Tables.under(spark, scratch_dir(spark, "lake"), **layout)
    batches = _batches(spark, sf_dir)
    for run, names in [*batches, *batches[-1:]]:
        jobs.run_all(spark, _drops(root, *names), tables, run, name_from="folder")
    return tables


@query
def medallion_end_to_end(spark, sf_dir):
    return _pipeline(spark, sf_dir).gold.read()


@query
def medallion_bucketed(spark, sf_dir):
    """The same jobs over bucketed tables."""
    return _pipeline(spark, sf_dir, buckets=8).gold.read()


@query
def medallion_quarantine(spark, sf_dir):
    return _pipeline(spark, sf_dir).quarantine.read().drop("_source_file_path")
