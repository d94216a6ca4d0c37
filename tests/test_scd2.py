"""The dimension against a row-by-row model, and its invariants."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keelson.operators import scd2
from keelson.spec import GOLD_SCHEMA

KEY = scd2.BUSINESS_KEY
SOURCE = (
    "SurrogateKey string, BusinessKey_CustomerID string, customer_unique_id string,"
    " customer_zip_code_prefix string, customer_city string, customer_state string,"
    " customer_region string, _record_hash string"
)


def source(spark, hashes):
    rows = [(f"s{k}", k, "u", "1", "city", "SP", "Sudeste", h) for k, h in hashes.items()]
    return spark.createDataFrame(rows, SOURCE)


def state(df):
    """{key: [(version, hash, current, start, end, inserted by, closed by)]}"""
    found = {}
    for r in df.collect():
        found.setdefault(r[KEY], []).append(
            (
                r.Version,
                r._record_hash,
                r.IsCurrent,
                str(r.EffectiveStartDate),
                str(r.EffectiveEndDate) if r.EffectiveEndDate else None,
                r._audit_insert_batch,
                r._audit_update_batch,
            )
        )
    return {k: sorted(v) for k, v in found.items()}


def model(batches, run_at):
    """The same by a plain loop over rows."""
    table = {}
    for day, hashes in enumerate(batches, 1):
        run = run_at(day)
        now = f"{run.as_of:%Y-%m-%d %H:%M:%S}"
        for key, value in hashes.items():
            versions = table.setdefault(key, [])
            if versions and versions[-1][1] == value:
                continue
            if versions:
                v, h, _, start, _, by, _ = versions[-1]
                versions[-1] = (v, h, False, start, now, by, run.batch_id)
            versions.append((len(versions) + 1, value, True, now, None, run.batch_id, None))
    return table


def apply_all(spark, batches, run_at):
    table = None
    for day, hashes in enumerate(batches, 1):
        table = scd2.apply_changes(table, source(spark, hashes), run_at(day))
    return table


batch = st.dictionaries(st.sampled_from("abcd"), st.sampled_from("xyz"), min_size=1)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(batches=st.lists(batch, min_size=1, max_size=4))
def test_against_model(spark, run_at, batches):
    assert state(apply_all(spark, batches, run_at)) == model(batches, run_at)


def test_first_load_has_the_full_schema(spark, run_at):
    first = scd2.apply_changes(None, source(spark, {"a": "x"}), run_at(1))
    assert [(f.name, f.dataType) for f in first.schema] == [
        (f.name, f.dataType) for f in GOLD_SCHEMA
    ]
    second = scd2.apply_changes(first, source(spark, {"a": "y"}), run_at(2))
    assert [(f.name, f.dataType) for f in second.schema] == [
        (f.name, f.dataType) for f in GOLD_SCHEMA
    ]


def test_rerun_changes_nothing(spark, run_at):
    batches = [{"a": "x", "b": "x"}, {"a": "y", "c": "x"}]
    table = apply_all(spark, batches, run_at)
    for day in (3, 4, 5):
        again = scd2.apply_changes(table, source(spark, batches[-1]), run_at(day))
        assert state(again) == state(table)


def test_empty_dimension_is_an_initial_load(spark, run_at):
    first = scd2.apply_changes(None, source(spark, {"a": "x"}), run_at(1))
    empty = spark.createDataFrame([], GOLD_SCHEMA)
    assert state(scd2.apply_changes(empty, source(spark, {"a": "x"}), run_at(1))) == state(first)


def test_invariants_on_the_feed(spark, sf_dir):
    from pyspark.sql import functions as F

    from keelson.suite.queries import all_queries

    gold = all_queries()["gold_build"](spark, sf_dir).persist()
    per_key = gold.groupBy(KEY).agg(
        F.count("*").alias("n"),
        F.count_if("IsCurrent").alias("current"),
        F.max("Version").alias("top"),
        F.count_distinct("Version").alias("distinct"),
        F.count_if(F.col("IsCurrent") != F.col("EffectiveEndDate").isNull()).alias("odd"),
    )
    assert per_key.filter("current != 1 or top != n or distinct != n or odd != 0").count() == 0
    nexts = gold.alias("a").join(
        gold.alias("b"), [F.col(f"a.{KEY}") == F.col(f"b.{KEY}"), F.expr("b.Version = a.Version + 1")]
    )
    assert nexts.count() == gold.filter("not IsCurrent").count() > 0
    assert nexts.filter("a.EffectiveEndDate != b.EffectiveStartDate").count() == 0
    assert nexts.filter("a._audit_update_batch != b._audit_insert_batch").count() == 0
    assert nexts.filter("a._record_hash = b._record_hash").count() == 0
    gold.unpersist()


def test_next_versions_and_changed_rows(spark, run_at):
    table = apply_all(spark, [{"a": "x", "b": "x"}, {"a": "y"}], run_at)
    incoming = source(spark, {"a": "z", "b": "x", "c": "x"})
    numbered = scd2.next_versions(incoming, table)
    assert {r[KEY]: r.NewVersion for r in numbered.collect()} == {"a": 3, "b": 2, "c": 1}
    assert dict(numbered.dtypes)["NewVersion"] == "int"
    assert [r[KEY] for r in scd2.changed_rows(incoming, table).collect()] == ["a"]


def test_all_facts_join_current_rows_only(spark, run_at):
    table = apply_all(spark, [{"a": "x"}, {"a": "y"}], run_at)
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "q")], "id int, customer string")
    found = scd2.join_facts(facts, table, "customer").collect()
    assert sorted((r.id, r.in_dimension) for r in found) == [(1, True), (2, True), (3, False)]
