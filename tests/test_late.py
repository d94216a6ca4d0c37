"""Out-of-order loads, keys that go and come back, joins as of a date: against row-by-row models."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.operators import late, scd2
from keelson.operators.as_of import join_as_of
from keelson.operators.chunked import crowded, key_type, numbered, with_neighbours

KEY = scd2.BUSINESS_KEY
DAY = 24 * 3600
quick = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(day):
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(days=day)


def arrivals(spark, rows):
    data = [(f"s{k}", k, "city " + v, v, at(d) if d is not None else None) for k, d, v in rows]
    return spark.createDataFrame(data, f"SurrogateKey string, {KEY} string, customer_city string, _record_hash string, _valid_from timestamp")


def delivered(spark, loads, run_at, seconds=DAY * 7):
    dimension = observations = None
    for day, rows in enumerate(loads, 1):
        new = arrivals(spark, rows)
        observations = late.observed(observations, new, run_at(day))
        dimension = late.apply_late(dimension, observations, new, run_at(day), seconds=seconds)
    return dimension


def history(df):
    return sorted(
        (r[KEY], r.Version, r._record_hash, r.IsCurrent, str(r.EffectiveStartDate), str(r.EffectiveEndDate) if r.EffectiveEndDate else None)
        for r in df.collect()
    )


def model(rows):
    """One history from all observations, whatever load each came in."""
    seen, out = {}, []
    for key, day, value in rows:
        seen.setdefault(key, {})[day] = value
    for key, days in seen.items():
        versions = []
        for day in sorted(days):
            if not versions or versions[-1][1] != days[day]:
                versions.append((day, days[day]))
        for n, (day, value) in enumerate(versions):
            end = f"{at(versions[n + 1][0]):%Y-%m-%d %H:%M:%S}" if n + 1 < len(versions) else None
            out.append((key, n + 1, value, end is None, f"{at(day):%Y-%m-%d %H:%M:%S}", end))
    return sorted(out)


facts_of_keys = st.dictionaries(
    st.tuples(st.sampled_from("ab"), st.integers(0, 40)), st.sampled_from("xyz"), min_size=1, max_size=12
)


@quick
@given(facts=facts_of_keys, order=st.randoms(use_true_random=False), loads=st.integers(1, 4))
def test_any_order_of_arrival_gives_one_history(spark, run_at, facts, order, loads):
    rows = [(k, d, v) for (k, d), v in facts.items()]
    order.shuffle(rows)
    dealt = [part for part in (rows[i::loads] for i in range(loads)) if part]
    assert history(delivered(spark, dealt, run_at)) == model(rows)


def test_late_arrival_splits_moves_and_merges(spark, run_at):
    first = [("a", 1, "x"), ("a", 3, "x"), ("a", 9, "y"), ("b", 2, "x")]
    once = delivered(spark, [first], run_at)
    assert [v[1:3] for v in history(once)] == [(1, "x"), (2, "y"), (1, "x")]
    split = delivered(spark, [first, [("a", 2, "y")]], run_at)
    assert [v[2] for v in history(split) if v[0] == "a"] == ["x", "y", "x", "y"]
    merged = delivered(spark, [first, [("a", 2, "y")], [("a", 2, "x")]], run_at)  # a correction of the same date
    assert history(merged) == history(once)


def test_audit_columns_of_late_loads(spark, run_at):
    first, then = [("a", 1, "x"), ("a", 9, "z"), ("b", 2, "x")], [("a", 5, "y")]
    dimension = delivered(spark, [first, then], run_at)
    found = {(r[KEY], r.Version): (r._audit_insert_batch, r._audit_update_batch) for r in dimension.collect()}
    one, two = run_at(1).batch_id, run_at(2).batch_id
    assert found == {("a", 1): (one, two), ("a", 2): (two, None), ("a", 3): (one, two), ("b", 1): (one, None)}
    assert dimension.columns == delivered(spark, [first], run_at).columns


def test_repeated_loads_and_rows_without_key_or_date_change_nothing(spark, run_at):
    rows = [("a", 1, "x"), ("a", 4, "y"), ("b", 2, "x")]
    observations = late.observed(None, arrivals(spark, rows), run_at(1))
    once = late.apply_late(None, observations, arrivals(spark, rows), run_at(1))
    bad = arrivals(spark, [*rows, (None, 3, "z"), ("a", None, "z"), ("a", 1, "x")])
    again = late.observed(observations, bad, run_at(2))
    twice = late.apply_late(once, again, bad, run_at(2))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_late_loads_bring_new_columns(spark, run_at):
    old = arrivals(spark, [("a", 5, "x"), ("b", 5, "x")])
    new = arrivals(spark, [("a", 2, "y")]).withColumn("score", F.lit(7))
    observations = late.observed(None, old, run_at(1))
    dimension = late.apply_late(None, observations, old, run_at(1))
    dimension = late.apply_late(dimension, late.observed(observations, new, run_at(2)), new, run_at(2))
    assert sorted((r[KEY], r.Version, r.score) for r in dimension.collect()) == [("a", 1, 7), ("a", 2, None), ("b", 1, None)]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_late_load_is_dealt_out_once(spark, run_at):
    """The keys of the load are made distinct; observations, versions held and keys then go by key together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old, new = arrivals(spark, [("a", 1, "x"), ("b", 3, "x")]), arrivals(spark, [("a", 2, "y")])
        seen = late.observed(None, old, run_at(1))
        held = spark.createDataFrame(late.apply_late(None, seen, old, run_at(1)).collect(), late.apply_late(None, seen, old, run_at(1)).schema)
        both = spark.createDataFrame(late.observed(seen, new, run_at(2)).collect(), late.observed(seen, new, run_at(2)).schema)
        assert shuffles(late.apply_late(held, both, new, run_at(2))) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_crowded_key_gives_the_same_history(spark, run_at):
    random.seed(5)
    rows = [(k, d, random.choice("xyz")) for k, n in [("hot", 200), *((f"k{i}", 3) for i in range(30))] for d in random.sample(range(400), n)]
    random.shuffle(rows)
    loads = [rows[::2], [r for r in rows[1::2] if r[0] != "k3"], [("hot", 500, "x")]]
    found = []
    for crowd in (20, 10**6):
        dimension = observations = None
        for day, load in enumerate(loads, 1):
            new = arrivals(spark, load)
            observations = late.observed(observations, new, run_at(day)).localCheckpoint()
            kind = key_type((observations, KEY))
            assert len(crowded(kind, (observations, KEY), crowd=crowd)) == (crowd == 20)
            dimension = late.apply_late(dimension, observations, new, run_at(day), seconds=DAY * 30, crowd=crowd).localCheckpoint()
        found.append(sorted(map(str, dimension.collect())))
        assert history(dimension) == model([r for load in loads for r in load])
    assert found[0] == found[1]


def test_chunked_windows_equal_whole_ones(spark):
    random.seed(3)
    rows = [(k, at(d), random.choice("pq")) for k in "ab" for d in random.sample(range(300), 60)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v string")
    whole = {}
    for k in "ab":
        mine = sorted(r for r in rows if r[0] == k)
        for i, (_, t, _) in enumerate(mine):
            whole[k, t] = (i + 1, mine[i + 1][1] if i + 1 < len(mine) else None, mine[i - 1][2] if i else None)
    for seconds in (DAY, 30 * DAY, 4000 * DAY):
        nth = {(r.k, r.t): (r.nth, r.next) for r in numbered(df, "k", "t", seconds).collect()}
        seen = {(r.k, r.t): r.previous_v for r in with_neighbours(df, "k", "t", {"v": F.col("v")}, seconds).collect()}
        utc = lambda t: t.replace(tzinfo=None) if t else None
        assert {k: (*nth[k], seen[k]) for k in nth} == {(k, utc(t)): (n, utc(e), p) for (k, t), (n, e, p) in whole.items()}


# --- Changes in order -------------------------------------------------------------------------


def source(spark, hashes):
    rows = [(f"s{k}", k, "city", h) for k, h in hashes]
    return spark.createDataFrame(rows, f"SurrogateKey string, {KEY} string, customer_city string, _record_hash string")


def test_a_key_given_twice_fails_the_load(spark, run_at):
    table = scd2.apply_changes(None, source(spark, [("a", "x")]), run_at(1))
    for target in (None, table):
        with pytest.raises(Exception, match="repeats"):
            scd2.apply_changes(target, source(spark, [("a", "y"), ("a", "z")]), run_at(2)).collect()


def test_a_load_older_than_the_current_version_changes_nothing(spark, run_at):
    table = scd2.apply_changes(None, source(spark, [("a", "x")]), run_at(5))
    older = scd2.apply_changes(table, source(spark, [("a", "w"), ("b", "w")]), run_at(3))
    assert sorted((r[KEY], r._record_hash, r.IsCurrent) for r in older.collect()) == [("a", "x", True), ("b", "w", True)]


full_loads = st.lists(st.dictionaries(st.sampled_from("abc"), st.sampled_from("xy")), min_size=1, max_size=4)


@quick
@given(loads=full_loads)
def test_full_deliveries_close_and_reopen(spark, run_at, loads):
    table, expected = None, {}
    for day, hashes in enumerate(loads, 1):
        table = scd2.apply_changes(table, source(spark, list(hashes.items())), run_at(day), close_absent=True)
        now = run_at(day)
        for key in {*hashes, *expected}:
            versions = expected.setdefault(key, [])
            is_open = versions and versions[-1][3] is None
            if is_open and hashes.get(key) == versions[-1][1]:
                continue
            if is_open:
                versions[-1] = (*versions[-1][:3], now.batch_id)
            if key in hashes:
                versions.append((len(versions) + 1, hashes[key], now.batch_id, None))
    again = scd2.apply_changes(table, source(spark, list(loads[-1].items())), run_at(len(loads) + 1), close_absent=True)
    found = {}
    for r in again.collect():
        found.setdefault(r[KEY], []).append((r.Version, r._record_hash, r._audit_insert_batch, r._audit_update_batch))
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in expected.items() if v}


def test_columns_and_types_of_a_later_load_reach_the_dimension(spark, run_at):
    one = source(spark, [("a", "x"), ("b", "x")]).withColumn("points", F.lit(3))
    two = source(spark, [("a", "y")]).withColumns({"points": F.lit(2**40), "level": F.lit("gold")})
    table = scd2.apply_changes(scd2.apply_changes(None, one, run_at(1)), two, run_at(2))
    rows = {(r[KEY], r.Version): (r.points, r.level) for r in table.collect()}
    assert rows == {("a", 1): (3, None), ("a", 2): (2**40, "gold"), ("b", 1): (3, None)}
    assert dict(table.dtypes)["points"] == "bigint"
    back = scd2.apply_changes(table, one.drop("points"), run_at(3))
    assert {(r[KEY], r.Version): r.points for r in back.collect()}[("a", 3)] is None


# --- Join as of a date ------------------------------------------------------------------------


def dimension(spark, rows):
    data = [(k, c, at(a) if a is not None else None, at(b) if b is not None else None) for k, c, a, b in rows]
    return spark.createDataFrame(data, f"{KEY} string, customer_city string, EffectiveStartDate timestamp, EffectiveEndDate timestamp")


versions = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60)), max_size=8, unique=True)
facts = st.lists(st.tuples(st.sampled_from(["a", "b", "q", None]), st.one_of(st.none(), st.integers(-5, 90))), min_size=1, max_size=12)


@quick
@given(starts=versions, given_facts=facts, seconds=st.sampled_from([DAY, 7 * DAY, 400 * DAY]), gaps=st.booleans())
def test_as_of_against_a_loop(spark, starts, given_facts, seconds, gaps):
    rows = []
    for key in "ab":
        days = sorted(d for k, d in starts if k == key)
        for i, day in enumerate(days):
            after = days[i + 1] if i + 1 < len(days) else None
            if gaps and i % 2:
                after = min(after, day + 3) if after is not None else day + 3
            rows.append((key, f"{key}{day}", day, after))
    df = spark.createDataFrame([(i, k, at(d) if d is not None else None) for i, (k, d) in enumerate(given_facts)], "id int, customer string, t timestamp")
    found = {r.id: (r.customer_city, r.in_dimension) for r in join_as_of(df, dimension(spark, rows), "customer", "t", seconds=seconds).collect()}
    expected = {}
    for i, (key, day) in enumerate(given_facts):
        hits = [c for k, c, a, b in rows if k == key and day is not None and a <= day and (b is None or day < b)]
        expected[i] = (hits[0], True) if hits else (None, False)
    assert found == expected


def test_as_of_plan_and_a_hot_customer(spark):
    """No range join; a customer with a third of the facts is split into its chunks, and a hot chunk by the join."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 600).cast("string"))
    time = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    facts = spark.range(60000).select("id", hot.alias("customer"), time.alias("t"), F.md5(hot).alias("note"))
    held = spark.range(600).select(
        F.col("id").cast("string").alias(KEY), F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_city"),
        F.timestamp_seconds(F.lit(1_699_000_000)).alias("EffectiveStartDate"), F.lit(None).cast("timestamp").alias("EffectiveEndDate"),
    )
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
        result = join_as_of(facts, held, "customer", "t")
        plan = result._jdf.queryExecution().executedPlan().toString()
        rows = result.select("id", "customer", "customer_city").collect()
        whole = join_as_of(facts, held, "customer", "t", seconds=10**9).select("id", "note", "customer_city")
        assert len(whole.collect()) == 60000
        split = whole._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
    assert len(rows) == len({r.id for r in rows}) == 60000 and all(r.customer_city == "c" + r.customer for r in rows)
    assert "skew=true" in split


def test_as_of_is_dealt_out_once(spark):
    """Facts and versions go by key together; nothing is made per key and chunk."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.createDataFrame([(1, "a", at(3), "n"), (2, None, at(3), "n")], "id int, customer string, t timestamp, note string")
        result = join_as_of(facts, dimension(spark, [("a", "x", 1, None)]), "customer", "t")
        assert shuffles(result) == 1
        assert {r.id: r.customer_city for r in result.collect()} == {1: "x", 2: None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_as_of_gives_the_same_for_crowded_keys_and_other_types(spark):
    random.seed(7)
    facts = [(i, random.choice([1] * 200 + [None] * 200 + [*range(2, 42)]), random.choice([None, *range(100)])) for i in range(1500)]
    held = [(k, f"{k}-{d}", at(d), at(e) if e else None) for k in range(41) for d, e in ((0, 20), (20, 50), (60, None), (60, 90))]
    df = spark.createDataFrame([(i, k, at(d) if d is not None else None) for i, k, d in facts], "id int, customer int, t timestamp")
    for kind in ("int", "bigint"):
        versions = spark.createDataFrame(held, f"{KEY} {kind}, customer_city string, EffectiveStartDate timestamp, EffectiveEndDate timestamp")
        whole, split = (join_as_of(df, versions, "customer", "t", crowd=crowd) for crowd in (10**6, 50))
        assert shuffles(split) > shuffles(whole) == 1 and dict(whole.dtypes)["customer"] == "int"
        assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
        assert whole.count() == 1500
