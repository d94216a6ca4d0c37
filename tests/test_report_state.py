"""Reports over summed state against the reports over all rows, load by load."""

from keelson.operators import profile, report_state
from keelson.sources.tables import FileKeyedTable
from keelson.spec import BRONZE_SCHEMA

PAIRS = [
    (report_state.load_profile, profile.load_profile), (report_state.null_profile, profile.null_profile),
    (report_state.duplicate_keys, profile.duplicate_keys), (report_state.top_values, profile.top_values),
    (report_state.bad_formats, profile.bad_formats), (report_state.lineage, profile.lineage),
    (report_state.batch_file_counts, profile.batch_file_counts),
]


def rows(df):
    return [tuple(r) for r in df.collect()], df.columns


def test_reports_follow_every_load(spark, tmp_path, raw_rows):
    bronze = FileKeyedTable(spark, str(tmp_path / "b"), BRONZE_SCHEMA)
    state = FileKeyedTable(spark, str(tmp_path / "s"), report_state.STATE_SCHEMA)
    loads = [
        (["a.csv"], raw_rows(("1", "u", "12", "x", "SP"), ("1", None, "AB", "x", "SP"), (None, "u", None, None, None))),
        (["b.csv", "c.csv"], raw_rows(("1", "u", "AB", "x", "RJ", 1, "b.csv"), ("2", "u", "99", "x", "SP", 2, "b.csv"))),
        (["a.csv"], raw_rows(("7", "u", "zz", "x", None, 3))),  # delivered again with other rows
        (["b.csv"], raw_rows(("7", "u", "zz", "x", None, 3)).limit(0)),  # and now without rows
    ]
    for names, load in loads:
        bronze.replace(load, names)
        state.replace(report_state.summarise(load), names)
        for mine, whole in PAIRS:
            assert rows(mine(state.read())) == rows(whole(bronze.read())), mine.__name__


def test_state_of_nothing(spark):
    empty = spark.createDataFrame([], BRONZE_SCHEMA)
    state = report_state.summarise(empty)
    assert state.collect() == [] and [f.name for f in state.schema] == report_state.STATE_SCHEMA.fieldNames()
    for mine, whole in PAIRS:
        if mine is not report_state.top_values:
            assert rows(mine(state)) == rows(whole(empty)), mine.__name__


def test_state_is_one_shuffle(spark, raw_rows):
    plan = report_state.summarise(raw_rows(("1", "u", "12", "x", "SP")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
