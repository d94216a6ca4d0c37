"""Schema evolution of stored tables, interleaved layout, co-partitioned merges."""

import glob
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.evolve import conform, merged_schema, readable_as, union_evolving, widest
from keelson.operators.layout import clustered, interleave, interleaved, rank_of
from keelson.plans import jobs
from keelson.sources.tables import BucketedTable, CopartitionedTable, FileKeyedTable, SchemaError, SnapshotTable

KINDS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2),
         T.DecimalType(30, 10), T.DateType(), T.TimestampNTZType(), T.StringType(), T.NullType(), T.BooleanType()]


def test_the_types_form_a_lattice():
    for a in KINDS:
        assert widest(a, a) == a
        for b in KINDS:
            assert widest(a, b) == widest(b, a)
            assert widest(widest(a, b), a) == widest(a, b)
            for c in KINDS:
                assert widest(widest(a, b), c) == widest(a, widest(b, c)) or T.StringType() in (
                    widest(widest(a, b), c), widest(a, widest(b, c)))


def test_widest_of_nested_types(spark):
    one = T._parse_datatype_string("a int, b array<int>, c map<string,int>, s struct<x:int>")
    two = T._parse_datatype_string("s struct<x:bigint,y:string>, a bigint, b array<double>, c map<string,bigint>, d date")
    assert merged_schema(one, two).simpleString() == (
        "struct<a:bigint,b:array<double>,c:map<string,bigint>,s:struct<x:bigint,y:string>,d:date>"
    )


def test_values_survive_widening(spark):
    rows = spark.sql("select 7 as i, cast(1.25 as decimal(5,2)) as d, named_struct('x', 1) as s, array(named_struct('x', 2)) as l, date'2024-01-02' as t")
    wide = spark.sql("select 5000000000 as i, cast(1 as decimal(20,0)) as d, named_struct('x', 1L, 'y', 'n') as s, array(named_struct('x', 2L, 'y', 'm')) as l, 'x' as t, 1 as new")
    both = union_evolving(rows, wide).orderBy("i").collect()
    assert both[0].asDict(recursive=True) == {"i": 7, "d": Decimal("1.25"), "s": {"x": 1, "y": None}, "l": [{"x": 2, "y": None}], "t": "2024-01-02", "new": None}
    assert both[1].new == 1 and both[1].s.y == "n" and both[1].i == 5000000000
    assert conform(rows.selectExpr("cast(null as struct<x:int>) as s"), T._parse_datatype_string("s struct<x:bigint,y:int>")).first().s is None


@pytest.mark.parametrize("narrow,wide", [(a, widest(a, b)) for a in KINDS[:-2] for b in KINDS[:-2] if readable_as(a, widest(a, b)) and widest(a, b) != a])
def test_what_counts_as_readable_is(spark, tmp_path, narrow, wide):
    literal = "date'2024-01-02'" if isinstance(narrow, T.DateType) else "7"
    spark.range(1).select(F.expr(literal).cast(narrow).alias("x")).write.parquet(str(tmp_path / "t"))
    read = spark.read.schema(T.StructType([T.StructField("x", wide)])).parquet(str(tmp_path / "t"))
    assert read.first().x == spark.range(1).select(F.expr(literal).cast(narrow).cast(wide)).first()[0]


FIRST = "k string, h string, f string, n int"


def loads(spark):
    one = spark.createDataFrame([("a", "1", "p", 1), ("b", "1", "p", 2)], FIRST)
    two = spark.createDataFrame([("a", "2", "q", 2**40, "x"), ("c", "1", "q", 5, "y")], "k string, h string, f string, n bigint, extra string")
    return one, two


def tables(spark, root, schema):
    return {
        "snapshot": SnapshotTable(spark, f"{root}/s", schema),
        "bucketed": BucketedTable(spark, f"{root}/b", schema, "k", 4),
        "file keyed": FileKeyedTable(spark, f"{root}/f", schema, "f"),
        "copartitioned": CopartitionedTable(spark, f"t_{abs(hash(root))}", schema, "k", 4, f"{root}/c"),
    }


def test_all_tables_take_new_columns_and_wider_types(spark, tmp_path):
    from keelson.operators.upsert import upsert

    one, two = loads(spark)
    for name, table in tables(spark, str(tmp_path), one.schema).items():
        if name == "file keyed":
            table.replace(one, ["p"])
            table.replace(two, ["q"])
        else:
            for rows in (one, two):
                first = not table.exists()
                table.merge(rows, lambda old, new: new if first else upsert(old, new, "k", "h", unique_source=True))
        found = sorted((tuple(r) for r in table.read().select("k", "n", "extra").collect()), key=str)
        expected = [("a", 2**40, "x"), ("b", 2, None), ("c", 5, "y")] + [("a", 1, None)] * (name == "file keyed")
        assert found == sorted(expected, key=str), name
        assert dict(table.read().dtypes)["n"] == "bigint"


def test_a_file_replaced_after_the_change_keeps_the_columns(spark, tmp_path):
    one, two = loads(spark)
    table = FileKeyedTable(spark, str(tmp_path / "t"), one.schema, "f")
    table.replace(one, ["p"])
    table.replace(two, ["q"])
    table.replace(one.limit(0), ["q"])
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", "1", "p", 1, None), ("b", "1", "p", 2, None)]


def test_a_change_the_files_cannot_follow_is_refused_until_rewritten(spark, tmp_path):
    one, _ = loads(spark)
    text = one.withColumn("n", F.lit("seven"))
    for table in (FileKeyedTable(spark, str(tmp_path / "f"), one.schema, "f"), BucketedTable(spark, str(tmp_path / "b"), one.schema, "k", 2)):
        put = table.overwrite if isinstance(table, FileKeyedTable) else lambda rows: table.merge(rows, lambda _, new: new)
        put(one)
        with pytest.raises(SchemaError, match="rewrite"):
            put(text)
        assert sorted(r.n for r in table.read().collect()) == [1, 2]
        table.rewrite(text.schema)
        assert sorted(r.n for r in table.read().collect()) == ["1", "2"]
        put(text)
        assert {r.n for r in table.read().collect()} == {"seven"}


def test_a_new_source_column_survives_to_the_dimension(spark, tmp_path, run_at):
    from dataclasses import replace

    from keelson.spec import CUSTOMER_CONTRACT

    tables = jobs.Tables.under(spark, str(tmp_path / "lake"), buckets=2)
    contract = replace(CUSTOMER_CONTRACT, keep_extra=True)
    (tmp_path / "a.csv").write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n1,u,123,x,SP\n2,u,123,x,SP\n")
    (tmp_path / "b.csv").write_text("tier,customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\ngold,1,u,999,x,SP\n")
    for day, name in ((1, "a.csv"), (2, "b.csv")):
        jobs.ingest(spark, [str(tmp_path / name)], tables, run_at(day), contract)
        jobs.clean(tables, run_at(day))
        jobs.build_dimension(tables, run_at(day))
    rows = {(r.BusinessKey_CustomerID, r.Version): r.tier for r in tables.gold.read().collect()}
    assert rows == {("1", 1): None, ("1", 2): "gold", ("2", 1): None}


# --- Layout -----------------------------------------------------------------------------------


def test_ranks_and_interleaved_bits(spark):
    cuts = ["b", "d", "f"]
    rows = spark.createDataFrame([(x,) for x in "abcdefg"] + [(None,)], "x string")
    assert [r[0] for r in rows.select(rank_of("x", cuts)).collect()] == [0, 1, 1, 2, 2, 3, 3, 0]
    a, b = 0b101, 0b11
    z = spark.range(1).select(interleave([F.lit(a), F.lit(b)], [3, 2])).first()[0]
    assert z == 0b11011  # a2 b1 a1 b0 a0


def skipped(folder, column, value) -> tuple[int, int]:
    """Files whose min and max exclude the value, and all files."""
    out = total = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        total += 1
        out += all(value < s.min or value > s.max for s in stats)
    return out, total


def test_each_column_alone_skips_files(spark, tmp_path):
    rows = spark.range(40000).select(
        F.col("id"), (F.xxhash64("id") % 27).cast("string").alias("state"),
        F.when(F.col("id") % 3 == 0, F.lit(10)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50))).alias("zip"),
    )
    interleaved(rows, ["state", "zip"], ["id"], files=16).write.parquet(str(tmp_path / "z"))
    clustered(rows, ["state", "zip"], ["id"], files=16).write.parquet(str(tmp_path / "l"))
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    for column, value in (("state", "5"), ("zip", 40)):
        out, total = skipped(tmp_path / "z", column, value)
        assert total == 16 and out >= 8, (column, out)
    assert skipped(tmp_path / "l", "zip", 40)[0] <= 2


def test_interleaved_region_and_state_of_the_feed(spark, sf_dir, tmp_path):
    from keelson.suite.queries import _source

    rows = _source(spark, sf_dir, 3)
    interleaved(rows, ["customer_region", "customer_state"], ["customer_id"], files=16).write.parquet(str(tmp_path / "t"))
    for column, value in (("customer_region", "Norte"), ("customer_state", "SP")):
        assert skipped(tmp_path / "t", column, value)[0] >= 6
    empty = interleaved(rows.limit(0), ["customer_region", "customer_state"], files=2)
    assert empty.collect() == [] and empty.columns == rows.columns


def test_a_copartitioned_target_is_not_moved(spark, tmp_path):
    from keelson.operators.upsert import upsert

    schema = T._parse_datatype_string("k string, h string, n bigint")
    table = CopartitionedTable(spark, "plan_target", schema, "k", 4, str(tmp_path / "t"))
    rows = spark.range(100).selectExpr("cast(id as string) as k", "'1' as h", "id as n")
    table.merge(rows, lambda _, new: new)
    load = spark.range(50, 150).selectExpr("cast(id as string) as k", "'2' as h", "id + 1000 as n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = upsert(table.read(), load.repartition(4, "k"), "k", "h", unique_source=True)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("SortMergeJoin") : ]
        target = side[: side.index("plan_target")] if "plan_target" in side else side
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
        assert "Exchange" not in target
        table.merge(load, lambda old, new: upsert(old, new, "k", "h", unique_source=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = {r.k: r.n for r in table.read().collect()}
    assert found == {str(i): (i if i < 50 else i + 1000) for i in range(150)}
    assert spark.table("plan_target").count() == 150
