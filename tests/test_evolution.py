"""Stored tables keep new columns, and settings of the session change no result."""

from datetime import date, datetime, timezone

import pytest

from keelson.operators.profile import top_values
from keelson.sources.contract import ContractError, checked_headers
from keelson.sources.csv_feed import stamped
from keelson.sources.tables import SnapshotTable
from keelson.spec import CUSTOMER_SPEC, Run


def test_a_snapshot_table_keeps_new_columns(spark, tmp_path):
    first = spark.createDataFrame([("a", "1")], "k string, h string")
    table = SnapshotTable(spark, str(tmp_path / "t"), first.schema)
    table.publish(first)
    source = spark.createDataFrame([("b", "2", 7)], "k string, h string, extra int")
    table.merge(source, lambda old, new: old.unionByName(new, allowMissingColumns=True))
    assert {tuple(r) for r in table.read().collect()} == {("a", "1", None), ("b", "2", 7)}
    table.publish(table.read())
    assert table.read().columns == ["k", "h", "extra"]


def test_no_drops_is_a_contract_error(spark):
    with pytest.raises(ContractError):
        checked_headers(spark, [], CUSTOMER_SPEC)


def test_ingestion_date_is_the_utc_day(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        rows = spark.createDataFrame([("file:/in/a.csv",)], "_encoded_path string")
        as_of = datetime(2024, 1, 5, 1, tzinfo=timezone.utc)
        assert stamped(rows, Run("r", "b", as_of, "shop")).first()["_ingestion_date"] == date(2024, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_top_values_reads_its_rows_once(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    found = top_values(rows, "c_mktsegment", 3)
    assert found.count() == 3 and 0 < sum(r["pct"] for r in found.collect()) <= 100
