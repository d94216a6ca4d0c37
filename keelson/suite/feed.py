"""A customer feed derived from the ``customer`` and ``orders`` tables.

``customer`` is the master delivery, one row per customer, a file per segment. Every order is a later delivery of
the customer's record as given with that order, in yearly files and two batches; an urgent open
order is a guest, a customer the master does not know. So keys repeat, change, stay, and appear,
over all rows of both tables. The expressions are SQL that Spark and DuckDB both read.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from keelson.spec import REGIONS, Run

#: The codes of the fixed table end to end, as both engines can cut them by number.
_STATES = [code for codes in REGIONS.values() for code in codes]
CODES = "".join(_STATES)

MASTER_BATCH = "19941231000000"
FIRST_ORDERS_BATCH = "19980701000000"
LAST_ORDERS_BATCH = "20010831000000"
CUT = "timestamp '1998-07-01 00:00:00'"

RUNS = (
    Run("run-1", MASTER_BATCH, datetime(1994, 12, 31, tzinfo=timezone.utc), "tpch"),
    Run("run-2", FIRST_ORDERS_BATCH, datetime(1998, 7, 1, tzinfo=timezone.utc), "tpch"),
    Run("run-3", LAST_ORDERS_BATCH, datetime(2001, 8, 31, tzinfo=timezone.utc), "tpch"),
)


def customer_key(number: str, guest: str = "false") -> str:
    """Ids are 32 hex digits, as such feeds have them."""
    return f"md5(concat(case when {guest} then 'guest ' else 'customer ' end, cast({number} as string)))"


ORDER_IS_GUEST = "o_orderpriority = '1-URGENT' and o_orderstatus = 'O'"
ORDER_CUSTOMER_KEY = customer_key("o_custkey", ORDER_IS_GUEST)


def _business(row: str, customer: str, key: str, moved: str) -> dict[str, str]:
    """The five delivered columns, with gaps, bad values, padding and mixed case by row number."""
    code = f"substr('{CODES}', cast(2 * (({customer} + {moved}) % {len(_STATES)}) + 1 as int), 2)"
    return {
        "customer_id": f"case when {row} % 97 = 96 then null else {key} end",
        "customer_unique_id": (
            f"case when {row} % 89 = 88 then null"
            f" else md5(concat('person ', cast({customer} as string))) end"
        ),
        "customer_zip_code_prefix": (
            f"case when {row} % 83 = 82 then null"
            f" when {row} % 79 = 78 then concat('AB', cast({customer} as string))"
            f" else concat(' ', cast(10000 + {customer} % 9000 as string), ' ') end"
        ),
        "customer_city": (
            f"case when {row} % 71 = 70 then null"
            f" else concat('  city ', cast({customer} % 997 as string), ' ') end"
        ),
        "customer_state": (
            f"case when {row} % 73 = 72 then null when {row} % 67 = 66 then 'XYZ'"
            f" when {row} % 61 = 60 then 'ZZ' when {row} % 2 = 0 then lower({code}) else {code} end"
        ),
    }


def _audit(run: str, batch: str, created: str, ingested: str, file: str) -> dict[str, str]:
    return {
        "_pipeline_run_id": run,
        "_batch_id": batch,
        "_source_system": "'tpch'",
        "_load_type": "'INCREMENTAL'",
        "_created_at": created,
        "_ingestion_date": ingested,
        "_source_file_path": f"concat('/feed/', {file})",
        "_source_file_name": file,
    }


_EARLY = f"o_orderdate < {CUT}"

MASTER_COLUMNS = {
    **_business("c_custkey", "c_custkey", customer_key("c_custkey"), "0"),
    **_audit(
        "'run-1'",
        f"'{MASTER_BATCH}'",
        "timestamp '1994-12-31 00:00:00'",
        "date '1994-12-31'",
        "concat('customers_', lower(c_mktsegment), '.csv')",
    ),
}

ORDER_COLUMNS = {
    **_business(
        "o_orderkey",
        "o_custkey",
        ORDER_CUSTOMER_KEY,
        "case when o_orderstatus = 'P' then 1 else 0 end",
    ),
    **_audit(
        f"case when {_EARLY} then 'run-2' else 'run-3' end",
        f"case when {_EARLY} then '{FIRST_ORDERS_BATCH}' else '{LAST_ORDERS_BATCH}' end",
        "cast(o_orderdate as timestamp)",
        f"case when {_EARLY} then date '1998-07-01' else date '2001-08-31' end",
        f"concat('orders_', cast(year(o_orderdate) as string),"
        f" case when {_EARLY} then 'a' else 'b' end, '.csv')",
    ),
}


#: A further column that the master delivers as 32 bits and later files as 64.
MASTER_ACCOUNT = "cast(c_custkey as int)"
ORDER_ACCOUNT = "cast(o_custkey as bigint) * 1000 + 3000000000"


def selected(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]


FEED_SQL = (
    f"select {', '.join(selected(MASTER_COLUMNS))} from customer"
    f" union all select {', '.join(selected(ORDER_COLUMNS))} from orders"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*selected(MASTER_COLUMNS))


def order_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*selected(ORDER_COLUMNS))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master(spark, sf_dir).unionByName(order_deliveries(spark, sf_dir))


#: A delivered order as a CSV line, some damaged by their number: cut short, with a field too many, or with a
#: quote that is never closed, in the middle and at the end.
LINE = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")) + ")"
DAMAGED_LINE = f"""case when number % 53 = 5 then substr({LINE}, 1, 40)
    when number % 59 = 7 then concat({LINE}, ',more')
    when number % 61 = 11 then concat('"', {LINE})
    when number % 67 = 13 then concat({LINE}, ',"open') else {LINE} end"""
IS_DAMAGED = "(number % 53 = 5 or number % 59 = 7 or number % 61 = 11 or number % 67 = 13)"


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``drop, line`` of every order delivery."""
    rows = table(spark, sf_dir, "orders").selectExpr(*selected(ORDER_COLUMNS), "o_orderkey as number")
    return rows.selectExpr("_source_file_name as drop", f"{DAMAGED_LINE} as line")
