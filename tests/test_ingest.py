import pytest

from keelson.plans.jobs import Tables, ingest
from keelson.sources.contract import ContractError, feed_report
from keelson.sources.csv_feed import read_drops
from keelson.spec import BRONZE_SCHEMA, CUSTOMER_CONTRACT

HEADER = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"


@pytest.fixture
def drop(tmp_path):
    def write(name, text):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def business(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "text, problem",
    [
        ("", "empty"),
        (HEADER.replace(",", ";") + "1;2;3;4;5\n", "delimiter"),
        ("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city\n", "customer_state"),
        (HEADER.replace("customer_id", "Customer_ID"), r"missing columns \['customer_id'\]"),
    ],
)
def test_contract_breaches_stop_the_ingest(spark, drop, run_at, tmp_path, text, problem):
    good, bad = drop("good.csv", HEADER + "1,u,1,x,SP\n"), drop("bad.csv", text)
    tables = Tables.under(spark, str(tmp_path / "lake"))
    with pytest.raises(ContractError, match=problem):
        ingest(spark, [good, bad], tables, run_at(1))
    assert not tables.bronze.exists()


def test_quotes_gaps_short_and_long_rows(spark, drop, run_at):
    path = drop(
        "a.csv",
        HEADER + '1,u,12,"x, y",SP\n2,u,12," say ""hi"" ",SP\n3,u,,"",SP\n4,u\n5,u,1,x,SP,more\n',
    )
    assert business(read_drops(spark, [path], CUSTOMER_CONTRACT, run_at(1))) == [
        ("1", "u", "12", "x, y", "SP"),
        ("2", "u", "12", ' say "hi" ', "SP"),
        ("3", "u", None, None, "SP"),
        ("4", "u", None, None, None),
        ("5", "u", "1", "x", "SP"),
    ]


def test_any_column_order_and_extra_columns(spark, drop, run_at):
    paths = [
        drop("a.csv", HEADER + "1,u,10,x,SP\n"),
        drop("b.csv", '"customer_state", customer_id,more,customer_city,customer_unique_id,'
             "customer_zip_code_prefix\nRJ,2,m,y,v,20\n"),
    ]
    rows = read_drops(spark, paths, CUSTOMER_CONTRACT, run_at(1))
    assert business(rows) == [("1", "u", "10", "x", "SP"), ("2", "v", "20", "y", "RJ")]


def test_part_file_with_another_order_is_not_shifted(spark, drop, run_at):
    drop("d/part-0.csv", HEADER + "1,u,10,x,SP\n" * 50)
    drop("d/part-1.csv", "customer_state,customer_unique_id,customer_zip_code_prefix,customer_city,"
         "customer_id\nSP,u,10,x,1\n")  # fmt: skip
    folder = drop("d/part-2.csv", HEADER).rsplit("/", 1)[0]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_drops(spark, [folder], CUSTOMER_CONTRACT, run_at(1)).collect()


NAMES = ["a b.csv", "a+b.csv", "it's.csv", "100%25.csv", "20240101", "x=y,z.csv", "ção.csv"]


def test_odd_file_names_survive_and_are_replaced(spark, drop, run_at, tmp_path):
    paths = [drop(name, HEADER + f"{i},u,1,x,SP\n") for i, name in enumerate(NAMES)]
    tables = Tables.under(spark, str(tmp_path / "lake"))
    for day in (1, 2):
        count = ingest(spark, paths, tables, run_at(day))
        assert count.first().inserted_rows == len(NAMES)
    rows = tables.bronze.read().collect()
    assert sorted(r._source_file_name for r in rows) == sorted(NAMES)
    assert {r._pipeline_run_id for r in rows} == {"run-2"}
    assert sorted(r._source_file_path for r in rows) == sorted(f"file:{p}" for p in paths)


def test_audit_columns(spark, drop, run_at, tmp_path):
    tables = Tables.under(spark, str(tmp_path / "lake"))
    ingest(spark, [drop("a.csv", HEADER + "1,u,1,x,SP\n")], tables, run_at(5))
    row = tables.bronze.read().first()
    assert tables.bronze.read().schema == BRONZE_SCHEMA
    assert row[5:9] == ("run-5", "20240105000000", "shop", "INCREMENTAL")
    assert str(row._created_at) == "2024-01-05 00:00:00"
    assert str(row._ingestion_date) == "2024-01-05"


def test_reingesting_replaces_only_that_file(spark, drop, run_at, tmp_path):
    tables = Tables.under(spark, str(tmp_path / "lake"))
    a, b = drop("a.csv", HEADER + "1,u,1,x,SP\n2,u,1,x,SP\n"), drop("b.csv", HEADER + "3,u,1,x,SP\n")
    ingest(spark, [a, b], tables, run_at(1))
    drop("a.csv", HEADER + "9,u,1,x,SP\n")
    ingest(spark, [a], tables, run_at(2))
    assert sorted(r.customer_id for r in tables.bronze.read().collect()) == ["3", "9"]


def test_file_that_became_empty_of_rows_is_cleared(spark, drop, run_at, tmp_path):
    tables = Tables.under(spark, str(tmp_path / "lake"))
    a, b = drop("a.csv", HEADER + "1,u,1,x,SP\n"), drop("b.csv", HEADER + "3,u,1,x,SP\n")
    ingest(spark, [a, b], tables, run_at(1))
    drop("a.csv", HEADER)
    assert ingest(spark, [a, b], tables, run_at(2)).first().inserted_rows == 1
    assert [r.customer_id for r in tables.bronze.read().collect()] == ["3"]
    assert ingest(spark, [a], tables, run_at(3)).first().inserted_rows == 0
    drop("a.csv", HEADER + "7,u,1,x,SP\n")
    ingest(spark, [a], tables, run_at(4))
    assert sorted(r.customer_id for r in tables.bronze.read().collect()) == ["3", "7"]


def test_first_ingest_of_a_header_only_file(spark, drop, run_at, tmp_path):
    tables = Tables.under(spark, str(tmp_path / "lake"))
    assert ingest(spark, [drop("a.csv", HEADER)], tables, run_at(1)).first().inserted_rows == 0


def test_same_name_in_two_folders(spark, drop, run_at, tmp_path):
    one, two = drop("x/a.csv", HEADER + "1,u,1,x,SP\n"), drop("y/a.csv", HEADER + "2,u,1,x,SP\n")
    by_name = Tables.under(spark, str(tmp_path / "by_name"))
    by_path = Tables.under(spark, str(tmp_path / "by_path"), replace_key="_source_file_path")
    for tables in (by_name, by_path):
        ingest(spark, [one], tables, run_at(1))
        ingest(spark, [two], tables, run_at(2))
    assert [r.customer_id for r in by_name.bronze.read().collect()] == ["2"]
    assert sorted(r.customer_id for r in by_path.bronze.read().collect()) == ["1", "2"]


def test_report_lists_every_file(spark, drop):
    bodies = {
        "ok.csv": HEADER + "1,u,1,x,SP\n",
        "empty.csv": "",
        "header only.csv": HEADER,
        "semi.csv": HEADER.replace(",", ";"),
        "short.csv": "customer_id, customer_city\n",
        "extra.csv": "more," + HEADER,
    }
    paths = [drop(name, text) for name, text in bodies.items()]
    report = {
        r.file_path.split("/")[-1]: r for r in feed_report(spark, paths, CUSTOMER_CONTRACT).collect()
    }
    assert set(report) == set(bodies)
    valid = {name for name, r in report.items() if r.is_valid}
    assert valid == {"ok.csv", "header only.csv", "extra.csv"}
    assert report["extra.csv"].extra_columns == "more"
    assert report["empty.csv"].is_empty and not report["semi.csv"].has_delimiter
    assert (
        report["short.csv"].missing_columns
        == "customer_unique_id,customer_zip_code_prefix,customer_state"
    )
