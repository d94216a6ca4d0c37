"""Deliveries that hold earlier files: what is read, what is replaced."""

import os

import pytest

from keelson.plans.jobs import Tables, ingest_new
from keelson.sources import ledger
from keelson.sources.contract import ContractError

HEADER = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return path


@pytest.fixture
def tables(spark, tmp_path):
    return Tables.under(spark, str(tmp_path / "lake"))


def lines(*ids):
    return HEADER + "".join(f"{i},u,10,x,SP\n" for i in ids)


def states(df):
    return {r.source: r.state for r in df.collect()}


def held(tables):
    return sorted((r._source_file_name, r.customer_id, r._batch_id) for r in tables.bronze.read().collect())


def test_only_new_and_changed_files_are_ingested(spark, folder, tables, run_at):
    (folder / "a.csv").write_text(lines(1, 2))
    (folder / "b.csv").write_text(lines(3))
    assert states(ingest_new(spark, [str(folder)], tables, run_at(1))) == {"a.csv": "new", "b.csv": "new"}
    (folder / "b.csv").write_text(lines(4, 5))
    (folder / "c [1]{x} %41+.csv").write_text(lines(6))
    found = states(ingest_new(spark, [str(folder)], tables, run_at(2)))
    assert found == {"a.csv": "unchanged", "b.csv": "changed", "c [1]{x} %41+.csv": "new"}
    first, second = run_at(1).batch_id, run_at(2).batch_id
    expected = [("a.csv", "1", first), ("a.csv", "2", first), ("b.csv", "4", second), ("b.csv", "5", second)]
    assert held(tables) == [*expected, ("c [1]{x} %41+.csv", "6", second)]
    rows = {r.source: (r.rows, r.batch_id) for r in tables.ledger.read().collect()}
    assert rows == {"a.csv": (2, first), "b.csv": (2, second), "c [1]{x} %41+.csv": (1, second)}


def test_an_unchanged_listing_is_not_read(spark, folder, tables, run_at):
    path = folder / "a.csv"
    path.write_text(lines(1))
    ingest_new(spark, [str(folder)], tables, run_at(1))
    times = os.stat(path)
    # As long, with the same time, and no longer a file that could be ingested.
    path.write_bytes(b"\xff" * times.st_size)
    os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    assert states(ingest_new(spark, [str(folder)], tables, run_at(2))) == {"a.csv": "unchanged"}
    assert held(tables) == [("a.csv", "1", run_at(1).batch_id)]
    plan = ledger.listed(spark, [str(folder)])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_a_copied_file_is_noted_but_not_ingested(spark, folder, tables, run_at):
    path = folder / "a.csv"
    path.write_text(lines(1, 2))
    ingest_new(spark, [str(folder)], tables, run_at(1))
    os.utime(path, (1, 1))
    assert states(ingest_new(spark, [str(folder)], tables, run_at(2))) == {"a.csv": "same"}
    assert {b for _, _, b in held(tables)} == {run_at(1).batch_id}
    assert states(ingest_new(spark, [str(folder)], tables, run_at(3))) == {"a.csv": "unchanged"}
    # As long and with the same lines, but another header: not the same content.
    text = path.read_text().splitlines(keepends=True)
    path.write_text("".join([text[1], text[0], text[2]]))
    with pytest.raises(ContractError, match="missing"):
        ingest_new(spark, [str(folder)], tables, run_at(4))
    assert {b for _, _, b in held(tables)} == {run_at(1).batch_id}


def test_folders_of_part_files(spark, folder, tables, run_at):
    for drop, part, ids in (("d1", "p0", (1,)), ("d1", "p1", (2,)), ("d2", "p0", (3,))):
        (folder / drop).mkdir(exist_ok=True)
        (folder / drop / f"{part}.csv").write_text(lines(*ids))
    assert set(states(ingest_new(spark, [str(folder)], tables, run_at(1), name_from="folder"))) == {"d1", "d2"}
    (folder / "d1" / "p2.csv").write_text(lines(4))
    found = states(ingest_new(spark, [str(folder)], tables, run_at(2), name_from="folder"))
    assert found == {"d1": "changed", "d2": "unchanged"}
    assert [(f, i) for f, i, _ in held(tables)] == [("d1", "1"), ("d1", "2"), ("d1", "4"), ("d2", "3")]


def test_a_file_that_lost_its_rows_is_cleared(spark, folder, tables, run_at):
    (folder / "a.csv").write_text(lines(1))
    ingest_new(spark, [str(folder)], tables, run_at(1))
    (folder / "a.csv").write_text(HEADER)
    assert states(ingest_new(spark, [str(folder)], tables, run_at(2))) == {"a.csv": "changed"}
    assert held(tables) == []


@pytest.mark.parametrize("text, problem", [("", "empty"), ("\n\n", "empty"), ("a;b\n", "delimiter"), ("a,b\n", "missing")])
def test_one_bad_file_stops_the_delivery(spark, folder, tables, run_at, text, problem):
    (folder / "a.csv").write_text(lines(1))
    (folder / "b.csv").write_text(text)
    with pytest.raises(ContractError, match=f"b.csv: .*{problem}"):
        ingest_new(spark, [str(folder)], tables, run_at(1))
    assert not tables.bronze.exists() and not tables.ledger.exists()


def test_a_run_that_died_before_the_ledger_is_repeated(spark, folder, tables, run_at, monkeypatch):
    (folder / "a.csv").write_text(lines(1))
    with monkeypatch.context() as broken:
        broken.setattr(type(tables.ledger), "publish", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            ingest_new(spark, [str(folder)], tables, run_at(1))
    assert states(ingest_new(spark, [str(folder)], tables, run_at(1))) == {"a.csv": "new"}
    assert held(tables) == [("a.csv", "1", run_at(1).batch_id)]


def test_many_drops_take_few_jobs(spark, folder, tables, run_at):
    for n in range(300):
        (folder / f"{n}.csv").write_text(lines(n))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ledger", "many drops")
    try:
        ingest_new(spark, [str(folder)], tables, run_at(1))
        jobs = len(status.getJobIdsForGroup("ledger"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tables.bronze.read().count() == 300 and jobs < 60
