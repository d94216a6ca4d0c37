"""Malformed rows keep their text and reach the quarantine."""

from dataclasses import replace

import pytest

from keelson.operators.cleanse import prepare, quarantined_rows, valid_rows
from keelson.sources.contract import ContractError
from keelson.sources.csv_feed import read_drops
from keelson.spec import CUSTOMER_CONTRACT, CUSTOMER_SPEC, RESCUE_RULE

HEADER = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
CONTRACT = replace(CUSTOMER_CONTRACT, rescue=True)
BAD = ["4,u", "5,u,1,x,SP,more", '6,u,"1,x,SP', '7,u,1,x,"SP', '"']
GOOD = ['1,u,12,"x, y",SP', '2,u,12," say ""hi"" ",SP', '3,u,,"",SP', ",,,,"]


def test_every_line_is_accounted_for(spark, tmp_path, run_at):
    (tmp_path / "a.csv").write_text(HEADER + "\n".join([*GOOD, "", *BAD]) + "\n")
    (tmp_path / "b.csv").write_text('"customer_state", customer_id,customer_city,customer_unique_id,customer_zip_code_prefix\nSP,9,x,u,7\nSP,9\n')
    rows = read_drops(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], CONTRACT, run_at(1))
    found = rows.collect()
    assert sorted(r._rescued_row for r in found if r._rescued_row) == sorted([*BAD, "SP,9"])
    kept = sorted((tuple(r)[:5] for r in found if not r._rescued_row), key=str)
    plain = read_drops(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], CUSTOMER_CONTRACT, run_at(1))
    expected = [tuple(r)[:5] for r in plain.collect() if r.customer_id not in ("4", "5", "6", "7") and tuple(r)[:5] != ("9", None, None, None, "SP")]
    assert kept == sorted((e for e in expected if e in kept), key=str) and len(kept) == len(GOOD) + 1
    spec = replace(CUSTOMER_SPEC, rules={**RESCUE_RULE, **CUSTOMER_SPEC.rules})
    prepared = prepare(rows, spec)
    rejected = quarantined_rows(prepared, spec, run_at(1)).collect()
    assert len(rejected) + valid_rows(prepared, spec, run_at(1)).count() == len(GOOD) + len(BAD) + 2
    assert all(r._dq_error_reason.startswith("DQ-00") == (r._rescued_row is not None) for r in rejected)


def test_a_part_file_with_another_header_fails(spark, tmp_path, run_at):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "p0.csv").write_text(HEADER + "1,u,1,x,SP\n")
    (folder / "p1.csv").write_text("customer_state,customer_city,customer_zip_code_prefix,customer_unique_id,customer_id\nSP,x,1,u,2\n")
    with pytest.raises(ContractError, match="header"):
        read_drops(spark, [str(folder)], CONTRACT, run_at(1), name_from="folder")


def test_header_only_and_repeated_headers(spark, tmp_path, run_at):
    (tmp_path / "a.csv").write_text(HEADER)
    (tmp_path / "b.csv").write_text(HEADER + "1,u,1,x,SP\n" + HEADER)
    rows = read_drops(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], CONTRACT, run_at(1))
    assert [r.customer_id for r in rows.collect()] == ["1"]
