import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keelson.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions=4,
        spark__default__parallelism=4,
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def run_at():
    """A run by its day in January 2024."""
    from datetime import datetime, timezone

    from keelson.spec import Run

    def at(day: int) -> Run:
        as_of = datetime(2024, 1, day, tzinfo=timezone.utc)
        return Run(f"run-{day}", f"{as_of:%Y%m%d}000000", as_of, "shop")

    return at


@pytest.fixture
def raw_rows(spark):
    """Bronze rows from (id, unique id, zip, city, state[, created day[, file]])."""
    from datetime import date, datetime, timezone

    from keelson.spec import BRONZE_SCHEMA

    def build(*rows):
        full = []
        for row in rows:
            business, rest = row[:5], row[5:]
            day = rest[0] if rest else 1
            file = rest[1] if len(rest) > 1 else "a.csv"
            created = datetime(2024, 1, day, tzinfo=timezone.utc)
            full.append(
                (*business, "r", f"2024010{day}", "shop", "FULL", created, date(2024, 1, day), file, file)
            )
        return spark.createDataFrame(full, BRONZE_SCHEMA)

    return build
