import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from raw_data import NOW, history_ddl  # noqa: E402
from tidemark.schemas import FEATURES, RAW_SUPPORT_TICKETS, RAW_TRANSACTIONS, RAW_USERS  # noqa: E402
from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_raw(spark):
    """Raw tables from short tuples: users (id, signup, plan), transactions (user, amount, status,
    time), tickets (user, resolved, time)."""

    def make(users=(), transactions=(), tickets=()):
        return (
            spark.createDataFrame([(u, s, "US", p, "25-34", NOW) for u, s, p in users], RAW_USERS),
            spark.createDataFrame(
                [(i, u, float(a), "one-time", s, t) for i, (u, a, s, t) in enumerate(transactions)], RAW_TRANSACTIONS
            ),
            spark.createDataFrame(
                [(i, u, "low", r, t) for i, (u, r, t) in enumerate(tickets)], RAW_SUPPORT_TICKETS
            ),
        )

    return make


@pytest.fixture
def windows_raw(make_raw):
    """One user with three successes in the last week and a failure 20 days ago."""
    day = timedelta(days=1)
    return make_raw(
        [(1, datetime(2024, 1, 1).date(), "pro")],
        [
            (1, 100.0, "success", NOW - day),
            (1, 50.0, "success", NOW - 3 * day),
            (1, 25.0, "success", NOW - 6 * day),
            (1, 10.0, "failed", NOW - 20 * day),
        ],
    )


@pytest.fixture
def make_history(spark):
    """History rows from (entity, time, values) with all features 1.0 unless named in values."""

    def make(rows, version="v1"):
        full = [
            (e, "user", version, t, *[v.get(c, 1.0) for c in FEATURES])
            for e, t, v in rows
        ]
        return spark.createDataFrame(full, history_ddl())

    return make
