import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from foliant.session import discard_written, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    discard_written(session)


@pytest.fixture
def cells_of(spark):
    """Cells from (row_key, column, value[, day]) with column ``family:qualifier``."""
    import datetime as dt

    def make(*rows):
        full = []
        for row in rows:
            key, column, value = row[:3]
            day = row[3] if len(row) > 3 else 1
            family, _, qualifier = column.partition(":")
            full.append((key, family, qualifier, dt.datetime(2024, 1, day), value))
        return spark.createDataFrame(full, "row_key string, family string, qualifier string, ts timestamp, value string")

    return make


def table(frame, *columns):
    """Rows as a sorted list of tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted([tuple(r) for r in chosen.collect()], key=str)


def counts(frame):
    return {(r["counter_group"], r["counter"]): r["n"] for r in frame.collect()}
