from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lanewarden.schemas import CROSSING  # noqa: E402
from lanewarden.session import build_session  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="2",
        spark__default__parallelism="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def crossings(spark):
    """Build crossings from ``(plate, lane, index, seconds after T0, limit, reading[, km])``."""

    def build(rows):
        return spark.createDataFrame(
            [
                (
                    plate, lane, 10 * lane + index, index,
                    float(rest[0]) if rest else 1.0 + index, float(limit),
                    None if seconds is None else T0 + dt.timedelta(seconds=seconds), reading,
                )
                for plate, lane, index, seconds, limit, reading, *rest in rows
            ],
            CROSSING,
        )

    return build
