from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from handmade import EVENT_SCHEMA, ORDER_SCHEMA, ZONES  # noqa: E402

from legmeter.session import build_session  # noqa: E402
from legmeter.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_tables(spark):
    """Tables from hand-made rows; only the ones named exist."""

    def make(orders=(), events=(), leg_distances=(), **others) -> Tables:
        frames = {
            "marketorders": spark.createDataFrame(list(orders), ORDER_SCHEMA),
            "warehouse_locations": spark.createDataFrame(ZONES, "warehouse string, country_time_zone string"),
            "warehouses": spark.createDataFrame(
                [("W0", "zero", 28.5, 40.8), ("W1", "one", 28.6, 40.9), ("W9", "nine", 28.7, 41.0)],
                "_id_oid string, name string, location__coordinates_lon double, location__coordinates_lat double",
            ),
            "courier_status_logs": spark.createDataFrame(list(events), EVENT_SCHEMA),
            "leg_distances": spark.createDataFrame(
                list(leg_distances), "_id_oid string, step int, distance double, distance_type string"
            ),
            **others,
        }
        return Tables(frames.__getitem__)

    return make
