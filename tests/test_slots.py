"""All runs of a grid in one pass against one run after the other."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from compare import spark_rows
from handmade import EVENT_SCHEMA, ORDER_SCHEMA
from pyspark.sql import functions as F

from legmeter.catalog.queries import UPDATED_AT, stand_ins
from legmeter.config import JobConfig, Reasons, RunWindow
from legmeter.operators import snapshots
from legmeter.operators.pricing import GreatCircle
from legmeter.plans import market, water
from legmeter.plans.job import TARGETS, run, run_slots, store
from legmeter.plans.slots import SlotGrid, legs_market_slots, legs_water_slots
from legmeter.sources.tables import Tables

ZONES = [("W0", "Europe/Istanbul"), ("W1", "Asia/Tokyo"), ("W2", "Europe/Berlin")]


def drawn_orders(start: datetime, hours: int, size: int, domain: int, seed: int):
    """Orders of few couriers, with ties, cancelled ones and shared jobs; W9 has no zone."""
    draw = random.Random(seed)
    rows = []
    for i in range(size):
        time = start + timedelta(minutes=5 * draw.randrange(12 * hours))
        cancelled = draw.random() < 0.3
        job = draw.choice([None, f"J{draw.randrange(size // 6)}"])
        rows.append((
            f"o{i:04}", draw.choice(["W0", "W1", "W2", "W9"]), draw.choice([None, "C0", "C1"]), draw.choice([None, "V0", "V1"]),
            draw.choice([900, 1000, 500]), domain, None if cancelled else time, time if cancelled or draw.random() < 0.1 else None,
            draw.choice([None, True, True, False]), draw.choice([None, 1, 2, 3]), job, draw.randrange(1000) / 10, draw.randrange(1000) / 10, 28.5, 40.8,
        ))
    return rows


def drawn_events(start: datetime, hours: int, size: int, seed: int):
    draw = random.Random(seed)
    rows = []
    for i in range(size):
        time = start + timedelta(minutes=5 * draw.randrange(12 * hours))
        refill = draw.random() < 0.4
        rows.append((
            f"e{i:04}", None if refill else draw.choice([None, f"o{draw.randrange(size):04}"]), time, time, draw.choice(["W0", "W1", "W2", "W9"]),
            draw.choice([None, "C0", "C1"]), "F0", "refill" if refill else None, "V0", 200, 400, 28.6, 40.9,
        ))
    return rows


@pytest.fixture(scope="module", params=["spring", "autumn"])
def tables(spark, request):
    """Two days of orders; Istanbul and Berlin change their clocks within them in spring and autumn."""
    start = {"spring": datetime(1998, 3, 28), "autumn": datetime(1998, 10, 24)}[request.param]
    frames = {
        "marketorders": spark.createDataFrame(
            drawn_orders(start, 48, 260, 1, 1) + [(f"w{r[0]}", *r[1:]) for r in drawn_orders(start, 48, 260, 4, 2)], ORDER_SCHEMA
        ),
        "warehouse_locations": spark.createDataFrame(ZONES, "warehouse string, country_time_zone string"),
        "warehouses": spark.createDataFrame([(w, w, 28.5, 40.8) for w, _ in ZONES], "_id_oid string, name string, location__coordinates_lon double, location__coordinates_lat double"),
        "courier_status_logs": spark.createDataFrame([(r[0], r[1] and f"w{r[1]}", *r[2:]) for r in drawn_events(start, 48, 260, 3)], EVENT_SCHEMA),
    }
    found = Tables({name: df.cache() for name, df in frames.items()}.__getitem__)
    found.start = start
    return found


def one_by_one(grid, build, columns):
    """The rows of every run, each built alone."""
    whole = None
    for k in range(grid.runs):
        begin = grid.start + k * grid.every
        rows = build(RunWindow(begin, begin + grid.span)).select(*columns, F.lit(str(begin)).cast("timestamp_ntz").alias("run_start"))
        whole = rows if whole is None else whole.unionByName(rows)
    return spark_rows(whole)


def grid_of(tables, hours, every, length=None):
    start = tables.start + timedelta(hours=20)
    return SlotGrid(start, start + timedelta(hours=hours), timedelta(minutes=every), length and timedelta(minutes=length))


@pytest.mark.parametrize("hours,every,length", [(10, 120, None), (8, 120, 240)])
def test_market_runs(tables, hours, every, length):
    grid = grid_of(tables, hours, every, length)
    found = spark_rows(legs_market_slots(tables, grid))
    assert found == one_by_one(grid, lambda w: market.legs_market(tables, w), market.LEG_COLUMNS)
    assert sum(found[1].values()) > 20


@pytest.mark.parametrize("hours,every,length", [(8, 120, 240)])
def test_water_runs(tables, hours, every, length):
    grid = grid_of(tables, hours, every, length)
    found = spark_rows(legs_water_slots(tables, grid, Reasons()))
    assert found == one_by_one(grid, lambda w: water.legs_water(tables, w, Reasons()), water.LEG_COLUMNS)
    refilled = found[0].index("is_from_warehouse")
    assert len({row[refilled] for row in found[1]}) == 2


def test_no_action_and_the_same_plan_at_every_size(spark, tables):
    grid = grid_of(tables, 24, 15)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    rows = legs_market_slots(tables, grid)
    legs_water_slots(tables, grid, Reasons())
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("else", "")
    assert rows.count() > 0


def test_storing_all_runs_at_once_is_storing_them_in_turn(spark, tmp_path):
    tables = stand_ins(spark, "/root/testdata/sf0.001").tables
    start = datetime(1998, 1, 12)
    grid = SlotGrid(start, start + timedelta(hours=2), timedelta(hours=2), timedelta(hours=4))
    config = JobConfig("osrm", grid.window, UPDATED_AT, line="1")
    for k in range(grid.runs):
        window = RunWindow(start + k * grid.every, start + k * grid.every + grid.span)
        one = JobConfig("osrm", window, UPDATED_AT, line="1")
        store(spark, run(tables, one, GreatCircle(8.0)), str(tmp_path / "turn"), one)
    store(spark, run_slots(tables, config, grid, GreatCircle(8.0)), str(tmp_path / "once"), config)
    for name, (table, _, layout, _) in TARGETS.items():
        if name in ("leg_distances", "refill_distances"):
            kept = [spark_rows(snapshots.read(spark, str(tmp_path / way / table), layout)) for way in ("turn", "once")]
            assert kept[0] == kept[1] and sum(kept[0][1].values()) > 0


def test_grids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        SlotGrid("1998-01-01", "1998-01-02", timedelta(hours=1), timedelta(minutes=90))
    with pytest.raises(ValueError):
        SlotGrid("1998-01-01", "1998-01-02", timedelta(minutes=7)).whole(2)
    assert SlotGrid("1998-01-02", "1998-01-01", timedelta(hours=1)).runs == 0
    assert SlotGrid("1998-01-01", "1998-01-01 10:59:00", timedelta(hours=1)).runs == 11
