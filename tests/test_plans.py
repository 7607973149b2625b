"""Shape of the physical plans on tables stored as a deployment stores them."""

from __future__ import annotations

import re

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from legmeter.catalog.queries import WINDOW, stand_ins
from legmeter.config import Reasons, RunWindow
from legmeter.functions.timing import in_days
from legmeter.operators import snapshots
from legmeter.operators.legs import price_legs
from legmeter.operators.pricing import TablePrices
from legmeter.operators.upsert import LEG_KEYS
from legmeter.plans import gps, market, missing, trips, water
from legmeter.sources.tables import INPUT_TABLES, LEG_LAYOUT, Tables, store_by_day

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    views = stand_ins(spark, SF_DIR)
    for name in INPUT_TABLES:
        views.frame(name).write.parquet(str(root / name))
    return Tables.from_parquet(spark, str(root))


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def by_day(spark, stored, tmp_path_factory):
    root = tmp_path_factory.mktemp("days")
    effective = F.coalesce("deliver_date", "cancel_date")
    store_by_day(stored.marketorders, effective, str(root / "marketorders"))
    store_by_day(stored.food_orders, F.coalesce("deliverdate", "canceldate"), str(root / "food_orders"))
    store_by_day(stored.courier_status_logs, F.col("createdat"), str(root / "courier_status_logs"))
    places = {name: str(root / name) for name in ("marketorders", "food_orders", "courier_status_logs")}
    rest = Tables(lambda name: spark.read.parquet(places[name]) if name in places else getattr(stored, name))
    return rest


def plan_of(df) -> str:
    """The plan before adaptive execution has run anything."""
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan_of(df).splitlines() if "FileScan parquet" in line]


def scan_of(df, column: str) -> str:
    return next(line for line in scans(df) if column in line)


def test_window_reaches_the_market_scan(stored):
    scan = scan_of(market.legs_market(stored, WINDOW), "deliver_date")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", scan).group(1)
    assert "GreaterThanOrEqual(deliver_date" in pushed and "LessThan(cancel_date" in pushed
    assert "In(domaintype, [1,3])" in pushed
    assert "checkoutdatel" not in scan


def test_tables_stored_by_day_read_only_the_days(by_day, stored):
    short = RunWindow("1998-01-10 03:00:00", "1998-01-11 03:00:00")
    reasons = Reasons()
    for build, column in (
        (lambda t: market.legs_market(t, short), "deliver_date"),
        (lambda t: water.legs_water(t, short, reasons), "deliver_date"),
        (lambda t: water.refill_info(t, short, reasons), "createdat"),
        (lambda t: trips.food_order_info(t, short), "deliverdate"),
        (lambda t: gps.gps_distance_info(t, short), "deliver_date"),
        (lambda t: missing.market_missing(t, short).drop("avg_distance"), "deliver_date"),
    ):
        pruned = build(by_day)
        assert re.search(r"PartitionFilters: \[isnotnull\(event_day", scan_of(pruned, column))
        assert spark_rows(pruned) == spark_rows(build(stored))


def test_only_the_folders_of_the_window_are_opened(by_day):
    rows = in_days(by_day.marketorders, RunWindow("1998-01-10 03:00:00", "1998-01-11 03:00:00")).select("_id_oid")
    assert rows.count() > 0
    rows.collect()
    node = rows._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().head()
    assert node.metrics().apply("numPartitions").value() == 2


def opened_files(df) -> set[str]:
    return {name.split("/data/")[1] for name in df.inputFiles()}


def test_stored_results_are_read_by_slice(spark, stored, tmp_path):
    """The missing run opens the slices of its own ids only, here plain numbers."""
    path = str(tmp_path / "legs")
    state = snapshots.merge(spark, path, stored.leg_distances, LEG_KEYS, LEG_LAYOUT, "_id_oid", 100)
    assert len(state.slices) > 5
    some = stored.marketorders.filter(F.col("_id_oid").cast("long") < 400)
    near = snapshots.read_near(spark, path, LEG_LAYOUT, some, "_id_oid")
    held = [s for s in state.slices if s.least <= "#" + "399".zfill(19)]
    assert 0 < len(held) < len(state.slices) / 2
    assert {name.rsplit("/", 1)[0] for name in opened_files(near)} == {f for s in held for f in s.folders}
    frames = {"marketorders": some, "warehouse_locations": stored.warehouse_locations, "leg_distances": stored.leg_distances}
    by_slice = Tables(frames.__getitem__, lambda name, ids, key: snapshots.read_near(spark, path, LEG_LAYOUT, ids, key))
    plainly = Tables(frames.__getitem__)
    found, wanted = (spark_rows(missing.market_missing(t, WINDOW).drop("avg_distance")) for t in (by_slice, plainly))
    assert found == wanted
    averages = [
        {r.warehouse_id: round(r.avg_distance, 6) for r in missing.avg_distance_market(t, WINDOW).collect()}
        for t in (by_slice, plainly)
    ]
    assert averages[0] == averages[1] != {}


def test_window_reaches_the_event_scan(stored):
    scan = scan_of(water.refill_info(stored, WINDOW, Reasons()), "createdat")
    assert "GreaterThanOrEqual(createdat" in scan and "data_plate" not in scan


def test_trip_filters_reach_the_scan(stored):
    scan = scan_of(trips.food_order_info(stored, WINDOW), "deliverdate")
    assert "GreaterThanOrEqual(deliverdate" in scan and "deliverytype" in scan


def test_one_shuffle_and_one_sort_feed_both_market_windows(stored):
    plan = plan_of(market.courier_sequence(market.padded_market_rows(stored, WINDOW), "eff_date_l"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert len(re.findall(r"\bWindow \[", plan)) == 2


def test_a_join_by_warehouse_does_not_decide_where_couriers_go(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(market.courier_sequence(market.padded_market_rows(stored, WINDOW), "eff_date_l"))
        assert re.search(r"Exchange hashpartitioning\(warehouse_id#\d+, courier_id#\d+", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimensions_are_broadcast_by_size_only(spark, stored):
    df = trips.food_order_info(stored, WINDOW)
    assert plan_of(df).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = plan_of(trips.food_order_info(stored, WINDOW))
        assert "BroadcastHashJoin" not in again and again.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_averages_read_three_columns(stored):
    scan = scan_of(missing.avg_legs_food(stored, WINDOW), "store_to_rest")
    schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"_id_oid", "store_to_rest", "rest_to_client", "client_to_store"}


def test_price_table_is_shuffled_once(spark, stored):
    """The aggregation that makes legs unique and the join share their partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prices = spark.createDataFrame(
            [(1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
            "from_lon double, from_lat double, to_lon double, to_lat double, distance double, duration double",
        )
        plan = plan_of(TablePrices(prices).price(prices.select("from_lon", "from_lat", "to_lon", "to_lat")))
        assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in plan
        assert "SortAggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_price_table_is_cut_down_to_the_legs_before_it_is_aggregated(spark):
    names = ["from_lon", "from_lat", "to_lon", "to_lat"]
    rows = [(float(i), 2.0, 3.0, 4.0, 5.0, 6.0) for i in range(9)]
    prices = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "distance", "duration"]))
    legs = prices.select(*names).limit(3)
    plan = price_legs(legs, TablePrices(prices))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("min(distance") < plan.index("LeftSemi")
    assert price_legs(legs, TablePrices(prices)).filter("distance = 5").count() == 3


def test_routes_decode_after_the_last_shuffle_without_row_functions(stored):
    plan = plan_of(gps.gps_routes(stored, WINDOW))
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.index("Generate") < plan.index("Exchange")
