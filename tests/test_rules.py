"""Hand-made rows for what random tables miss."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from handmade import at, event, order

from legmeter.config import Reasons, RunWindow
from legmeter.functions.timing import run_grid
from legmeter.operators.legs import legs_with_return, predict_missing, predict_missing_trip
from legmeter.plans import finalize, gps, market, missing, water

DAY = RunWindow("1998-01-10", "1998-01-11")
REASONS = Reasons()


def by_id(df, key="order_id"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


def test_previous_drop_looks_back_two_hours_and_no_further(make_tables):
    tables = make_tables(
        [
            order("far", "09 21:59:59", lon=1.0),
            order("near", "09 22:00:00", courier="C1", lon=2.0),
            order("a", "10 00:10:00", batched=True, index=2, job="J1"),
            order("b", "10 00:10:00", courier="C1", batched=True, index=2, job="J2"),
        ]
    )
    legs = by_id(market.legs_market(tables, DAY))
    assert set(legs) == {"a", "b"}
    assert legs["a"].prev_lon is None and legs["a"].from_lon is None
    assert legs["b"].prev_lon == 2.0 and legs["b"].from_lon == 2.0


def test_window_end_is_open(make_tables):
    tables = make_tables([order("in", "10 00:00:00"), order("out", "11 00:00:00")])
    assert set(by_id(market.legs_market(tables, DAY))) == {"in"}


def test_ties_in_time_go_by_id(make_tables):
    tables = make_tables([order("b", "10 01:00:00", lon=2.0), order("a", "10 01:00:00", lon=1.0)])
    legs = by_id(market.legs_market(tables, DAY))
    assert legs["a"].prev_lon is None and legs["b"].prev_lon == 1.0
    assert (legs["a"].order_number, legs["b"].order_number) == (1, 2)


def test_cancelled_orders_need_a_courier(make_tables):
    tables = make_tables(
        [
            order("taken", cancelled="10 01:00:00", status=500),
            order("untaken", cancelled="10 02:00:00", status=500, courier=None),
            order("open", "10 03:00:00", status=500),
        ]
    )
    legs = by_id(market.legs_market(tables, DAY))
    assert set(legs) == {"taken"}
    assert legs["taken"].deliver_date == at("10 01:00:00")
    assert legs["taken"].deliver_date_l == at("10 03:00:00")


def test_unknown_zone_keeps_the_order_and_its_place(make_tables):
    tables = make_tables(
        [order("a", "10 05:00:00", warehouse="W9", lon=1.0), order("0", "10 06:00:00", warehouse="W9", lon=2.0)]
    )
    legs = by_id(market.legs_market(tables, DAY))
    assert legs["a"].deliver_date_l is None
    assert legs["0"].prev_lon == 1.0 and legs["0"].order_number == 2


def test_order_number_restarts_on_the_local_day(make_tables):
    tables = make_tables([order("late", "10 21:59:00"), order("next", "10 22:01:00")])
    legs = by_id(market.legs_market(tables, DAY))
    assert (legs["late"].order_number, legs["next"].order_number) == (1, 1)
    assert legs["next"].prev_lon is not None


def test_job_maximum_and_return_flag(make_tables):
    tables = make_tables(
        [
            order("a", "10 01:00:00", batched=True, index=1, job="J"),
            order("b", "10 01:10:00", batched=True, index=2, job="J"),
            order("plain", "10 02:00:00", batched=False),
            order("unknown", "10 03:00:00", batched=None),
            # Not flagged as batched: it does not count towards the maximum.
            order("stray", "10 04:00:00", batched=None, index=9, job="J"),
        ]
    )
    legs = by_id(market.legs_market(tables, DAY))
    flags = {name: (row.max_index, row.will_return_warehouse) for name, row in legs.items()}
    assert flags == {"a": (2, 0), "b": (2, 1), "plain": (1, 0), "unknown": (1, 0), "stray": (2, 0)}

    both = legs_with_return(market.legs_market(tables, DAY)).collect()
    back = {r.order_id for r in both if r.is_return}
    assert back == {"b", "plain"} and len(both) == 7
    for row in both:
        if row.is_return:
            assert row.step == -1 and (row.to_lon, row.to_lat) == (row.warehouse_lon, row.warehouse_lat)


def test_two_refills_before_one_order_do_not_repeat_it(make_tables):
    tables = make_tables(
        [order("o1", "10 03:00:00", domain=4), order("o2", "10 04:00:00", domain=4)],
        [
            event("1", "10 01:00:00", reason="refill"),
            event("2", "10 02:00:00", reason="refill"),
            event("3", "10 03:00:00", marketorder="o1"),
            event("4", "10 04:00:00", marketorder="o2"),
        ],
    )
    assert [r.next_order for r in water.next_order_after_refill(tables, DAY, REASONS).orderBy("log_id").collect()] == [
        "o1",
        "o1",
    ]
    legs = by_id(water.legs_water(tables, DAY, REASONS))
    assert legs["o1"].is_from_warehouse == 1 and legs["o1"].from_lon == legs["o1"].warehouse_lon
    assert legs["o2"].is_from_warehouse == 0 and legs["o2"].from_lon == legs["o2"].prev_lon


def test_order_after_refill_is_found_past_the_end(make_tables):
    tables = make_tables(
        events=[
            event("1", "10 23:30:00", reason="refill"),
            event("2", "11 01:00:00", marketorder="o1"),
            event("3", "10 23:40:00", reason="refill", courier="C9"),
            event("4", "11 02:00:00", marketorder="o2", courier="C9"),
        ]
    )
    found = by_id(water.next_order_after_refill(tables, DAY, REASONS), "log_id")
    assert found["1"].next_order == "o1" and found["3"].next_order is None


def test_cancelled_water_orders_come_last(make_tables):
    tables = make_tables(
        [
            order("c", cancelled="10 01:00:00", status=500, domain=4, lon=1.0),
            order("d", "10 02:00:00", domain=4, lon=2.0),
        ]
    )
    legs = by_id(water.legs_water(tables, DAY, REASONS))
    assert legs["d"].prev_lon is None and legs["c"].prev_lon == 2.0
    # The missing-order run goes by effective date, and only delivered orders can be missing.
    gaps = by_id(missing.water_missing(tables, DAY, REASONS))
    assert set(gaps) == {"d"} and gaps["d"].prev_lon == 1.0


@pytest.mark.parametrize(
    "reason,new,old,local,kept",
    [
        ("refill", 200, 400, "12:00:00", "refill"),
        ("refill", 300, 400, "12:00:00", None),
        (None, 4100, 400, "12:00:00", "refill"),
        ("busy", 200, 900, "12:00:00", "busy_return_warehouse"),
        ("busy", 200, 400, "12:00:00", None),
        ("busy", 4100, 400, "12:00:00", "busy_return_warehouse"),
        ("refill", 200, 400, "02:00:00", None),
        ("refill", 200, 400, "07:59:59", None),
        ("refill", 200, 400, "08:00:00", "refill"),
        ("refill", 200, 400, "01:59:59", "refill"),
    ],
)
def test_refill_events(make_tables, reason, new, old, local, kept):
    tables = make_tables(events=[event("1", "10 12:00:00", None, reason, new, old, local=f"10 {local}")])
    assert [r.type for r in water.refill_info(tables, DAY, REASONS).collect()] == ([kept] if kept else [])


def test_missing_orders_and_their_average(make_tables):
    tables = make_tables(
        [order("p", "10 01:00:00"), order("q", "10 02:00:00"), order("r", "10 03:00:00"), order("s", "10 04:00:00", warehouse="W1")],
        leg_distances=[
            ("p", 1, 2.0, "osrm"), ("p", 1, 4.0, "gps"), ("q", 1, None, "osrm"), ("r", 1, 6.0, "gps"),
        ],
    )
    gaps = by_id(missing.market_missing(tables, DAY))
    assert set(gaps) == {"q", "r", "s"}
    assert gaps["q"].avg_distance == 4.0 and gaps["s"].avg_distance is None


def test_fallback_fills_only_what_it_can(spark):
    schema = "order_id string, distance double, avg_distance double, is_return boolean, distance_type string"
    rows = [
        ("priced", 500.0, 3.0, False, "osrm"),
        ("filled", None, 3.0, False, "osrm"),
        ("open", None, None, False, "osrm"),
        ("back", None, 3.0, True, "osrm"),
        ("water", None, 3.0, None, "osrm"),
    ]
    found = by_id(predict_missing(spark.createDataFrame(rows, schema)))
    result = {name: (row.distance, row.distance_type) for name, row in found.items()}
    assert result == {
        "priced": (500.0, "osrm"),
        "filled": (3000.0, "predicted"),
        "open": (None, "osrm"),
        "back": (None, "osrm"),
        "water": (3000.0, "predicted"),
    }


def test_each_trip_leg_has_its_own_average(spark):
    names = ["store_to_rest", "rest_to_client", "client_to_store"]
    schema = "order_id string, distance_type string, " + ", ".join(f"{n} double, {n}_avg double" for n in names)
    rows = [("x", "osrm", None, 1.0, 20.0, 2.0, None, 3.0), ("y", "osrm", 1.0, 1.0, 2.0, 2.0, 3.0, 3.0)]
    found = by_id(predict_missing_trip(spark.createDataFrame(rows, schema)))
    assert [found["x"][n] for n in names] == [1000.0, 20.0, 3000.0] and found["x"].distance_type == "predicted"
    assert [found["y"][n] for n in names] == [1.0, 2.0, 3.0] and found["y"].distance_type == "osrm"


def test_trip_with_any_gap_is_missing_once(spark):
    schema = "_id_oid string, store_to_rest double, rest_to_client double, client_to_store double"
    rows = [("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0), ("b", 1.0, None, 1.0), ("c", None, None, None), ("c", None, None, None)]
    assert {r.order_id for r in missing.complete_trips(spark.createDataFrame(rows, schema)).collect()} == {"a"}


def test_gps_rows_of_other_lines_keep_no_coordinates(make_tables, spark):
    distances = spark.createDataFrame(
        [("m", 1, 3.0), ("w", 1, 4.0), ("c", 1, 5.0), ("n", 1, None)], "_id_oid string, step int, corrected_distance double"
    )
    tables = make_tables(
        [
            order("m", "10 01:00:00", batched=False, lon=1.0),
            order("w", "10 01:00:00", domain=4),
            order("c", cancelled="10 01:00:00", status=500),
            order("n", "10 02:00:00", batched=True, index=3, job="J"),
        ],
        orders_distances=distances,
    )
    info = gps.gps_distance_info(tables, DAY)
    found = by_id(info, "_id_oid")
    assert set(found) == {"m", "w", "n"} and found["w"].to_lon is None and found["n"].step == 3
    steps = sorted((r._id_oid, r.step) for r in gps.gps_with_return(info).collect())
    assert steps == [("m", -1), ("m", 1), ("w", 1)]


def test_finished_rows_have_no_gaps_and_no_copies(spark):
    schema = (
        "order_id string, step int, to_lon double, to_lat double, from_lon double, from_lat double, distance double, "
        "duration double, distance_type string"
    )
    row = ("a", 1, 1.0, 2.0, 3.0, 4.0, 1500.0, 60.0, "osrm")
    frame = spark.createDataFrame([row, row, ("b", 1, 1.0, 2.0, 3.0, 4.0, None, None, "osrm")], schema)
    found = finalize.finalize_legs(frame, "1998-02-01").collect()
    assert [(r._id_oid, r.distance, r.updated_at) for r in found] == [("a", 1.5, datetime(1998, 2, 1))]


@pytest.mark.parametrize(
    "every,start,end,first,last,count",
    [
        (timedelta(days=1), "1998-01-01", "1998-01-03 05:00:00", "1998-01-01", "1998-01-03", 3),
        (timedelta(hours=6), "1998-01-01", "1998-01-01 13:10:00", "1998-01-01", "1998-01-01 12:00:00", 3),
        (timedelta(minutes=15), "1998-01-01", "1998-01-01 00:44:59", "1998-01-01", "1998-01-01 00:30:00", 3),
        (timedelta(hours=1), "1998-01-02", "1998-01-01", None, None, 0),
    ],
)
def test_run_grid(spark, every, start, end, first, last, count):
    runs = sorted(r.run_start for r in run_grid(spark, every, start, end).collect())
    assert len(runs) == count
    if count:
        assert (runs[0], runs[-1]) == (datetime.fromisoformat(first), datetime.fromisoformat(last))


@pytest.mark.parametrize("bad", [timedelta(hours=5), timedelta(minutes=7), timedelta(seconds=90), timedelta(days=2)])
def test_run_grid_rejects_uneven_intervals(spark, bad):
    with pytest.raises(ValueError):
        run_grid(spark, bad, "1998-01-01", "1998-01-02")
