"""Named queries over the stand-in tables. Each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import ARTISAN_DOMAIN, FOOD_DOMAIN, ROAD, JobConfig, Reasons, RunWindow, as_datetime
from legmeter.functions.routes import route_offsets
from legmeter.functions.text import is_object_id
from legmeter.functions.timing import day_start, effective_date, run_grid, to_home_zone, within
from legmeter.operators import snapshots
from legmeter.operators.legs import (
    TRIP_LEGS,
    legs_with_return,
    predict_missing,
    predict_missing_trip,
    price_legs,
    trip_legs,
    with_step,
)
from legmeter.operators.orders import batch_max, in_warehouses, is_eligible
from legmeter.operators.price_store import RememberedPrices, StoredPrices, store_prices
from legmeter.operators.pricing import LEG_POINTS, BatchPrices, GreatCircle, TablePrices, distinct_legs
from legmeter.operators.routes import latest_routes, route_to_points
from legmeter.operators.upsert import (
    LEG_KEYS,
    POINT_KEYS,
    REFILL_KEYS,
    TRIP_KEYS,
    expired_routes,
    remaining,
    retain,
    upsert,
)
from legmeter.plans import averages, export, finalize, gps, job, market, missing, slots, trips, water
from legmeter.plans.slots import SlotGrid
from legmeter.session import materialise, work_folder
from legmeter.sources import feed, landing
from legmeter.sources.standins import StandIns
from legmeter.sources.tables import LEG_LAYOUT, POINT_LAYOUT, REFILL_LAYOUT, TRIP_LAYOUT, Tables, conform
from legmeter.sources.templates import run_sql

# The stand-in month starts on 1 January; its first day is what the look-backs read.
WINDOW = RunWindow("1998-01-02 00:00:00", "1998-02-01 00:00:00")
TRIP_POINTS = (
    ("warehouse_lon", "warehouse_lat", "restaurant_lon", "restaurant_lat"),
    ("restaurant_lon", "restaurant_lat", "to_lon", "to_lat"),
    ("to_lon", "to_lat", "warehouse_lon", "warehouse_lat"),
)
ODD_WINDOW = RunWindow("1998-01-05 06:30:00", "1998-01-25 18:15:00")
FIRST_HALF = "deliver_date < timestamp_ntz'1998-01-17'"
UPDATED_AT = "1998-02-01 00:00:00"
RETENTION_START = "1998-02-20 00:00:00"
SOME_WAREHOUSES = ("W1", "W3", "W8")
REASONS = Reasons()
# Rows of a slice of a stored table here; small, so that the test tables have some.
SLICE_ROWS = 20_000
FLEET_DAYS = ("1993-01-01", "1998-06-30")
STAGE_LAYOUT = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("distance", T.DoubleType()),
    ]
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


_OPENED: dict[tuple[str, str], StandIns] = {}


def stand_ins(spark: SparkSession, sf_dir: str) -> StandIns:
    """The views over a folder, defined once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPENED or _OPENED[key].spark is not spark:
        _OPENED[key] = StandIns(spark, sf_dir)
    return _OPENED[key]


def query(build: Callable[[StandIns], DataFrame]) -> Callable[[StandIns], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(stand_ins(spark, sf_dir))
    return build


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def table_prices(legs: DataFrame, *point_sets: tuple[str, str, str, str]) -> TablePrices:
    """Stand-in road table over the legs at hand; about a seventh of them is left out."""
    lon1, lat1, lon2, lat2 = [F.col(name) for name in LEG_POINTS]
    metres = F.round(F.abs(lon2 - lon1) * 85000 + F.abs(lat2 - lat1) * 111000, 3)
    pairs = F.array(
        *[
            F.struct(*[F.col(point).alias(name) for point, name in zip(points, LEG_POINTS)])
            for points in point_sets or (LEG_POINTS,)
        ]
    )
    known = legs.select(F.inline(pairs)).filter(F.round(lon2 * 1000).cast("long") % 7 != 0).distinct()
    return TablePrices(known.withColumn("distance", metres).withColumn("duration", metres / 8))


def on_roads(legs: DataFrame, *point_sets: tuple[str, str, str, str]) -> tuple[DataFrame, TablePrices]:
    """The legs, written once, and the stand-in road table made of them."""
    legs = materialise(legs, "legs")
    return legs, replace(table_prices(legs, *point_sets), cut_down=True)


def ask_prices(legs: pd.DataFrame, attempt: int) -> pd.DataFrame:
    """Stand-in for a road service: some legs answer only when asked again, some never."""
    metres = (
        (legs["to_lon"] - legs["from_lon"]).abs() * 85000 + (legs["to_lat"] - legs["from_lat"]).abs() * 111000
    ).round(3)
    mark = (legs["to_lon"] * 1000).round().astype("int64")
    metres = metres.where((mark % 7 != 0) & ((mark % 3 != 0) | (attempt > 0)))
    return pd.DataFrame({"distance": metres, "duration": metres / 8})


def priced_market(s: StandIns) -> DataFrame:
    """Only the columns that finished legs are made of are written and moved."""
    legs = legs_with_return(market.legs_market(s.tables, WINDOW))
    return price_legs(*on_roads(legs.select("order_id", "step", *LEG_POINTS)))


def priced_water(s: StandIns) -> DataFrame:
    return price_legs(*on_roads(with_step(water.legs_water(s.tables, WINDOW, REASONS))))


def priced_refill(s: StandIns) -> DataFrame:
    points = ("refill_lon", "refill_lat", "warehouse_lon", "warehouse_lat")
    return job.refill_legs(*on_roads(water.refill_info(s.tables, WINDOW, REASONS), points))


def priced_trips(orders: DataFrame) -> DataFrame:
    return trip_legs(*on_roads(orders, *TRIP_POINTS))


# --- scans, sources, sinks ---------------------------------------------------------------------


@query
def sql_template(s: StandIns) -> DataFrame:
    text = "select order_id, step, osrm, km from {logs} where date_l between :first and :last and osrm is not null"
    first, last = FLEET_DAYS
    return run_sql(s.spark, text, {"first": first, "last": last}, logs=s.tables.fleet_vehicle_km_logs)


@query
def csv_stage_roundtrip(s: StandIns) -> DataFrame:
    path = work_folder(s.spark, "stage")
    landing.write_stage(conform(s.tables.leg_distances, LEG_LAYOUT), path)
    return landing.read_stage(s.spark, path, LEG_LAYOUT)


def upserted(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` reads the batch for its keys and for its rows, so the batch is worked out and written once."""
    return upsert(target, materialise(batch, "batch"), keys)


@query
def upsert_market(s: StandIns) -> DataFrame:
    target = conform(s.tables.leg_distances, LEG_LAYOUT)
    return upserted(target, finalize_market(s), LEG_KEYS)


@query
def upsert_gps(s: StandIns) -> DataFrame:
    target = conform(s.tables.leg_distances, LEG_LAYOUT)
    return upserted(target, finalize_gps(s), LEG_KEYS)


@query
def upsert_food(s: StandIns) -> DataFrame:
    return upserted(conform(s.tables.food_distances, TRIP_LAYOUT), finalize_food(s), TRIP_KEYS)


@query
def upsert_artisan(s: StandIns) -> DataFrame:
    return upserted(conform(s.tables.artisan_distances, TRIP_LAYOUT), finalize_artisan(s), TRIP_KEYS)


@query
def upsert_refill(s: StandIns) -> DataFrame:
    return upserted(conform(s.frame("refill_distances"), REFILL_LAYOUT), finalize_refill(s), REFILL_KEYS)


@query
def upsert_route(s: StandIns) -> DataFrame:
    return upserted(conform(s.frame("route_points"), POINT_LAYOUT), gps_routes(s), POINT_KEYS)


@query
def route_retention(s: StandIns) -> DataFrame:
    return retain(s.frame("route_points"), expired_routes(s.tables.routes_market, RETENTION_START))


@query
def route_retention_count(s: StandIns) -> DataFrame:
    return remaining(route_retention(s))


@query
def load_error_report(s: StandIns) -> DataFrame:
    _, errors = landing.split_lines(s.frame("raw_loads"), STAGE_LAYOUT)
    return landing.load_error_report(errors, s.frame("loads"))


@query
def load_accepted(s: StandIns) -> DataFrame:
    accepted, _ = landing.split_lines(s.frame("raw_loads"), STAGE_LAYOUT)
    return accepted


@query
def partner_export(s: StandIns) -> DataFrame:
    return export.partner_export(s.tables, WINDOW)


def landed_feed(s: StandIns) -> DataFrame:
    """The partner rows as JSON in a landing folder, read back as a run does."""
    path = work_folder(s.spark, "feed")
    s.frame("partner_rows").write.json(path)
    window = landing.feed_window("partner", WINDOW)
    return landing.read_partner_feed(s.spark, path, window, UPDATED_AT)


@query
def partner_feed(s: StandIns) -> DataFrame:
    return landed_feed(s)


@query
def check_tables(s: StandIns) -> DataFrame:
    folder = work_folder(s.spark, "check")
    results = {
        "refill_info": finalize_refill(s),
        "food_order_info": finalize_food(s),
        "gps_distance_info": finalize_gps(s),
    }
    landing.write_check_tables(folder, **results)
    sheets = []
    for name in results:
        sheet = s.spark.read.option("header", True).csv(f"{folder}/{name}")
        titles = F.lit(", ".join(sheet.columns[:3])).alias("titles")
        sheets.append(
            sheet.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sheet"), "rows", titles)
        )
    return reduce(DataFrame.unionByName, sheets)


# --- filters, projections, scalar functions ------------------------------------------------------


@query
def lookback_trim(s: StandIns) -> DataFrame:
    rows = market.courier_sequence(market.padded_market_rows(s.tables, WINDOW), "eff_date_l")
    return rows.filter(within(F.col("eff_date"), WINDOW)).select(
        "order_id", F.col("eff_date").alias("deliver_date"), F.col("prev_lon").isNotNull().alias("has_previous")
    )


@query
def next_order_after_refill(s: StandIns) -> DataFrame:
    return water.next_order_after_refill(s.tables, WINDOW, REASONS)


@query
def eligible_orders(s: StandIns) -> DataFrame:
    orders = s.tables.marketorders
    kept = is_eligible(F.col("status"), F.col("courier_courier_oid"), F.col("cancel_date"))
    return orders.filter(kept).select(F.col("_id_oid").alias("order_id"), "status", "domaintype")


@query
def warehouse_filter(s: StandIns) -> DataFrame:
    kept = in_warehouses(F.col("warehouse_warehouse_oid"), SOME_WAREHOUSES)
    return s.tables.marketorders.filter(kept).select(
        F.col("_id_oid").alias("order_id"), F.col("warehouse_warehouse_oid").alias("warehouse_id")
    )


@query
def local_time_orders(s: StandIns) -> DataFrame:
    rows = market.padded_market_rows(s.tables, WINDOW)
    return rows.select(
        "order_id",
        F.col("eff_date").alias("deliver_date"),
        F.col("eff_date_l").alias("deliver_date_l"),
        day_start(F.col("eff_date_l")).alias("day"),
        "delivery_batch_index",
    )


@query
def fixed_zone_time(s: StandIns) -> DataFrame:
    return s.tables.courier_status_logs.select(
        F.col("_id_oid").alias("log_id"), "createdat", to_home_zone(F.col("createdat")).alias("home_time")
    )


@query
def object_id_check(s: StandIns) -> DataFrame:
    digest = F.md5(F.col("event_id").cast("string"))
    text = (
        F.when(F.col("event_id") % 3 == 0, F.substring(digest, 1, 24))
        .when(F.col("event_id") % 3 == 1, F.upper(F.substring(digest, 1, 24)))
        .otherwise(digest)
    )
    return s.frame("events").select("event_id", is_object_id(text).alias("is_object_id"))


@query
def run_grid_slots(s: StandIns) -> DataFrame:
    moment = effective_date(F.col("deliver_date"), F.col("cancel_date"))
    bounds = s.tables.marketorders.agg(day_start(F.min(moment)).alias("start"), F.max(moment).alias("end"))
    return run_grid(bounds, timedelta(minutes=15))


QUERIES["run_grid"] = QUERIES.pop("run_grid_slots")


# --- market ------------------------------------------------------------------------------------


@query
def legs_market(s: StandIns) -> DataFrame:
    return market.legs_market(s.tables, WINDOW)


@query
def legs_market_preview(s: StandIns) -> DataFrame:
    return market.preview(legs_market(s))


@query
def prev_drop_market(s: StandIns) -> DataFrame:
    rows = market.courier_sequence(market.padded_market_rows(s.tables, WINDOW), "eff_date_l")
    return rows.select("order_id", "warehouse_id", "courier_id", "prev_lon", "prev_lat")


@query
def order_number_market(s: StandIns) -> DataFrame:
    rows = market.courier_sequence(market.padded_market_rows(s.tables, WINDOW), "eff_date_l")
    return rows.select("order_id", "warehouse_id", "courier_id", "order_number")


QUERIES["batch_max"] = lambda spark, sf_dir: batch_max(
    market.padded_market_rows(stand_ins(spark, sf_dir).tables, WINDOW)
)

RETURN_COLUMNS = ["order_id", "step", "is_return", "from_lon", "from_lat", "to_lon", "to_lat"]


@query
def legs_with_return_all(s: StandIns) -> DataFrame:
    return legs_with_return(market.legs_market(s.tables, WINDOW)).select(*RETURN_COLUMNS)


QUERIES["legs_with_return"] = QUERIES.pop("legs_with_return_all")

PRICED_COLUMNS = ["order_id", "from_lon", "from_lat", "to_lon", "to_lat", "distance", "duration", "distance_type"]


@query
def price_legs_table(s: StandIns) -> DataFrame:
    legs = materialise(market.legs_market(s.tables, WINDOW), "legs")
    return rounded(price_legs(legs, table_prices(legs)).select(*PRICED_COLUMNS), "distance", "duration")


@query
def price_legs_stored(s: StandIns) -> DataFrame:
    """Prices from a stored table, of which only the places of the legs are opened."""
    path = work_folder(s.spark, "prices")
    legs = materialise(market.legs_market(s.tables, WINDOW), "legs")
    store_prices(table_prices(legs).prices, path, "1998-01-01", SLICE_ROWS)
    return rounded(price_legs(legs, StoredPrices(path)).select(*PRICED_COLUMNS), "distance", "duration")


def remembered(path: str, now: str) -> RememberedPrices:
    return RememberedPrices(ask_prices, path, now, slice_rows=SLICE_ROWS)


@query
def price_legs_remembered(s: StandIns) -> DataFrame:
    """Prices of a service whose answers are kept: the second run asks for the legs of the second half only."""
    path = work_folder(s.spark, "answers")
    legs = materialise(market.legs_market(s.tables, WINDOW), "legs")
    price_legs(legs.where(FIRST_HALF), remembered(path, "1998-01-17"))
    return rounded(price_legs(legs, remembered(path, "1998-02-01")).select(*PRICED_COLUMNS), "distance", "duration")


@query
def price_legs_unanswered(s: StandIns) -> DataFrame:
    """What the second run asks for: legs that are new, and those that have failed."""
    path = work_folder(s.spark, "answers")
    legs = materialise(market.legs_market(s.tables, WINDOW), "legs")
    price_legs(legs.where(FIRST_HALF), remembered(path, "1998-01-17"))
    return remembered(path, "1998-02-01").unanswered(distinct_legs(legs, [LEG_POINTS])).toDF(*LEG_POINTS, "failures")


@query
def price_legs_haversine(s: StandIns) -> DataFrame:
    legs = market.legs_market(s.tables, WINDOW)
    priced = price_legs(legs, GreatCircle(metres_per_second=8.0)).select(*PRICED_COLUMNS)
    return rounded(priced, "distance", "duration", digits=3)


@query
def price_legs_retry(s: StandIns) -> DataFrame:
    legs = market.legs_market(s.tables, WINDOW)
    return rounded(price_legs(legs, BatchPrices(ask_prices)).select(*PRICED_COLUMNS), "distance", "duration")


@query
def finalize_market(s: StandIns) -> DataFrame:
    return rounded(finalize.finalize_legs(priced_market(s), UPDATED_AT), "distance", "duration")


@query
def all_market_legs(s: StandIns) -> DataFrame:
    both = finalize.all_legs(priced_market(s), priced_water(s)).select("step", *PRICED_COLUMNS)
    return rounded(both, "distance", "duration").distinct()


# --- water and refill ----------------------------------------------------------------------------


@query
def legs_water(s: StandIns) -> DataFrame:
    return water.legs_water(s.tables, WINDOW, REASONS)


@query
def prev_drop_water(s: StandIns) -> DataFrame:
    rows = water.vehicle_sequence(water.padded_water_rows(s.tables, WINDOW))
    return rows.select("order_id", "warehouse_id", "courier_fleetvehicle_oid", "prev_lon", "prev_lat")


@query
def order_number_water(s: StandIns) -> DataFrame:
    rows = water.vehicle_sequence(water.padded_water_rows(s.tables, WINDOW))
    return rows.select("order_id", "courier_id", "order_number")


@query
def refill_info(s: StandIns) -> DataFrame:
    return water.refill_info(s.tables, WINDOW, REASONS)


@query
def refill_legs(s: StandIns) -> DataFrame:
    priced = priced_refill(s).select("log_id", "refill_lon", "refill_lat", "distance", "duration", "distance_type")
    return rounded(priced, "distance", "duration")


@query
def finalize_refill(s: StandIns) -> DataFrame:
    return rounded(finalize.finalize_refill(priced_refill(s), UPDATED_AT), "refill_distance", "duration")


@query
def water_warehouses(s: StandIns) -> DataFrame:
    return water.water_warehouses(s.tables)


# --- food and artisan ------------------------------------------------------------------------------

TRIP_NUMBERS = ["distance", "duration", *TRIP_LEGS, *[f"{leg}_duration" for leg in TRIP_LEGS]]
TRIP_PRICES = [*TRIP_LEGS, *[f"{leg}_duration" for leg in TRIP_LEGS]]


@query
def food_order_info(s: StandIns) -> DataFrame:
    return trips.food_order_info(s.tables, WINDOW)


@query
def artisan_order_info(s: StandIns) -> DataFrame:
    return trips.artisan_order_info(s.tables, WINDOW)


@query
def task_batch_index(s: StandIns) -> DataFrame:
    return trips.task_batch_index(s.tables)


@query
def task_batch_index_completed(s: StandIns) -> DataFrame:
    return trips.task_batch_index(s.tables, "orderid_oid", trips.COMPLETED_TASKS)


@query
def trip_legs_food(s: StandIns) -> DataFrame:
    return rounded(priced_trips(food_order_info(s)).select("order_id", *TRIP_PRICES, "distance_type"), *TRIP_PRICES)


@query
def trip_legs_artisan(s: StandIns) -> DataFrame:
    priced = priced_trips(artisan_order_info(s)).select("order_id", "batch_index", *TRIP_PRICES, "distance_type")
    return rounded(priced, *TRIP_PRICES)


@query
def finalize_food(s: StandIns) -> DataFrame:
    orders = food_order_info(s).select("order_id", *dict.fromkeys(name for points in TRIP_POINTS for name in points))
    return rounded(finalize.finalize_trips(priced_trips(orders), UPDATED_AT), *TRIP_NUMBERS)


@query
def finalize_artisan(s: StandIns) -> DataFrame:
    priced = priced_trips(artisan_order_info(s))
    return rounded(finalize.finalize_trips(priced, UPDATED_AT, "batch_index"), *TRIP_NUMBERS)


# --- missing orders --------------------------------------------------------------------------------

AVERAGES = [f"{leg}_avg" for leg in TRIP_LEGS]


@query
def avg_distance_market(s: StandIns) -> DataFrame:
    return rounded(missing.avg_distance_market(s.tables, WINDOW), "avg_distance")


@query
def avg_distance_water(s: StandIns) -> DataFrame:
    return rounded(missing.avg_distance_water(s.tables, WINDOW), "avg_distance")


@query
def avg_legs_food(s: StandIns) -> DataFrame:
    return rounded(missing.avg_legs_food(s.tables, WINDOW), *AVERAGES)


@query
def avg_legs_artisan(s: StandIns) -> DataFrame:
    return rounded(missing.avg_legs_artisan(s.tables, WINDOW), *AVERAGES)


@query
def market_missing(s: StandIns) -> DataFrame:
    return rounded(missing.market_missing(s.tables, WINDOW), "avg_distance")


@query
def water_missing(s: StandIns) -> DataFrame:
    return rounded(missing.water_missing(s.tables, WINDOW, REASONS), "avg_distance")


@query
def food_missing(s: StandIns) -> DataFrame:
    return rounded(missing.food_missing(s.tables, WINDOW), *AVERAGES)


@query
def artisan_missing(s: StandIns) -> DataFrame:
    return rounded(missing.artisan_missing(s.tables, WINDOW), *AVERAGES)


@query
def predict_missing_market(s: StandIns) -> DataFrame:
    priced = predict_missing(price_legs(*on_roads(legs_with_return(missing.market_missing(s.tables, WINDOW)))))
    return rounded(priced.select("order_id", "step", "distance", "duration", "distance_type"), "distance", "duration")


@query
def predict_missing_water(s: StandIns) -> DataFrame:
    priced = predict_missing(price_legs(*on_roads(with_step(missing.water_missing(s.tables, WINDOW, REASONS)))))
    return rounded(priced.select("order_id", "step", "distance", "duration", "distance_type"), "distance", "duration")


@query
def predict_missing_food(s: StandIns) -> DataFrame:
    priced = predict_missing_trip(priced_trips(missing.food_missing(s.tables, WINDOW)))
    return rounded(priced.select("order_id", *TRIP_PRICES, "distance_type"), *TRIP_PRICES)


@query
def predict_missing_artisan(s: StandIns) -> DataFrame:
    priced = predict_missing_trip(priced_trips(missing.artisan_missing(s.tables, WINDOW)))
    return rounded(priced.select("order_id", *TRIP_PRICES, "distance_type"), *TRIP_PRICES)


# --- GPS and routes ----------------------------------------------------------------------------------


@query
def gps_distance_info(s: StandIns) -> DataFrame:
    return gps.gps_distance_info(s.tables, WINDOW)


@query
def gps_with_return(s: StandIns) -> DataFrame:
    return gps.gps_with_return(gps_distance_info(s))


@query
def finalize_gps(s: StandIns) -> DataFrame:
    return finalize.finalize_gps(gps_distance_info(s), UPDATED_AT)


@query
def gps_routes(s: StandIns) -> DataFrame:
    return gps.gps_routes(s.tables, WINDOW)


@query
def route_time_decode(s: StandIns) -> DataFrame:
    return s.tables.routes_market.select(
        "_id_oid", F.posexplode(route_offsets(F.col("encoded_time"))).alias("position", "seconds")
    )


@query
def route_points(s: StandIns) -> DataFrame:
    return route_to_points(s.tables.routes_market)


@query
def route_dedup(s: StandIns) -> DataFrame:
    """Every route twice, the other copy an hour earlier or later with its texts cut short."""
    routes = s.tables.routes_market.select("_id_oid", "start_time", "encoded_latlons", "encoded_time")
    shift = F.when(F.col("_id_oid").cast("long") % 4 == 0, 3600).otherwise(-3600)
    other = routes.select(
        "_id_oid",
        F.timestamp_add("SECOND", shift, F.col("start_time")).alias("start_time"),
        F.substring("encoded_latlons", 1, 10).alias("encoded_latlons"),
        F.lit("2s").alias("encoded_time"),
    )
    return latest_routes(routes.unionByName(other))


@query
def stage_load_errors(s: StandIns) -> DataFrame:
    """Rejected fields of staged files, by file and line. Every load is a file with a header."""
    return staged_loads(s)[1].select(load_of("file"), "line_number", "colname", "value", "raw_line", "err_reason")


@query
def stage_load_accepted(s: StandIns) -> DataFrame:
    return staged_loads(s)[0].select(load_of("file"), "line_number", "order_id", "step", "distance")


def load_of(column: str) -> Column:
    return F.regexp_extract(column, "load=([0-9]+)", 1).cast("long").alias("query")


def staged_loads(s: StandIns) -> tuple[DataFrame, DataFrame]:
    path = work_folder(s.spark, "stage")
    lines = s.frame("raw_loads").select("query", "line_number", "raw_line")
    headers = lines.select("query", F.lit(-1).alias("line_number"), F.lit(",".join(STAGE_LAYOUT.names)).alias("raw_line")).distinct()
    whole = lines.unionByName(headers).repartition("query").withColumn("load", F.col("query"))
    whole.sortWithinPartitions("load", "line_number").select("load", "raw_line").write.partitionBy("load").text(path)
    return landing.read_stage_checked(s.spark, path, STAGE_LAYOUT)


@cache
def taken_in(s: StandIns) -> tuple[str, list[feed.Intake]]:
    """The partner's rows, landed compressed in two lots of which every 50th row is cut short or has a text for a distance."""
    folder, store = work_folder(s.spark, "landing"), work_folder(s.spark, "feed")
    rows = s.frame("partner_rows")
    line = F.to_json(F.struct(*rows.columns))
    kind = F.col("order_id").cast("long") % 50
    spoiled = F.when(kind == 7, F.expr("left(line, length(line) - 5)")).when(kind == 8, F.regexp_replace("line", '"distance":[^,]+', '"distance":"far"')).otherwise(F.col("line"))
    lots = rows.withColumn("line", line).select(spoiled.alias("value"), (F.col("order_id").cast("long") % 2).alias("lot"))
    intakes = []
    for lot in (0, 1):
        lots.where(F.col("lot") == lot).select("value").write.mode("append").option("compression", "gzip").text(folder)
        intakes.append(feed.take_in(s.spark, folder, store, UPDATED_AT))
    return store, intakes


@query
def partner_feed_taken_in(s: StandIns) -> DataFrame:
    return feed.read_feed(s.spark, taken_in(s)[0], WINDOW, UPDATED_AT)


@query
def partner_feed_rejects(s: StandIns) -> DataFrame:
    rejects = snapshots.read(s.spark, f"{taken_in(s)[0]}/rejects", feed.REJECT_LAYOUT)
    return rejects.select(F.regexp_extract("raw", '"order_id":"([0-9]+)"', 1).alias("order_id"), "reason")


@query
def partner_feed_intakes(s: StandIns) -> DataFrame:
    """How many rows each of two intakes took in and rejected."""
    intakes = taken_in(s)[1]
    return s.spark.createDataFrame([(n, i.rows, i.rejected) for n, i in enumerate(intakes)], "lot int, rows bigint, rejected bigint")


# --- many runs in one pass ----------------------------------------------------------------------------------


def slot_grid(every: timedelta, length: timedelta) -> SlotGrid:
    return SlotGrid(WINDOW.start, as_datetime(WINDOW.end) - length, every, length)


# Every quarter of an hour of the month, and three hours from every hour on.
QUARTERS = slot_grid(timedelta(minutes=15), timedelta(minutes=15))
HOURS = slot_grid(timedelta(hours=1), timedelta(hours=3))


@query
def legs_market_slots(s: StandIns) -> DataFrame:
    return slots.legs_market_slots(s.tables, QUARTERS)


@query
def legs_water_slots(s: StandIns) -> DataFrame:
    return slots.legs_water_slots(s.tables, HOURS, REASONS)


@query
def food_order_slots(s: StandIns) -> DataFrame:
    return slots.order_lines_slots(s.tables, QUARTERS, REASONS, ["food"])["food"]


# --- partner, export, counters ---------------------------------------------------------------------------


@query
def partner_arrange_market(s: StandIns) -> DataFrame:
    return finalize.arrange_partner_legs(landed_feed(s))


@query
def partner_arrange_food(s: StandIns) -> DataFrame:
    return finalize.arrange_partner_trips(landed_feed(s), FOOD_DOMAIN)


@query
def partner_arrange_artisan(s: StandIns) -> DataFrame:
    return finalize.arrange_partner_trips(landed_feed(s), ARTISAN_DOMAIN)


@query
def water_km_capped(s: StandIns) -> DataFrame:
    return export.water_km_capped(s.tables, WINDOW.start, WINDOW.end)


@query
def fleet_km(s: StandIns) -> DataFrame:
    return export.fleet_km(s.tables, *FLEET_DAYS)


@query
def run_counts(s: StandIns) -> DataFrame:
    lines = job.order_lines(s.tables, JobConfig("osrm", WINDOW, UPDATED_AT))
    return finalize.run_counts(**{name: lines[name] for name in ("market", "water", "food", "artisan")})


@dataclass(frozen=True)
class FormulaPrices:
    """The stand-in road table as a plain expression; about a seventh of all legs has no price."""

    label: str = ROAD
    looks_first: bool = False

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> FormulaPrices:
        return self

    def price(
        self, df: DataFrame, points=LEG_POINTS, distance: str = "distance", duration: str = "duration"
    ) -> DataFrame:
        lon1, lat1, lon2, lat2 = [F.col(point) for point in points]
        metres = F.round(F.abs(lon2 - lon1) * 85000 + F.abs(lat2 - lat1) * 111000, 3)
        known = F.when(F.round(lon2 * 1000).cast("long") % 7 != 0, metres)
        return df.withColumn(distance, known).withColumn(duration, F.col(distance) / 8)


def stacked(results: dict[str, DataFrame]) -> DataFrame:
    """Every row of every result table of a run, with the table's name."""
    labelled = [rows.withColumn("result", F.lit(name)) for name, rows in results.items()]
    whole = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), labelled)
    return rounded(whole, *[name for name in (*TRIP_NUMBERS, "refill_distance") if name in whole.columns])


@query
def run_osrm(s: StandIns) -> DataFrame:
    """Market, water and refill, straight-line priced."""
    config = JobConfig("osrm", WINDOW, UPDATED_AT, line="1")
    return stacked(job.run(s.tables, config, GreatCircle(metres_per_second=8.0)))


@query
def run_osrm_all(s: StandIns) -> DataFrame:
    return stacked(job.run(s.tables, JobConfig("osrm", WINDOW, UPDATED_AT), FormulaPrices()))


@query
def run_gps(s: StandIns) -> DataFrame:
    return stacked(job.run(s.tables, JobConfig("gps", WINDOW, UPDATED_AT)))


@query
def run_both(s: StandIns) -> DataFrame:
    return stacked(job.run(s.tables, JobConfig("both", WINDOW, UPDATED_AT, line="2"), FormulaPrices()))


@query
def run_monthly_missing(s: StandIns) -> DataFrame:
    return stacked(job.run(s.tables, JobConfig("monthly_missing", WINDOW, UPDATED_AT), FormulaPrices()))


@query
def run_partner(s: StandIns) -> DataFrame:
    path = work_folder(s.spark, "feed")
    s.frame("partner_rows").write.json(path)
    return stacked(job.run(s.tables, JobConfig("partner", WINDOW, UPDATED_AT), feed_path=path))


# --- stored targets --------------------------------------------------------------------------------------


def merged_twice(target: DataFrame, batch: DataFrame, keys: list[str], layout: T.StructType, sort_key: str) -> DataFrame:
    """Store the target, merge the batch into it twice, read the table back."""
    spark = target.sparkSession
    path, batch = work_folder(spark, "stored"), materialise(batch, "batch")
    for rows in (target, batch, batch):
        snapshots.merge(spark, path, rows, keys, layout, sort_key, SLICE_ROWS)
    return snapshots.read(spark, path, layout)


@query
def store_market(s: StandIns) -> DataFrame:
    return merged_twice(s.tables.leg_distances, finalize_market(s), LEG_KEYS, LEG_LAYOUT, "_id_oid")


@query
def store_refill(s: StandIns) -> DataFrame:
    return merged_twice(s.frame("refill_distances"), finalize_refill(s), REFILL_KEYS, REFILL_LAYOUT, "createdatl")


@query
def store_route(s: StandIns) -> DataFrame:
    return merged_twice(s.frame("route_points"), gps_routes(s), POINT_KEYS, POINT_LAYOUT, "_id_oid")


@cache
def expired_points(s: StandIns) -> str:
    path = work_folder(s.spark, "stored")
    snapshots.merge(s.spark, path, s.frame("route_points"), POINT_KEYS, POINT_LAYOUT, "_id_oid", SLICE_ROWS)
    expired = expired_routes(s.tables.routes_market, RETENTION_START)
    for _ in range(2):
        snapshots.expire(s.spark, path, expired, POINT_LAYOUT, slice_rows=SLICE_ROWS)
    return path


@query
def expire_route(s: StandIns) -> DataFrame:
    return snapshots.read(s.spark, expired_points(s), POINT_LAYOUT)


@query
def expire_route_count(s: StandIns) -> DataFrame:
    """Points left, from the counts that the table keeps for its slices."""
    left = snapshots.snapshot(s.spark, expired_points(s)).rows
    return s.spark.createDataFrame([(left,)], "remaining bigint")


@query
def store_market_changes(s: StandIns) -> DataFrame:
    """What a merge changed: rows that only the version before it has, and rows that only the newest one has."""
    path = work_folder(s.spark, "stored")
    for rows in (s.tables.leg_distances, finalize_market(s)):
        snapshots.merge(s.spark, path, rows, LEG_KEYS, LEG_LAYOUT, "_id_oid", SLICE_ROWS)
    before, after = (snapshots.read(s.spark, path, LEG_LAYOUT, version) for version in (1, 2))
    gone = before.exceptAll(after).withColumn("change", F.lit("removed"))
    return gone.unionByName(after.exceptAll(before).withColumn("change", F.lit("added")))


@cache
def stored_with_averages(s: StandIns) -> tuple[str, Tables]:
    """Result tables stored twice, the second time with new distances, with the averages kept along."""
    root = work_folder(s.spark, "results")
    firsts = {"leg_distances": s.tables.leg_distances, "food_distances": s.tables.food_distances, "artisan_distances": s.tables.artisan_distances}
    for results in (firsts, {"leg_distances": finalize_market(s), "food_distances": finalize_food(s)}):
        job.store(s.spark, results, root, JobConfig("osrm", WINDOW, UPDATED_AT), s.tables)
    near = lambda name, ids, key: snapshots.read_near(s.spark, f"{root}/{name}", job.READ_AGAIN[name], ids, key)
    return root, Tables(lambda name: getattr(s.tables, name), near)


@query
def average_state(s: StandIns) -> DataFrame:
    """The kept sums after rows have been replaced."""
    return averages.read_state(s.spark, stored_with_averages(s)[0])


@query
def avg_distance_kept(s: StandIns) -> DataFrame:
    """Averages from the kept sums over a window that starts and ends within a day."""
    root, tables = stored_with_averages(s)
    lines = ("market", "water")
    found = [averages.averages(s.spark, tables, root, line, ODD_WINDOW).withColumn("line", F.lit(line)) for line in lines]
    return rounded(reduce(DataFrame.unionByName, found), "avg_distance")


@query
def avg_legs_kept(s: StandIns) -> DataFrame:
    root, tables = stored_with_averages(s)
    return rounded(averages.averages(s.spark, tables, root, "food", ODD_WINDOW), *(f"{leg}_avg" for leg in TRIP_LEGS))


@query
def market_missing_stored(s: StandIns) -> DataFrame:
    """Missing orders against a stored result table, of which only the slices near the window's ids are opened."""
    path = work_folder(s.spark, "stored")
    snapshots.merge(s.spark, path, s.tables.leg_distances, LEG_KEYS, LEG_LAYOUT, "_id_oid", SLICE_ROWS)
    near = lambda name, ids, key: snapshots.read_near(s.spark, path, LEG_LAYOUT, ids, key)
    stored = Tables(lambda name: getattr(s.tables, name), near)
    return rounded(missing.market_missing(stored, WINDOW), "avg_distance")
