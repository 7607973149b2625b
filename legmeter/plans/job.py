"""One run: choose the lines by mode, price them, finish them, store them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legmeter.config import ARTISAN_DOMAIN, FOOD_DOMAIN, JobConfig, RunWindow
from legmeter.operators import snapshots
from legmeter.operators.legs import (
    legs_with_return,
    predict_missing,
    predict_missing_trip,
    price_legs,
    trip_legs,
    with_step,
)
from legmeter.operators.pricing import settled
from legmeter.operators.upsert import LEG_KEYS, POINT_KEYS, REFILL_KEYS, TRIP_KEYS, expired_routes
from legmeter.plans import averages, gps, missing, trips, water
from legmeter.plans.export import write_partner_export
from legmeter.plans.finalize import (
    all_legs,
    arrange_partner_legs,
    arrange_partner_trips,
    finalize_gps,
    finalize_legs,
    finalize_refill,
    finalize_trips,
)
from legmeter.plans.market import legs_market
from legmeter.plans.slots import SlotGrid, order_lines_slots
from legmeter.sources.landing import feed_window, read_partner_feed, write_check_tables
from legmeter.sources.tables import LEG_LAYOUT, POINT_LAYOUT, REFILL_LAYOUT, TRIP_LAYOUT, Tables

MODES = ("osrm", "gps", "both", "monthly_missing", "partner")
# Which domain choice runs which line; the market choice 1 includes water.
LINES = {
    "market": ("all", "1", "3"),
    "water": ("all", "1", "4"),
    "food": ("all", "2"),
    "artisan": ("all", "6"),
}

# Fixed value: UTC hour of the run that also exports.
EXPORT_HOUR = 4

# Result name -> (stored table, keys, layout, sort key).
TARGETS = {
    "leg_distances": ("leg_distances", LEG_KEYS, LEG_LAYOUT, "_id_oid"),
    "gps_distances": ("leg_distances", LEG_KEYS, LEG_LAYOUT, "_id_oid"),
    "food_distances": ("food_distances", TRIP_KEYS, TRIP_LAYOUT, "_id_oid"),
    "artisan_distances": ("artisan_distances", TRIP_KEYS, TRIP_LAYOUT, "_id_oid"),
    "refill_distances": ("refill_distances", REFILL_KEYS, REFILL_LAYOUT, "createdatl"),
    "route_points": ("route_points", POINT_KEYS, POINT_LAYOUT, "_id_oid"),
}


# Result tables that later runs read.
READ_AGAIN = {"leg_distances": LEG_LAYOUT, "food_distances": TRIP_LAYOUT, "artisan_distances": TRIP_LAYOUT}


def open_tables(spark: SparkSession, root: str, results: str) -> Tables:
    """Input tables from ``root/<name>`` and the result tables that runs have stored under ``results``."""
    plain, base = Tables.from_parquet(spark, root), results.rstrip("/")

    def load(name: str) -> DataFrame:
        if name in READ_AGAIN:
            return snapshots.read(spark, f"{base}/{name}", READ_AGAIN[name])
        return getattr(plain, name)

    def load_near(name: str, ids: DataFrame, key: str) -> DataFrame:
        return snapshots.read_near(spark, f"{base}/{name}", READ_AGAIN[name], ids, key)

    def load_averages(line: str, *chosen) -> DataFrame | None:
        if not snapshots.exists(spark, f"{base}/{averages.TABLE}"):
            return None
        return averages.averages(spark, opened, base, line, *chosen)

    opened = Tables(load, load_near, load_averages)
    return opened


def order_lines(tables: Tables, config: JobConfig) -> dict[str, DataFrame]:
    """The unpriced rows of every line the run covers."""
    window, places, policy = config.window, config.warehouses, config.split
    if config.mode == "monthly_missing":
        return {
            "market": missing.market_missing(tables, window, places, policy),
            "water": missing.water_missing(tables, window, config.reasons, places, policy),
            "food": missing.food_missing(tables, window, places),
            "artisan": missing.artisan_missing(tables, window, places, policy),
        }
    if config.mode not in ("osrm", "both"):
        return {}
    chosen = {name for name, choices in LINES.items() if config.line in choices}
    found: dict[str, DataFrame] = {}
    if "market" in chosen:
        found["market"] = legs_market(tables, window, places, policy)
    if "water" in chosen:
        found["water"] = water.legs_water(tables, window, config.reasons, places, policy)
        found["refill"] = water.refill_info(tables, window, config.reasons, places)
    if "food" in chosen:
        found["food"] = trips.food_order_info(tables, window, places)
    if "artisan" in chosen:
        found["artisan"] = trips.artisan_order_info(tables, window, places, policy)
    return found


def refill_legs(refills: DataFrame, provider) -> DataFrame:
    """Refill point to warehouse."""
    points = ("refill_lon", "refill_lat", "warehouse_lon", "warehouse_lat")
    refills = settled(refills, provider)
    return provider.prepared(refills, [points]).price(refills, points).withColumn("distance_type", F.lit(provider.label))


def price_lines(lines: dict[str, DataFrame], config: JobConfig, provider) -> dict[str, DataFrame]:
    """Priced and finished results. Market and water share one pricing pass."""
    fill = config.mode == "monthly_missing"
    results: dict[str, DataFrame] = {}
    parts = []
    if "market" in lines:
        parts.append(legs_with_return(lines["market"]))
    if "water" in lines:
        parts.append(with_step(lines["water"]))
    if parts:
        priced = price_legs(all_legs(*parts), provider)
        results["leg_distances"] = finalize_legs(predict_missing(priced) if fill else priced, config.updated_at)
    if "refill" in lines:
        results["refill_distances"] = finalize_refill(refill_legs(lines["refill"], provider), config.updated_at)
    for name, step in (("food", None), ("artisan", "batch_index")):
        if name in lines:
            priced = trip_legs(lines[name], provider)
            results[f"{name}_distances"] = finalize_trips(
                predict_missing_trip(priced) if fill else priced, config.updated_at, step
            )
    return results


def run(tables: Tables, config: JobConfig, provider=None, feed_path: str | None = None) -> dict[str, DataFrame]:
    """All results of a run. Building them counts ordered groups and may ask the price service. ``provider`` prices legs; ``feed_path`` is the partner's landing folder."""
    if config.mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    results: dict[str, DataFrame] = {}
    if config.mode in ("osrm", "both", "monthly_missing"):
        results.update(price_lines(order_lines(tables, config), config, provider))
    if config.mode in ("gps", "both"):
        measured = gps.gps_distance_info(tables, config.window, config.warehouses, config.split)
        results["gps_distances"] = finalize_gps(measured, config.updated_at)
        results["route_points"] = gps.gps_routes(tables, config.window, config.warehouses, config.zero_offset_is_null)
    if config.mode == "partner":
        feed = read_partner_feed(
            SparkSession.active(),
            feed_path,
            feed_window(config.mode, config.window),
            config.updated_at,
            config.partner_label,
            config.partner_period,
        )
        results["leg_distances"] = arrange_partner_legs(feed)
        results["food_distances"] = arrange_partner_trips(feed, FOOD_DOMAIN)
        results["artisan_distances"] = arrange_partner_trips(feed, ARTISAN_DOMAIN)
    return results


def run_slots(tables: Tables, config: JobConfig, grid: SlotGrid, provider) -> dict[str, DataFrame]:
    """The results of all runs of a grid in mode ``osrm``, as storing one run after the other would leave them.

    ``config.window`` plays no part: the grid has the windows. An order that several runs cover counts in the last.
    """
    names = {"market": ["market"], "water": ["water", "refill"], "food": ["food"], "artisan": ["artisan"]}
    chosen = [part for name, choices in LINES.items() if config.line in choices for part in names[name]]
    lines = order_lines_slots(tables, grid, config.reasons, chosen, config.warehouses, latest_only=True)
    return price_lines({name: rows.drop("run_start") for name, rows in lines.items()}, config, provider)


def store(
    spark: SparkSession, results: dict[str, DataFrame], root: str, config: JobConfig, tables: Tables | None = None
) -> int | None:
    """Merge every result into its table under ``root`` and, with ``tables``, bring the kept averages up to date.

    A run with routes also expires old ones and returns how many points are left, from the counts of the slices.
    """
    base = root.rstrip("/")
    for name, rows in results.items():
        table, keys, layout, sort_key = TARGETS[name]
        snapshots.merge(spark, f"{base}/{table}", rows, keys, layout, sort_key)
    if tables is not None and any(name in results for name in READ_AGAIN):
        averages.refresh(spark, tables, base, config.window)
        snapshots.vacuum(spark, f"{base}/{averages.TABLE}")
    for table in sorted({TARGETS[name][0] for name in results}):
        snapshots.vacuum(spark, f"{base}/{table}")
    if "route_points" in results and tables is not None:
        path = f"{base}/route_points"
        expired = expired_routes(tables.routes_market, config.window.start, config.warehouses)
        return snapshots.expire(spark, path, expired, POINT_LAYOUT).rows
    return None


def daily_export(tables: Tables, config: JobConfig, now: datetime, path: str) -> bool:
    """The run at the export hour in mode ``osrm`` also writes the partner export of the day before."""
    if config.mode != "osrm" or now.hour != EXPORT_HOUR:
        return False
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    write_partner_export(tables, RunWindow(midnight - timedelta(days=1), midnight), path)
    return True


def check(results: dict[str, DataFrame], folder: str) -> None:
    """Write the results for inspection instead of storing them."""
    write_check_tables(folder, **results)
