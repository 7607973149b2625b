"""Orders still without a road price, with the warehouse averages that can stand in for one.

The missing set is a subset of the very rows that carry the legs, so it is an anti join on those rows
and not a second scan joined back.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.config import (
    MARKET_DOMAINS,
    PREDICTED,
    ROAD,
    WATER_DOMAIN,
    WATER_LOOK_BACK_HOURS,
    Reasons,
    RunWindow,
    SplitPolicy,
)
from legmeter.functions.timing import effective_within, in_days, within
from legmeter.operators.legs import TRIP_LEGS
from legmeter.operators.orders import batch_max, in_warehouses, is_eligible
from legmeter.plans.market import courier_sequence, leg_columns, padded_market_rows
from legmeter.plans.trips import (
    COMPLETED_TASKS,
    TRIP_COLUMNS,
    artisan_delivery,
    courier_warehouse,
    food_delivery,
    kept_orders,
    task_batch_index,
    trip_rows,
    warehouse_or_store,
)
from legmeter.plans.water import next_order_after_refill, orders_after_refill, padded_water_rows, vehicle_sequence, water_start
from legmeter.sources.tables import Tables

# Output columns.
MARKET_COLUMNS = [
    "order_id", "deliver_date_l", "deliver_date", "is_batched", "delivery_batch_index", "max_index",
    "delivery_job_oid", "warehouse_id", "courier_id", "order_number", "warehouse_lon", "warehouse_lat", "prev_lon",
    "prev_lat", "from_lon", "from_lat", "to_lon", "to_lat", "avg_distance", "will_return_warehouse",
]
# Output columns.
WATER_COLUMNS = [
    "order_id", "deliver_date", "deliver_date_l", "is_batched", "delivery_batch_index", "delivery_job_oid",
    "warehouse_id", "courier_id", "courier_fleetvehicle_oid", "order_number", "warehouse_lon", "warehouse_lat",
    "to_lon", "to_lat", "prev_lon", "prev_lat", "is_from_warehouse", "avg_distance", "from_lon", "from_lat",
]


def priced_orders(leg_distances: DataFrame) -> DataFrame:
    """Ids that already have a road or predicted distance."""
    return (
        leg_distances.filter(F.col("distance_type").isin(ROAD, PREDICTED) & F.col("distance").isNotNull())
        .select(F.col("_id_oid").alias("order_id"))
        .distinct()
    )


def _average_distance(
    tables: Tables, window: RunWindow, domains: tuple[int, ...], warehouses: Iterable[str], kind: Column
) -> DataFrame:
    orders = in_days(tables.marketorders, window).filter(
        effective_within(F.col("deliver_date"), F.col("cancel_date"), window)
        & F.col("domaintype").isin(*domains)
        & is_eligible(F.col("status"), F.col("courier_courier_oid"), F.col("cancel_date"))
        & in_warehouses(F.col("warehouse_warehouse_oid"), warehouses)
    ).select("_id_oid", F.col("warehouse_warehouse_oid").alias("warehouse_id"))
    return (
        tables.near("leg_distances", orders, "_id_oid")
        .filter(kind)
        .select("_id_oid", "distance")
        .join(orders, "_id_oid")
        .groupBy("warehouse_id")
        .agg(F.avg("distance").alias("avg_distance"))
    )


def avg_distance_market(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    """Average km per warehouse over all kinds of distance; kept sums are used where there are some."""
    kept = tables.averages("market", window, warehouses)
    return kept if kept is not None else _average_distance(tables, window, MARKET_DOMAINS, warehouses, F.lit(True))


def avg_distance_water(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    """Average road km per warehouse, over the window and the day before it."""
    kept = tables.averages("water", window, warehouses)
    if kept is not None:
        return kept
    wide = window.widened(back_hours=WATER_LOOK_BACK_HOURS)
    return _average_distance(tables, wide, (WATER_DOMAIN,), warehouses, F.col("distance_type") == ROAD)


def market_missing(
    tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",), policy: SplitPolicy = SplitPolicy()
) -> DataFrame:
    rows = padded_market_rows(tables, window, warehouses)
    sequenced = courier_sequence(rows, "eff_date_l", policy).filter(within(F.col("eff_date"), window))
    stored = tables.near("leg_distances", rows, "order_id")
    missing = sequenced.join(priced_orders(stored), "order_id", "left_anti")
    return (
        leg_columns(missing, batch_max(rows))
        .join(avg_distance_market(tables, window, warehouses), "warehouse_id", "left")
        .withColumnsRenamed({"eff_date": "deliver_date", "delivered_l": "deliver_date_l"})
        .select(*MARKET_COLUMNS)
    )


def water_missing(
    tables: Tables,
    window: RunWindow,
    reasons: Reasons,
    warehouses: Iterable[str] = ("all",),
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Only delivered orders count as missing here; cancelled ones still serve as previous drops."""
    rows = padded_water_rows(tables, window, warehouses)
    sequenced = vehicle_sequence(rows, by_effective_date=True, policy=policy).filter(
        within(F.col("delivered"), window)
    )
    stored = tables.near("leg_distances", rows, "order_id")
    missing = sequenced.join(priced_orders(stored), "order_id", "left_anti")
    refilled = orders_after_refill(next_order_after_refill(tables, window, reasons, warehouses, policy))
    return (
        water_start(missing, refilled)
        .join(avg_distance_water(tables, window, warehouses), "warehouse_id", "left")
        .withColumnsRenamed({"eff_date": "deliver_date", "eff_date_l": "deliver_date_l"})
        .select(*WATER_COLUMNS)
    )


def complete_trips(trip_distances: DataFrame) -> DataFrame:
    """Ids whose every stored row has all three legs; an order with any gap is priced again."""
    whole = F.col(TRIP_LEGS[0]).isNotNull() & F.col(TRIP_LEGS[1]).isNotNull() & F.col(TRIP_LEGS[2]).isNotNull()
    return (
        trip_distances.groupBy(F.col("_id_oid").alias("order_id"))
        .agg(F.bool_and(whole).alias("_whole"))
        .filter("_whole")
        .select("order_id")
    )


def _average_legs(kept: DataFrame, tables: Tables, distances: str) -> DataFrame:
    """Average km of each leg per courier warehouse, for warehouses with a known zone."""
    zones = tables.warehouse_locations.select(F.col("warehouse").alias("courierwarehouse_oid"))
    orders = kept.select("_id_oid", "courierwarehouse_oid").join(zones, "courierwarehouse_oid")
    return (
        tables.near(distances, kept, "_id_oid")
        .select("_id_oid", *TRIP_LEGS)
        .join(orders, "_id_oid")
        .groupBy("courierwarehouse_oid")
        .agg(*[F.avg(leg).alias(f"{leg}_avg") for leg in TRIP_LEGS])
    )


def avg_legs_food(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    known = tables.averages("food", window, warehouses)
    if known is not None:
        return known.withColumnRenamed("warehouse_id", "courierwarehouse_oid")
    kept = kept_orders(tables.food_orders, window, food_delivery(), warehouses)
    return _average_legs(kept, tables, "food_distances")


def avg_legs_artisan(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    known = tables.averages("artisan", window, warehouses)
    if known is not None:
        return known.withColumnRenamed("warehouse_id", "courierwarehouse_oid")
    kept = kept_orders(tables.artisan_orders, window, artisan_delivery(), warehouses)
    return _average_legs(kept, tables, "artisan_distances")


def _with_averages(missing: DataFrame, averages: DataFrame) -> DataFrame:
    return missing.join(
        averages.withColumnRenamed("courierwarehouse_oid", "warehouse_id"), "warehouse_id", "left"
    )


def food_missing(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    kept = kept_orders(tables.food_orders, window, food_delivery(), warehouses)
    rows = trip_rows(kept, tables, courier_warehouse(), "inner")
    missing = rows.join(complete_trips(tables.near("food_distances", kept, "_id_oid")), "order_id", "left_anti")
    averaged = _with_averages(missing, avg_legs_food(tables, window, warehouses))
    return averaged.select(*TRIP_COLUMNS, *[f"{leg}_avg" for leg in TRIP_LEGS])


def artisan_missing(
    tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",), policy: SplitPolicy = SplitPolicy()
) -> DataFrame:
    """One row per order; ``batch_index`` is the order's first completed delivery task, if it has one."""
    kept = kept_orders(tables.artisan_orders, window, artisan_delivery(), warehouses)
    rows = trip_rows(kept, tables, warehouse_or_store(), "inner")
    missing = rows.join(complete_trips(tables.near("artisan_distances", kept, "_id_oid")), "order_id", "left_anti")
    first = (
        task_batch_index(tables, "orderid_oid", COMPLETED_TASKS, policy, kept)
        .groupBy(F.col("orderid_oid").alias("order_id"))
        .agg(F.min("batch_index").alias("batch_index"))
    )
    averaged = _with_averages(missing.join(first, "order_id", "left"), avg_legs_artisan(tables, window, warehouses))
    return averaged.select(*TRIP_COLUMNS, "batch_index", *[f"{leg}_avg" for leg in TRIP_LEGS])
