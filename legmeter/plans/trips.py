"""Food and artisan orders: store to restaurant to client to store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.config import DIRECT_DELIVERY, RunWindow, SplitPolicy
from legmeter.functions.timing import effective_date, effective_within, in_days, to_zone
from legmeter.operators.ordered_groups import OrderedGroups
from legmeter.operators.joins import left_join_any
from legmeter.operators.orders import in_warehouses, is_eligible, with_zone
from legmeter.sources.tables import Tables

# Courier task kind and states.
DELIVERY_TASK = "Delivery"
CLOSED_TASKS = ("COMPLETED", "CANCELLED")
COMPLETED_TASKS = ("COMPLETED",)

# Output columns.
TRIP_COLUMNS = [
    "order_id", "deliver_date", "deliver_date_l", "day", "warehouse_id", "courier_id", "warehouse_lon",
    "warehouse_lat", "restaurant_lon", "restaurant_lat", "to_lon", "to_lat",
]


def food_delivery() -> Column:
    return F.col("deliverytype").isNull() | (F.col("deliverytype") == DIRECT_DELIVERY)


def artisan_delivery() -> Column:
    return F.col("deliverytype") == DIRECT_DELIVERY


def courier_warehouse() -> Column:
    return F.col("courierwarehouse_oid")


def warehouse_or_store() -> Column:
    return F.coalesce("courierwarehouse_oid", "courierstore_oid")


def kept_orders(
    orders: DataFrame, window: RunWindow, delivery: Column, warehouses: Iterable[str] = ("all",)
) -> DataFrame:
    return in_days(orders, window).filter(
        effective_within(F.col("deliverdate"), F.col("canceldate"), window)
        & is_eligible(F.col("status"), F.col("courier_oid"), F.col("canceldate"))
        & delivery
        & in_warehouses(F.col("courierwarehouse_oid"), warehouses)
    )


def trip_rows(kept: DataFrame, tables: Tables, place: Column, how: str = "left") -> DataFrame:
    """Orders with store coordinates and local time; ``place`` is the column both dimensions hang on."""
    stores = tables.warehouses.select(
        F.col("_id_oid").alias("_store"),
        F.col("location__coordinates_lon").alias("warehouse_lon"),
        F.col("location__coordinates_lat").alias("warehouse_lat"),
    )
    effective = effective_date(F.col("deliverdate"), F.col("canceldate"))
    local = to_zone(effective, F.col("zone"))
    placed = kept.withColumn("_place", place).join(stores, F.col("_place") == F.col("_store"), how)
    return with_zone(placed, tables.warehouse_locations, F.col("_place"), how).select(
        F.col("_id_oid").alias("order_id"),
        effective.alias("deliver_date"),
        local.alias("deliver_date_l"),
        F.to_date(local).alias("day"),
        warehouse_or_store().alias("warehouse_id"),
        F.col("courier_oid").alias("courier_id"),
        "warehouse_lon",
        "warehouse_lat",
        F.col("restaurantloc_lon").alias("restaurant_lon"),
        F.col("restaurantloc_lat").alias("restaurant_lat"),
        F.col("deliveryaddress_location__coordinates_lon").alias("to_lon"),
        F.col("deliveryaddress_location__coordinates_lat").alias("to_lat"),
    )


def food_order_info(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    kept = kept_orders(tables.food_orders, window, food_delivery(), warehouses)
    return trip_rows(kept, tables, courier_warehouse())


def task_batch_index(
    tables: Tables,
    group: str = "taskgroupid_oid",
    states: tuple[str, ...] = CLOSED_TASKS,
    policy: SplitPolicy = SplitPolicy(),
    orders: DataFrame | None = None,
) -> DataFrame:
    """Position of each delivery task in its group, by sequence.

    With ``orders`` (``_id_oid``) only the groups that hold a task of theirs are ranked, not the whole history.
    """
    tasks = tables.courier_tasks.filter((F.col("type") == DELIVERY_TASK) & F.col("status").isin(*states))
    if orders is not None:
        wanted = tasks.join(orders.select(F.col("_id_oid").alias("orderid_oid")), "orderid_oid", "left_semi")
        wanted = wanted.select(F.col(group).alias("_group")).distinct()
        # A null group is a group too.
        tasks = tasks.join(wanted, F.col(group).eqNullSafe(F.col("_group")), "left_semi")
    groups = OrderedGroups([group], ["sequence", "task_id"], policy=policy, name="task_piece")
    marked = groups.mark(tasks.select("task_id", "orderid_oid", "taskgroupid_oid", "sequence"))
    return groups.number(marked, marked, "batch_index").drop(groups.piece)


def artisan_order_info(
    tables: Tables,
    window: RunWindow,
    warehouses: Iterable[str] = ("all",),
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """As the food orders, once per closed delivery task of the order, with the task's position."""
    kept = kept_orders(tables.artisan_orders, window, artisan_delivery(), warehouses)
    positions = task_batch_index(tables, policy=policy, orders=kept).select(
        F.col("orderid_oid").alias("order_id"), "batch_index"
    )
    return left_join_any(trip_rows(kept, tables, warehouse_or_store()), positions, "order_id").select(
        *TRIP_COLUMNS, "batch_index"
    )
