"""Water legs and refill trips."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import (
    AVAILABLE_STATUS,
    BUSY_STATUS,
    BUSY_TRIP,
    QUIET_HOURS,
    REFILL_LOOK_AHEAD_HOURS,
    REFILL_STATUS,
    REFILL_TRIP,
    WATER_DOMAIN,
    WATER_LOOK_BACK_HOURS,
    Reasons,
    RunWindow,
    SplitPolicy,
)
from legmeter.functions.timing import day_number, in_days, to_home_zone, to_zone, within
from legmeter.operators.ordered_groups import OrderedGroups, mark_groups
from legmeter.operators.orders import in_warehouses, market_rows, start_point, with_zone
from legmeter.sources.tables import Tables

# Output columns.
LEG_COLUMNS = [
    "order_id", "deliver_date_l", "is_batched", "delivery_batch_index", "delivery_job_oid", "warehouse_id",
    "courier_id", "courier_fleetvehicle_oid", "order_number", "warehouse_lon", "warehouse_lat", "to_lon", "to_lat",
    "prev_lon", "prev_lat", "is_from_warehouse", "from_lon", "from_lat",
]


def padded_water_rows(tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    wide = window.widened(back_hours=WATER_LOOK_BACK_HOURS)
    return market_rows(tables.marketorders, tables.warehouse_locations, wide, (WATER_DOMAIN,), warehouses)


def vehicle_sequence(rows: DataFrame, by_effective_date: bool = False, policy: SplitPolicy = SplitPolicy()) -> DataFrame:
    """Add the previous drop of the vehicle and the courier's daily order number.

    The order is by home-zone delivery time, cancelled orders last; the missing-order run uses the
    effective date instead.
    """
    timed = rows.withColumn("_day", day_number(F.col("eff_date_l"))).withColumn(
        "_time", F.col("eff_date") if by_effective_date else to_home_zone(F.col("delivered"))
    )
    order = ["_time", "eff_date", "order_id"]
    vehicles = OrderedGroups(["courier_fleetvehicle_oid", "warehouse_id"], order, policy=policy, name="vehicle_piece")
    couriers = OrderedGroups(["_day", "courier_id"], order, policy=policy, name="courier_piece", count_by=["courier_id"])
    # Both marks come before the first window, so that neither counts over a windowed plan.
    marked = mark_groups(timed, vehicles, couriers)
    found = vehicles.previous(marked, marked, {"prev_lon": "to_lon", "prev_lat": "to_lat"})
    numbered = couriers.number(found, marked, "order_number")
    return numbered.drop("_day", "_time", vehicles.piece, couriers.piece)


def refill_events(tables: Tables, wide: RunWindow, reasons: Reasons, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    """Refills and the events that name an order, with the local time they are compared by and its zone."""
    # Only refills are asked for, and only rows with an order can answer; all others stay out of the window.
    events = in_days(tables.courier_status_logs, wide).filter(
        within(F.col("createdat"), wide)
        & in_warehouses(F.col("warehouse_oid"), warehouses)
        & ((F.col("data_reason_oid") == reasons.refill) | F.col("marketorder_oid").isNotNull())
    )
    # The zone hangs on the warehouse master row, so an unknown warehouse has none.
    zones = tables.warehouse_locations.join(
        tables.warehouses.select(F.col("_id_oid").alias("warehouse")), "warehouse", "left_semi"
    )
    return with_zone(events, zones, F.col("warehouse_oid")).select(
        F.col("_id_oid").alias("log_id"),
        "createdat",
        to_zone(F.col("createdat"), F.col("zone")).alias("compare_date_l"),
        F.col("warehouse_oid").alias("warehouse_id"),
        F.col("courier_oid").alias("courier_id"),
        F.col("data_plate").alias("vehicle"),
        "data_reason_oid",
        "marketorder_oid",
        "zone",
    )


def next_order_after_refill(
    tables: Tables,
    window: RunWindow,
    reasons: Reasons,
    warehouses: Iterable[str] = ("all",),
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Refill events of the window with the courier's next order, looked for up to two hours past the end."""
    rows = refill_events(tables, window.widened(ahead_hours=REFILL_LOOK_AHEAD_HOURS), reasons, warehouses).drop("zone")
    groups = OrderedGroups(
        ["warehouse_id", "courier_id"], ["compare_date_l", "createdat", "log_id"], policy=policy, name="event_piece"
    )
    marked = groups.mark(rows)
    return (
        groups.next_value(marked, marked, "next_order", "marketorder_oid")
        .filter((F.col("data_reason_oid") == reasons.refill) & within(F.col("createdat"), window))
        .select("log_id", "createdat", "compare_date_l", "warehouse_id", "courier_id", "vehicle", "next_order")
    )


def orders_after_refill(refills: DataFrame) -> DataFrame:
    """Each order that follows a refill, once, however many refills came before it."""
    return refills.filter(F.col("next_order").isNotNull()).select(F.col("next_order").alias("order_id")).distinct()


def water_start(sequenced: DataFrame, after_refill: DataFrame) -> DataFrame:
    flagged = sequenced.join(after_refill.withColumn("_refilled", F.lit(1)), "order_id", "left")
    return flagged.select(
        "*",
        F.coalesce("_refilled", F.lit(0)).alias("is_from_warehouse"),
        *start_point(F.col("_refilled") == 1),
    ).drop("_refilled")


def legs_water(
    tables: Tables,
    window: RunWindow,
    reasons: Reasons,
    warehouses: Iterable[str] = ("all",),
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    rows = padded_water_rows(tables, window, warehouses)
    sequenced = vehicle_sequence(rows, policy=policy).filter(within(F.col("eff_date"), window))
    refilled = orders_after_refill(next_order_after_refill(tables, window, reasons, warehouses, policy))
    return water_start(sequenced, refilled).withColumnRenamed("eff_date_l", "deliver_date_l").select(*LEG_COLUMNS)


def refill_info(
    tables: Tables, window: RunWindow, reasons: Reasons, warehouses: Iterable[str] = ("all",)
) -> DataFrame:
    """Trips back to the warehouse for a refill, outside the quiet hours."""
    reason, new, old = F.col("data_reason_oid"), F.col("newstatus"), F.col("oldstatus")
    refilled = ((reason == reasons.refill) & (new == AVAILABLE_STATUS)) | (new == REFILL_STATUS)
    called_back = (reason == reasons.busy) & (new == AVAILABLE_STATUS) & (old == BUSY_STATUS)
    events = in_days(tables.courier_status_logs, window).filter(
        within(F.col("createdat"), window)
        & (refilled | called_back)
        & ~F.hour("createdatl").isin(*QUIET_HOURS)
        & in_warehouses(F.col("warehouse_oid"), warehouses)
    ).withColumnsRenamed({"_id_oid": "log_id", "warehouse_oid": "warehouse_id"})
    places = tables.warehouses.select(
        F.col("_id_oid").alias("warehouse_id"),
        "name",
        F.col("location__coordinates_lon").alias("warehouse_lon"),
        F.col("location__coordinates_lat").alias("warehouse_lat"),
    )
    return events.join(places, "warehouse_id", "left").select(
        "log_id",
        "marketorder_oid",
        "createdat",
        "createdatl",
        F.to_date("createdatl").alias("date_l"),
        "warehouse_id",
        "name",
        F.col("location__coordinates_lon").alias("refill_lon"),
        F.col("location__coordinates_lat").alias("refill_lat"),
        "warehouse_lon",
        "warehouse_lat",
        F.col("courier_oid").alias("courier_id"),
        F.col("currentmarketemployer_franchise_oid").alias("courier_franchise_id"),
        F.when(reason == reasons.busy, BUSY_TRIP).otherwise(REFILL_TRIP).alias("type"),
    )


def water_warehouses(tables: Tables) -> DataFrame:
    """Warehouses that serve the water line, once each."""
    return (
        tables.warehouse_domaintypes.filter(F.col("domaintypes") == WATER_DOMAIN)
        .select(F.col("_p_id_oid").alias("warehouse_id"))
        .distinct()
    )
