"""GPS-measured distances and routes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import GPS, RETURN_STEP, RunWindow, SplitPolicy
from legmeter.functions.timing import effective_within, in_days, within
from legmeter.operators.orders import in_warehouses, start_point
from legmeter.operators.routes import latest_routes, route_to_points
from legmeter.plans.market import courier_sequence, padded_market_rows
from legmeter.sources.tables import Tables


def gps_distance_info(
    tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",), policy: SplitPolicy = SplitPolicy()
) -> DataFrame:
    """Measured distances of orders delivered in the window, with the legs of the market orders among them.

    Cancelled orders play no part, neither as results nor as previous drops.
    """
    delivered = in_days(tables.marketorders, window).filter(
        within(F.col("deliver_date"), window) & in_warehouses(F.col("warehouse_warehouse_oid"), warehouses)
    ).select("_id_oid")
    measured = tables.orders_distances.select("_id_oid", F.col("corrected_distance").alias("distance")).join(
        delivered, "_id_oid"
    )
    rows = padded_market_rows(tables, window, warehouses, delivered_only=True)
    sequenced = courier_sequence(rows, "delivered_l", policy).filter(within(F.col("delivered"), window))
    # The start point needs the order's place in its batch only, not the job's last one.
    legs = sequenced.select(
        F.col("order_id").alias("_id_oid"), "to_lon", "to_lat", "is_batched", "delivery_batch_index",
        *start_point(F.col("delivery_batch_index") == 1),
    )
    return measured.join(legs, "_id_oid", "left").select(
        "_id_oid",
        F.coalesce("delivery_batch_index", F.lit(1)).cast("int").alias("step"),
        "to_lon",
        "to_lat",
        "from_lon",
        "from_lat",
        "distance",
        F.lit(GPS).alias("distance_type"),
        "is_batched",
    )


def gps_with_return(distances: DataFrame) -> DataFrame:
    """Known distances, with those of unbatched orders once more as step -1."""
    steps = F.when(
        F.col("is_batched") == F.lit(False), F.array("step", F.lit(RETURN_STEP))
    ).otherwise(F.array("step"))
    return distances.filter(F.col("distance").isNotNull()).select(
        "_id_oid",
        F.explode(steps).alias("step"),
        *[name for name in distances.columns if name not in ("_id_oid", "step")],
    )


def gps_routes(
    tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",), zero_offset_is_null: bool = True
) -> DataFrame:
    """Points of the routes whose orders fall in the window."""
    orders = in_days(tables.marketorders, window).filter(
        effective_within(F.col("deliver_date"), F.col("cancel_date"), window)
    ).select("_id_oid")
    routes = tables.routes_market.filter(in_warehouses(F.col("warehouse"), warehouses)).select(
        "_id_oid", "encoded_latlons", "encoded_time", "start_time"
    )
    return route_to_points(latest_routes(routes.join(orders, "_id_oid")), zero_offset_is_null)
