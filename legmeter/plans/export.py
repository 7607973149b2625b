"""Daily export of fleet and water kilometres."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import ROAD, WATER_DOMAIN, WATER_KM_CAP, RunWindow, ntz
from legmeter.functions.timing import day_start, iso_text
from legmeter.sources.tables import Tables

EXPORT_COLUMNS = ["order_id", "courier_id", "date_l", "domain_type", "step", "osrm", "distance"]


def fleet_km(tables: Tables, first, last) -> DataFrame:
    """Fleet vehicle log rows with a road distance, from ``first`` to ``last``, both included."""
    return tables.fleet_vehicle_km_logs.filter(
        F.col("date_l").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
        & F.col("osrm").isNotNull()
    ).select("order_id", "courier_id", "date_l", "order_domain", "step", "osrm", "km")


def water_km_capped(tables: Tables, first, last) -> DataFrame:
    """Water legs of orders checked out from ``first`` to ``last``, road km capped at 13."""
    orders = tables.marketorders.filter(
        (F.col("domaintype") == WATER_DOMAIN) & F.col("checkoutdatel").between(ntz(first), ntz(last))
    ).select("_id_oid", "courier_courier_oid", "checkoutdatel")
    stored = tables.near("leg_distances", orders, "_id_oid")
    legs = stored.filter(F.col("distance_type") == ROAD).select("_id_oid", "step", "distance")
    # ``least`` would turn an unknown distance into the cap.
    capped = F.when(F.col("distance") > WATER_KM_CAP, F.lit(WATER_KM_CAP)).otherwise(F.col("distance"))
    return orders.join(legs, "_id_oid").select(
        F.col("_id_oid").alias("order_id"),
        "courier_courier_oid",
        day_start(F.col("checkoutdatel")).alias("date_l"),
        F.lit(WATER_DOMAIN).alias("domaintype"),
        "step",
        capped.alias("osrm"),
        capped.alias("km"),
    )


def partner_export(tables: Tables, window: RunWindow) -> DataFrame:
    """Both sources in one layout, each row with the window as ISO text."""
    fleet = fleet_km(tables, str(window.start)[:10], str(window.end)[:10]).select(
        "order_id",
        "courier_id",
        F.col("date_l").cast("timestamp_ntz").alias("date_l"),
        F.col("order_domain").alias("domain_type"),
        "step",
        "osrm",
        F.col("km").alias("distance"),
    )
    water = water_km_capped(tables, window.start, window.end).withColumnsRenamed(
        {"courier_courier_oid": "courier_id", "domaintype": "domain_type", "km": "distance"}
    )
    return fleet.unionByName(water).select(
        *EXPORT_COLUMNS, iso_text(window.lo).alias("start_time"), iso_text(window.hi).alias("end_time")
    )


def write_partner_export(tables: Tables, window: RunWindow, path: str) -> None:
    partner_export(tables, window).select(*EXPORT_COLUMNS).write.option("header", True).csv(path)
