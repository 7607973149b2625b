"""Stages shared by the order plans: who counts, when, in which zone, in which batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.config import FINISHED_STATUSES, RunWindow
from legmeter.functions.timing import effective_date, effective_within, in_days, to_zone, within


def is_eligible(status: Column, courier: Column, cancelled: Column) -> Column:
    """Finished, or cancelled after a courier had taken it."""
    return status.isin(*FINISHED_STATUSES) | (courier.isNotNull() & cancelled.isNotNull())


def in_warehouses(column: Column, warehouses: Iterable[str]) -> Column:
    """True for every row if ``all`` is among the names (a null warehouse included)."""
    chosen = list(warehouses)
    return F.lit(True) if "all" in chosen else column.isin(*chosen)


def with_zone(df: DataFrame, zones: DataFrame, warehouse: Column, how: str = "left") -> DataFrame:
    """Add ``zone``. Spark broadcasts the dimension as long as its size allows it."""
    side = zones.select(F.col("warehouse").alias("_zone_of"), F.col("country_time_zone").alias("zone"))
    return df.join(side, warehouse == F.col("_zone_of"), how).drop("_zone_of")


def market_rows(
    orders: DataFrame,
    zones: DataFrame,
    window: RunWindow,
    domains: tuple[int, ...],
    warehouses: Iterable[str] = ("all",),
    delivered_only: bool = False,
) -> DataFrame:
    """Eligible orders of ``domains`` whose effective (or delivery) date falls in ``window``."""
    dated = (
        within(F.col("deliver_date"), window)
        if delivered_only
        else effective_within(F.col("deliver_date"), F.col("cancel_date"), window)
    )
    kept = in_days(orders, window).filter(
        dated
        & F.col("domaintype").isin(*domains)
        & is_eligible(F.col("status"), F.col("courier_courier_oid"), F.col("cancel_date"))
        & in_warehouses(F.col("warehouse_warehouse_oid"), warehouses)
    )
    effective = effective_date(F.col("deliver_date"), F.col("cancel_date"))
    return with_zone(kept, zones, F.col("warehouse_warehouse_oid")).select(
        F.col("_id_oid").alias("order_id"),
        F.col("warehouse_warehouse_oid").alias("warehouse_id"),
        F.col("courier_courier_oid").alias("courier_id"),
        "courier_fleetvehicle_oid",
        "delivery_job_oid",
        F.col("delivery_batch_isbatched").alias("is_batched"),
        F.col("delivery_batch_index").alias("batch_index_raw"),
        F.coalesce("delivery_batch_index", F.lit(1)).alias("delivery_batch_index"),
        F.col("deliver_date").alias("delivered"),
        "cancel_date",
        effective.alias("eff_date"),
        to_zone(F.col("deliver_date"), F.col("zone")).alias("delivered_l"),
        to_zone(effective, F.col("zone")).alias("eff_date_l"),
        F.col("delivery_address_location__coordinates_lon").alias("to_lon"),
        F.col("delivery_address_location__coordinates_lat").alias("to_lat"),
        F.col("warehouse_location__coordinates_lon").alias("warehouse_lon"),
        F.col("warehouse_location__coordinates_lat").alias("warehouse_lat"),
    )


def batch_max(rows: DataFrame) -> DataFrame:
    """Highest batch index per delivery job, over batched orders of a known job."""
    return (
        rows.filter(F.col("is_batched").eqNullSafe(True) & F.col("delivery_job_oid").isNotNull())
        .groupBy("delivery_job_oid")
        .agg(F.max("batch_index_raw").alias("max_index"))
    )


def with_batch_max(rows: DataFrame, maxima: DataFrame) -> DataFrame:
    """Left join of the job maximum as ``job_max``.

    Orders without a job never match, but they would all hash to one task, so they are keyed by their
    own id instead. The letter in front keeps both kinds of key apart.
    """
    keyed = rows.withColumn(
        "_job_key",
        F.coalesce(
            F.concat(F.lit("j"), F.col("delivery_job_oid").cast("string")),
            F.concat(F.lit("o"), F.col("order_id").cast("string")),
        ),
    )
    side = maxima.select(
        F.concat(F.lit("j"), F.col("delivery_job_oid").cast("string")).alias("_job_key"),
        F.col("max_index").alias("job_max"),
    )
    return keyed.join(side, "_job_key", "left").drop("_job_key")


def start_point(from_warehouse: Column) -> list[Column]:
    """``from_lon``/``from_lat``: the warehouse, or else the previous drop."""
    return [
        F.when(from_warehouse, F.col(f"warehouse_{axis}")).otherwise(F.col(f"prev_{axis}")).alias(f"from_{axis}")
        for axis in ("lon", "lat")
    ]
