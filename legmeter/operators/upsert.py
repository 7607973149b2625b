"""Keyed replacement of rows, and retention. ``snapshots`` stores result tables this way."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import RETENTION_DAYS, as_datetime, ntz

# Keys by which each result table replaces rows.
LEG_KEYS = ["_id_oid", "distance_type"]
TRIP_KEYS = ["_id_oid", "distance_type"]
REFILL_KEYS = ["courier_id", "createdatl"]
POINT_KEYS = ["_id_oid"]


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the rows whose key occurs in ``batch``, plus all of ``batch``.

    The batch may hold several rows per key and keeps them all. A null in a key matches nothing.
    """
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def expired_routes(routes: DataFrame, start, warehouses=("all",), days: int = RETENTION_DAYS) -> DataFrame:
    """Ids of the routes checked out more than ``days`` before ``start``."""
    old = F.col("checkout_date_l") < ntz(as_datetime(start) - timedelta(days=days))
    chosen = routes.filter(old)
    if "all" not in warehouses:
        chosen = chosen.filter(F.col("warehouse").isin(*warehouses))
    return chosen.select("_id_oid").distinct()


def retain(points: DataFrame, expired: DataFrame) -> DataFrame:
    return points.join(expired, "_id_oid", "left_anti")


def remaining(points: DataFrame) -> DataFrame:
    return points.agg(F.count(F.lit(1)).alias("remaining"))
