"""Bring priced rows into the result layouts: km, typed constants, no gaps, no copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import ARTISAN_DOMAIN, FOOD_DOMAIN, MARKET_DOMAINS, WATER_DOMAIN, ntz
from legmeter.operators.legs import TRIP_LEGS
from legmeter.sources.tables import LEG_LAYOUT, REFILL_LAYOUT, TRIP_LAYOUT, conform

METRES_PER_KM = 1000


def all_legs(*parts: DataFrame) -> DataFrame:
    """Market and water legs together; either may lack columns of the other."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def finalize_legs(priced: DataFrame, updated_at) -> DataFrame:
    """Market and water legs; the distinct runs once, on the narrow result."""
    rows = priced.filter(F.col("distance").isNotNull()).select(
        F.col("order_id").alias("_id_oid"),
        "step",
        "to_lon",
        "to_lat",
        "from_lon",
        "from_lat",
        (F.col("distance") / METRES_PER_KM).alias("distance"),
        "distance_type",
        ntz(updated_at).alias("updated_at"),
        "duration",
    )
    return conform(rows, LEG_LAYOUT).distinct()


def finalize_trips(priced: DataFrame, updated_at, step: str | None = None) -> DataFrame:
    """Food (no step) and artisan trips; all three legs must be known."""
    rows = priced.dropna(subset=list(TRIP_LEGS)).select(
        F.col("order_id").alias("_id_oid"),
        F.col("warehouse_lon").alias("store_lon"),
        F.col("warehouse_lat").alias("store_lat"),
        "restaurant_lon",
        "restaurant_lat",
        F.col("to_lon").alias("client_lon"),
        F.col("to_lat").alias("client_lat"),
        *[(F.col(leg) / METRES_PER_KM).alias(leg) for leg in TRIP_LEGS],
        *[F.col(f"{leg}_duration") for leg in TRIP_LEGS],
        "distance_type",
        ntz(updated_at).alias("updated_at"),
        (F.col(step) if step else F.lit(None)).cast("int").alias("step"),
    )
    first, second, third = TRIP_LEGS
    summed = rows.withColumns(
        {
            "distance": F.col(first) + F.col(second) + F.col(third),
            "duration": F.col(f"{first}_duration") + F.col(f"{second}_duration") + F.col(f"{third}_duration"),
        }
    )
    return conform(summed, TRIP_LAYOUT).distinct()


def finalize_refill(priced: DataFrame, updated_at) -> DataFrame:
    rows = priced.filter(F.col("distance").isNotNull()).withColumns(
        {
            "lon": F.col("refill_lon"),
            "lat": F.col("refill_lat"),
            "refill_distance": F.col("distance") / METRES_PER_KM,
            "updated_at": ntz(updated_at),
        }
    )
    return conform(rows, REFILL_LAYOUT).distinct()


def finalize_gps(distances: DataFrame, updated_at) -> DataFrame:
    """Measured distances are in km already and have no duration."""
    return conform(distances.withColumn("updated_at", ntz(updated_at)), LEG_LAYOUT).distinct()


def arrange_partner_legs(feed: DataFrame) -> DataFrame:
    """Partner rows of the market and water domains in the leg layout."""
    rows = feed.filter(F.col("domain_type").isin(*MARKET_DOMAINS, WATER_DOMAIN))
    return conform(rows.withColumnRenamed("order_id", "_id_oid"), LEG_LAYOUT).distinct()


def arrange_partner_trips(feed: DataFrame, domain: int) -> DataFrame:
    """Partner rows of the food or artisan domain in the trip layout; the single legs are unknown."""
    if domain not in (FOOD_DOMAIN, ARTISAN_DOMAIN):
        raise ValueError("only food and artisan rows are trips")
    rows = feed.filter(F.col("domain_type") == domain)
    return conform(rows.withColumnRenamed("order_id", "_id_oid"), TRIP_LAYOUT).distinct()


def run_counts(**lines: DataFrame) -> DataFrame:
    """Rows per business line, lines without rows included."""
    counted = None
    for name, rows in lines.items():
        one = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("line"), "rows")
        counted = one if counted is None else counted.unionByName(one)
    return counted
