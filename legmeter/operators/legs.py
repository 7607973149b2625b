"""Legs: return legs, three-leg trips, pricing and the fallback to averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import PREDICTED, RETURN_STEP
from legmeter.operators.pricing import LEG_POINTS, settled

# The legs of a food or artisan trip.
TRIP_LEGS = ("store_to_rest", "rest_to_client", "client_to_store")
_TRIP_POINTS = {
    "store_to_rest": ("warehouse_lon", "warehouse_lat", "restaurant_lon", "restaurant_lat"),
    "rest_to_client": ("restaurant_lon", "restaurant_lat", "to_lon", "to_lat"),
    "client_to_store": ("to_lon", "to_lat", "warehouse_lon", "warehouse_lat"),
}
# Averages come from result tables in km, legs are in metres until they are finished.
METRES_PER_KM = 1000.0


def with_step(legs: DataFrame, index: str = "delivery_batch_index") -> DataFrame:
    return legs.withColumn("step", F.col(index).cast("int"))


def legs_with_return(legs: DataFrame) -> DataFrame:
    """Add a leg back to the warehouse (step -1) for unbatched orders and for the last of a batch.

    One pass: each order explodes into its one or two legs.
    """
    here = ["from_lon", "from_lat", "to_lon", "to_lat"]
    outward = F.struct(
        F.col("delivery_batch_index").cast("int").alias("step"), F.lit(False).alias("is_return"), *here
    )
    back = F.struct(
        F.lit(RETURN_STEP).alias("step"),
        F.lit(True).alias("is_return"),
        F.col("to_lon").alias("from_lon"),
        F.col("to_lat").alias("from_lat"),
        F.col("warehouse_lon").alias("to_lon"),
        F.col("warehouse_lat").alias("to_lat"),
    )
    goes_back = (F.col("is_batched") == F.lit(False)) | (F.col("is_batched") & (F.col("will_return_warehouse") == 1))
    both = F.when(goes_back, F.array(outward, back)).otherwise(F.array(outward))
    kept = [name for name in legs.columns if name not in here]
    return legs.select(*kept, F.inline(both))


def price_legs(legs: DataFrame, provider) -> DataFrame:
    legs = settled(legs, provider)
    return provider.prepared(legs, [LEG_POINTS]).price(legs).withColumn("distance_type", F.lit(provider.label))


def predict_missing(priced: DataFrame) -> DataFrame:
    """Fill outward legs without a price from the warehouse average and label them so."""
    missing = F.col("distance").isNull() & F.col("avg_distance").isNotNull()
    if "is_return" in priced.columns:
        missing = missing & ~F.coalesce("is_return", F.lit(False))
    return priced.withColumns(
        {
            "distance_type": F.when(missing, F.lit(PREDICTED)).otherwise(F.col("distance_type")),
            "distance": F.when(missing, F.col("avg_distance") * METRES_PER_KM).otherwise(F.col("distance")),
        }
    )


def trip_legs(orders: DataFrame, provider) -> DataFrame:
    """Distance and duration of store-restaurant, restaurant-client and client-store per order.

    Three lookups in a row: each moves the orders once at most, and a table's side of the shuffle is
    reused. Exploding into legs and folding back would move three times the rows twice.
    """
    priced = orders = settled(orders, provider)
    prices = provider.prepared(orders, list(_TRIP_POINTS.values()))
    for leg, points in _TRIP_POINTS.items():
        priced = prices.price(priced, points, leg, f"{leg}_duration")
    return priced.withColumn("distance_type", F.lit(provider.label))


def predict_missing_trip(priced: DataFrame) -> DataFrame:
    """Fill each leg from its own warehouse average; the row is predicted if any leg was."""
    filled = {leg: F.col(leg).isNull() & F.col(f"{leg}_avg").isNotNull() for leg in TRIP_LEGS}
    any_filled = filled[TRIP_LEGS[0]] | filled[TRIP_LEGS[1]] | filled[TRIP_LEGS[2]]
    return priced.withColumns(
        {
            "distance_type": F.when(any_filled, F.lit(PREDICTED)).otherwise(F.col("distance_type")),
            **{
                leg: F.when(filled[leg], F.col(f"{leg}_avg") * METRES_PER_KM).otherwise(F.col(leg))
                for leg in TRIP_LEGS
            },
        }
    )
