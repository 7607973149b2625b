"""Encoded routes to point rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.functions.routes import route_offsets, route_points
from legmeter.functions.timing import plus_seconds


def latest_routes(routes: DataFrame) -> DataFrame:
    """One route per order: the latest start. A maximum, so copies shrink before the shuffle."""
    newest = F.max(F.struct("start_time", "encoded_latlons", "encoded_time")).alias("_newest")
    return routes.groupBy("_id_oid").agg(newest).select("_id_oid", "_newest.*")


def damaged_routes(routes: DataFrame) -> DataFrame:
    """``damaged``: how many routes have a text that cannot be decoded. Such routes give no points."""
    points = routes.select("encoded_latlons", route_points(F.col("encoded_latlons")).alias("_points"))
    bad = F.col("encoded_latlons").isNotNull() & F.col("_points").isNull()
    return points.agg(F.count_if(bad).alias("damaged"))


def route_to_points(routes: DataFrame, zero_offset_is_null: bool = True) -> DataFrame:
    """Rows ``(_id_oid, time, lon, lat)`` in route order.

    Points and offsets pair up to the shorter list. Without any offsets every point is kept and has
    no time. An offset of zero gives no time either, unless ``zero_offset_is_null`` is off.
    """
    decoded = routes.select(
        "_id_oid",
        "start_time",
        route_points(F.col("encoded_latlons")).alias("_points"),
        route_offsets(F.coalesce("encoded_time", F.lit(""))).alias("_offsets"),
    )

    def moment(offset):
        usable = offset.isNotNull() & (offset != 0) if zero_offset_is_null else offset.isNotNull()
        return F.when(usable, plus_seconds(F.col("start_time"), offset))

    n_points = F.coalesce(F.size("_points"), F.lit(0))
    paired = F.when(F.col("_offsets").isNull(), n_points).otherwise(F.least(n_points, F.size("_offsets")))
    sized = decoded.withColumn("_n", F.greatest(paired, F.lit(0)))
    times = F.when(
        F.col("_offsets").isNull(), F.array_repeat(F.lit(None).cast("timestamp_ntz"), F.col("_n"))
    ).otherwise(F.transform(F.slice("_offsets", F.lit(1), F.col("_n")), moment))
    zipped = F.arrays_zip(F.slice("_points", F.lit(1), F.col("_n")).alias("point"), times.alias("time"))
    return sized.select("_id_oid", F.explode(zipped).alias("_row")).select(
        "_id_oid", "_row.time", F.col("_row.point.lon").alias("lon"), F.col("_row.point.lat").alias("lat")
    )
