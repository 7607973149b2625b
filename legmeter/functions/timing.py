"""Time expressions on zone-less timestamps; none of them depends on the session time zone."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legmeter.config import EVENT_DAY, HOME_ZONE, ISO_TEXT, RunWindow


def effective_date(delivered: Column, cancelled: Column) -> Column:
    return F.coalesce(delivered, cancelled)


def within(time: Column, window: RunWindow) -> Column:
    return (time >= window.lo) & (time < window.hi)


def effective_within(delivered: Column, cancelled: Column, window: RunWindow) -> Column:
    """``coalesce(delivered, cancelled)`` in the window, spelled on the bare columns.

    Comparisons of bare columns can be handed to the source, a ``coalesce`` cannot. Spark does not skip
    parquet row groups by zone-less timestamps, though: large tables should be stored by day, see
    ``in_days``.
    """
    return within(delivered, window) | (delivered.isNull() & within(cancelled, window))


def in_days(df: DataFrame, *windows: RunWindow) -> DataFrame:
    """Read only the folders of the windows' days, if the table is stored by ``EVENT_DAY``."""
    if EVENT_DAY not in df.columns:
        return df
    return df.filter(reduce(or_, (F.col(EVENT_DAY).between(F.to_date(w.lo), F.to_date(w.hi)) for w in windows)))


def to_zone(time: Column, zone: Column | str) -> Column:
    """UTC wall clock to the wall clock of ``zone``; a null zone gives null."""
    target = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), target, time)


def to_home_zone(time: Column) -> Column:
    return to_zone(time, HOME_ZONE)


def day_start(time: Column) -> Column:
    """Midnight of the day. ``date_trunc`` would pass through a zoned type and shift in some zones."""
    return F.to_date(time).cast("timestamp_ntz")


def day_number(time: Column) -> Column:
    """Days since 1970 as a never-null int that sorts nulls last."""
    return F.coalesce(F.datediff(time, F.lit("1970-01-01")), F.lit(2**31 - 1))


def plus_seconds(time: Column, seconds: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.round(seconds * 1_000_000).cast("long"), time)


def iso_text(time: Column) -> Column:
    return F.date_format(time, ISO_TEXT)


def _in_day(time: str) -> Column:
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def run_grid(spark_or_bounds: SparkSession | DataFrame, every: timedelta, start=None, end=None) -> DataFrame:
    """Start times of all runs from ``start`` to the end floored to the interval, both included.

    Takes either a session with ``start``/``end`` or a one-row frame with those two columns. The
    interval must be whole days, or divide a day in whole hours, or an hour in whole minutes.
    """
    seconds = int(every.total_seconds())
    if seconds <= 0 or seconds > 86400:
        raise ValueError("the interval must be at most one day")
    hours, minutes = seconds // 3600, seconds // 60
    whole = seconds % 3600 == 0 and 24 % hours == 0 if hours else seconds % 60 == 0 and 60 % max(minutes, 1) == 0
    if not whole:
        raise ValueError("the interval must divide a day in hours or an hour in minutes")
    if isinstance(spark_or_bounds, DataFrame):
        bounds = spark_or_bounds
    else:
        bounds = spark_or_bounds.range(1).select(
            F.lit(str(start)).cast("timestamp_ntz").alias("start"), F.lit(str(end)).cast("timestamp_ntz").alias("end")
        )
    end_day = day_start(F.col("end"))
    floored = F.timestamp_add("SECOND", (F.floor(_in_day("end") / seconds) * seconds).cast("int"), end_day)
    # An end before the start has no run at all; a bare sequence would count backwards.
    apart = F.datediff("floored", "start").cast("long") * 86400 + _in_day("floored") - _in_day("start")
    steps = F.floor(apart / seconds)
    return (
        bounds.withColumn("floored", floored)
        .filter(F.col("floored") >= F.col("start"))
        .select("start", F.explode(F.sequence(F.lit(0).cast("long"), steps)).alias("slot"))
        .select(F.timestamp_add("SECOND", F.col("slot") * seconds, F.col("start")).alias("run_start"))
    )
