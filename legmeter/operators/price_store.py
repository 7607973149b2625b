"""Road distances kept between runs, by place: a run opens only the parts of the table near its own legs.

The table is a snapshot whose key is the quadkey of a leg's start: four children a level, so that places near each other
have keys near each other and a slice is a piece of the map. A slice is cut where legs are dense.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import LEGS_PER_CALL, ROAD, as_datetime, ntz
from legmeter.functions.geo import MICRO
from legmeter.operators import snapshots
from legmeter.operators.pricing import KEYS, LEG_POINTS, KeyedPrices, PriceFunction, ask_legs, distinct_legs, leg_keys
from legmeter.session import materialise

#: Levels of the quadkey: cells of about 38 by 19 metres at the equator.
LEVELS = 20
#: Fixed layout of the stored answers: a leg in whole micro-degrees, its answer, when it was asked and how often in vain.
PRICE_LAYOUT = T.StructType(
    [T.StructField("tile", T.StringType())]
    + [T.StructField(key, T.LongType()) for key in KEYS]
    + [T.StructField(name, T.DoubleType()) for name in ("distance", "duration")]
    + [T.StructField("asked_at", T.TimestampNTZType()), T.StructField("failures", T.IntegerType())]
)
PRICE_KEYS = ["tile", *KEYS]


def quadkey(lon_micro: Column, lat_micro: Column, levels: int = LEVELS) -> Column:
    """The cell of a place as one digit of base 4 a level; places outside the map fall into its edge."""

    def cell(micro: Column, span: int) -> Column:
        share = F.floor((micro + span * MICRO) * (1 << levels) / (2 * span * MICRO))
        return F.greatest(F.least(share, F.lit((1 << levels) - 1)), F.lit(0))

    def digits(place: Column) -> Column:
        bit = lambda axis, at: F.call_function("shiftright", place[axis], at).bitwiseAND(F.lit(1))
        levels_down = F.sequence(F.lit(levels - 1), F.lit(0), F.lit(-1))
        return F.array_join(F.transform(levels_down, lambda at: (bit("x", at) + 2 * bit("y", at)).cast("string")), "")

    # Named once: spelled out, the place would stand in every digit.
    place = F.struct(cell(lon_micro, 180).alias("x"), cell(lat_micro, 90).alias("y"))
    return F.element_at(F.transform(F.array(place), digits), 1)


def with_tile(legs: DataFrame) -> DataFrame:
    return legs.withColumn("tile", quadkey(F.col(KEYS[0]), F.col(KEYS[1])))


def store_prices(prices: DataFrame, path: str, asked_at, slice_rows: int = snapshots.SLICE_ROWS) -> snapshots.Snapshot:
    """Merge a distance table (``from_lon, from_lat, to_lon, to_lat, distance, duration``) into the store at ``path``.

    Of several rows a leg the shortest distance and the shortest duration count; a leg in the store is replaced.
    """
    single = (
        prices.where("distance is not null").select(*leg_keys(LEG_POINTS), "distance", "duration").dropna(subset=list(KEYS))
        .groupBy(*KEYS).agg(F.min("distance").alias("distance"), F.min("duration").alias("duration"))
    )
    rows = with_tile(single).withColumns({"asked_at": ntz(asked_at), "failures": F.lit(0)})
    return snapshots.merge(prices.sparkSession, path, rows, PRICE_KEYS, PRICE_LAYOUT, "tile", slice_rows)


def _near(path: str, legs: DataFrame) -> DataFrame:
    """The stored answers of the slices that hold a start of ``legs`` (by keys)."""
    return snapshots.read_near(legs.sparkSession, path, PRICE_LAYOUT, with_tile(legs).select("tile").distinct(), "tile")


def _as_prices(stored: DataFrame, label: str) -> KeyedPrices:
    answered = stored.where("distance is not null")
    return KeyedPrices(answered.select(*KEYS, F.col("distance").alias("_distance"), F.col("duration").alias("_duration")), label)


@dataclass(frozen=True)
class StoredPrices:
    """Distances from the store at ``path``. A leg is there once, so that nothing is aggregated."""

    path: str
    label: str = ROAD
    looks_first: bool = field(default=True, init=False)

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> KeyedPrices:
        return _as_prices(_near(self.path, distinct_legs(df, point_sets)), self.label)


@dataclass(frozen=True)
class RememberedPrices:
    """Distances from ``function``, asked once and kept in the store at ``path``.

    A run asks for the legs that the store does not know, for answers older than ``max_age``, and again for legs without
    an answer until they have failed ``give_up`` times; those are tried once more after ``max_age``. All other legs are
    read. The answers are merged after the calls, so that a run that fails later need not ask again.
    """

    function: PriceFunction
    path: str
    now: datetime | str
    max_age: timedelta = timedelta(days=90)
    give_up: int = 3
    legs_per_call: int = LEGS_PER_CALL
    rounds: int = 3
    parallel: int = 32
    legs_per_task: int = 5000
    label: str = ROAD
    slice_rows: int = snapshots.SLICE_ROWS
    looks_first: bool = field(default=True, init=False)

    def unanswered(self, legs: DataFrame) -> DataFrame:
        """The legs to ask, with how often they have failed."""
        fresh = F.col("asked_at") >= ntz(as_datetime(self.now) - self.max_age)
        settled = fresh & (F.col("distance").isNotNull() | (F.col("failures") >= self.give_up))
        known = _near(self.path, legs).select(*KEYS, settled.alias("_settled"), "failures")
        return legs.join(known, list(KEYS), "left").where("_settled is null or not _settled").select(*KEYS, F.coalesce("failures", F.lit(0)).alias("failures"))

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> KeyedPrices:
        legs = materialise(distinct_legs(df, point_sets), "legs")
        asked = materialise(self.unanswered(legs), "unanswered")
        tasks = max(self.parallel, math.ceil(asked.count() / self.legs_per_task))
        answers = materialise(ask_legs(asked.select(*KEYS), self.function, self.legs_per_call, self.rounds, tasks), "answers")
        keyed = answers.select(*leg_keys(LEG_POINTS), "distance", "duration").join(asked, list(KEYS))
        failures = F.when(F.col("distance").isNull(), F.col("failures") + 1).otherwise(0)
        rows = with_tile(keyed.withColumns({"failures": failures, "asked_at": ntz(self.now)}))
        snapshots.merge(df.sparkSession, self.path, rows, PRICE_KEYS, PRICE_LAYOUT, "tile", self.slice_rows)
        return _as_prices(_near(self.path, legs), self.label)
