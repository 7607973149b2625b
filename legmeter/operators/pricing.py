"""Prices for legs: a distance table, a user function called in batches, or straight lines.

A provider has ``label`` (what its distances are called), ``price``, and ``prepared``, which gives the
provider to use when the same rows are priced for several pairs of points. ``looks_first`` says that ``prepared``
reads the legs; ``settled`` then writes them once, so that they are not worked out again for the pricing.
``price_store`` has providers that keep prices between runs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.config import LEGS_PER_CALL, ROAD
from legmeter.functions.geo import MICRO, great_circle_m, micro_degrees
from legmeter.session import materialise

LEG_POINTS = ("from_lon", "from_lat", "to_lon", "to_lat")
KEYS = ("_k_from_lon", "_k_from_lat", "_k_to_lon", "_k_to_lat")


def leg_keys(points: tuple[str, str, str, str]) -> list[Column]:
    return [micro_degrees(F.col(point)).alias(key) for key, point in zip(KEYS, points)]


def distinct_legs(df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> DataFrame:
    """The leg keys between all given points of ``df``, each once; legs without a coordinate have no price."""
    found = F.array(*[F.struct(*leg_keys(points)) for points in point_sets])
    return df.select(F.inline(found)).dropna().distinct()


@dataclass(frozen=True)
class TablePrices:
    """Distances from a table with the four leg columns, ``distance`` (m) and ``duration`` (s).

    Coordinates meet as whole micro-degrees. The table may hold all legs ever driven and a run asks for few
    of them, so ``prepared`` cuts it down to the legs of the run before anything is aggregated. Should a leg
    occur more than once, its shortest distance and its shortest duration count. The semi join, the
    aggregation and the join use the same keys, so the table is shuffled once. ``cut_down`` says that the
    table holds the run's legs only.
    """

    prices: DataFrame
    label: str = ROAD
    cut_down: bool = False

    @property
    def looks_first(self) -> bool:
        return not self.cut_down

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> "TablePrices":
        if self.cut_down:
            return self
        keyed = self.prices.select("*", *leg_keys(LEG_POINTS)).join(distinct_legs(df, point_sets), list(KEYS), "left_semi")
        return TablePrices(keyed.select(*LEG_POINTS, "distance", "duration"), self.label, cut_down=True)

    def price(
        self, df: DataFrame, points=LEG_POINTS, distance: str = "distance", duration: str = "duration"
    ) -> DataFrame:
        side = (
            self.prices.filter(F.col("distance").isNotNull())
            .select(*leg_keys(LEG_POINTS), "distance", "duration")
            .groupBy(*KEYS)
            .agg(F.min("distance").alias("_distance"), F.min("duration").alias("_duration"))
        )
        return KeyedPrices(side, self.label).price(df, points, distance, duration)


@dataclass(frozen=True)
class KeyedPrices:
    """Distances from ``side``: the keys of a leg, each leg once, ``_distance`` and ``_duration``."""

    side: DataFrame
    label: str = ROAD
    looks_first: bool = field(default=False, init=False)

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> "KeyedPrices":
        return self

    def price(
        self, df: DataFrame, points=LEG_POINTS, distance: str = "distance", duration: str = "duration"
    ) -> DataFrame:
        return (
            df.select("*", *leg_keys(points))
            .join(self.side, list(KEYS), "left")
            .withColumns({distance: F.col("_distance"), duration: F.col("_duration")})
            .drop("_distance", "_duration", *KEYS)
        )


@dataclass(frozen=True)
class GreatCircle:
    """Straight-line distance as a plain expression. It keeps its own label: it is not a road distance."""

    metres_per_second: float | None = None
    label: str = "haversine"
    looks_first: bool = field(default=False, init=False)

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> "GreatCircle":
        return self

    def price(
        self, df: DataFrame, points=LEG_POINTS, distance: str = "distance", duration: str = "duration"
    ) -> DataFrame:
        speed = F.lit(self.metres_per_second).cast("double")
        return df.withColumn(distance, great_circle_m(*[F.col(point) for point in points])).withColumn(
            duration, F.col(distance) / speed
        )


PriceFunction = Callable[[pd.DataFrame, int], pd.DataFrame]


@dataclass(frozen=True)
class BatchPrices:
    """Distances from ``function(legs, attempt)``, which gets up to ``legs_per_call`` legs at a time.

    The function returns ``distance`` and ``duration`` for each leg, null where it found none. Legs
    still null are asked again, up to ``rounds`` attempts. Every distinct leg is asked once and the
    answers are written to the work folder, so that neither a later action nor a lost executor asks
    again. The legs are dealt to ``parallel`` tasks, or more if a task would get over ``legs_per_task`` legs; a call
    that fails repeats its task's share only. ``profile`` may name a task resource of the service, which then limits
    how many tasks call at once.
    """

    function: PriceFunction
    legs_per_call: int = LEGS_PER_CALL
    rounds: int = 3
    parallel: int = 32
    label: str = ROAD
    legs_per_task: int = 5000
    profile: ResourceProfile | None = None
    looks_first: bool = field(default=True, init=False)

    def prepared(self, df: DataFrame, point_sets: list[tuple[str, str, str, str]]) -> TablePrices:
        """Ask for the legs between all given points of ``df`` and keep the answers."""
        legs = materialise(distinct_legs(df, point_sets), "legs")
        tasks = max(self.parallel, math.ceil(legs.count() / self.legs_per_task))
        priced = ask_legs(legs, self.function, self.legs_per_call, self.rounds, tasks, self.profile)
        return TablePrices(materialise(priced, "prices"), self.label, cut_down=True)

    def price(
        self, df: DataFrame, points=LEG_POINTS, distance: str = "distance", duration: str = "duration"
    ) -> DataFrame:
        return self.prepared(df, [points]).price(df, points, distance, duration)


def ask_legs(
    legs: DataFrame, function: PriceFunction, legs_per_call: int, rounds: int, tasks: int, profile: ResourceProfile | None = None
) -> DataFrame:
    """The answers of ``function`` for the leg keys ``legs``, in degrees, asked by ``tasks`` tasks."""
    asked = legs.repartition(tasks, *KEYS).select(*[(F.col(key) / MICRO).alias(name) for key, name in zip(KEYS, LEG_POINTS)])
    return asked.mapInPandas(
        _asker(function, legs_per_call, rounds),
        "from_lon double, from_lat double, to_lon double, to_lat double, distance double, duration double",
        profile=profile,
    )


def settled(df: DataFrame, provider) -> DataFrame:
    """``df``, written once if the provider looks at it before it prices it."""
    return materialise(df, "legs") if provider.looks_first else df


def _asker(function: PriceFunction, size: int, rounds: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The task side: full calls of ``size`` legs; each further round asks only for what is missing."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for legs in frames:
            distance, duration = np.full((2, len(legs)), np.nan)
            for attempt in range(rounds):
                missing = np.flatnonzero(np.isnan(distance))
                for first in range(0, len(missing), size):
                    rows = missing[first : first + size]
                    answer = function(legs.iloc[rows].reset_index(drop=True), attempt)
                    distance[rows] = answer["distance"].to_numpy(dtype=float)
                    duration[rows] = answer["duration"].to_numpy(dtype=float)
            yield legs.assign(distance=distance, duration=duration)

    return ask
