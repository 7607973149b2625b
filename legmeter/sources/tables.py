"""Input tables and result layouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import EVENT_DAY

_S, _D, _I, _N = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Column names and order of the result tables.
LEG_LAYOUT = _layout(
    ("_id_oid", _S), ("step", _I), ("to_lon", _D), ("to_lat", _D), ("from_lon", _D), ("from_lat", _D),
    ("distance", _D), ("distance_type", _S), ("updated_at", _N), ("duration", _D),
)
TRIP_LAYOUT = _layout(
    ("_id_oid", _S), ("store_lon", _D), ("store_lat", _D), ("restaurant_lon", _D), ("restaurant_lat", _D),
    ("client_lon", _D), ("client_lat", _D), ("store_to_rest", _D), ("rest_to_client", _D), ("client_to_store", _D),
    ("updated_at", _N), ("distance_type", _S), ("distance", _D), ("step", _I), ("duration", _D),
    ("store_to_rest_duration", _D), ("rest_to_client_duration", _D), ("client_to_store_duration", _D),
)
REFILL_LAYOUT = _layout(
    ("warehouse_id", _S), ("createdatl", _N), ("courier_id", _S), ("courier_franchise_id", _S), ("lon", _D),
    ("lat", _D), ("refill_distance", _D), ("distance_type", _S), ("updated_at", _N), ("duration", _D),
    ("log_id", _S), ("type", _S),
)
POINT_LAYOUT = _layout(("_id_oid", _S), ("time", _N), ("lon", _D), ("lat", _D))
FEED_LAYOUT = _layout(
    ("order_id", _S), ("step", _I), ("distance", _D), ("domain_type", _I), ("start_time", _N), ("processed_time", _N)
)


# Names of the input tables; the three ``*_distances`` tables are results that later runs read.
INPUT_TABLES = (
    "marketorders",
    "food_orders",
    "artisan_orders",
    "courier_tasks",
    "warehouses",
    "warehouse_locations",
    "warehouse_domaintypes",
    "courier_status_logs",
    "orders_distances",
    "routes_market",
    "fleet_vehicle_km_logs",
    "leg_distances",
    "food_distances",
    "artisan_distances",
)


class Tables:
    """The tables a run reads, as attributes. A table is opened when a plan first names it."""

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        load_near: Callable[[str, DataFrame, str], DataFrame] | None = None,
        load_averages: Callable[..., DataFrame] | None = None,
    ):
        self._load, self._load_near, self._load_averages = load, load_near, load_averages

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUT_TABLES:
            raise AttributeError(name)
        frame = self._load(name)
        self.__dict__[name] = frame
        return frame

    def near(self, name: str, ids: DataFrame, key: str) -> DataFrame:
        """The result table ``name``, or as little of it as can hold the ids in column ``key``.

        Result tables keep the whole history, a window's ids are in few places of it.
        """
        return self._load_near(name, ids, key) if self._load_near else getattr(self, name)

    def averages(self, line: str, *chosen) -> DataFrame | None:
        """The averages that are kept for a line over a window and warehouses, if any are kept."""
        return self._load_averages(line, *chosen) if self._load_averages else None

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, **paths: str) -> "Tables":
        """Every table from ``root/<name>``, unless ``paths`` names another place for it."""
        return cls(lambda name: spark.read.parquet(paths.get(name, f"{root.rstrip('/')}/{name}")))

    @classmethod
    def from_catalog(cls, spark: SparkSession, schema: str, **names: str) -> "Tables":
        return cls(lambda name: spark.table(names.get(name, f"{schema}.{name}")))


def store_by_day(df: DataFrame, time: Column, path: str) -> None:
    """Write an input table in one folder per UTC day of ``time``; days of any size make even files."""
    (
        df.withColumn(EVENT_DAY, F.to_date(time))
        .hint("rebalance", EVENT_DAY)
        .write.partitionBy(EVENT_DAY)
        .parquet(path)
    )


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns of ``layout``, by name and in its order; the ones ``df`` lacks become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
    )
