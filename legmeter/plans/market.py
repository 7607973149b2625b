"""Market legs: previous drop of the courier, daily number, batch position, return flag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.config import MARKET_DOMAINS, MARKET_LOOK_BACK_HOURS, PREVIEW_ROWS, RunWindow, SplitPolicy
from legmeter.functions.timing import day_number, within
from legmeter.operators.ordered_groups import OrderedGroups
from legmeter.operators.orders import batch_max, market_rows, start_point, with_batch_max
from legmeter.sources.tables import Tables

# Output columns.
LEG_COLUMNS = [
    "order_id", "deliver_date", "cancel_date", "deliver_date_l", "is_batched", "delivery_batch_index", "max_index",
    "delivery_job_oid", "warehouse_id", "courier_id", "order_number", "warehouse_lon", "warehouse_lat", "prev_lon",
    "prev_lat", "from_lon", "from_lat", "to_lon", "to_lat", "will_return_warehouse",
]


def padded_market_rows(
    tables: Tables, window: RunWindow, warehouses: Iterable[str] = ("all",), delivered_only: bool = False
) -> DataFrame:
    """Rows of the window and the two hours before it, where a first drop finds its predecessor."""
    wide = window.widened(back_hours=MARKET_LOOK_BACK_HOURS)
    return market_rows(
        tables.marketorders, tables.warehouse_locations, wide, MARKET_DOMAINS, warehouses, delivered_only
    )


def courier_sequence(rows: DataFrame, local: str, policy: SplitPolicy = SplitPolicy()) -> DataFrame:
    """Add ``prev_lon``, ``prev_lat`` and ``order_number`` along each courier's drops at a warehouse."""
    groups = OrderedGroups(
        ["warehouse_id", "courier_id"], [local, "eff_date", "order_id"], day="_day", policy=policy, name="drop_piece"
    )
    marked = groups.mark(rows.withColumn("_day", day_number(F.col(local))))
    found = groups.previous(marked, marked, {"prev_lon": "to_lon", "prev_lat": "to_lat"})
    return groups.number(found, marked, "order_number").drop("_day", groups.piece)


def leg_columns(sequenced: DataFrame, maxima: DataFrame) -> DataFrame:
    """Start point and return flag. The flag compares with the bare maximum: no batch, no flag."""
    return with_batch_max(sequenced, maxima).select(
        "*",
        F.coalesce("job_max", F.lit(1)).alias("max_index"),
        *start_point(F.col("delivery_batch_index") == 1),
        F.when(F.col("delivery_batch_index") == F.col("job_max"), 1).otherwise(0).alias("will_return_warehouse"),
    )


def legs_market(
    tables: Tables,
    window: RunWindow,
    warehouses: Iterable[str] = ("all",),
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    rows = padded_market_rows(tables, window, warehouses)
    sequenced = courier_sequence(rows, "eff_date_l", policy).filter(within(F.col("eff_date"), window))
    return (
        leg_columns(sequenced, batch_max(rows))
        .withColumnsRenamed({"eff_date": "deliver_date", "eff_date_l": "deliver_date_l"})
        .select(*LEG_COLUMNS)
    )


def preview(df: DataFrame, key: str = "order_id", rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by key, for a look at a result."""
    return df.orderBy(key).limit(rows)
