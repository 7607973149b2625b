"""Warehouse averages kept as sums: a run adds what it stored and takes back what it replaced.

The state has a sum and a count for every line, warehouse, day and kind of distance. It names the versions of the result
tables that it covers, in the same step in which it is published, so that nothing is counted twice or left out whenever a
run ends. Distances are summed as whole millionths of a kilometre: what is taken back is exactly what was added.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, time, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import MARKET_DOMAINS, ROAD, WATER_DOMAIN, WATER_LOOK_BACK_HOURS, RunWindow, as_datetime
from legmeter.functions.timing import effective_date, effective_within, in_days
from legmeter.operators import snapshots
from legmeter.operators.legs import TRIP_LEGS
from legmeter.operators.orders import in_warehouses, is_eligible
from legmeter.plans.trips import artisan_delivery, food_delivery
from legmeter.sources.tables import LEG_LAYOUT, TRIP_LAYOUT, Tables

# Columns of the state.
STATE_LAYOUT = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("warehouse_id", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("kind", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)
STATE_KEYS = ["line", "warehouse_id", "day", "kind"]
UNIT = 1_000_000
TABLE = "average_state"


@dataclass(frozen=True)
class Line:
    """Where a line's distances are stored, and which of its orders count."""

    name: str
    table: str
    orders: str
    counts: Callable[[], Column]
    warehouse: str
    delivered: str
    cancelled: str
    values: tuple[str, ...]


def _market(domains: tuple[int, ...]) -> Callable[[], Column]:
    return lambda: F.col("domaintype").isin(*domains) & is_eligible(F.col("status"), F.col("courier_courier_oid"), F.col("cancel_date"))


def _trip(delivery: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: delivery() & is_eligible(F.col("status"), F.col("courier_oid"), F.col("canceldate"))


_ORDER = ("warehouse_warehouse_oid", "deliver_date", "cancel_date", ("distance",))
_TRIP = ("courierwarehouse_oid", "deliverdate", "canceldate", TRIP_LEGS)
LINES = {
    line.name: line
    for line in (
        Line("market", "leg_distances", "marketorders", _market(MARKET_DOMAINS), *_ORDER),
        Line("water", "leg_distances", "marketorders", _market((WATER_DOMAIN,)), *_ORDER),
        Line("food", "food_distances", "food_orders", _trip(food_delivery), *_TRIP),
        Line("artisan", "artisan_distances", "artisan_orders", _trip(artisan_delivery), *_TRIP),
    )
}


def line_sums(lines: Line | tuple[Line, ...], distances: DataFrame, tables: Tables, windows: RunWindow | list[RunWindow] | None) -> DataFrame:
    """State rows of ``distances`` (with ``sign``), over the orders of ``windows`` or over all.

    Several lines may be asked for if they differ in nothing but which orders count: they share the reading and the join.
    """
    lines = lines if isinstance(lines, tuple) else (lines,)
    line = lines[0]
    orders = getattr(tables, line.orders)
    if windows is not None:
        orders = in_windows(line, orders, windows)
    orders = orders.filter(reduce(or_, (each.counts() for each in lines)))
    names = F.array_compact(F.array(*(F.when(each.counts(), F.lit(each.name)) for each in lines)))
    effective = effective_date(F.col(line.delivered), F.col(line.cancelled))
    named = F.explode(names) if len(lines) > 1 else F.lit(line.name)
    kept = orders.select("_id_oid", F.col(line.warehouse).alias("warehouse_id"), F.to_date(effective).alias("day"), named.alias("line"))
    if line.table != "leg_distances":
        # Trips count only at warehouses with a known zone.
        kept = kept.join(tables.warehouse_locations.select(F.col("warehouse").alias("warehouse_id")), "warehouse_id", "left_semi")
    # A null would be a key that replaces nothing; nobody asks for the averages of no warehouse.
    kept = kept.where("warehouse_id is not null")
    rows = distances.where(F.coalesce(*line.values).isNotNull()).join(kept, "_id_oid")
    kinds = [F.coalesce("distance_type", F.lit("")).alias("kind")] if line.table == "leg_distances" else []
    rows = rows.select("line", "warehouse_id", "day", "sign", *kinds, *(F.round(F.col(v) * UNIT).cast("long").alias(v) for v in line.values))
    # One row for all kinds of a trip: they part after they have been summed. A kind without any value has no sum.
    known = {v: F.when(F.col(v).isNotNull(), F.col("sign")) for v in line.values}
    pairs = [F.struct(F.sum(F.col(v) * sign).alias("total"), F.sum(sign).cast("long").alias("count")).alias(v) for v, sign in known.items()]
    sums = rows.groupBy("line", "warehouse_id", "day", *(["kind"] if kinds else [])).agg(*pairs)
    kind = {v: F.col("kind") if kinds else F.lit(v) for v in line.values}
    parted = F.array(*(F.struct(kind[v].alias("kind"), F.col(f"{v}.total"), F.col(f"{v}.count")) for v in line.values))
    return sums.select("line", "warehouse_id", "day", F.inline(parted)).where("total is not null").select(*STATE_LAYOUT.names)


def in_windows(line: Line, orders: DataFrame, windows: RunWindow | list[RunWindow]) -> DataFrame:
    """The orders of a line whose effective date falls in one of ``windows``."""
    windows = [windows] if isinstance(windows, RunWindow) else windows
    return in_days(orders, *windows).filter(reduce(or_, (effective_within(F.col(line.delivered), F.col(line.cancelled), w) for w in windows)))


def _sharing() -> list[tuple[Line, ...]]:
    """The lines, together if they read the same columns of the same tables."""
    found: dict[tuple, list[Line]] = {}
    for line in LINES.values():
        found.setdefault((line.table, line.orders, line.warehouse, line.delivered, line.cancelled, line.values), []).append(line)
    return [tuple(lines) for lines in found.values()]


def refresh(spark: SparkSession, tables: Tables, results: str, window: RunWindow | None = None) -> snapshots.Snapshot:
    """Bring the state beside the result tables under ``results`` up to their newest versions.

    ``window`` has the orders whose results may have changed since, as the window of a run does; without one all orders
    are read. If a version that the state covers is gone, the state is summed up anew over all orders.
    """
    base = results.rstrip("/")
    path = f"{base}/{TABLE}"
    layouts = {"leg_distances": LEG_LAYOUT, "food_distances": TRIP_LAYOUT, "artisan_distances": TRIP_LAYOUT}
    newest = {name: snapshots.snapshot(spark, f"{base}/{name}").version for name in layouts}
    state = snapshots.snapshot(spark, path)
    covered = {name: state.notes.get(name, 0) for name in layouts}
    if covered == newest and state.version:
        return state
    try:
        changed = {name: snapshots.difference(spark, f"{base}/{name}", layouts[name], covered[name], newest[name]) for name in layouts}
        anew = not state.version
    except LookupError:
        changed = {name: snapshots.difference(spark, f"{base}/{name}", layouts[name], 0, newest[name]) for name in layouts}
        anew = True
    sums = [line_sums(lines, changed[lines[0].table], tables, None if anew else window) for lines in _sharing()]
    delta = reduce(DataFrame.unionByName, sums).where("total != 0 or count != 0")
    return snapshots.merge(spark, path, delta, STATE_KEYS, STATE_LAYOUT, "day", notes=newest, anew=anew, added=("total", "count"))


def read_state(spark: SparkSession, results: str) -> DataFrame:
    return snapshots.read(spark, f"{results.rstrip('/')}/{TABLE}", STATE_LAYOUT).where("count != 0")


def _edges(window: RunWindow) -> tuple[tuple, list[RunWindow]]:
    """The whole days of a window ``[first, last)``, and the parts of days at its ends."""
    start, end = as_datetime(window.start), as_datetime(window.end)
    first = start if start.time() == time(0) else datetime.combine(start.date() + timedelta(days=1), time(0))
    last = datetime.combine(end.date(), time(0))
    if first >= last:
        return (first, first), [RunWindow(start, end)]
    return (first, last), [RunWindow(a, b) for a, b in ((start, first), (last, end)) if a < b]


def averages(spark: SparkSession, tables: Tables, results: str, name: str, window: RunWindow, warehouses: Iterable[str] = ("all",)) -> DataFrame:
    """``warehouse_id`` and the averages of a line over ``window``: ``avg_distance``, or one a leg of a trip.

    Whole days come from the state; of the parts of days at the ends the stored rows near their orders are read.
    """
    line = LINES[name]
    if name == "water":
        window = window.widened(back_hours=WATER_LOOK_BACK_HOURS)
    (first, last), parts = _edges(window)
    known = read_state(spark, results).where((F.col("line") == name) & (F.col("day") >= F.lit(first.date())) & (F.col("day") < F.lit(last.date())))
    sums = known.select(*STATE_LAYOUT.names)
    if parts:
        near = tables.near(line.table, in_windows(line, getattr(tables, line.orders), parts), "_id_oid").withColumn("sign", F.lit(1))
        sums = sums.unionByName(line_sums(line, near, tables, parts))
    if name == "water":
        sums = sums.where(F.col("kind") == ROAD)
    sums = sums.where(in_warehouses(F.col("warehouse_id"), warehouses))

    def average(kind: Column) -> Column:
        return F.sum(F.when(kind, F.col("total"))) / F.sum(F.when(kind, F.col("count"))) / UNIT

    if line.table == "leg_distances":
        return sums.groupBy("warehouse_id").agg(average(F.lit(True)).alias("avg_distance"))
    return sums.groupBy("warehouse_id").agg(*(average(F.col("kind") == leg).alias(f"{leg}_avg") for leg in TRIP_LEGS))
