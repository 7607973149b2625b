"""Many runs in one pass: the legs of every run of a grid of start times.

A run at ``start`` covers the orders of ``[start, start + length)`` and looks back a fixed time from its start. Each order
knows its place on the grid, so what a run sees is a range of places relative to the order's own: previous drops, daily
numbers and batch maxima become range frames, and no order is read once per run.

Groups are cut into blocks of the grid, each with as much of its neighbours as a run can see. So no group grows with the
length of the history, and no count is needed beforehand. Orders are sequenced by local time, which runs along the grid but
for the hours at which a zone changes its clocks; blocks with such an hour repeat their rows for every run instead.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legmeter.config import (
    HOME_ZONE,
    MARKET_DOMAINS,
    MARKET_LOOK_BACK_HOURS,
    REFILL_LOOK_AHEAD_HOURS,
    WATER_DOMAIN,
    WATER_LOOK_BACK_HOURS,
    Reasons,
    RunWindow,
    as_datetime,
    ntz,
)
from legmeter.functions.timing import day_number, to_home_zone, to_zone
from legmeter.operators.orders import market_rows, start_point, with_zone
from legmeter.plans import market, trips, water
from legmeter.sources.tables import Tables

BLOCK_HOURS = 24


@dataclass(frozen=True)
class SlotGrid:
    """Runs at ``start`` and every ``every`` after it, up to ``end`` included; each covers ``length`` (``every`` if not given)."""

    start: datetime | str
    end: datetime | str
    every: timedelta
    length: timedelta | None = None

    def __post_init__(self) -> None:
        if self.seconds <= 0 or self.seconds != int(self.every.total_seconds()) or self.span.total_seconds() % self.seconds:
            raise ValueError("a run must cover a whole number of intervals of whole seconds")
        if as_datetime(self.start).microsecond:
            raise ValueError("the start must be a whole second")

    @property
    def seconds(self) -> int:
        return int(self.every.total_seconds())

    @property
    def span(self) -> timedelta:
        return self.every if self.length is None else self.length

    @property
    def runs(self) -> int:
        return max(0, int((as_datetime(self.end) - as_datetime(self.start)) / self.every) + 1)

    @property
    def places(self) -> int:
        """Places of the grid that one run covers."""
        return int(self.span.total_seconds()) // self.seconds

    @property
    def window(self) -> RunWindow:
        """All times that any run covers."""
        return RunWindow(self.start, as_datetime(self.start) + (self.runs - 1) * self.every + self.span)

    def whole(self, hours: int) -> int:
        """``hours`` as places of the grid."""
        if hours * 3600 % self.seconds:
            raise ValueError(f"the interval must divide {hours} hours")
        return hours * 3600 // self.seconds

    def place(self, time: Column) -> Column:
        """The place of a time: 0 from the first start on, negative before. It does not depend on the session's zone."""
        start = as_datetime(self.start)
        seconds = (start - datetime(start.year, start.month, start.day)).seconds
        since = F.datediff(time, F.lit(start.date())) * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time) - seconds
        return F.floor(since / self.seconds).cast("long")

    def start_of(self, run: Column) -> Column:
        return F.timestamp_add("SECOND", (run * self.seconds).cast("int"), ntz(self.start))


@dataclass(frozen=True)
class _Blocks:
    """Blocks of the grid whose rows see ``back`` places before and ``ahead`` places after the run they are in."""

    grid: SlotGrid
    back: int
    ahead: int = 0

    @property
    def size(self) -> int:
        return max(self.grid.whole(BLOCK_HOURS), 4 * (self.back + self.ahead + self.grid.places))

    def spread(self, rows: DataFrame, zone: Column) -> tuple[DataFrame, DataFrame]:
        """``rows`` (with ``_place``) by ``_block``, once in their own (``_own``) and once in a neighbour that sees them.

        The second frame holds the blocks in which ``zone`` changes its clocks.
        """
        more = self.grid.places - 1
        first = F.floor((F.col("_place") - more - self.ahead) / self.size)
        last = F.floor((F.col("_place") + more + self.back) / self.size)
        placed = rows.withColumn("_block", F.explode(F.sequence(first, last)))
        placed = placed.withColumn("_own", F.floor(F.col("_place") / self.size) == F.col("_block"))

        def offset(place: Column) -> Column:
            time = self.grid.start_of(place)
            local = to_zone(time, zone)
            return F.datediff(local, time) * 1440 + (F.hour(local) - F.hour(time)) * 60 + F.minute(local) - F.minute(time)

        low, high = F.col("_block") * self.size - more - self.back, (F.col("_block") + 1) * self.size + more + self.ahead
        # Some zones change twice within days, so the middle is looked at as well.
        changes = [~offset(low).eqNullSafe(offset(at)) for at in (F.floor((low + high) / 2), high)]
        changing = changes[0] | changes[1]
        return placed.where(~changing), placed.where(changing)

    def frame(self, window, j: int, last: int | None = None):
        """The places that the run ``j`` places before the row sees, up to ``last`` relative to the row."""
        return window.orderBy("_place").rangeBetween(-(self.back + j), self.grid.places - 1 - j if last is None else last)

    def each_run(self, rows: DataFrame) -> DataFrame:
        """Every row once for each run that sees it (``_run``), for plain windows by run."""
        runs = F.sequence(F.col("_place") - self.grid.places - self.ahead + 1, F.col("_place") + self.back)
        return rows.withColumn("_run", F.explode(F.filter(runs, self._exists)))

    def _exists(self, run: Column) -> Column:
        return (run >= 0) & (run < self.grid.runs)

    def own_runs(self, rows: DataFrame, values: list[Column]) -> DataFrame:
        """Own rows once for each run that covers them, with the run's entry of ``values`` (structs by ``j``) as ``_seen``."""
        found = rows.where("_own").select("*", F.posexplode(F.array(*values)).alias("_j", "_seen"))
        return found.withColumn("_run", F.col("_place") - F.col("_j")).where(self._exists(F.col("_run"))).drop("_j")

    def covered(self) -> Column:
        """Whether a row of ``each_run`` is covered by its run."""
        return F.col("_own") & F.col("_place").between(F.col("_run"), F.col("_run") + self.grid.places - 1)


def _seen(previous: Column, number: Column) -> Column:
    return F.struct(previous.getField("lon").alias("lon"), previous.getField("lat").alias("lat"), number.cast("int").alias("number"))


def _drop() -> Column:
    return F.struct(F.col("to_lon").alias("lon"), F.col("to_lat").alias("lat"), F.col("_place").alias("place"))


def _ascending(order: list[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def _sequenced(rows: DataFrame) -> DataFrame:
    names = {"prev_lon": F.col("_seen.lon"), "prev_lat": F.col("_seen.lat"), "order_number": F.col("_seen.number")}
    return rows.withColumns(names).drop("_seen", "_own", "_block")


def _courier_runs(rows: DataFrame, zones: DataFrame, grid: SlotGrid) -> DataFrame:
    """Market rows by run, with the previous drop and the daily number that the run sees."""
    blocks = _Blocks(grid, grid.whole(MARKET_LOOK_BACK_HOURS))
    order = ["eff_date_l", "eff_date", "order_id"]
    dated = with_zone(rows.withColumn("_day", day_number(F.col("eff_date_l"))), zones, F.col("warehouse_id"))
    steady, changing = (part.drop("zone") for part in blocks.spread(dated, F.col("zone")))

    keys = ["warehouse_id", "courier_id", "_block"]
    along = Window.partitionBy(*keys).orderBy("_day", "_place", *_ascending(order))
    daily = Window.partitionBy(*keys, "_day")
    inside = Window.partitionBy(*keys, "_day", "_place").orderBy(*_ascending(order))
    runs = range(grid.places)
    marked = steady.repartition(*keys).withColumns(
        {"_last": F.lag(_drop()).over(along), "_nth": F.row_number().over(inside)}
        | {f"_before{j}": F.count(F.lit(1)).over(blocks.frame(daily, j, -1)) for j in runs}
    )
    values = [
        _seen(F.when(F.col("_last.place") >= F.col("_place") - j - blocks.back, F.col("_last")), F.col("_nth") + F.col(f"_before{j}"))
        for j in runs
    ]
    frames = blocks.own_runs(marked, values).drop("_last", "_nth", *(f"_before{j}" for j in runs))

    by_run = ["warehouse_id", "courier_id", "_run"]
    plain = Window.partitionBy(*by_run).orderBy(*_ascending(order))
    numbered = Window.partitionBy(*by_run, "_day").orderBy(*_ascending(order))
    exact = blocks.each_run(changing).withColumns({"_last": F.lag(_drop()).over(plain), "_nth": F.row_number().over(numbered)})
    exact = exact.withColumn("_seen", _seen(F.col("_last"), F.col("_nth"))).where(blocks.covered()).drop("_last", "_nth")
    return _sequenced(frames.unionByName(exact)).drop("_day")


def _batch_maxima(rows: DataFrame, grid: SlotGrid, back: int) -> DataFrame:
    """``_job_key, _job_max`` (by ``j``) of every job and place."""
    blocks = _Blocks(grid, back)
    batched = F.when(F.col("is_batched").eqNullSafe(True), F.col("batch_index_raw"))
    jobs = rows.where("delivery_job_oid is not null").groupBy("delivery_job_oid", "_place").agg(F.max(batched).alias("_max"))
    along = Window.partitionBy("delivery_job_oid")
    found = F.array(*(F.max("_max").over(blocks.frame(along, j)) for j in range(grid.places)))
    return jobs.select(_job_key(F.col("delivery_job_oid")).alias("_job_key"), found.alias("_job_max"))


def _job_key(job: Column) -> Column:
    return F.concat(F.lit("j"), job.cast("string"), F.lit("/"), F.col("_place").cast("string"))


def _started(rows: DataFrame, grid: SlotGrid, columns: list[str], latest_only: bool) -> DataFrame:
    if latest_only:
        rows = rows.where(F.col("_run") == F.least(F.col("_place"), F.lit(grid.runs - 1)))
    return rows.select(*columns, grid.start_of(F.col("_run")).alias("run_start"))


def legs_market_slots(tables: Tables, grid: SlotGrid, warehouses: Iterable[str] = ("all",), latest_only: bool = False) -> DataFrame:
    """The market legs of every run, with ``run_start``; ``latest_only`` keeps each order's last run."""
    wide = grid.window.widened(back_hours=MARKET_LOOK_BACK_HOURS)
    rows = market_rows(tables.marketorders, tables.warehouse_locations, wide, MARKET_DOMAINS, warehouses)
    rows = rows.withColumn("_place", grid.place(F.col("eff_date")))
    by_run = _courier_runs(rows, tables.warehouse_locations, grid)
    # Orders without a job never match; keyed by their own id they do not meet in one task.
    key = F.coalesce(_job_key(F.col("delivery_job_oid")), F.concat(F.lit("o"), F.col("order_id").cast("string")))
    keyed = by_run.withColumn("_job_key", key).join(_batch_maxima(rows, grid, grid.whole(MARKET_LOOK_BACK_HOURS)), "_job_key", "left")
    legs = keyed.withColumn("job_max", F.get("_job_max", (F.col("_place") - F.col("_run")).cast("int"))).select(
        "*",
        F.coalesce("job_max", F.lit(1)).alias("max_index"),
        *start_point(F.col("delivery_batch_index") == 1),
        F.when(F.col("delivery_batch_index") == F.col("job_max"), 1).otherwise(0).alias("will_return_warehouse"),
    )
    named = legs.withColumnsRenamed({"eff_date": "deliver_date", "eff_date_l": "deliver_date_l"})
    return _started(named, grid, market.LEG_COLUMNS, latest_only)


def _vehicle_runs(rows: DataFrame, grid: SlotGrid) -> DataFrame:
    """Water rows by run. Cancelled orders come after all delivered ones that the run sees, in both sequences."""
    blocks = _Blocks(grid, grid.whole(WATER_LOOK_BACK_HOURS))
    order = ["_time", "eff_date", "order_id"]
    timed = rows.withColumns({"_day": day_number(F.col("eff_date_l")), "_time": to_home_zone(F.col("delivered")), "_late": F.col("delivered").isNull()})
    steady, changing = blocks.spread(timed, F.lit(HOME_ZONE))
    runs = range(grid.places)

    vehicle = ["courier_fleetvehicle_oid", "warehouse_id", "_block"]
    same_kind = Window.partitionBy(*vehicle, "_late").orderBy("_place", *_ascending(order))
    whole = Window.partitionBy(*vehicle)
    delivered = F.when(~F.col("_late"), F.struct("_time", "eff_date", "order_id", _drop().alias("drop")))
    marked = steady.repartition(*vehicle).withColumns(
        {"_last": F.lag(_drop()).over(same_kind)} | {f"_latest{j}": F.max(delivered).over(blocks.frame(whole, j)) for j in runs}
    )
    courier = ["courier_id", "_block"]
    daily = Window.partitionBy(*courier, "_day")
    inside = Window.partitionBy(*courier, "_day", "_late", "_place").orderBy(*_ascending(order))
    kinds = {"on_time": F.when(~F.col("_late"), 1), "late": F.when(F.col("_late"), 1)}
    counted = marked.withColumns(
        {"_nth": F.row_number().over(inside)}
        | {f"_before_{kind}{j}": F.count(one).over(blocks.frame(daily, j, -1)) for kind, one in kinds.items() for j in runs}
        | {f"_all_on_time{j}": F.count(kinds["on_time"]).over(blocks.frame(daily, j)) for j in runs}
    )
    values = []
    for j in runs:
        last = F.when(F.col("_last.place") >= F.col("_place") - j - blocks.back, F.col("_last"))
        previous = F.when(F.col("_late"), F.coalesce(last, F.col(f"_latest{j}.drop"))).otherwise(last)
        before = F.when(F.col("_late"), F.col(f"_all_on_time{j}") + F.col(f"_before_late{j}")).otherwise(F.col(f"_before_on_time{j}"))
        values.append(_seen(previous, F.col("_nth") + before))
    names = [f"{name}{j}" for name in ("_latest", "_before_on_time", "_before_late", "_all_on_time") for j in runs]
    frames = blocks.own_runs(counted, values).drop("_last", "_nth", *names)

    along = Window.partitionBy("courier_fleetvehicle_oid", "warehouse_id", "_run").orderBy(*_ascending(order))
    numbered = Window.partitionBy("courier_id", "_run", "_day").orderBy(*_ascending(order))
    exact = blocks.each_run(changing).withColumns({"_last": F.lag(_drop()).over(along), "_nth": F.row_number().over(numbered)})
    exact = exact.withColumn("_seen", _seen(F.col("_last"), F.col("_nth"))).where(blocks.covered()).drop("_last", "_nth")
    return _sequenced(frames.unionByName(exact)).drop("_day", "_time", "_late")


def _refilled_runs(tables: Tables, grid: SlotGrid, reasons: Reasons, warehouses: Iterable[str]) -> DataFrame:
    """``order_id, _run`` of the orders that follow a refill of the run, looked for a fixed time past the run's end."""
    blocks = _Blocks(grid, 0, grid.whole(REFILL_LOOK_AHEAD_HOURS))
    rows = water.refill_events(tables, grid.window.widened(ahead_hours=REFILL_LOOK_AHEAD_HOURS), reasons, warehouses)
    order = ["compare_date_l", "createdat", "log_id"]
    steady, changing = blocks.spread(rows.withColumn("_place", grid.place(F.col("createdat"))), F.col("zone"))
    answer = F.when(F.col("marketorder_oid").isNotNull(), F.struct(F.col("marketorder_oid").alias("order_id"), F.col("_place").alias("place")))

    def following(keys: list[str], lead: list[str]) -> Column:
        falling = Window.partitionBy(*keys).orderBy(*(F.col(n).desc() for n in lead), *(F.col(n).desc_nulls_first() for n in order))
        return F.last(answer, ignorenulls=True).over(falling.rowsBetween(Window.unboundedPreceding, -1))

    is_refill = F.col("data_reason_oid") == reasons.refill
    next_seen = steady.repartition("warehouse_id", "courier_id", "_block").withColumn("_next", following(["warehouse_id", "courier_id", "_block"], ["_place"])).where(is_refill)
    last_place = grid.places - 1 + blocks.ahead
    values = [
        F.struct(F.when(F.col("_next.place") <= F.col("_place") - j + last_place, F.col("_next.order_id")).alias("order_id")) for j in range(grid.places)
    ]
    frames = blocks.own_runs(next_seen, values).select("_seen.order_id", "_run")
    exact = blocks.each_run(changing).withColumn("_next", following(["warehouse_id", "courier_id", "_run"], []))
    found = frames.unionByName(exact.where(is_refill & blocks.covered()).select("_next.order_id", "_run"))
    return found.where("order_id is not null").distinct()


def legs_water_slots(
    tables: Tables, grid: SlotGrid, reasons: Reasons, warehouses: Iterable[str] = ("all",), latest_only: bool = False
) -> DataFrame:
    """The water legs of every run, with ``run_start``."""
    wide = grid.window.widened(back_hours=WATER_LOOK_BACK_HOURS)
    rows = market_rows(tables.marketorders, tables.warehouse_locations, wide, (WATER_DOMAIN,), warehouses)
    by_run = _vehicle_runs(rows.withColumn("_place", grid.place(F.col("eff_date"))), grid)
    refilled = _refilled_runs(tables, grid, reasons, warehouses).withColumn("_refilled", F.lit(1))
    legs = by_run.join(refilled, ["order_id", "_run"], "left").select(
        "*", F.coalesce("_refilled", F.lit(0)).alias("is_from_warehouse"), *start_point(F.col("_refilled") == 1)
    )
    return _started(legs.withColumnRenamed("eff_date_l", "deliver_date_l"), grid, water.LEG_COLUMNS, latest_only)


def _by_run(rows: DataFrame, time: str, grid: SlotGrid, latest_only: bool) -> DataFrame:
    """Rows that need no others, once for each run that covers them."""
    place = grid.place(F.col(time))
    runs = F.sequence(place - grid.places + 1, place)
    placed = rows.withColumn("_place", place).withColumn("_run", F.explode(F.filter(runs, lambda run: (run >= 0) & (run < grid.runs))))
    return _started(placed, grid, rows.columns, latest_only)


def order_lines_slots(
    tables: Tables, grid: SlotGrid, reasons: Reasons, lines: Iterable[str], warehouses: Iterable[str] = ("all",), latest_only: bool = False
) -> dict[str, DataFrame]:
    """The unpriced rows of every line, for all runs of the grid."""
    window = grid.window
    build = {
        "market": lambda: legs_market_slots(tables, grid, warehouses, latest_only),
        "water": lambda: legs_water_slots(tables, grid, reasons, warehouses, latest_only),
        "refill": lambda: _by_run(water.refill_info(tables, window, reasons, warehouses), "createdat", grid, latest_only),
        "food": lambda: _by_run(trips.food_order_info(tables, window, warehouses), "deliver_date", grid, latest_only),
        "artisan": lambda: _by_run(trips.artisan_order_info(tables, window, warehouses), "deliver_date", grid, latest_only),
    }
    return {name: build[name]() for name in lines}
