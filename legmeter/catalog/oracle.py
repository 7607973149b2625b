"""DuckDB SQL for every query, built from small named steps over the same stand-in views.

The steps are written straight from the meaning of each query (joins back, window functions over whole
groups, long forms of the anti joins), not from the Spark plans, so that the two check each other.
"""

from __future__ import annotations

import re

from legmeter.catalog.queries import FLEET_DAYS, ODD_WINDOW, RETENTION_START, SOME_WAREHOUSES, TRIP_POINTS, UPDATED_AT, WINDOW
from legmeter.operators.legs import TRIP_LEGS
from legmeter.sources.standins import STEPS as STEPS_OF_POINTS
from legmeter.sources.standins import VIEWS, render

START, END = f"timestamp '{WINDOW.start}'", f"timestamp '{WINDOW.end}'"
NOW = f"timestamp '{UPDATED_AT}'"


def local(time: str, zone: str = "country_time_zone") -> str:
    return f"(({time}) at time zone 'UTC') at time zone {zone}"


def between_dates(time: str, back: int = 0) -> str:
    return f"{time} >= {START} - interval {back} hour and {time} < {END}"


def eligible(courier: str, cancelled: str) -> str:
    return f"(status in (900, 1000) or ({courier} is not null and {cancelled} is not null))"


def price(x1: str, y1: str, x2: str, y2: str) -> str:
    """The stand-in road table as a formula; null where the table has no entry."""
    return (
        f"case when cast(round({x2} * 1000) as bigint) % 7 <> 0 "
        f"then round(abs({x2} - {x1}) * 85000e0 + abs({y2} - {y1}) * 111000e0, 3) end"
    )


def straight(x1: str, y1: str, x2: str, y2: str) -> str:
    return (
        f"2 * 6371008.8e0 * asin(sqrt(pow(sin(radians({y2} - {y1}) / 2), 2) + cos(radians({y1})) "
        f"* cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2)))"
    )


def market_rows(domains: str, back: int, delivered_only: bool = False) -> str:
    time = "deliver_date" if delivered_only else "coalesce(deliver_date, cancel_date)"
    return f"""
select _id_oid as order_id, warehouse_warehouse_oid as warehouse_id, courier_courier_oid as courier_id,
  courier_fleetvehicle_oid, delivery_job_oid, delivery_batch_isbatched as is_batched,
  delivery_batch_index as raw_index, coalesce(delivery_batch_index, 1) as delivery_batch_index,
  deliver_date as delivered, cancel_date, coalesce(deliver_date, cancel_date) as eff,
  {local("deliver_date")} as delivered_l, {local("coalesce(deliver_date, cancel_date)")} as eff_l,
  delivery_address_location__coordinates_lon as to_lon, delivery_address_location__coordinates_lat as to_lat,
  warehouse_location__coordinates_lon as warehouse_lon, warehouse_location__coordinates_lat as warehouse_lat
from marketorders left join warehouse_locations on warehouse_warehouse_oid = warehouse
where {between_dates(time, back)} and {eligible("courier_courier_oid", "cancel_date")} and domaintype in ({domains})"""


def courier_seq(rows: str, time: str) -> str:
    return f"""
select *, lag(to_lon) over drops as prev_lon, lag(to_lat) over drops as prev_lat,
  cast(row_number() over (partition by cast({time} as date), warehouse_id, courier_id
    order by {time} nulls last, eff, order_id) as integer) as order_number
from {rows}
window drops as (partition by warehouse_id, courier_id order by {time} nulls last, eff, order_id)"""


def vehicle_seq(time: str) -> str:
    return f"""
select *, lag(to_lon) over drops as prev_lon, lag(to_lat) over drops as prev_lat,
  cast(row_number() over (partition by cast(eff_l as date), courier_id
    order by {time} nulls last, eff, order_id) as integer) as order_number
from water_rows
window drops as (partition by courier_fleetvehicle_oid, warehouse_id order by {time} nulls last, eff, order_id)"""


def from_point(condition: str) -> str:
    return (
        f"case when {condition} then warehouse_lon else prev_lon end as from_lon, "
        f"case when {condition} then warehouse_lat else prev_lat end as from_lat"
    )


def job_max(rows: str) -> str:
    return f"""
select delivery_job_oid, max(raw_index) as max_index from {rows}
where is_batched is true and delivery_job_oid is not null group by 1"""


def market_legs(sequence: str, maxima: str, time: str) -> str:
    return f"""
select q.*, coalesce(m.max_index, 1) as max_index, {from_point("delivery_batch_index = 1")},
  case when delivery_batch_index = m.max_index then 1 else 0 end as will_return_warehouse
from {sequence} q left join {maxima} m on q.delivery_job_oid = m.delivery_job_oid
where {between_dates(time)}"""


def water_legs(sequence: str, time: str) -> str:
    return f"""
select q.*, case when r.order_id is not null then 1 else 0 end as is_from_warehouse,
  {from_point("r.order_id is not null")}
from {sequence} q left join refilled r on q.order_id = r.order_id where {between_dates(time)}"""


def with_return(legs: str) -> str:
    return f"""
select *, cast(delivery_batch_index as integer) as step, false as is_return,
  from_lon as x1, from_lat as y1, to_lon as x2, to_lat as y2 from {legs}
union all
select *, -1 as step, true as is_return, to_lon as x1, to_lat as y1, warehouse_lon as x2, warehouse_lat as y2
from {legs} where is_batched = false or (is_batched and will_return_warehouse = 1)"""


def single(legs: str) -> str:
    return f"""
select *, cast(delivery_batch_index as integer) as step, false as is_return,
  from_lon as x1, from_lat as y1, to_lon as x2, to_lat as y2 from {legs}"""


def priced(legs: str) -> str:
    return f"select *, {price('x1', 'y1', 'x2', 'y2')} as metres from {legs}"


def predicted(legs: str) -> str:
    filled = "metres is null and avg_distance is not null and not is_return"
    return f"""
select order_id, step, round(case when {filled} then avg_distance * 1000 else metres end, 6) as distance,
  round(metres / 8, 6) as duration, case when {filled} then 'predicted' else 'osrm' end as distance_type
from ({priced(legs)}) as p"""


def average(domains: str, back: int, extra: str = "true") -> str:
    return f"""
select warehouse_warehouse_oid as warehouse_id, avg(distance) as avg_distance
from leg_distances d join marketorders o on d._id_oid = o._id_oid
where {between_dates("coalesce(deliver_date, cancel_date)", back)}
  and {eligible("courier_courier_oid", "cancel_date")} and domaintype in ({domains}) and {extra}
group by 1"""


def unpriced(domains: str, back: int, time: str) -> str:
    return f"""
select o._id_oid as order_id from marketorders o left join (
  select d._id_oid, d.distance from leg_distances d join marketorders k on d._id_oid = k._id_oid
  where d.distance_type in ('osrm', 'predicted') and d.distance is not null and k.domaintype in ({domains})
    and {between_dates("coalesce(k.deliver_date, k.cancel_date)", back)}) x on o._id_oid = x._id_oid
where x.distance is null and o.domaintype in ({domains}) and {between_dates(time)}
  and {eligible("courier_courier_oid", "cancel_date")}"""


def trip_orders(table: str, kind: str, place: str, how: str) -> str:
    time = "coalesce(deliverdate, canceldate)"
    return f"""
select o._id_oid as order_id, {time} as deliver_date, {local(time)} as deliver_date_l,
  cast({local(time)} as date) as day, coalesce(courierwarehouse_oid, courierstore_oid) as warehouse_id,
  courier_oid as courier_id, w.location__coordinates_lon as warehouse_lon,
  w.location__coordinates_lat as warehouse_lat, restaurantloc_lon as restaurant_lon,
  restaurantloc_lat as restaurant_lat, deliveryaddress_location__coordinates_lon as to_lon,
  deliveryaddress_location__coordinates_lat as to_lat
from {table} o {how} join warehouses w on {place} = w._id_oid {how} join warehouse_locations z on {place} = z.warehouse
where {between_dates(time)} and {eligible("courier_oid", "canceldate")} and {kind}"""


def task_ranks(group: str, states: str) -> str:
    return f"""
select task_id, orderid_oid, taskgroupid_oid, sequence,
  cast(row_number() over (partition by {group} order by sequence nulls last, task_id) as integer) as batch_index
from courier_tasks where type = 'Delivery' and status in ({states})"""


def average_legs(table: str, distances: str, kind: str) -> str:
    averages = ", ".join(f"avg({leg}) as {leg}_avg" for leg in TRIP_LEGS)
    time = "coalesce(deliverdate, canceldate)"
    return f"""
select courierwarehouse_oid, {averages}
from {distances} d join {table} o on d._id_oid = o._id_oid join warehouse_locations on courierwarehouse_oid = warehouse
where {between_dates(time)} and {eligible("courier_oid", "canceldate")} and {kind} group by 1"""


def trip_gaps(table: str, distances: str, kind: str, place: str) -> str:
    time = "coalesce(deliverdate, canceldate)"
    gaps = " or ".join(f"d.{leg} is null" for leg in TRIP_LEGS)
    return f"""
select distinct o._id_oid as order_id
from {table} o join warehouse_locations on {place} = warehouse left join {distances} d on d._id_oid = o._id_oid
where {between_dates(time)} and {eligible("courier_oid", "canceldate")} and {kind} and ({gaps})"""


def slot_rows(rows: str, time: str, every: str, span: str, back: int, ahead: int = 0) -> str:
    """Every run's own copy of the rows that it sees."""
    return f"""
select run_start, r.* from {rows} r join (
  select unnest(generate_series({START}, {END} - interval {span}, interval {every})) as run_start) s
on {time} >= run_start - interval {back} hour and {time} < run_start + interval {span} + interval {ahead} hour"""


def slot_sequence(rows: str, drops: str, numbers: str, time: str) -> str:
    """As one run's sequence, run by run."""
    order = f"order by {time} nulls last, eff, order_id"
    return f"""
select *, lag(to_lon) over drops as prev_lon, lag(to_lat) over drops as prev_lat,
  cast(row_number() over (partition by run_start, {numbers} {order}) as integer) as order_number
from {rows} window drops as (partition by run_start, {drops} {order})"""


LEG_POINTS = dict(zip(TRIP_LEGS, TRIP_POINTS))


def trip_priced(orders: str) -> str:
    metres = ", ".join(f"{price(*LEG_POINTS[leg])} as {leg}" for leg in TRIP_LEGS)
    seconds = ", ".join(f"{price(*LEG_POINTS[leg])} / 8 as {leg}_duration" for leg in TRIP_LEGS)
    return f"select *, {metres}, {seconds} from {orders}"


def trip_columns() -> str:
    return ", ".join(f"round({leg}{end}, 6) as {leg}{end}" for end in ("", "_duration") for leg in TRIP_LEGS)


def trip_predicted(orders: str) -> str:
    filled = {leg: f"({leg} is null and {leg}_avg is not null)" for leg in TRIP_LEGS}
    legs = ", ".join(
        f"round(case when {filled[leg]} then {leg}_avg * 1000 else {leg} end, 6) as {leg}, "
        f"round({leg}_duration, 6) as {leg}_duration"
        for leg in TRIP_LEGS
    )
    return f"""
select order_id, {legs}, case when {" or ".join(filled.values())} then 'predicted' else 'osrm' end as distance_type
from ({trip_priced(orders)}) as p"""


def trip_final(orders: str, step: str) -> str:
    a, b, c = TRIP_LEGS
    legs = ", ".join(
        f"round({leg} / 1000, 6) as {leg}, round({leg}_duration, 6) as {leg}_duration" for leg in TRIP_LEGS
    )
    return f"""
select distinct order_id as _id_oid, warehouse_lon as store_lon, warehouse_lat as store_lat, restaurant_lon,
  restaurant_lat, to_lon as client_lon, to_lat as client_lat, {legs}, {NOW} as updated_at, 'osrm' as distance_type,
  round({a} / 1000 + {b} / 1000 + {c} / 1000, 6) as distance, cast({step} as integer) as step,
  round({a}_duration + {b}_duration + {c}_duration, 6) as duration
from ({trip_priced(orders)}) as p where {a} is not null and {b} is not null and {c} is not null"""


def merged(target: str, batch: str, keys: tuple[str, ...], columns: str) -> str:
    names = ", ".join(keys)
    return f"""
select {columns} from {target} anti join (select distinct {names} from {batch}) as replaced using ({names})
union all select {columns} from {batch}"""


def null_columns(present: str, absent: dict[str, str]) -> str:
    return ", ".join([present, *[f"cast(null as {kind}) as {name}" for name, kind in absent.items()]])


LEG_ORDER = "_id_oid, step, to_lon, to_lat, from_lon, from_lat, distance, distance_type, updated_at, duration"
TRIP_ORDER = (
    "_id_oid, store_lon, store_lat, restaurant_lon, restaurant_lat, client_lon, client_lat, store_to_rest, "
    "rest_to_client, client_to_store, updated_at, distance_type, distance, step, duration, store_to_rest_duration, "
    "rest_to_client_duration, client_to_store_duration"
)
REFILL_ORDER = (
    "warehouse_id, createdatl, courier_id, courier_franchise_id, lon, lat, refill_distance, distance_type, "
    "updated_at, duration, log_id, type"
)
LEG_NULLS = {c: "double" for c in ("to_lon", "to_lat", "from_lon", "from_lat", "duration")} | {
    "updated_at": "timestamp"
}
TRIP_NULLS = {
    c: "double"
    for c in TRIP_ORDER.split(", ")
    if c not in ("_id_oid", "step", "updated_at", "distance_type", *TRIP_LEGS)
} | {"updated_at": "timestamp", "step": "integer"}
FOOD_KIND = "(deliverytype is null or deliverytype = 1)"
ARTISAN_KIND = "deliverytype = 1"
# Interval and length of the runs of a grid.
MARKET_SLOTS, WATER_SLOTS = ("15 minute", "15 minute"), ("60 minute", "180 minute")
STORE = "coalesce(courierwarehouse_oid, courierstore_oid)"
FEED_KM = "case when distance / 1000 > 1000 then round(distance / 1000 / 100000, 4) else distance / 1000 end"

STEPS: dict[str, str] = {
    **{name: render(name, "duckdb") for name in VIEWS},
    "market_rows": market_rows("1, 3", 2),
    "market_seq": courier_seq("market_rows", "eff_l"),
    "market_max": job_max("market_rows"),
    "market_legs": market_legs("market_seq", "market_max", "eff"),
    "market_both": with_return("market_legs"),
    "market_priced": priced("market_both"),
    "market_final": f"""
select distinct order_id as _id_oid, step, x2 as to_lon, y2 as to_lat, x1 as from_lon, y1 as from_lat,
  round(metres / 1000, 6) as distance, 'osrm' as distance_type, {NOW} as updated_at, round(metres / 8, 6) as duration
from market_priced where metres is not null""",
    "water_rows": market_rows("4", 24),
    "water_timed": "select * from water_rows",
    "water_seq": vehicle_seq(local("delivered", "'Europe/Istanbul'")),
    "water_seq_eff": vehicle_seq("eff"),
    "refill_events": f"""
select l._id_oid as log_id, createdat, {local("createdat")} as compare_date_l, warehouse_oid as warehouse_id,
  courier_oid as courier_id, data_plate as vehicle, data_reason_oid, marketorder_oid
from courier_status_logs l left join warehouses w on warehouse_oid = w._id_oid
  left join warehouse_locations z on w._id_oid = z.warehouse
where createdat >= {START} and createdat < {END} + interval 2 hour""",
    "refill_next": f"""
select * exclude (data_reason_oid, marketorder_oid) from (
  select *, lag(marketorder_oid ignore nulls) over (partition by warehouse_id, courier_id
    order by compare_date_l desc nulls last, createdat desc, log_id desc) as next_order from refill_events) as e
where data_reason_oid = 'refill' and {between_dates("createdat")}""",
    "refilled": "select distinct next_order as order_id from refill_next where next_order is not null",
    "water_legs": water_legs("water_seq", "eff"),
    "water_single": single("water_legs"),
    "water_priced": priced("water_single"),
    "road_final": f"""
select distinct order_id as _id_oid, step, x2 as to_lon, y2 as to_lat, x1 as from_lon, y1 as from_lat,
  round(metres / 1000, 6) as distance, 'osrm' as distance_type, {NOW} as updated_at, round(metres / 8, 6) as duration
from (select order_id, step, x1, y1, x2, y2, metres from market_priced
  union all select order_id, step, x1, y1, x2, y2, metres from water_priced) as u where metres is not null""",
    "gap_priced": f"""
select order_id, step, is_return, x1, y1, x2, y2, avg_distance, metres from ({priced("market_gap_both")}) as m
union all select order_id, step, is_return, x1, y1, x2, y2, avg_distance, metres from ({priced("water_gap_single")}) as w""",
    "gap_final": f"""
select distinct order_id as _id_oid, step, x2 as to_lon, y2 as to_lat, x1 as from_lon, y1 as from_lat,
  round(coalesce(metres / 1000, case when not is_return then avg_distance end), 6) as distance,
  case when metres is null then 'predicted' else 'osrm' end as distance_type, {NOW} as updated_at,
  round(metres / 8, 6) as duration
from gap_priced where metres is not null or (avg_distance is not null and not is_return)""",
    "refill_trips": f"""
select l._id_oid as log_id, marketorder_oid, createdat, createdatl, cast(createdatl as date) as date_l,
  warehouse_oid as warehouse_id, w.name, l.location__coordinates_lon as refill_lon,
  l.location__coordinates_lat as refill_lat, w.location__coordinates_lon as warehouse_lon,
  w.location__coordinates_lat as warehouse_lat, courier_oid as courier_id,
  currentmarketemployer_franchise_oid as courier_franchise_id,
  case when data_reason_oid = 'busy' then 'busy_return_warehouse' else 'refill' end as type
from courier_status_logs l left join warehouses w on warehouse_oid = w._id_oid
where ((data_reason_oid = 'refill' and newstatus = 200) or newstatus = 4100
    or (data_reason_oid = 'busy' and newstatus = 200 and oldstatus = 900))
  and {between_dates("createdat")} and extract(hour from createdatl) not between 2 and 7""",
    "refill_priced": f"select *, {price('refill_lon', 'refill_lat', 'warehouse_lon', 'warehouse_lat')} as metres from refill_trips",
    "refill_final": f"""
select distinct warehouse_id, createdatl, courier_id, courier_franchise_id, refill_lon as lon, refill_lat as lat,
  round(metres / 1000, 6) as refill_distance, 'osrm' as distance_type, {NOW} as updated_at,
  round(metres / 8, 6) as duration, log_id, type
from refill_priced where metres is not null""",
    "food_info": trip_orders("food_orders", FOOD_KIND, "courierwarehouse_oid", "left"),
    "closed_tasks": task_ranks("taskgroupid_oid", "'COMPLETED', 'CANCELLED'"),
    "completed_tasks": task_ranks("orderid_oid", "'COMPLETED'"),
    "artisan_base": trip_orders("artisan_orders", ARTISAN_KIND, STORE, "left"),
    "artisan_info": "select a.*, t.batch_index from artisan_base a left join closed_tasks t on a.order_id = t.orderid_oid",
    "food_final": trip_final("food_info", "null"),
    "artisan_final": trip_final("artisan_info", "batch_index"),
    "market_avg": average("1, 3", 0),
    "water_avg": average("4", 24, "distance_type = 'osrm'"),
    "food_avg": average_legs("food_orders", "food_distances", FOOD_KIND),
    "artisan_avg": average_legs("artisan_orders", "artisan_distances", ARTISAN_KIND),
    "market_unpriced": unpriced("1, 3", 0, "coalesce(o.deliver_date, o.cancel_date)"),
    "water_unpriced": unpriced("4", 24, "o.deliver_date"),
    "market_gap": """
select l.*, avg_distance from market_unpriced u join market_legs l on u.order_id = l.order_id
  left join market_avg a on l.warehouse_id = a.warehouse_id""",
    "market_gap_both": with_return("market_gap"),
    "water_gap_legs": water_legs("water_seq_eff", "eff"),
    "water_gap": """
select l.*, avg_distance from water_unpriced u join water_gap_legs l on u.order_id = l.order_id
  left join water_avg a on l.warehouse_id = a.warehouse_id""",
    "water_gap_single": single("water_gap"),
    "food_gap_ids": trip_gaps("food_orders", "food_distances", FOOD_KIND, "courierwarehouse_oid"),
    "food_known": trip_orders("food_orders", FOOD_KIND, "courierwarehouse_oid", "inner"),
    "food_gap": """
select k.*, a.* exclude (courierwarehouse_oid) from food_gap_ids g join food_known k on g.order_id = k.order_id
  left join food_avg a on k.warehouse_id = a.courierwarehouse_oid""",
    "artisan_gap_ids": trip_gaps("artisan_orders", "artisan_distances", ARTISAN_KIND, STORE),
    "artisan_known": trip_orders("artisan_orders", ARTISAN_KIND, STORE, "inner"),
    "artisan_first": "select orderid_oid, min(batch_index) as batch_index from completed_tasks group by 1",
    "artisan_gap": """
select k.*, f.batch_index, a.* exclude (courierwarehouse_oid)
from artisan_gap_ids g join artisan_known k on g.order_id = k.order_id
  left join artisan_first f on k.order_id = f.orderid_oid
  left join artisan_avg a on k.warehouse_id = a.courierwarehouse_oid""",
    "gps_rows": market_rows("1, 3", 2, delivered_only=True),
    "gps_seq": courier_seq("gps_rows", "delivered_l"),
    "gps_max": job_max("gps_rows"),
    "gps_legs": market_legs("gps_seq", "gps_max", "delivered"),
    "gps_info": f"""
select d._id_oid, cast(coalesce(l.delivery_batch_index, 1) as integer) as step, l.to_lon, l.to_lat, l.from_lon,
  l.from_lat, d.corrected_distance as distance, 'gps' as distance_type, l.is_batched
from orders_distances d left join marketorders o on d._id_oid = o._id_oid left join gps_legs l on d._id_oid = l.order_id
where {between_dates("o.deliver_date")}""",
    "gps_final": f"""
select distinct _id_oid, step, to_lon, to_lat, from_lon, from_lat, distance, distance_type, {NOW} as updated_at,
  cast(null as double) as duration from gps_info""",
    "spots": f"""
select shape, i, {STEPS_OF_POINTS["lat"]} as z_lat, {STEPS_OF_POINTS["lon"]} as z_lon
from (select *, unnest(range(1, n_points + 1)) as i from route_shapes) as x""",
    "known_points": """
select shape, i, sum(case when z_lat % 2 = 1 then -(z_lat + 1) / 2 else z_lat / 2 end) over along / 1e7 as lat,
  sum(case when z_lon % 2 = 1 then -(z_lon + 1) / 2 else z_lon / 2 end) over along / 1e7 as lon
from spots window along as (partition by shape order by i)""",
    # A single time that is left out makes an empty text, which is a route without times.
    "known_offsets": """
select shape, i, case when (shape + i) % 13 <> 0
  then (i - 1) * (shape % 50 + 1) * case when i > 1 and shape % 19 = 4 then -1e0 else 1e0 end end as seconds
from (select *, unnest(range(1, n_times + 1)) as i from route_shapes where not (n_times = 1 and (shape + 1) % 13 = 0)) as x""",
    "timed_points": """
select p.shape, p.i, p.lat, p.lon, o.seconds from known_points p left join known_offsets o on p.shape = o.shape and p.i = o.i
where o.i is not null or p.shape not in (select shape from known_offsets)""",
    "all_points": """
select cast(o_orderkey as varchar) as _id_oid, case when seconds <> 0 then eff + to_seconds(cast(seconds as bigint)) end as time, lon, lat
from base_orders join timed_points on o_orderkey % 3001 = shape""",
    "window_points": f"""
select p.* from all_points p join marketorders o on p._id_oid = o._id_oid
where {between_dates("coalesce(deliver_date, cancel_date)")}""",
    "leg_merged": merged("leg_target", "market_final", ("_id_oid", "distance_type"), LEG_ORDER),
    "asked_legs": """
  select cast(round(from_lon * 1000000) as bigint) as from_lon, cast(round(from_lat * 1000000) as bigint) as from_lat,
    cast(round(to_lon * 1000000) as bigint) as to_lon, cast(round(to_lat * 1000000) as bigint) as to_lat,
    cast(round(to_lon * 1000) as bigint) % 7 <> 0 as answered, eff < timestamp '1998-01-17' as early
  from market_legs where from_lon is not null and from_lat is not null and to_lon is not null and to_lat is not null""",
    "market_slot_rows": slot_rows("market_rows", "eff", *MARKET_SLOTS, 2),
    "market_slot_seq": slot_sequence(
        "market_slot_rows", "warehouse_id, courier_id", "cast(eff_l as date), warehouse_id, courier_id", "eff_l"
    ),
    "market_slot_max": """
select run_start, delivery_job_oid, max(raw_index) as max_index from market_slot_rows
where is_batched is true and delivery_job_oid is not null group by all""",
    "market_slot_legs": f"""
select q.*, coalesce(m.max_index, 1) as max_index, {from_point("delivery_batch_index = 1")},
  case when delivery_batch_index = m.max_index then 1 else 0 end as will_return_warehouse
from market_slot_seq q left join market_slot_max m on q.run_start = m.run_start and q.delivery_job_oid = m.delivery_job_oid
where eff >= q.run_start and eff < q.run_start + interval {MARKET_SLOTS[1]}""",
    "water_slot_rows": slot_rows("water_rows", "eff", *WATER_SLOTS, 24),
    "water_slot_seq": slot_sequence(
        "water_slot_rows", "courier_fleetvehicle_oid, warehouse_id", "cast(eff_l as date), courier_id",
        local("delivered", "'Europe/Istanbul'"),
    ),
    "slot_events": slot_rows("refill_events", "createdat", *WATER_SLOTS, 0, 2),
    "slot_refilled": f"""
select distinct run_start, next_order as order_id from (
  select *, lag(marketorder_oid ignore nulls) over (partition by run_start, warehouse_id, courier_id
    order by compare_date_l desc nulls last, createdat desc, log_id desc) as next_order from slot_events) as e
where data_reason_oid = 'refill' and createdat < run_start + interval {WATER_SLOTS[1]} and next_order is not null""",
    "water_slot_legs": f"""
select q.*, case when r.order_id is not null then 1 else 0 end as is_from_warehouse, {from_point("r.order_id is not null")}
from water_slot_seq q left join slot_refilled r on q.run_start = r.run_start and q.order_id = r.order_id
where eff >= q.run_start and eff < q.run_start + interval {WATER_SLOTS[1]}""",
    "food_merged": merged("food_target", "food_final", ("_id_oid", "distance_type"), TRIP_ORDER),
    "expired_ids": f"select _id_oid from routes_market where checkout_date_l < timestamp '{RETENTION_START}' - interval 31 day",
    "kept_points": "select * from route_points where _id_oid not in (select _id_oid from expired_ids)",
    "leg_target": f"select {null_columns('_id_oid, step, distance, distance_type', LEG_NULLS)} from leg_distances",
    "food_target": f"select {null_columns('_id_oid, distance_type, ' + ', '.join(TRIP_LEGS), TRIP_NULLS)} from food_distances",
    "artisan_target": f"select {null_columns('_id_oid, distance_type, ' + ', '.join(TRIP_LEGS), TRIP_NULLS)} from artisan_distances",
    "refill_target": f"""
select {null_columns("warehouse_id, createdatl, courier_id, courier_franchise_id, refill_distance, distance_type, log_id, type",
  {"lon": "double", "lat": "double", "updated_at": "timestamp", "duration": "double"})} from refill_distances""",
    "feed": f"""
select order_id, step, {FEED_KM} as distance, domain_type, 'partner' as distance_type, {NOW} as updated_at
from partner_rows where {between_dates("processed_time")}""",
    "water_km": f"""
select o._id_oid as order_id, courier_courier_oid, date_trunc('day', checkoutdatel)::timestamp as date_l, 4 as domaintype, step,
  case when distance > 13 then 13.0e0 else distance end as osrm, case when distance > 13 then 13.0e0 else distance end as km
from marketorders o join leg_distances d on o._id_oid = d._id_oid
where checkoutdatel between {START} and {END} and distance_type = 'osrm' and domaintype = 4""",
    "fields": """
select query, line_number, raw_line, string_split(raw_line, ',') as parts from raw_loads""",
    "staged_lines": """
select query, line_number, 1 + row_number() over (partition by query order by line_number) as file_line from raw_loads""",
    "spoiled_rows": """
select order_id, cast(order_id as bigint) % 2 as lot, cast(order_id as bigint) % 50 as kind from partner_rows""",
    "field_errors": """
select query, line_number, cast(null as varchar) as colname, cast(null as varchar) as value, raw_line,
  'wrong number of fields' as err_reason from fields where len(parts) <> 3
union all select query, line_number, 'order_id', parts[1], raw_line, 'invalid bigint' from fields
  where len(parts) = 3 and try_cast(parts[1] as bigint) is null
union all select query, line_number, 'step', parts[2], raw_line, 'invalid int' from fields
  where len(parts) = 3 and try_cast(parts[2] as integer) is null
union all select query, line_number, 'distance', parts[3], raw_line, 'invalid double' from fields
  where len(parts) = 3 and try_cast(parts[3] as double) is null""",
}

PRICED = "order_id, from_lon, from_lat, to_lon, to_lat"
MARKET_ORDER = (
    "order_id, eff as deliver_date, cancel_date, eff_l as deliver_date_l, is_batched, delivery_batch_index, max_index, "
    "delivery_job_oid, warehouse_id, courier_id, order_number, warehouse_lon, warehouse_lat, prev_lon, prev_lat, "
    "from_lon, from_lat, to_lon, to_lat, will_return_warehouse"
)
LEG_PRICE = price("from_lon", "from_lat", "to_lon", "to_lat")
STRAIGHT = straight("from_lon", "from_lat", "to_lon", "to_lat")
TABLE_PRICED = f"""
select {PRICED}, round({LEG_PRICE}, 6) as distance, round({LEG_PRICE} / 8, 6) as duration, 'osrm' as distance_type
from market_legs"""
GAP_AVERAGES = ", ".join(f"round({leg}_avg, 6) as {leg}_avg" for leg in TRIP_LEGS)
TRIP_INFO = (
    "order_id, deliver_date, deliver_date_l, day, warehouse_id, courier_id, warehouse_lon, warehouse_lat, "
    "restaurant_lon, restaurant_lat, to_lon, to_lat"
)
PARTNER_TRIP_NULLS = {
    c: "double"
    for c in TRIP_ORDER.split(", ")
    if c not in ("_id_oid", "step", "updated_at", "distance_type", "distance")
}


def partner_trips(domain: int) -> str:
    present = "order_id as _id_oid, step, distance, distance_type, updated_at"
    return f"select distinct {null_columns(present, PARTNER_TRIP_NULLS)} from feed where domain_type = {domain}"


PARTNER_LEGS = f"""
select distinct {null_columns("order_id as _id_oid, step, distance, distance_type, updated_at",
  {c: "double" for c in ("to_lon", "to_lat", "from_lon", "from_lat", "duration")})} from feed where domain_type in (1, 3, 4)"""


def stacked(**tables: str) -> str:
    return " union all by name ".join(f"select '{name}' as result, * from ({text}) as t" for name, text in tables.items())


def legs_straight() -> str:
    metres = straight("x1", "y1", "x2", "y2")
    return f"""
select distinct order_id as _id_oid, step, x2 as to_lon, y2 as to_lat, x1 as from_lon, y1 as from_lat,
  round(metres / 1000, 6) as distance, 'haversine' as distance_type, {NOW} as updated_at, round(metres / 8, 6) as duration
from (select order_id, step, x1, y1, x2, y2, {metres} as metres from (select order_id, step, x1, y1, x2, y2 from market_both
  union all select order_id, step, x1, y1, x2, y2 from water_single) as u) as m where metres is not null"""


def refill_straight() -> str:
    metres = straight("refill_lon", "refill_lat", "warehouse_lon", "warehouse_lat")
    return f"""
select distinct warehouse_id, createdatl, courier_id, courier_franchise_id, refill_lon as lon, refill_lat as lat,
  round(metres / 1000, 6) as refill_distance, 'haversine' as distance_type, {NOW} as updated_at,
  round(metres / 8, 6) as duration, log_id, type
from (select *, {metres} as metres from refill_trips) as m where metres is not null"""


def trip_gap_final(orders: str, step: str) -> str:
    """Trips of orders with a gap: a leg without a price takes the average, which has no duration."""
    legs = ", ".join(f"coalesce({leg} / 1000, {leg}_avg) as km_{leg}" for leg in TRIP_LEGS)
    filled = " or ".join(f"({leg} is null and {leg}_avg is not null)" for leg in TRIP_LEGS)
    shown = ", ".join(f"round(km_{leg}, 6) as {leg}, round({leg}_duration, 6) as {leg}_duration" for leg in TRIP_LEGS)
    known = " and ".join(f"km_{leg} is not null" for leg in TRIP_LEGS)
    return f"""
select distinct order_id as _id_oid, warehouse_lon as store_lon, warehouse_lat as store_lat, restaurant_lon,
  restaurant_lat, to_lon as client_lon, to_lat as client_lat, {shown}, {NOW} as updated_at,
  case when {filled} then 'predicted' else 'osrm' end as distance_type,
  round({" + ".join(f"km_{leg}" for leg in TRIP_LEGS)}, 6) as distance, cast({step} as integer) as step,
  round({" + ".join(f"{leg}_duration" for leg in TRIP_LEGS)}, 6) as duration
from (select *, {legs} from ({trip_priced(orders)}) as p) as q where {known}"""


ANSWERS: dict[str, str] = {
    "sql_template": f"""
select order_id, step, osrm, km from fleet_vehicle_km_logs
where date_l between date '{FLEET_DAYS[0]}' and date '{FLEET_DAYS[1]}' and osrm is not null""",
    "csv_stage_roundtrip": f"select {LEG_ORDER} from leg_target",
    "upsert_market": merged("leg_target", "market_final", ("_id_oid", "distance_type"), LEG_ORDER),
    "upsert_gps": merged("leg_target", "gps_final", ("_id_oid", "distance_type"), LEG_ORDER),
    "upsert_food": merged("food_target", "food_final", ("_id_oid", "distance_type"), TRIP_ORDER),
    "upsert_artisan": merged("artisan_target", "artisan_final", ("_id_oid", "distance_type"), TRIP_ORDER),
    "upsert_refill": merged("refill_target", "refill_final", ("courier_id", "createdatl"), REFILL_ORDER),
    "upsert_route": merged("route_points", "window_points", ("_id_oid",), "_id_oid, time, lon, lat"),
    "route_retention": "select * from kept_points",
    "route_retention_count": "select count(*) as remaining from kept_points",
    "load_error_report": """
select starttime, e.query, line_number, colname, value, raw_line, err_reason
from field_errors e join loads l on e.query = l.query
order by starttime desc, e.query desc, line_number, colname nulls first limit 100""",
    "load_accepted": """
select query, line_number, cast(parts[1] as bigint) as order_id, cast(parts[2] as integer) as step,
  cast(parts[3] as double) as distance from fields
where len(parts) = 3 and try_cast(parts[2] as integer) is not null and try_cast(parts[3] as double) is not null""",
    "partner_export": f"""
select *, '1998-01-02T00:00:00Z' as start_time, '1998-02-01T00:00:00Z' as end_time from (
  select order_id, courier_id, cast(date_l as timestamp) as date_l, order_domain as domain_type, step, osrm,
    km as distance from fleet_vehicle_km_logs
  where date_l between date '1998-01-02' and date '1998-02-01' and osrm is not null
  union all select order_id, courier_courier_oid, date_l, domaintype, step, osrm, km from water_km) as u""",
    "partner_feed": "select * from feed",
    "stage_load_errors": """
select e.query, file_line as line_number, colname, value, raw_line, err_reason
from field_errors e join staged_lines l on e.query = l.query and e.line_number = l.line_number""",
    "stage_load_accepted": """
select f.query, file_line as line_number, cast(parts[1] as bigint) as order_id, cast(parts[2] as integer) as step,
  cast(parts[3] as double) as distance from fields f join staged_lines l on f.query = l.query and f.line_number = l.line_number
where len(parts) = 3 and try_cast(parts[2] as integer) is not null and try_cast(parts[3] as double) is not null""",
    "partner_feed_taken_in": "select * from feed where cast(order_id as bigint) % 50 not in (7, 8)",
    "partner_feed_rejects": """
select order_id, case kind when 7 then 'no JSON' else 'a field of another type' end as reason from spoiled_rows where kind in (7, 8)""",
    "partner_feed_intakes": """
select cast(lot as integer) as lot, count(*) filter (kind not in (7, 8)) as rows, count(*) filter (kind in (7, 8)) as rejected
from spoiled_rows group by lot""",
    "check_tables": """
select 'refill_info' as sheet, count(*) as rows, 'Warehouse Id, Createdatl, Courier Id' as titles from refill_final
union all select 'food_order_info', count(*), ' Id Oid, Store Lon, Store Lat' from food_final
union all select 'gps_distance_info', count(*), ' Id Oid, Step, To Lon' from gps_final""",
    "lookback_trim": f"""
select order_id, eff as deliver_date, prev_lon is not null as has_previous from market_seq where {between_dates("eff")}""",
    "next_order_after_refill": "select * from refill_next",
    "eligible_orders": f"""
select _id_oid as order_id, status, domaintype from marketorders where {eligible("courier_courier_oid", "cancel_date")}""",
    "warehouse_filter": f"""
select _id_oid as order_id, warehouse_warehouse_oid as warehouse_id from marketorders
where warehouse_warehouse_oid in {SOME_WAREHOUSES}""",
    "local_time_orders": """
select order_id, eff as deliver_date, eff_l as deliver_date_l, date_trunc('day', eff_l)::timestamp as day,
  delivery_batch_index from market_rows""",
    "fixed_zone_time": f"""
select _id_oid as log_id, createdat, {local("createdat", "'Europe/Istanbul'")} as home_time from courier_status_logs""",
    "object_id_check": r"""
select event_id, regexp_matches(case event_id % 3 when 0 then md5(cast(event_id as varchar))[1:24]
  when 1 then upper(md5(cast(event_id as varchar))[1:24]) else md5(cast(event_id as varchar)) end,
  '^[a-f\d]{24}$') as is_object_id from events""",
    "run_grid": """
select unnest(generate_series(date_trunc('day', min(t))::timestamp, time_bucket(interval 15 minute, max(t)), interval 15 minute))
  as run_start from (select coalesce(deliver_date, cancel_date) as t from marketorders) as x""",
    "legs_market": f"select {MARKET_ORDER} from market_legs",
    "legs_market_preview": f"select {MARKET_ORDER} from market_legs order by order_id limit 200",
    "prev_drop_market": "select order_id, warehouse_id, courier_id, prev_lon, prev_lat from market_seq",
    "order_number_market": "select order_id, warehouse_id, courier_id, order_number from market_seq",
    "batch_max": "select * from market_max",
    "legs_with_return": """
select order_id, step, is_return, x1 as from_lon, y1 as from_lat, x2 as to_lon, y2 as to_lat from market_both""",
    "price_legs_table": TABLE_PRICED,
    "price_legs_retry": TABLE_PRICED,
    "price_legs_stored": TABLE_PRICED,
    "price_legs_remembered": TABLE_PRICED,
    "price_legs_unanswered": """
select from_lon, from_lat, to_lon, to_lat, cast(bool_or(early) as integer) as failures from asked_legs
group by all having not bool_or(early and answered)""",
    "price_legs_haversine": f"""
select {PRICED}, round({STRAIGHT}, 3) as distance, round({STRAIGHT} / 8, 3) as duration, 'haversine' as distance_type
from market_legs""",
    "finalize_market": f"select {LEG_ORDER} from market_final",
    "all_market_legs": """
select distinct step, order_id, x1 as from_lon, y1 as from_lat, x2 as to_lon, y2 as to_lat, round(metres, 6) as distance,
  round(metres / 8, 6) as duration, 'osrm' as distance_type
from (select order_id, step, x1, y1, x2, y2, metres from market_priced
  union all select order_id, step, x1, y1, x2, y2, metres from water_priced) as u""",
    "legs_market_slots": """
select order_id, eff as deliver_date, cancel_date, eff_l as deliver_date_l, is_batched, delivery_batch_index, max_index,
  delivery_job_oid, warehouse_id, courier_id, order_number, warehouse_lon, warehouse_lat, prev_lon, prev_lat, from_lon, from_lat,
  to_lon, to_lat, will_return_warehouse, run_start from market_slot_legs""",
    "legs_water_slots": """
select order_id, eff_l as deliver_date_l, is_batched, delivery_batch_index, delivery_job_oid, warehouse_id, courier_id,
  courier_fleetvehicle_oid, order_number, warehouse_lon, warehouse_lat, to_lon, to_lat, prev_lon, prev_lat,
  is_from_warehouse, from_lon, from_lat, run_start from water_slot_legs""",
    "food_order_slots": f"""
select f.*, run_start from food_info f join (
  select unnest(generate_series({START}, {END} - interval {MARKET_SLOTS[1]}, interval {MARKET_SLOTS[0]})) as run_start) s
on deliver_date >= run_start and deliver_date < run_start + interval {MARKET_SLOTS[1]}""",
    "legs_water": """
select order_id, eff_l as deliver_date_l, is_batched, delivery_batch_index, delivery_job_oid, warehouse_id, courier_id,
  courier_fleetvehicle_oid, order_number, warehouse_lon, warehouse_lat, to_lon, to_lat, prev_lon, prev_lat,
  is_from_warehouse, from_lon, from_lat from water_legs""",
    "prev_drop_water": "select order_id, warehouse_id, courier_fleetvehicle_oid, prev_lon, prev_lat from water_seq",
    "order_number_water": "select order_id, courier_id, order_number from water_seq",
    "refill_info": "select * from refill_trips",
    "refill_legs": """
select log_id, refill_lon, refill_lat, round(metres, 6) as distance, round(metres / 8, 6) as duration,
  'osrm' as distance_type from refill_priced""",
    "finalize_refill": "select * from refill_final",
    "water_warehouses": "select _p_id_oid as warehouse_id from warehouse_domaintypes where domaintypes = 4 group by 1",
    "food_order_info": "select * from food_info",
    "artisan_order_info": "select * from artisan_info",
    "task_batch_index": "select * from closed_tasks",
    "task_batch_index_completed": "select * from completed_tasks",
    "trip_legs_food": f"select order_id, {trip_columns()}, 'osrm' as distance_type from ({trip_priced('food_info')}) as p",
    "trip_legs_artisan": f"""
select order_id, batch_index, {trip_columns()}, 'osrm' as distance_type from ({trip_priced('artisan_info')}) as p""",
    "finalize_food": "select * from food_final",
    "finalize_artisan": "select * from artisan_final",
    "avg_distance_market": "select warehouse_id, round(avg_distance, 6) as avg_distance from market_avg",
    "avg_distance_water": "select warehouse_id, round(avg_distance, 6) as avg_distance from water_avg",
    "avg_legs_food": f"select courierwarehouse_oid, {GAP_AVERAGES} from food_avg",
    "avg_legs_artisan": f"select courierwarehouse_oid, {GAP_AVERAGES} from artisan_avg",
    "market_missing": """
select order_id, delivered_l as deliver_date_l, eff as deliver_date, is_batched, delivery_batch_index, max_index,
  delivery_job_oid, warehouse_id, courier_id, order_number, warehouse_lon, warehouse_lat, prev_lon, prev_lat, from_lon,
  from_lat, to_lon, to_lat, round(avg_distance, 6) as avg_distance, will_return_warehouse from market_gap""",
    "water_missing": """
select order_id, eff as deliver_date, eff_l as deliver_date_l, is_batched, delivery_batch_index, delivery_job_oid,
  warehouse_id, courier_id, courier_fleetvehicle_oid, order_number, warehouse_lon, warehouse_lat, to_lon, to_lat, prev_lon,
  prev_lat, is_from_warehouse, round(avg_distance, 6) as avg_distance, from_lon, from_lat from water_gap""",
    "food_missing": f"select {TRIP_INFO}, {GAP_AVERAGES} from food_gap",
    "artisan_missing": f"select {TRIP_INFO}, batch_index, {GAP_AVERAGES} from artisan_gap",
    "predict_missing_market": predicted("market_gap_both"),
    "predict_missing_water": predicted("water_gap_single"),
    "predict_missing_food": trip_predicted("food_gap"),
    "predict_missing_artisan": trip_predicted("artisan_gap"),
    "gps_distance_info": "select * from gps_info",
    "gps_with_return": """
select * from gps_info where distance is not null
union all select * replace (-1 as step) from gps_info where distance is not null and is_batched = false""",
    "finalize_gps": "select * from gps_final",
    "gps_routes": "select * from window_points",
    "route_time_decode": """
select cast(o_orderkey as varchar) as _id_oid, cast(i - 1 as integer) as position, seconds
from orders join known_offsets on o_orderkey % 3001 = shape""",
    "route_points": "select * from all_points",
    "route_dedup": """
select _id_oid, start_time, encoded_latlons, encoded_time from (
  select *, row_number() over (partition by _id_oid order by start_time desc) as n from (
    select _id_oid, start_time, encoded_latlons, encoded_time from routes_market
    union all select _id_oid, start_time + to_seconds(case when cast(_id_oid as bigint) % 4 = 0 then 3600 else -3600 end),
      encoded_latlons[1:10], '2s' from routes_market) as u) as v where n = 1""",
    "partner_arrange_market": PARTNER_LEGS,
    "partner_arrange_food": partner_trips(2),
    "partner_arrange_artisan": partner_trips(6),
    "water_km_capped": "select * from water_km",
    "fleet_km": f"""
select order_id, courier_id, date_l, order_domain, step, osrm, km from fleet_vehicle_km_logs
where date_l between date '{FLEET_DAYS[0]}' and date '{FLEET_DAYS[1]}' and osrm is not null""",
    "run_counts": """
select 'market' as line, count(*) as rows from market_legs union all select 'water', count(*) from water_legs
union all select 'food', count(*) from food_info union all select 'artisan', count(*) from artisan_info""",
    "run_osrm": stacked(leg_distances=legs_straight(), refill_distances=refill_straight()),
    "run_osrm_all": stacked(
        leg_distances="select * from road_final", refill_distances="select * from refill_final",
        food_distances="select * from food_final", artisan_distances="select * from artisan_final",
    ),
    "run_gps": stacked(gps_distances="select * from gps_final", route_points="select * from window_points"),
    "run_both": stacked(
        food_distances="select * from food_final", gps_distances="select * from gps_final",
        route_points="select * from window_points",
    ),
    "run_monthly_missing": stacked(
        leg_distances="select * from gap_final", food_distances=trip_gap_final("food_gap", "null"),
        artisan_distances=trip_gap_final("artisan_gap", "batch_index"),
    ),
    "run_partner": stacked(
        leg_distances=PARTNER_LEGS, food_distances=partner_trips(2), artisan_distances=partner_trips(6)
    ),
    "store_market_changes": f"""
select *, 'removed' as change from (select {LEG_ORDER} from leg_target except all select * from leg_merged) as gone
union all select *, 'added' as change from (select * from leg_merged except all select {LEG_ORDER} from leg_target) as come""",
    "store_market": merged("leg_target", "market_final", ("_id_oid", "distance_type"), LEG_ORDER),
    "store_refill": merged("refill_target", "refill_final", ("courier_id", "createdatl"), REFILL_ORDER),
    "store_route": merged("route_points", "window_points", ("_id_oid",), "_id_oid, time, lon, lat"),
    "expire_route": "select * from kept_points",
    "expire_route_count": "select count(*) as remaining from kept_points",
}
ODD = f"timestamp '{ODD_WINDOW.start}'", f"timestamp '{ODD_WINDOW.end}'"


def kept_sums(line: str, distances: str, orders: str, warehouse: str, time: str, kinds: dict[str, str], counts: str) -> str:
    """Sums by warehouse, day and kind, worked out from the stored rows."""
    return " union all ".join(
        f"""
select '{line}' as line, {warehouse} as warehouse_id, cast({time} as date) as day, {kind} as kind,
  cast(sum(cast(round({value} * 1000000) as bigint)) as bigint) as total, count({value}) as count
from {distances} d join {orders} o on d._id_oid = o._id_oid where {counts} and {value} is not null and {warehouse} is not null
group by all"""
        for value, kind in kinds.items()
    )


_TIME, _TRIP_TIME = "coalesce(deliver_date, cancel_date)", "coalesce(deliverdate, canceldate)"
_ZONED = "courierwarehouse_oid in (select warehouse from warehouse_locations)"
_COUNTS = {domains: f"domaintype in ({domains}) and {eligible('courier_courier_oid', 'cancel_date')}" for domains in ("1, 3", "4")}
ANSWERS["average_state"] = " union all ".join(
    [kept_sums(line, "leg_merged", "marketorders", "warehouse_warehouse_oid", _TIME, {"distance": "distance_type"}, _COUNTS[domains])
     for line, domains in (("market", "1, 3"), ("water", "4"))]
    + [kept_sums(line, table, f"{line}_orders", "courierwarehouse_oid", _TRIP_TIME, {leg: f"'{leg}'" for leg in TRIP_LEGS},
                 f"{kind} and {eligible('courier_oid', 'canceldate')} and {_ZONED}")
       for line, table, kind in (("food", "food_merged", FOOD_KIND), ("artisan", "artisan_target", ARTISAN_KIND))]
)
ANSWERS["avg_distance_kept"] = " union all ".join(
    f"""
select '{line}' as line, warehouse_warehouse_oid as warehouse_id, round(avg(distance), 6) as avg_distance
from leg_merged d join marketorders o on d._id_oid = o._id_oid
where {_COUNTS[domains]} and {_TIME} >= {ODD[0]} - interval {back} hour and {_TIME} < {ODD[1]} and {extra} and distance is not null
  and warehouse_warehouse_oid is not null group by all"""
    for line, domains, back, extra in (("market", "1, 3", 0, "true"), ("water", "4", 24, "distance_type = 'osrm'"))
)
ANSWERS["avg_legs_kept"] = f"""
select courierwarehouse_oid as warehouse_id, {", ".join(f"round(avg({leg}), 6) as {leg}_avg" for leg in TRIP_LEGS)}
from food_merged d join food_orders o on d._id_oid = o._id_oid
where {FOOD_KIND} and {eligible('courier_oid', 'canceldate')} and {_ZONED}
  and {_TRIP_TIME} >= {ODD[0]} and {_TRIP_TIME} < {ODD[1]}
group by 1 having count({TRIP_LEGS[0]}) + count({TRIP_LEGS[1]}) + count({TRIP_LEGS[2]}) > 0"""
ANSWERS["market_missing_stored"] = ANSWERS["market_missing"]
# Steps that several others read and that are long to work out.
MATERIALISED = ("timed_points", "all_points", "window_points")


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", text)))
    return [name for name in STEPS if name in words]


def compose(text: str) -> str:
    """``text`` with the steps it reads in front, each after the ones it reads itself."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for parent in _needs(STEPS[name]):
            if parent != name:
                visit(parent)
        order.append(name)

    for name in _needs(text):
        visit(name)
    if not order:
        return text.strip()
    kind = {name: " materialized" for name in MATERIALISED}
    steps = ",\n".join(f"{name} as{kind.get(name, '')} (\n{STEPS[name].strip()}\n)" for name in order)
    return f"with {steps}\n{text.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: compose(text) for name, text in ANSWERS.items()}
