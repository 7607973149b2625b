"""The logical tables as views over the test tables, each written once for Spark and DuckDB.

Placeholders: ``{S}`` text type, ``{N}`` zone-less timestamp type, ``{adds:t|n}`` and ``{addd:t|n}``
add seconds and days, ``{glue:n|x}`` and ``{semi:n|x}`` put together ``x`` for ``i`` from 1 to ``n`` (with ``;``
in between), ``{b36:x|36}`` is a whole number in base 36.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from legmeter.sources.tables import Tables

# Steps of latitude and longitude of point ``i`` as the route text stores them: doubled, odd if negative. The first
# point is far away, the others are small steps of both signs.
STEPS = {
    "lat": "case when i = 1 then 816000000 + shape * 7919 % 1000000 else (shape * 31 + i * 7919) % 65536 end",
    "lon": "case when i = 1 then 570000000 + shape * 104729 % 1000000 else (shape * 37 + i * i * 101) % 40000 end",
}


def number_text(value: str) -> str:
    """SQL of a whole number below 2**30 in the route alphabet: five bits a character, low bits first."""
    characters = []
    for k in range(6):
        more = f"case when ({value}) >= {32 ** (k + 1)} then 95 else 63 end"
        character = f"chr(cast({more} + cast(floor(({value}) / {32**k}) as bigint) % 32 as int))"
        characters.append(character if k == 0 else f"case when ({value}) >= {32**k} then {character} else '' end")
    return f"concat({', '.join(characters)})"


VIEWS: dict[str, str] = {
    "warehouses": """
select concat('W', s_suppkey) as _id_oid, s_name as name,
  28.5e0 + (s_suppkey * 37 % 100) / 200e0 as location__coordinates_lon,
  40.8e0 + (s_suppkey * 53 % 100) / 400e0 as location__coordinates_lat
from supplier""",
    "warehouse_locations": """
select concat('W', s_suppkey) as warehouse,
  case when s_suppkey % 10 <> 9 then case s_suppkey % 5 when 0 then 'Europe/Istanbul' when 1 then 'Europe/London'
    when 2 then 'America/New_York' when 3 then 'Asia/Tokyo' else 'UTC' end end as country_time_zone
from supplier""",
    "warehouse_domaintypes": """
select concat('W', cast(floor(s_suppkey / 2) as bigint)) as _p_id_oid, case when s_suppkey % 2 = 0 then 4 else 1 end as domaintypes
from supplier""",
    "base_orders": """
select *, cast(floor(o_orderkey / 3) as bigint) as job, (select count(*) from supplier) as places,
  {adds:{adds:cast('1998-01-01 00:00:00' as {N})|(cast(floor(o_orderkey / 3) as bigint) * 104729) % 2592000}|(o_orderkey % 3) * 600} as eff
from orders""",
    "marketorders": """
select cast(o_orderkey as {S}) as _id_oid, concat('W', job % places) as warehouse_warehouse_oid,
  case when o_orderkey % 17 = 0 then null else concat('C', job % (4 * places)) end as courier_courier_oid,
  concat('V', job % (2 * places)) as courier_fleetvehicle_oid,
  case o_orderkey % 5 when 4 then 500 when 1 then 1000 when 3 then 1000 else 900 end as status,
  case when o_orderkey % 5 <> 4 then eff end as deliver_date,
  case when o_orderkey % 5 = 4 then eff end as cancel_date,
  {adds:eff|10800} as checkoutdatel,
  case job % 6 when 1 then 3 when 2 then 4 when 4 then 4 when 5 then 3 else 1 end as domaintype,
  case when job % 4 <> 0 then true when job % 8 = 0 then null else false end as delivery_batch_isbatched,
  case when job % 4 <> 0 then cast(o_orderkey % 3 + 1 as int) end as delivery_batch_index,
  case when job % 4 <> 0 then concat('J', job) end as delivery_job_oid,
  28.5e0 + (o_custkey % 1000) / 1000e0 as delivery_address_location__coordinates_lon,
  40.8e0 + (o_custkey * 7 % 1000) / 2000e0 as delivery_address_location__coordinates_lat,
  28.5e0 + ((job % places) * 37 % 100) / 200e0 as warehouse_location__coordinates_lon,
  40.8e0 + ((job % places) * 53 % 100) / 400e0 as warehouse_location__coordinates_lat
from base_orders""",
    "food_orders": """
select cast(o_orderkey as {S}) as _id_oid,
  case when o_orderkey % 7 = 0 then null else concat('W', o_custkey % places) end as courierwarehouse_oid,
  concat('W', o_custkey % (places - 1)) as courierstore_oid,
  case when o_orderkey % 17 = 0 then null else concat('C', o_custkey % (4 * places)) end as courier_oid,
  case o_orderkey % 5 when 4 then 500 when 1 then 1000 when 3 then 1000 else 900 end as status,
  case when o_orderkey % 5 <> 4 then eff end as deliverdate,
  case when o_orderkey % 5 = 4 then eff end as canceldate,
  case o_orderkey % 4 when 0 then null when 1 then 2 else 1 end as deliverytype,
  28.6e0 + (o_orderkey * 11 % 500) / 1000e0 as restaurantloc_lon,
  40.9e0 + (o_orderkey * 13 % 500) / 2000e0 as restaurantloc_lat,
  28.5e0 + (o_custkey % 1000) / 1000e0 as deliveryaddress_location__coordinates_lon,
  40.8e0 + (o_custkey * 7 % 1000) / 2000e0 as deliveryaddress_location__coordinates_lat
from base_orders""",
    "artisan_orders": "select * from food_orders",
    "courier_tasks": """
select concat(l_orderkey, '-', l_linenumber, '-', l_suppkey, '-', cast(cast(l_shipdate as date) as {S})) as task_id,
  cast(l_orderkey as {S}) as orderid_oid, concat('G', cast(floor(l_orderkey / 4) as bigint)) as taskgroupid_oid,
  l_linenumber as sequence, case when l_returnflag = 'N' then 'Pickup' else 'Delivery' end as type,
  case when l_linestatus = 'F' then 'COMPLETED' when l_linenumber % 3 = 0 then 'ASSIGNED' else 'CANCELLED' end as status
from lineitem""",
    "courier_status_logs": """
select cast(event_id as {S}) as _id_oid,
  case when event_type in ('view', 'purchase') then cast(event_id as {S}) end as marketorder_oid,
  {addd:ts|-9496} as createdat, {adds:{addd:ts|-9496}|10800} as createdatl,
  concat('W', user_id % (select count(*) from supplier)) as warehouse_oid, concat('C', user_id % (4 * (select count(*) from supplier))) as courier_oid,
  concat('F', user_id % 3) as currentmarketemployer_franchise_oid,
  case event_type when 'error' then 'refill' when 'click' then 'busy' end as data_reason_oid,
  concat('V', user_id % (2 * (select count(*) from supplier))) as data_plate,
  case when event_type = 'signup' then 4100 when event_id % 5 = 0 then 300 else 200 end as newstatus,
  case when event_id % 2 = 0 then 900 else 400 end as oldstatus,
  28.5e0 + value / 1000e0 as location__coordinates_lon, 40.8e0 + value / 2000e0 as location__coordinates_lat
from events""",
    "leg_distances": """
select cast(o_orderkey as {S}) as _id_oid, cast(o_orderkey % 3 + 1 as int) as step,
  case when o_orderkey % 4 = 0 then null else (o_orderkey % 250) / 10e0 end as distance,
  case when o_orderkey % 9 = 0 then 'predicted' when o_orderkey % 5 = 0 then 'gps' else 'osrm' end as distance_type
from orders where o_orderkey % 3 <> 1""",
    "food_distances": """
select cast(o_orderkey as {S}) as _id_oid, (o_orderkey % 70) / 10e0 as store_to_rest,
  case when o_orderkey % 4 = 1 then null else (o_orderkey % 90) / 10e0 end as rest_to_client,
  (o_orderkey % 110) / 10e0 as client_to_store, 'osrm' as distance_type
from orders where o_orderkey % 3 <> 1""",
    "artisan_distances": "select * from food_distances",
    "orders_distances": """
select cast(o_orderkey as {S}) as _id_oid, 1 as step,
  case when o_orderkey % 11 = 0 or o_orderkey % 2 = 1 then null else (o_orderkey % 300) / 10e0 end as corrected_distance
from orders""",
    # 3001 routes of 0 to 8 points, one of 300; times may be missing, fewer or more than the points.
    "route_shapes": """
select shape, cast(case when shape = 5 then 300 else shape % 9 end as int) as n_points,
  cast(case shape % 5 when 0 then 0 when 1 then shape % 9 + 1 when 2 then shape % 4 else shape % 9 end as int) as n_times
from (select distinct o_orderkey % 3001 as shape from orders) as s""",
    "route_texts": f"""
select shape, concat(case when n_points = 0 then '' else {{glue:n_points|concat({number_text(STEPS["lat"])}, {number_text(STEPS["lon"])})}} end,
    case when shape % 10 = 3 then 'A' else '' end) as encoded_latlons,
  case when n_times = 0 then '' else {{semi:n_times|case when (shape + i) % 13 = 0 then '' else
    concat(case when i > 1 and shape % 19 = 4 then '-' else '' end, {{b36:(i - 1) * (shape % 50 + 1) * 20|36}}) end}} end as encoded_time
from route_shapes""",
    "routes_market": """
select cast(o_orderkey as {S}) as _id_oid, encoded_latlons, encoded_time, eff as start_time, eff as checkout_date_l,
  concat('W', job % places) as warehouse
from base_orders join route_texts on o_orderkey % 3001 = shape""",
    "fleet_vehicle_km_logs": """
select cast(l_orderkey as {S}) as order_id, concat('C', l_suppkey % (4 * (select count(*) from supplier))) as courier_id,
  cast(l_shipdate as date) as date_l, case l_linenumber % 3 when 0 then 1 when 1 then 2 else 6 end as order_domain,
  l_linenumber as step, case when l_returnflag = 'A' then null else l_quantity / 10 end as osrm, l_quantity / 8 as km
from lineitem""",
    # Targets and landing data, also drawn from the test tables.
    "refill_distances": """
select concat('W', user_id % (select count(*) from supplier)) as warehouse_id, {adds:{addd:ts|-9496}|10800} as createdatl,
  concat('C', user_id % (4 * (select count(*) from supplier))) as courier_id, concat('F', user_id % 3) as courier_franchise_id,
  value / 10e0 as refill_distance, 'osrm' as distance_type, cast(event_id as {S}) as log_id, 'refill' as type
from events""",
    "route_points": """
select cast(l_orderkey as {S}) as _id_oid, {adds:eff|l_linenumber * 60} as time,
  28.5e0 + (l_partkey % 1000) / 1000e0 as lon, 40.8e0 + (l_suppkey % 1000) / 2000e0 as lat
from lineitem join base_orders on l_orderkey = o_orderkey""",
    "partner_rows": """
select cast(l_orderkey as {S}) as order_id, l_linenumber as step,
  case when l_returnflag = 'R' then l_quantity * 250000e0 else l_quantity * 200e0 end as distance,
  cast(case l_suppkey % 5 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4 else 6 end as int) as domain_type,
  eff as start_time, {adds:eff|3600} as processed_time
from lineitem join base_orders on l_orderkey = o_orderkey""",
    "raw_loads": """
select cast(floor(o_orderkey / 500) as bigint) as query, cast(o_orderkey % 500 as int) as line_number,
  concat(o_orderkey, ',', case when o_orderkey % 7 = 3 then 'one' else cast(o_orderkey % 5 as {S}) end, ',',
    case when o_orderkey % 11 = 5 then 'n/a' else cast(o_orderkey % 100 as {S}) end,
    case when o_orderkey % 13 = 8 then ',extra' else '' end) as raw_line
from orders""",
    "loads": """
select query, {adds:cast('1998-01-01 00:00:00' as {N})|query * 60} as starttime
from (select distinct cast(floor(o_orderkey / 500) as bigint) as query from orders) as all_loads""",
}

_SOURCE_TABLES = ("orders", "lineitem", "events", "supplier")
_DIALECTS = {
    "spark": {
        "S": "string",
        "N": "timestamp_ntz",
        "adds": lambda t, n: f"timestampadd(SECOND, cast({n} as int), {t})",
        "addd": lambda t, n: f"timestampadd(DAY, {n}, {t})",
        "glue": lambda n, x: f"array_join(transform(sequence(1, {n}), i -> {x}), '')",
        "semi": lambda n, x: f"array_join(transform(sequence(1, {n}), i -> {x}), ';')",
        "b36": lambda x, base: f"lower(conv({x}, 10, {base}))",
    },
    "duckdb": {
        "S": "varchar",
        "N": "timestamp",
        "adds": lambda t, n: f"({t} + to_seconds({n}))",
        "addd": lambda t, n: f"({t} + to_days({n}))",
        "glue": lambda n, x: f"array_to_string([{x} for i in range(1, {n} + 1)], '')",
        "semi": lambda n, x: f"array_to_string([{x} for i in range(1, {n} + 1)], ';')",
        "b36": lambda x, base: f"lower(to_base({x}, {base}))",
    },
}


def render(name: str, dialect: str) -> str:
    """The SQL of a view in the given dialect."""
    words = _DIALECTS[dialect]
    text = VIEWS[name].strip()
    text = text.replace("{S}", words["S"]).replace("{N}", words["N"])
    inner = re.compile(r"\{(adds|addd|glue|semi|b36):([^{}|]+)\|([^{}|]+)\}")
    while True:
        changed = inner.sub(lambda m: words[m.group(1)](m.group(2), m.group(3)), text)
        if changed == text:
            return text
        text = changed


def parents(name: str) -> list[str]:
    """Views and test tables that a view reads."""
    return re.findall(r"(?:from|join)\s+([a-z_]+)", VIEWS[name])


class StandIns:
    """Frames of the views over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in _SOURCE_TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            else:
                sources = {parent: self.frame(parent) for parent in parents(name)}
                text = render(name, "spark")
                for parent in sources:
                    text = re.sub(rf"\b(from|join)\s+{parent}\b", rf"\1 {{{parent}}}", text)
                self._frames[name] = self.spark.sql(text, **sources)
        return self._frames[name]

    @cached_property
    def tables(self) -> Tables:
        return Tables(self.frame)
