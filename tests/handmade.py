"""Hand-made rows for the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"1998-01-{text}")


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("_id_oid", T.StringType()),
        T.StructField("warehouse_warehouse_oid", T.StringType()),
        T.StructField("courier_courier_oid", T.StringType()),
        T.StructField("courier_fleetvehicle_oid", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("domaintype", T.IntegerType()),
        T.StructField("deliver_date", T.TimestampNTZType()),
        T.StructField("cancel_date", T.TimestampNTZType()),
        T.StructField("delivery_batch_isbatched", T.BooleanType()),
        T.StructField("delivery_batch_index", T.IntegerType()),
        T.StructField("delivery_job_oid", T.StringType()),
        T.StructField("delivery_address_location__coordinates_lon", T.DoubleType()),
        T.StructField("delivery_address_location__coordinates_lat", T.DoubleType()),
        T.StructField("warehouse_location__coordinates_lon", T.DoubleType()),
        T.StructField("warehouse_location__coordinates_lat", T.DoubleType()),
    ]
)


def order(oid, delivered=None, cancelled=None, warehouse="W0", courier="C0", vehicle="V0", status=900, domain=1,
          batched=None, index=None, job=None, lon=0.0, lat=0.0):
    return (
        oid, warehouse, courier, vehicle, status, domain, delivered and at(delivered), cancelled and at(cancelled),
        batched, index, job, lon, lat, 28.5, 40.8,
    )


ZONES = [("W0", "Europe/Istanbul"), ("W1", "Asia/Tokyo")]
EVENT_SCHEMA = (
    "_id_oid string, marketorder_oid string, createdat timestamp_ntz, createdatl timestamp_ntz, warehouse_oid string, "
    "courier_oid string, currentmarketemployer_franchise_oid string, data_reason_oid string, data_plate string, "
    "newstatus int, oldstatus int, location__coordinates_lon double, location__coordinates_lat double"
)


def event(eid, when, marketorder=None, reason=None, new=200, old=400, warehouse="W0", courier="C0", local=None):
    return (eid, marketorder, at(when), at(local or when), warehouse, courier, "F0", reason, "V0", new, old, 28.6, 40.9)
