"""The partner's landing folder, taken in file by file.

A ledger knows the files that have been taken in, so a run opens only those that are new or have changed. Their rows go to
a feed table by processing time, from which windows are read; what cannot be read goes to a table of rejects with the
reason. The ledger is written last: a run that ends before takes the same files in again, and their rows replace themselves.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import RunWindow, as_datetime, ntz
from legmeter.functions.timing import within
from legmeter.operators import snapshots
from legmeter.session import materialise
from legmeter.sources.landing import CORRUPT, _feed_rows, _moment
from legmeter.sources.tables import FEED_LAYOUT

_S, _L, _N = T.StringType(), T.LongType(), T.TimestampNTZType()


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# Fixed layouts of the three tables.
STORED_LAYOUT = T.StructType([*FEED_LAYOUT.fields, T.StructField("file", _S)])
REJECT_LAYOUT = _layout(("file", _S), ("raw", _S), ("reason", _S), ("seen_at", _N))
LEDGER_LAYOUT = _layout(("modified", _N), ("file", _S), ("size", _L), ("rows", _L), ("rejected", _L), ("taken_at", _N))
#: Files that turn up this much later than their time of writing says are still seen.
LATE = timedelta(days=2)


@dataclass(frozen=True)
class Intake:
    """What one intake took in."""

    files: int
    rows: int
    rejected: int


def _new_files(spark: SparkSession, folder: str, ledger: str, late: timedelta) -> DataFrame:
    """``file, modified, size`` of the files that the ledger does not know as they are.

    Only files written since shortly before the newest known one are listed, and only the ledger's slices of that time
    are read.
    """
    state = snapshots.snapshot(spark, ledger)
    newest = max((s.most for s in state.slices), default=None)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    since = "0000"
    if newest:
        bound = as_datetime(newest) - late
        since = bound.isoformat(sep=" ", timespec="seconds")
        files = files.option("modifiedAfter", bound.strftime("%Y-%m-%dT%H:%M:%S"))
    modified = F.convert_timezone(None, F.lit("UTC"), F.col("modificationTime").cast("timestamp")).cast("timestamp_ntz")
    listed = files.load(folder).select(F.col("path").alias("file"), modified.alias("modified"), F.col("length").alias("size"))
    known = snapshots.read_between(spark, ledger, LEDGER_LAYOUT, since, "9999").select("file", "modified", "size")
    return listed.join(known, ["file", "modified", "size"], "left_anti")


def take_in(spark: SparkSession, folder: str, store: str, now: datetime | str, late: timedelta = LATE) -> Intake:
    """Take the new files of ``folder`` into the tables under ``store``."""
    base = store.rstrip("/")
    fresh = materialise(_new_files(spark, folder, f"{base}/files", late), "files")
    paths = [row["file"] for row in fresh.select("file").collect()]  # a row a new file
    if not paths:
        return Intake(0, 0, 0)
    schema = T.StructType([*FEED_LAYOUT.fields, T.StructField(CORRUPT, _S)])
    read = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    parsed = materialise(read.select("*", F.col("_metadata.file_path").alias("file")), "feed")
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), F.when(F.get_json_object(CORRUPT, "$").isNull(), "no JSON").otherwise("a field of another type"))
        .when(F.col("order_id").isNull(), "no order")
        .when(F.col("start_time").isNull() | F.col("processed_time").isNull(), "no time")
    )
    judged = parsed.withColumn("reason", reason)
    raw = F.coalesce(CORRUPT, F.to_json(F.struct(*FEED_LAYOUT.names)))
    rejects = judged.where("reason is not null").select("file", raw.alias("raw"), "reason", ntz(now).alias("seen_at"))
    accepted = judged.where("reason is null").select(*STORED_LAYOUT.names)
    ledger = snapshots.read(spark, f"{base}/files", LEDGER_LAYOUT).select("file")
    changed = materialise(ledger.join(fresh.select("file"), "file", "left_semi").distinct(), "changed")
    if not changed.isEmpty():
        # What the file held before goes, and so does its old entry.
        snapshots.expire(spark, f"{base}/feed", changed, STORED_LAYOUT, "file", sort_key="processed_time")
        snapshots.expire(spark, f"{base}/files", changed, LEDGER_LAYOUT, "file", sort_key="modified")
        snapshots.expire(spark, f"{base}/rejects", changed, REJECT_LAYOUT, "file")
    snapshots.merge(spark, f"{base}/feed", accepted, ["processed_time", "file"], STORED_LAYOUT, "processed_time")
    snapshots.merge(spark, f"{base}/rejects", rejects, ["file"], REJECT_LAYOUT, "file")
    counts = judged.groupBy("file").agg(F.count_if(F.col("reason").isNull()).alias("rows"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    entries = fresh.join(counts, "file", "left").na.fill(0, ["rows", "rejected"]).withColumn("taken_at", ntz(now))
    entries = materialise(entries, "entries")
    snapshots.merge(spark, f"{base}/files", entries, ["modified", "file"], LEDGER_LAYOUT, "modified")
    total = entries.agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).first()
    return Intake(total["files"], total["rows"], total["rejected"])


def read_feed(
    spark: SparkSession, store: str, window: RunWindow, updated_at, label: str = "partner", period: str = "hourly", repair: bool = True
) -> DataFrame:
    """The taken-in rows of a window, as ``read_partner_feed`` gives those of a folder; hourly runs open its slices only."""
    path = f"{store.rstrip('/')}/feed"
    if period == "daily":
        stored = snapshots.read(spark, path, STORED_LAYOUT)
    else:
        low, high = (as_datetime(t).isoformat(sep=" ") for t in (window.start, window.end))
        stored = snapshots.read_between(spark, path, STORED_LAYOUT, low, high)
    return _feed_rows(stored.filter(within(F.col(_moment(period)), window)), updated_at, label, repair)
