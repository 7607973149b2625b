"""Result tables as snapshots: immutable data folders and one committed list of them.

A table is cut into slices of its key. A run writes the slices that it changes into a new folder and then publishes a
list of all slices as the next version. Readers take the newest complete list, so that they see the old table or the new
one and nothing between, whenever a run ends. Slices are cut again as they grow, so that plain ids need no fixed
number of folders.

``<table>/data/<version>-<id>/``  parquet folders, never written twice
``<table>/versions/<version>.json``  slices of a version: lower bound, least and greatest key, rows, folders
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.operators.upsert import upsert
from legmeter.session import materialise
from legmeter.sources.tables import conform

#: Rows of a slice; larger ones are cut, small neighbours that a run rewrites are joined.
SLICE_ROWS = 5_000_000
#: Slices of a table from which on slices become larger, up to ``SLICE_ROWS``: plans, lists and shuffles grow with them.
MOST_SLICES = 256
#: Rows that a task sorts and writes, and tasks from which on it takes more, up to a slice.
TASK_ROWS, MOST_TASKS = 500_000, 2_000
#: Versions that ``vacuum`` leaves readable.
KEPT_VERSIONS = 3
_AT, _SLICE, _PIECE = "_at", "_slice", "_piece"


@dataclass(frozen=True)
class Slice:
    """Rows whose key is not below ``low`` nor reaches the next slice's; ``least`` and ``most`` are keys it holds."""

    low: str
    least: str
    most: str
    rows: int
    folders: tuple[str, ...]


@dataclass(frozen=True)
class Snapshot:
    """A version of a table; ``notes`` are published with it."""

    version: int = 0
    slices: tuple[Slice, ...] = ()
    notes: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(s.rows for s in self.slices)


class Conflict(RuntimeError):
    """Another run has published this version meanwhile; the table holds that run's rows, not this one's."""


def order_text(key: Column) -> Column:
    """The key as text whose order is that of slices: whole numbers by value, nulls first."""
    text = key.cast("string")
    return F.coalesce(F.when(text.rlike("^[0-9]{1,19}$"), F.concat(F.lit("#"), F.lpad(text, 19, "0"))).otherwise(text), F.lit(""))


def _texts(values: list[str]) -> Column:
    """One constant, however many values there are."""
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def slice_of(at: Column, lows: list[str]) -> Column:
    """Number of the slice that holds a key: a binary search over the lower bounds."""
    if len(lows) < 2:
        return F.lit(0)
    bounds = _texts(lows)
    steps = [1 << k for k in reversed(range((len(lows) - 1).bit_length()))]
    # Beyond the last bound there is null, which no key reaches.
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda found, step: F.when(F.get(bounds, found + step) <= at, found + step).otherwise(found))


def cut_rows(slice_rows: int, rows: int) -> int:
    """Rows of a slice in a table of ``rows``: ``slice_rows``, or more in a table that would have too many slices."""
    return max(slice_rows, min(SLICE_ROWS, -(-rows // MOST_SLICES)))


def task_count(slice_rows: int, rows: int) -> int:
    """Tasks that write ``rows``: none sorts more than a slice, and large slices are shared among tasks."""
    return max(1, -(-rows // min(slice_rows, max(TASK_ROWS, -(-rows // MOST_TASKS)))))


# --- versions


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> list[int]:
    files, place = _files(spark, f"{path}/versions")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a version of the table has been published at ``path``."""
    return bool(_versions(spark, path.rstrip("/")))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest version of the table, or the one asked for; a table that has none is empty."""
    base = path.rstrip("/")
    known = _versions(spark, base)
    if version is None and not known:
        return Snapshot()
    wanted = known[-1] if version is None else version
    if wanted not in known:
        raise LookupError(f"version {version} of {path} is not there")
    files, place = _files(spark, f"{base}/versions/{wanted:012}.json")
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(files.open(place), "UTF-8")
    found = json.loads(text)
    slices = tuple(Slice(**{**s, "folders": tuple(s["folders"])}) for s in found["slices"])
    return Snapshot(found["version"], slices, found["notes"])


def _publish(spark: SparkSession, path: str, new: Snapshot) -> None:
    """Make ``new`` the newest version in one step: a whole file under another name, renamed to one that is free."""
    jvm = spark.sparkContext._jvm
    draft = f"{path}/versions/.draft-{uuid.uuid4().hex}"
    files, place = _files(spark, draft)
    stream = files.create(place, True)
    try:
        stream.write(json.dumps(asdict(new)).encode())
    finally:
        stream.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{new.version:012}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Without the option to overwrite, the rename fails if the name has been taken.
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(place), context.makeQualified(final), options)
    except Exception as error:
        if new.version in _versions(spark, path):
            raise Conflict(f"version {new.version} of {path}") from error
        raise


def vacuum(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Delete old versions and the data folders that no kept version names; the number of folders deleted.

    Folders of versions that have not been published yet belong to a run that may still be writing and stay.
    """
    base = path.rstrip("/")
    known = _versions(spark, base)
    kept, gone = known[-keep:], known[:-keep]
    if not kept:
        return 0
    for version in gone:
        _delete(spark, f"{base}/versions/{version:012}.json")
    used = {f.split("/")[0] for version in kept for s in snapshot(spark, base, version).slices for f in s.folders}
    files, place = _files(spark, f"{base}/data")
    names = [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
    stale = [n for n in names if n not in used and int(n.split("-")[0]) <= kept[-1]]
    for name in stale:
        _delete(spark, f"{base}/data/{name}")
    return len(stale)


def _delete(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


# --- reading


def _rows(spark: SparkSession, path: str, layout: T.StructType, slices: Iterable[Slice]) -> DataFrame:
    folders = [f"{path}/data/{name}" for s in slices for name in s.folders]
    return spark.read.schema(layout).parquet(*folders) if folders else spark.createDataFrame([], layout)


def read(spark: SparkSession, path: str, layout: T.StructType, version: int | None = None) -> DataFrame:
    """All rows of the newest version, or of an earlier one that is still there."""
    base = path.rstrip("/")
    return _rows(spark, base, layout, snapshot(spark, base, version).slices)


def _reached(state: Snapshot, keys: DataFrame) -> list[int]:
    """Numbers of the slices whose range of keys holds any of ``keys`` (column ``_at``): at most one row a slice is read."""
    least, most = _texts([s.least for s in state.slices]), _texts([s.most for s in state.slices])

    def inside(number: Column) -> Column:
        return F.when((F.col(_AT) >= F.get(least, number)) & (F.col(_AT) <= F.get(most, number)), number)

    # One expression, and no filter on it: each key is looked up once.
    number = F.get(F.transform(F.array(slice_of(F.col(_AT), [s.low for s in state.slices])), inside), 0)
    return sorted(row[0] for row in keys.select(number.alias(_SLICE)).distinct().collect() if row[0] is not None)


def read_near(spark: SparkSession, path: str, layout: T.StructType, ids: DataFrame, key: str) -> DataFrame:
    """The rows of the slices that can hold one of ``ids``: the others are not opened."""
    base = path.rstrip("/")
    state = snapshot(spark, base)
    if not state.slices:
        return _rows(spark, base, layout, ())
    return _rows(spark, base, layout, [state.slices[i] for i in _reached(state, ids.select(order_text(F.col(key)).alias(_AT)))])


def read_between(spark: SparkSession, path: str, layout: T.StructType, low: str, high: str) -> DataFrame:
    """The rows of the slices that can hold a key from ``low`` to ``high``, as ``order_text`` spells them."""
    base = path.rstrip("/")
    return _rows(spark, base, layout, [s for s in snapshot(spark, base).slices if s.least <= high and low <= s.most])


def difference(spark: SparkSession, path: str, layout: T.StructType, before: int, after: int) -> DataFrame:
    """Rows with ``sign``: 1 for those of folders that only ``after`` has, -1 for those that only ``before`` has.

    Version 0 is the empty table. A row of a slice that was written anew unchanged is there with both signs, so sums over
    ``sign`` tell what changed, and only the changed slices are read.
    """
    base = path.rstrip("/")
    old, new = (snapshot(spark, base, version).slices if version else () for version in (before, after))
    shared = {f for s in old for f in s.folders} & {f for s in new for f in s.folders}

    def only(slices: tuple[Slice, ...]) -> list[Slice]:
        return [replace(s, folders=tuple(f for f in s.folders if f not in shared)) for s in slices]

    signed = [_rows(spark, base, layout, only(slices)).withColumn("sign", F.lit(sign)) for slices, sign in ((new, 1), (old, -1))]
    return signed[0].unionByName(signed[1])


# --- writing


def merge(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], layout: T.StructType, sort_key: str,
    slice_rows: int = SLICE_ROWS, notes: dict | None = None, anew: bool = False, added: Iterable[str] = (),
) -> Snapshot:
    """Publish the table with the rows of ``batch`` in place of those that share their ``keys``.

    Only slices that ``batch`` has a key in are read and written anew; ``sort_key`` is one of ``keys``. ``notes`` replace
    those of the version before. With ``anew`` the batch is the whole table. With ``added``, all columns but the keys, a row
    of the batch adds its numbers to those of the row with its keys, null keys too, instead of replacing it.
    """
    base = path.rstrip("/")
    state = snapshot(spark, base)
    known = state.notes if notes is None else notes
    state = replace(state, notes=known, slices=() if anew else state.slices)
    lows = [s.low for s in state.slices]
    staged = materialise(_placed(conform(batch, layout), sort_key, lows), "batch")
    fresh = {row[_SLICE]: row["count"] for row in staged.groupBy(_SLICE).count().collect()}  # a row a slice
    if not fresh:
        if notes is not None or anew:
            state = replace(state, version=state.version + 1)
            _publish(spark, base, state)
        return state
    old = [state.slices[i] for i in sorted(fresh) if i < len(state.slices)]
    current = _placed(_rows(spark, base, layout, old), sort_key, lows)
    # The slice follows from the sort key. Nothing is looked for in a table that has no rows there.
    merged = upsert(current, staged, keys) if old and not added else current.unionByName(staged) if old else staged
    most_rows = sum(s.rows for s in old) + sum(fresh.values())
    return _rewrite(spark, base, state, merged, sort_key, sorted(fresh), most_rows, slice_rows, keys if old and added else ())


def expire(
    spark: SparkSession, path: str, expired: DataFrame, layout: T.StructType, key: str = "_id_oid", slice_rows: int = SLICE_ROWS,
    sort_key: str | None = None,
) -> Snapshot:
    """Publish the table without the rows of the ``expired`` keys.

    Most expired keys left long ago: slices whose range holds none of them are not opened, and of the others only the key
    column is read to find those to write anew. If the table is sorted by another column (``sort_key``), the key column of
    all slices is read.
    """
    base = path.rstrip("/")
    state = snapshot(spark, base)
    if not state.slices:
        return state
    lows = [s.low for s in state.slices]
    sorted_by = sort_key or key
    gone = materialise(expired.select(key).distinct(), "gone")
    near = range(len(state.slices)) if sorted_by != key else _reached(state, gone.select(order_text(F.col(key)).alias(_AT)))
    held = _placed(_rows(spark, base, layout, [state.slices[i] for i in near]), sorted_by, lows).join(gone, key, "left_semi")
    touched = sorted(row[0] for row in held.select(_SLICE).distinct().collect())
    if not touched:
        return state
    old = [state.slices[i] for i in touched]
    kept = _placed(_rows(spark, base, layout, old), sorted_by, lows).join(gone, key, "left_anti")
    return _rewrite(spark, base, state, kept.select(*layout.names, _SLICE), sorted_by, touched, sum(s.rows for s in old), slice_rows)


def _placed(rows: DataFrame, sort_key: str, lows: list[str]) -> DataFrame:
    return rows.withColumn(_SLICE, slice_of(order_text(F.col(sort_key)), lows))


def _rewrite(
    spark: SparkSession, base: str, state: Snapshot, rows: DataFrame, sort_key: str, touched: list[int], most_rows: int, slice_rows: int,
    summed_by: Iterable[str] = (),
) -> Snapshot:
    """Write ``rows`` as the new content of the ``touched`` slices and publish the version.

    With ``summed_by``, a key that has ``sort_key``, rows that share it become one with the sums of their other columns.
    """
    version = state.version + 1
    slice_rows = cut_rows(slice_rows, most_rows + sum(s.rows for i, s in enumerate(state.slices) if i not in touched))
    folder = f"{version:012}-{uuid.uuid4().hex[:8]}"
    at, tasks = order_text(F.col(sort_key)), task_count(slice_rows, most_rows)
    if summed_by:
        # Ranges of the whole key hold all rows of a key, so that the sums need no shuffle of their own.
        ranged = rows.withColumn(_AT, at).repartitionByRange(tasks, _AT, *summed_by)
        sums = [F.sum(name).alias(name) for name in rows.columns if name not in (*summed_by, _SLICE)]
        ranged = ranged.groupBy(_AT, _SLICE, *summed_by).agg(*sums).select(*rows.columns, _AT)
    else:
        # Ranges of the key; a salt lets a key that fills a slice alone span several tasks. Neither the text of the key
        # nor the salt is moved: they are worked out from the row where they are needed.
        salt = F.xxhash64(*(name for name in rows.columns if name != _SLICE))
        ranged = rows.repartitionByRange(tasks, at, salt).withColumn(_AT, at)
    (
        ranged.withColumn(_PIECE, F.spark_partition_id())
        .sortWithinPartitions(_SLICE, _PIECE, _AT)
        .drop(_AT)
        .write.partitionBy(_SLICE, _PIECE)
        .parquet(f"{base}/data/{folder}")
    )
    full = T.StructType([rows.schema[sort_key], T.StructField(_SLICE, T.IntegerType()), T.StructField(_PIECE, T.IntegerType())])
    pieces = spark.read.schema(full).parquet(f"{base}/data/{folder}").select(at.alias(_AT), _SLICE, _PIECE).groupBy(_SLICE, _PIECE)
    found = pieces.agg(F.min(_AT).alias("least"), F.max(_AT).alias("most"), F.count(F.lit(1)).alias("rows"))
    written: dict[int, list[Slice]] = {i: [] for i in touched}
    for row in sorted(found.collect(), key=lambda r: (r[_SLICE], r[_PIECE])):  # a row a piece
        name = f"{folder}/{_SLICE}={row[_SLICE]}/{_PIECE}={row[_PIECE]}"
        written[row[_SLICE]].append(Slice(row["least"], row["least"], row["most"], row["rows"], (name,)))
    new = Snapshot(version, _arranged(state, written, slice_rows), state.notes)
    _publish(spark, base, new)
    return new


def _arranged(state: Snapshot, written: dict[int, list[Slice]], slice_rows: int) -> tuple[Slice, ...]:
    """The slices of the next version in order: untouched ones as they were, written pieces cut or joined."""
    found: list[Slice] = []
    joinable = False
    for number in range(max(len(state.slices), max(written) + 1)):
        if number not in written:
            found.append(state.slices[number])
            joinable = False
            continue
        for piece in written[number]:
            last = found[-1] if found else None
            # Pieces that share a key are one slice whatever their size.
            if joinable and (last.most == piece.least or last.rows + piece.rows <= slice_rows):
                found[-1] = Slice(last.low, last.least, piece.most, last.rows + piece.rows, last.folders + piece.folders)
            else:
                found.append(piece)
            joinable = True
    if found:
        found[0] = Slice("", *list(asdict(found[0]).values())[1:])
    return tuple(found)
