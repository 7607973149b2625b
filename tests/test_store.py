"""Keyed merge, retention, stage files, feed and load errors."""

from __future__ import annotations

from datetime import datetime

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import RunWindow
from legmeter.functions.text import title_case_columns
from legmeter.operators import snapshots
from legmeter.operators.snapshots import order_text, slice_of
from legmeter.operators.upsert import LEG_KEYS, REFILL_KEYS, expired_routes, retain, upsert
from legmeter.sources.landing import feed_window, load_error_report, read_partner_feed, split_lines
from legmeter.sources.tables import LEG_LAYOUT, POINT_LAYOUT, REFILL_LAYOUT, conform
from legmeter.sources.templates import run_sql, run_sql_file

def legs(spark, rows):
    return conform(spark.createDataFrame(rows, "_id_oid string, distance_type string, step int, distance double"), LEG_LAYOUT)


def plain_rows(df):
    return sorted((r["_id_oid"], r["distance_type"], r["step"], r["distance"]) for r in df.collect())


def test_upsert_replaces_by_key_and_keeps_the_whole_batch(spark):
    target = legs(spark, [("a", "osrm", 1, 1.0), ("a", "osrm", -1, 1.5), ("a", "gps", 1, 2.0), ("b", "osrm", 1, 3.0), (None, "osrm", 1, 4.0)])
    batch = legs(spark, [("a", "osrm", 1, 9.0), ("a", "osrm", 2, 9.5), ("c", "osrm", 1, 8.0), (None, "osrm", 2, 7.0)])
    once = upsert(target, batch, LEG_KEYS)
    assert sorted(plain_rows(once.na.fill("-", ["_id_oid"]))) == [
        ("-", "osrm", 1, 4.0), ("-", "osrm", 2, 7.0), ("a", "gps", 1, 2.0), ("a", "osrm", 1, 9.0), ("a", "osrm", 2, 9.5),
        ("b", "osrm", 1, 3.0), ("c", "osrm", 1, 8.0),
    ]
    keyed = batch.filter("_id_oid is not null")
    assert spark_rows(upsert(upsert(target, keyed, LEG_KEYS), keyed, LEG_KEYS)) == spark_rows(upsert(target, keyed, LEG_KEYS))


def test_retention_keeps_exactly_the_complement(spark):
    routes = spark.createDataFrame(
        [("old", datetime(1998, 1, 9, 23, 59), "W1"), ("edge", datetime(1998, 1, 10), "W1"), ("other", datetime(1998, 1, 1), "W2")],
        "_id_oid string, checkout_date_l timestamp_ntz, warehouse string",
    )
    points = spark.createDataFrame([(i, 1.0) for i in ("old", "old", "edge", "other", "none")], "_id_oid string, lon double")
    start = "1998-02-10"
    assert sorted(r[0] for r in retain(points, expired_routes(routes, start)).collect()) == ["edge", "none"]
    kept = retain(points, expired_routes(routes, start, ("W1",)))
    assert sorted(r[0] for r in kept.collect()) == ["edge", "none", "other"]


def test_slices_are_found_by_binary_search(spark):
    lows = ["", "#" + "5".zfill(19), "#" + "40".zfill(19), "a", "b"]
    keys = [None, "", "0", "4", "5", "39", "40", "400", "Z", "a", "abc", "b", "zz"]
    frame = spark.createDataFrame([(k,) for k in keys], "k string").select("k", order_text(F.col("k")).alias("at"))
    for count in range(1, len(lows) + 1):
        for row in frame.select("at", slice_of(F.col("at"), lows[:count]).alias("found")).collect():
            assert row.found == max(i for i, low in enumerate(lows[:count]) if low <= row["at"])


def numbered(spark, ids, distance=1.0):
    return legs(spark, [(str(i), "osrm", 1, distance) for i in ids])


def test_plain_ids_touch_only_their_slices(spark, tmp_path):
    path = str(tmp_path / "legs")
    merge = lambda rows: snapshots.merge(spark, path, rows, LEG_KEYS, LEG_LAYOUT, "_id_oid", 100)
    assert snapshots.read(spark, path, LEG_LAYOUT).count() == 0
    first = numbered(spark, range(1000))
    state = merge(first)
    assert len(state.slices) >= 8 and state.rows == 1000 and state.slices[0].low == ""
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "legs" / "data").rglob("*.parquet")}
    batch = legs(spark, [("500", "osrm", 1, 20.0), ("500", "osrm", -1, 21.0), ("505", "gps", 1, 5.0)])
    for version in (2, 3):
        after = merge(batch)
        assert after.version == version
        assert spark_rows(snapshots.read(spark, path, LEG_LAYOUT)) == spark_rows(upsert(first, batch, LEG_KEYS))
    fresh = [s for s in after.slices if s not in state.slices]
    assert len(fresh) <= 3 and all("#" + "300".zfill(19) < s.least and s.most < "#" + "700".zfill(19) for s in fresh)
    assert all(f.stat().st_mtime_ns == at for f, at in files.items())
    assert spark_rows(snapshots.read(spark, path, LEG_LAYOUT, 1)) == spark_rows(first)


def test_slices_split_as_they_grow_and_small_ones_join(spark, tmp_path):
    path = str(tmp_path / "legs")
    for low in range(0, 600, 60):
        state = snapshots.merge(spark, path, numbered(spark, range(low, low + 60)), LEG_KEYS, LEG_LAYOUT, "_id_oid", 100)
    assert state.rows == 600 and 6 <= len(state.slices) <= 14
    lows = [s.low for s in state.slices]
    assert lows == sorted(set(lows)) and all(s.low <= s.least <= s.most for s in state.slices)
    whole = snapshots.merge(spark, path, numbered(spark, range(600), 2.0), LEG_KEYS, LEG_LAYOUT, "_id_oid", 1000)
    assert len(whole.slices) == 1 and {r.distance for r in snapshots.read(spark, path, LEG_LAYOUT).collect()} == {2.0}


def test_a_key_larger_than_a_slice_stays_one_slice(spark, tmp_path):
    path = str(tmp_path / "legs")
    rows = legs(spark, [("7", "osrm", i, 1.0) for i in range(300)] + [(None, "osrm", i, 1.0) for i in range(300)] + [("9", "osrm", 1, 1.0)])
    state = snapshots.merge(spark, path, rows, LEG_KEYS, LEG_LAYOUT, "_id_oid", 50)
    assert state.rows == 601 and sum(s.least <= "#" + "7".zfill(19) <= s.most for s in state.slices) == 1
    assert max(len(s.folders) for s in state.slices) > 1  # written by several tasks
    state = snapshots.merge(spark, path, legs(spark, [("7", "osrm", 1, 2.0)]), LEG_KEYS, LEG_LAYOUT, "_id_oid", 50)
    assert state.rows == 302


class Killed(Exception):
    pass


@pytest.mark.parametrize(
    "step,moment", [("materialise", "after"), ("_rewrite", "before"), ("_publish", "before"), ("_publish", "after"), ("vacuum", "before"), ("_delete", "before")]
)
def test_a_killed_run_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, moment):
    path = str(tmp_path / "legs")
    old, batch = numbered(spark, range(300)), numbered(spark, range(100, 120), 9.0)
    new = upsert(old, batch, LEG_KEYS)

    def store(rows):
        snapshots.merge(spark, path, rows, LEG_KEYS, LEG_LAYOUT, "_id_oid", 100)
        snapshots.vacuum(spark, path, keep=1)

    store(old)
    works = getattr(snapshots, step)

    def killed(*args, **kw):
        if moment == "after":
            works(*args, **kw)
        raise Killed

    monkeypatch.setattr(snapshots, step, killed)
    with pytest.raises(Killed):
        store(batch)
    monkeypatch.undo()
    found = spark_rows(snapshots.read(spark, path, LEG_LAYOUT))
    published = (step, moment) == ("_publish", "after") or step in ("vacuum", "_delete")
    assert found == spark_rows(new if published else old)
    store(batch)
    assert spark_rows(snapshots.read(spark, path, LEG_LAYOUT)) == spark_rows(new)
    named = {f.split("/")[0] for s in snapshots.snapshot(spark, path).slices for f in s.folders}
    assert {p.name for p in (tmp_path / "legs" / "data").iterdir()} == named


def test_of_two_runs_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "legs")
    snapshots.merge(spark, path, numbered(spark, range(10)), LEG_KEYS, LEG_LAYOUT, "_id_oid")
    publish = snapshots._publish

    def late(*args):
        monkeypatch.undo()
        snapshots.merge(spark, path, numbered(spark, [1], 5.0), LEG_KEYS, LEG_LAYOUT, "_id_oid")
        publish(*args)

    monkeypatch.setattr(snapshots, "_publish", late)
    with pytest.raises(snapshots.Conflict):
        snapshots.merge(spark, path, numbered(spark, [2], 7.0), LEG_KEYS, LEG_LAYOUT, "_id_oid")
    assert {r.distance for r in snapshots.read(spark, path, LEG_LAYOUT).collect()} == {1.0, 5.0}
    with pytest.raises(LookupError):
        snapshots.read(spark, path, LEG_LAYOUT, 9)


def test_refills_merge_by_courier_and_time(spark, tmp_path):
    path = str(tmp_path / "refills")
    schema = "courier_id string, createdatl timestamp_ntz, refill_distance double"
    one = spark.createDataFrame([("C1", datetime(1998, 1, 1, 9), 1.0), ("C2", datetime(1998, 1, 1, 9), 2.0)], schema)
    two = spark.createDataFrame([("C1", datetime(1998, 1, 1, 9), 5.0), ("C1", datetime(1998, 1, 2, 9), 6.0)], schema)
    for batch in (one, two, two.limit(0)):
        snapshots.merge(spark, path, batch, REFILL_KEYS, REFILL_LAYOUT, "createdatl")
    stored = snapshots.read(spark, path, REFILL_LAYOUT)
    assert sorted(r.refill_distance for r in stored.collect()) == [2.0, 5.0, 6.0]


def test_expired_points_leave_and_only_their_slices_are_opened(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "points")
    rows = [(str(i), float(i)) for i in range(400) for _ in range(2)]
    points = spark.createDataFrame(rows, "_id_oid string, lon double")
    state = snapshots.merge(spark, path, points, ["_id_oid"], POINT_LAYOUT, "_id_oid", 100)
    opened = []
    whole = snapshots._rows
    monkeypatch.setattr(snapshots, "_rows", lambda s, p, layout, slices: (opened.append(list(slices)), whole(s, p, layout, opened[-1]))[1])
    # Ids below 0 and beyond the table left long ago; 3 is in the first slice, 399 in the last.
    expired = spark.createDataFrame([(i,) for i in ("-5", "3", "399", "4000", "a", None)], "_id_oid string")
    for _ in range(2):
        left = snapshots.expire(spark, path, expired, POINT_LAYOUT, slice_rows=100)
        assert left.rows == 796 and left.version == 2
    assert all(len(slices) <= 2 for slices in opened) and len(state.slices) >= 7
    monkeypatch.undo()
    assert spark_rows(snapshots.read(spark, path, POINT_LAYOUT)) == spark_rows(
        points.where("_id_oid not in ('3', '399')").select("_id_oid", F.lit(None).cast("timestamp_ntz").alias("time"), "lon", F.lit(None).cast("double").alias("lat"))
    )
    everything = snapshots.expire(spark, path, points.select("_id_oid"), POINT_LAYOUT)
    assert everything.slices == () and snapshots.read(spark, path, POINT_LAYOUT).count() == 0


def test_feed_window_lags_unless_asked_for():
    window = RunWindow("1998-01-10 10:00:00", "1998-01-10 12:34:56")
    assert feed_window("partner", window) is window
    late = feed_window("osrm", window)
    assert (late.start, late.end) == (datetime(1998, 1, 10, 4, 30), datetime(1998, 1, 10, 6))


def test_feed_units_and_period(spark, tmp_path):
    rows = [
        ("a", 1, 2500.0, 1, datetime(1998, 1, 10, 1), datetime(1998, 1, 10, 5)),
        ("b", 1, 123456789.0, 2, datetime(1998, 1, 10, 5), datetime(1998, 1, 10, 1)),
    ]
    schema = "order_id string, step int, distance double, domain_type int, start_time timestamp_ntz, processed_time timestamp_ntz"
    spark.createDataFrame(rows, schema).write.json(str(tmp_path / "feed"))
    early = RunWindow("1998-01-10", "1998-01-10 03:00:00")
    read = lambda **kw: {r.order_id: r.distance for r in read_partner_feed(spark, str(tmp_path / "feed"), early, "1998-02-01", **kw).collect()}
    assert read(period="daily") == {"a": 2.5}
    assert read(period="hourly") == {"b": 1.2346}
    assert read(period="hourly", repair=False) == {"b": 123456.789}


def test_rejected_lines_are_reported(spark):
    layout = T.StructType([T.StructField("id", T.LongType()), T.StructField("km", T.DoubleType()), T.StructField("t", T.TimestampNTZType())])
    lines = ["1,2.5,1998-01-01 00:00:00", "x,y,1998-01-01", "3", "4,1.0,1998-01-01,more", "5,,", "6,1.0,soon"]
    raw = spark.createDataFrame([(7, i, line) for i, line in enumerate(lines)], "query long, line_number int, raw_line string")
    accepted, errors = split_lines(raw, layout)
    assert sorted(r.id for r in accepted.collect()) == [1, 5]
    found = sorted((r.line_number, r.colname or "", r.value or "") for r in errors.collect())
    assert found == [(1, "id", "x"), (1, "km", "y"), (2, "", ""), (3, "", ""), (5, "t", "soon")]
    loads = spark.createDataFrame([(7, datetime(1998, 1, 1))], "query long, starttime timestamp_ntz")
    report = load_error_report(errors, loads, rows=2).collect()
    assert [(r.line_number, r.colname) for r in report] == [(1, "id"), (1, "km")]


def test_sql_text_binds_values(spark, tmp_path):
    frame = spark.createDataFrame([("a'; drop", 1), ("b", 2)], "name string, n int")
    assert [r.n for r in run_sql(spark, "select n from {t} where name = :name", {"name": "a'; drop"}, t=frame).collect()] == [1]
    place = tmp_path / "q.sql"
    place.write_text("select sum(n) as n from {t}", encoding="utf-8")
    assert run_sql_file(spark, place, t=frame).first().n == 3
    assert run_sql(spark, "set spark.sql.shuffle.partitions") is not None
    assert run_sql(spark, "drop view if exists no_such_view") is None


def test_titles(spark):
    assert title_case_columns(spark.createDataFrame([(1, 2)], "order_number int, step int")).columns == ["Order Number", "Step"]


@pytest.mark.parametrize("value,wanted", [("a" * 24, True), ("A" * 24, False), ("a" * 23, False), ("g" * 24, False)])
def test_object_id(spark, value, wanted):
    from legmeter.functions.text import is_object_id

    assert spark.createDataFrame([(value,)], "v string").select(is_object_id(F.col("v")).alias("ok")).first().ok is wanted


def test_slices_stay_few_as_a_table_grows(spark, tmp_path):
    """Slices grow with the table, so that lists, plans and shuffles stay bounded; large ones are written by several tasks."""
    path = str(tmp_path / "legs")
    for distance in (1.0, 2.0):
        state = snapshots.merge(spark, path, numbered(spark, range(4000), distance), LEG_KEYS, LEG_LAYOUT, "_id_oid", 2)
        assert state.rows == 4000 and len(state.slices) <= 1.5 * snapshots.MOST_SLICES
    assert {r.distance for r in snapshots.read(spark, path, LEG_LAYOUT).collect()} == {2.0}
    assert snapshots.cut_rows(20_000, 1_000_000) == 20_000 and snapshots.cut_rows(20_000, 10**12) == snapshots.SLICE_ROWS
    assert snapshots.task_count(snapshots.SLICE_ROWS, 10_000_000) == 20 and snapshots.task_count(snapshots.SLICE_ROWS, 10**11) == 20_000


def test_ids_outside_all_slices_reach_none(spark, tmp_path):
    path = str(tmp_path / "legs")
    state = snapshots.merge(spark, path, numbered(spark, [*range(100, 200), *range(500, 600)]), LEG_KEYS, LEG_LAYOUT, "_id_oid", 50)
    ids = spark.createDataFrame([("1",), ("350",), ("601",), (None,), ("zz",)], "_id_oid string")
    assert len(state.slices) >= 3 and snapshots.read_near(spark, path, LEG_LAYOUT, ids, "_id_oid").count() == 0
    near = snapshots.read_near(spark, path, LEG_LAYOUT, spark.createDataFrame([("150",), ("1",)], "_id_oid string"), "_id_oid")
    assert 0 < near.count() < 200 and near.where("_id_oid = '150'").count() == 1


def test_a_first_merge_looks_for_nothing_and_stores_the_layout_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "legs")
    rows = legs(spark, [("7", "osrm", 1, 1.0), ("7", "osrm", 2, 1.5), (None, "osrm", 1, 4.0), ("x", None, 1, None)])
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "upsert", lambda *a: 1 / 0)
        state = snapshots.merge(spark, path, rows, LEG_KEYS, LEG_LAYOUT, "_id_oid", 2)
    assert spark_rows(snapshots.read(spark, path, LEG_LAYOUT)) == spark_rows(rows)
    assert (state.slices[0].least, state.slices[-1].most) == ("", "x")
    folder = f"{path}/data/{state.slices[0].folders[0]}"
    assert spark.read.parquet(folder).columns == LEG_LAYOUT.names  # the key's text is not stored beside the key


def test_numbers_are_added_to_the_row_of_the_same_key(spark, tmp_path):
    path = str(tmp_path / "sums")
    layout = T.StructType([T.StructField("place", T.StringType()), T.StructField("day", T.IntegerType()), T.StructField("total", T.LongType())])
    add = lambda rows: snapshots.merge(spark, path, spark.createDataFrame(rows, layout), ["place", "day"], layout, "day", 2, added=["total"])
    first = add([("a", day, day) for day in range(6)] + [(None, 3, 7), ("b", None, 5)])
    second = add([("a", 1, 10), (None, 3, -7), ("b", None, 1), ("c", 1, 2)])
    wanted = [("a", day, day + 10 * (day == 1)) for day in range(6)] + [(None, 3, 0), ("b", None, 6), ("c", 1, 2)]
    assert spark_rows(snapshots.read(spark, path, layout)) == spark_rows(spark.createDataFrame(wanted, layout))
    kept = {f for s in first.slices for f in s.folders} & {f for s in second.slices for f in s.folders}
    assert kept and second.rows == len(wanted)
