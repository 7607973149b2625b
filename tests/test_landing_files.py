"""Staged files by line, and the partner's folder taken in file by file."""

from __future__ import annotations

import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import types as T

from legmeter.config import RunWindow
from legmeter.operators import snapshots
from legmeter.sources import feed
from legmeter.sources.landing import numbered_lines, read_stage_checked

LAYOUT = T.StructType([T.StructField("id", T.LongType()), T.StructField("km", T.DoubleType())])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_lines_are_numbered_across_splits(spark, tmp_path, small_splits):
    wanted = set()
    for name, count in (("one.csv", 500), ("two.csv", 1), ("three.csv", 77), ("none.csv", 0)):
        lines = [f"{name} line {i}" + "x" * (i * 7 % 40) for i in range(1, count + 1)]
        (tmp_path / name).write_text("\n".join(lines) + ("" if count == 77 else "\n"))
        wanted |= {(name, i, line) for i, line in enumerate(lines, 1)}
    (tmp_path / "none.csv").write_text("")
    numbered = numbered_lines(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert {(r.file.rsplit("/", 1)[1], r.line_number, r.raw_line) for r in numbered.collect()} == wanted


def test_rejects_name_file_and_line(spark, tmp_path, small_splits):
    body = ["id,km"] + [f"{i},{i / 2}" for i in range(400)]
    body[100], body[250], body[251], body[399] = "x,1.0", "7", "", "8,far"
    (tmp_path / "a.csv").write_text("\n".join(body) + "\n")
    (tmp_path / "b.csv").write_text("id,km\n1,2.5,3\n2,\n")
    accepted, errors = read_stage_checked(spark, str(tmp_path), LAYOUT)
    found = sorted((r.file[-5:], r.line_number, r.colname or "", r.value or "", r.raw_line) for r in errors.collect())
    assert found == [
        ("a.csv", 101, "id", "x", "x,1.0"), ("a.csv", 251, "", "", "7"), ("a.csv", 400, "km", "far", "8,far"), ("b.csv", 2, "", "", "1,2.5,3"),
    ]
    rows = {(r.file[-5:], r.line_number): (r.id, r.km) for r in accepted.collect()}
    assert len(rows) == 396 + 1 and rows["a.csv", 2] == (0, 0.0) and rows["b.csv", 3] == (2, None)


def land(folder, name, rows, extra=()):
    lines = [json.dumps(dict(zip(("order_id", "step", "distance", "domain_type", "start_time", "processed_time"), r))) for r in rows]
    (folder / name).write_text("\n".join([*lines, *extra]) + "\n")


def order(oid, processed, distance=500.0):
    return (oid, 1, distance, 1, f"1998-01-0{processed[0]}T01:00:00.000", f"1998-01-0{processed}:00:00.000")


DAY = RunWindow("1998-01-01", "1998-01-09")


def stored(spark, store, window=DAY, **kw):
    return sorted((r.order_id, r.distance) for r in feed.read_feed(spark, store, window, "1998-02-01", **kw).collect())


def test_a_second_run_opens_only_new_files(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "feed", str(tmp_path / "store")
    folder.mkdir()
    opened = []
    new = feed._new_files
    monkeypatch.setattr(feed, "_new_files", lambda *a: (found := new(*a), opened.append(sorted(r.file.rsplit("/", 1)[1] for r in found.collect())))[0])
    assert feed.take_in(spark, str(folder), store, "1998-01-02") == feed.Intake(0, 0, 0)
    land(folder, "one.json", [order("a", "1T02"), order("b", "2T02", 7000.0)], ['{"order_id": "cut", "st', '{"order_id": "c", "distance": "far"}'])
    assert feed.take_in(spark, str(folder), store, "1998-01-03") == feed.Intake(1, 2, 2)
    land(folder, "two.json", [order("d", "5T02")], ['{"order_id": "e", "step": 1}', '{"step": 1}'])
    assert feed.take_in(spark, str(folder), store, "1998-01-04") == feed.Intake(1, 1, 2)
    assert feed.take_in(spark, str(folder), store, "1998-01-05") == feed.Intake(0, 0, 0)
    assert opened == [[], ["one.json"], ["two.json"], []]
    assert stored(spark, store) == [("a", 0.5), ("b", 7.0), ("d", 0.5)]
    assert stored(spark, store, RunWindow("1998-01-02", "1998-01-05 02:00:00")) == [("b", 7.0)]
    assert stored(spark, store, RunWindow("1998-01-05", "1998-01-06"), period="daily") == [("d", 0.5)]
    rejects = snapshots.read(spark, f"{store}/rejects", feed.REJECT_LAYOUT).collect()
    assert sorted((r.file[-8:], r.reason) for r in rejects) == [
        ("one.json", "a field of another type"), ("one.json", "no JSON"), ("two.json", "no order"), ("two.json", "no time"),
    ]
    assert any("cut" in r.raw for r in rejects) and {r.seen_at for r in rejects} == {datetime(1998, 1, 3), datetime(1998, 1, 4)}


def test_a_changed_file_replaces_its_rows_and_a_repeated_run_changes_nothing(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "feed", str(tmp_path / "store")
    folder.mkdir()
    land(folder, "one.json", [order("a", "1T02"), order("b", "2T02")], ["broken"])
    land(folder, "two.json", [order("c", "1T02")])
    with monkeypatch.context() as patch:
        merge = snapshots.merge

        def killed(spark, path, *args, **kw):
            if path.endswith("/files"):
                raise RuntimeError("killed")
            return merge(spark, path, *args, **kw)

        patch.setattr(snapshots, "merge", killed)
        with pytest.raises(RuntimeError):
            feed.take_in(spark, str(folder), store, "1998-01-03")
    assert feed.take_in(spark, str(folder), store, "1998-01-03") == feed.Intake(2, 3, 1)
    assert stored(spark, store) == [("a", 0.5), ("b", 0.5), ("c", 0.5)]
    assert snapshots.read(spark, f"{store}/rejects", feed.REJECT_LAYOUT).count() == 1
    land(folder, "one.json", [order("b", "3T02", 900.0)])
    os.utime(folder / "one.json", (2_000_000_000, 2_000_000_000))
    assert feed.take_in(spark, str(folder), store, "1998-01-04") == feed.Intake(1, 1, 0)
    assert stored(spark, store) == [("b", 0.9), ("c", 0.5)]
    assert snapshots.read(spark, f"{store}/rejects", feed.REJECT_LAYOUT).count() == 0
    assert snapshots.read(spark, f"{store}/files", feed.LEDGER_LAYOUT).count() == 2


def test_a_lot_is_stored_by_several_tasks_and_stays_one_slice(spark, tmp_path, monkeypatch):
    """Rows that fill less than a slice are sorted in parts, so that none has to spill; compressed files are read as others."""
    monkeypatch.setattr(snapshots, "TASK_ROWS", 100)
    folder, store = tmp_path / "feed", str(tmp_path / "store")
    folder.mkdir()
    rows = [order(str(i), f"{i % 7 + 1}T{i % 24:02}") for i in range(600)]
    land(folder, "one.json", rows[:300])
    land(tmp_path, "two.json", rows[300:], ["broken"])
    (folder / "two.json.gz").write_bytes(gzip.compress((tmp_path / "two.json").read_bytes()))
    assert feed.take_in(spark, str(folder), store, "1998-01-03") == feed.Intake(2, 600, 1)
    (kept,) = snapshots.snapshot(spark, f"{store}/feed").slices
    assert kept.rows == 600 and len(kept.folders) >= 4
    assert {row[0] for row in stored(spark, store)} == {str(i) for i in range(600)}
