"""Whole runs, by mode."""

from __future__ import annotations

from datetime import datetime

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from legmeter.catalog.queries import UPDATED_AT, WINDOW, stand_ins
from legmeter.config import JobConfig, RunWindow
from legmeter.operators import snapshots
from legmeter.operators.pricing import GreatCircle
from legmeter.plans.job import MODES, TARGETS, check, daily_export, open_tables, order_lines, run, store
from legmeter.sources.tables import LEG_LAYOUT

SF_DIR = "/root/testdata/sf0.001"
WEEK = RunWindow("1998-01-10", "1998-01-17")


@pytest.fixture(scope="module")
def tables(spark):
    return stand_ins(spark, SF_DIR).tables


def results(tables, mode, **kw):
    return run(tables, JobConfig(mode, kw.pop("window", WEEK), UPDATED_AT, **kw), GreatCircle(8.0))


@pytest.mark.parametrize(
    "line,names",
    [
        ("all", {"market", "water", "refill", "food", "artisan"}),
        ("1", {"market", "water", "refill"}),
        ("3", {"market"}),
        ("4", {"water", "refill"}),
        ("2", {"food"}),
        ("6", {"artisan"}),
    ],
)
def test_lines(tables, line, names):
    assert set(order_lines(tables, JobConfig("osrm", WEEK, UPDATED_AT, line=line))) == names


def test_modes_and_layouts(tables):
    expected = {
        "osrm": {"leg_distances", "refill_distances", "food_distances", "artisan_distances"},
        "gps": {"gps_distances", "route_points"},
        "monthly_missing": {"leg_distances", "food_distances", "artisan_distances"},
    }
    expected["both"] = expected["osrm"] | expected["gps"]
    for mode, names in expected.items():
        found = results(tables, mode)
        assert set(found) == names
        for name, rows in found.items():
            layout = TARGETS[name][2]
            assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in layout.fields]
    with pytest.raises(ValueError):
        results(tables, "other")


def test_partner_mode(spark, tables, tmp_path):
    path = str(tmp_path / "feed")
    stand_ins(spark, SF_DIR).frame("partner_rows").write.json(path)
    found = run(tables, JobConfig("partner", WINDOW, UPDATED_AT), feed_path=path)
    counts = {name: rows.count() for name, rows in found.items()}
    assert set(counts) == {"leg_distances", "food_distances", "artisan_distances"} and all(counts.values())
    assert {r[0] for r in found["leg_distances"].select("distance_type").distinct().collect()} == {"partner"}
    assert "partner" in MODES


def test_warehouse_choice_limits_every_line(tables):
    some = results(tables, "osrm", warehouses=("W1",))
    everything = results(tables, "osrm")
    for name in some:
        part, whole = spark_rows(some[name])[1], spark_rows(everything[name])[1]
        assert 0 < sum(part.values()) < sum(whole.values())


def test_store_twice_is_store_once(spark, tables, tmp_path):
    config = JobConfig("both", WEEK, UPDATED_AT, line="1")
    found = run(tables, config, GreatCircle(8.0))
    left = store(spark, found, str(tmp_path), config, tables)
    once = spark_rows(snapshots.read(spark, f"{tmp_path}/leg_distances", LEG_LAYOUT))
    assert store(spark, found, str(tmp_path), config, tables) == left > 0
    assert spark_rows(snapshots.read(spark, f"{tmp_path}/leg_distances", LEG_LAYOUT)) == once
    kinds = {row[names] for names in [once[0].index("distance_type")] for row in once[1]}
    assert kinds == {"haversine", "gps"}


def test_a_missing_run_reads_what_runs_have_stored(spark, tables, tmp_path):
    inputs, kept = str(tmp_path / "in"), str(tmp_path / "results")
    for name in ("marketorders", "warehouse_locations", "warehouses", "courier_status_logs", "food_orders", "artisan_orders", "courier_tasks"):
        getattr(tables, name).write.parquet(f"{inputs}/{name}")
    opened = open_tables(spark, inputs, kept)
    missing = lambda: order_lines(opened, JobConfig("monthly_missing", WEEK, UPDATED_AT))["market"].count()
    everything = missing()
    config = JobConfig("osrm", RunWindow("1998-01-10", "1998-01-14"), UPDATED_AT, line="3")
    found = {name: rows.withColumn("distance_type", F.lit("osrm")) for name, rows in run(tables, config, GreatCircle(8.0)).items()}
    store(spark, found, kept, config)
    priced = found["leg_distances"].select("_id_oid").distinct().count()
    assert 0 < priced and missing() == everything - priced


def test_export_runs_once_a_day(spark, tables, tmp_path):
    config = JobConfig("osrm", WEEK, UPDATED_AT)
    assert not daily_export(tables, config, datetime(1998, 1, 11, 5), str(tmp_path / "none"))
    assert not daily_export(tables, JobConfig("gps", WEEK, UPDATED_AT), datetime(1998, 1, 11, 4), str(tmp_path / "none"))
    assert daily_export(tables, config, datetime(1998, 1, 11, 4, 30), str(tmp_path / "export"))
    sheet = spark.read.option("header", True).csv(str(tmp_path / "export"))
    assert sheet.columns == ["order_id", "courier_id", "date_l", "domain_type", "step", "osrm", "distance"]
    assert {r[0][:10] for r in sheet.select("date_l").distinct().collect()} <= {"1998-01-10", "1998-01-11"}
    assert sheet.count() > 0


def test_check_writes_sheets(spark, tables, tmp_path):
    found = results(tables, "osrm", line="3")
    check(found, str(tmp_path / "sheets"))
    sheet = spark.read.option("header", True).csv(str(tmp_path / "sheets" / "leg_distances"))
    assert "Distance Type" in sheet.columns and sheet.count() == found["leg_distances"].count()
