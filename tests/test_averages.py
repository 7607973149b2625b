"""Averages kept as sums, against averages worked out from the stored rows."""

from __future__ import annotations

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from legmeter.catalog.queries import UPDATED_AT, WINDOW, stand_ins
from legmeter.config import JobConfig, RunWindow
from legmeter.operators import snapshots
from legmeter.operators.pricing import GreatCircle
from legmeter.plans import averages, missing
from legmeter.plans.job import READ_AGAIN, open_tables, order_lines, run, store
from legmeter.session import materialise
from legmeter.sources.tables import Tables

SF_DIR = "/root/testdata/sf0.001"
NAMES = ("marketorders", "warehouse_locations", "warehouses", "courier_status_logs", "food_orders", "artisan_orders", "courier_tasks")


@pytest.fixture(scope="module")
def tables(spark):
    return stand_ins(spark, SF_DIR).tables


def stored_tables(spark, tables, root):
    """The same orders with the stored results, averaged from the rows."""
    near = lambda name, ids, key: snapshots.read_near(spark, f"{root}/{name}", READ_AGAIN[name], ids, key)
    return Tables(lambda name: getattr(tables, name), near)


def summed_anew(spark, tables, root):
    whole = {name: snapshots.read(spark, f"{root}/{name}", layout).withColumn("sign", F.lit(1)) for name, layout in READ_AGAIN.items()}
    found = None
    for line in averages.LINES.values():
        sums = averages.line_sums(line, whole[line.table], tables, None)
        found = sums if found is None else found.unionByName(sums)
    return spark_rows(found.where("count != 0"))


def test_state_after_upserts_equals_a_recomputation(spark, tables, tmp_path):
    root = str(tmp_path)
    windows = [RunWindow("1998-01-05", "1998-01-12"), RunWindow("1998-01-10 03:00:00", "1998-01-14"), RunWindow("1998-01-05", "1998-01-12")]
    for turn, (window, line) in enumerate(zip(windows, ("all", "3", "2"))):
        config = JobConfig("osrm", window, UPDATED_AT, line=line)
        found = {
            name: rows.withColumn("distance", F.col("distance") * (turn + 1)) if "distance" in rows.columns else rows
            for name, rows in run(tables, config, GreatCircle(8.0)).items()
        }
        store(spark, found, root, config, tables)
        assert spark_rows(averages.read_state(spark, root)) == summed_anew(spark, tables, root)
    state = snapshots.snapshot(spark, f"{root}/{averages.TABLE}")
    assert state.notes == {"leg_distances": 2, "food_distances": 2, "artisan_distances": 1}
    # Nothing new, nothing done; a state that lags further than the versions reach back is summed up anew.
    assert averages.refresh(spark, tables, root) == state
    for name in READ_AGAIN:
        layout = READ_AGAIN[name]
        rows = materialise(snapshots.read(spark, f"{root}/{name}", layout).limit(50), "some")
        for _ in range(2):
            snapshots.merge(spark, f"{root}/{name}", rows, ["_id_oid", "distance_type"], layout, "_id_oid")
            snapshots.vacuum(spark, f"{root}/{name}", keep=1)
    averages.refresh(spark, tables, root, windows[0])
    assert spark_rows(averages.read_state(spark, root)) == summed_anew(spark, tables, root)


def test_kept_averages_are_those_of_the_rows(spark, tables, tmp_path):
    root = str(tmp_path)
    plain = {name: getattr(tables, name) for name in READ_AGAIN}
    store(spark, plain, root, JobConfig("osrm", WINDOW, UPDATED_AT), tables)
    by_row = stored_tables(spark, tables, root)
    recompute = {
        "market": lambda w, p: missing.avg_distance_market(by_row, w, p),
        "water": lambda w, p: missing.avg_distance_water(by_row, w, p),
        "food": lambda w, p: missing.avg_legs_food(by_row, w, p).withColumnRenamed("courierwarehouse_oid", "warehouse_id"),
        "artisan": lambda w, p: missing.avg_legs_artisan(by_row, w, p).withColumnRenamed("courierwarehouse_oid", "warehouse_id"),
    }
    spans = [("1998-01-05", "1998-01-20", ("W1", "W3")), ("1998-01-05 07:30:00", "1998-01-20 01:00:00", ("all",)), ("1998-01-06 03:00:00", "1998-01-06 21:00:00", ("all",))]
    for (start, end, places), names in zip(spans, (("market", "food"), ("market", "water", "food", "artisan"), ("water",))):
        for name in names:
            window = RunWindow(start, end)
            found, wanted = (
                {r[0]: tuple(None if v is None else round(v, 6) for v in r[1:]) for r in df.select("warehouse_id", *sorted(set(df.columns) - {"warehouse_id"})).collect()}
                for df in (averages.averages(spark, by_row, root, name, window, places), recompute[name](window, places))
            )
            wanted = {k: v for k, v in wanted.items() if k is not None and any(x is not None for x in v)}
            assert found == wanted


def test_a_run_killed_before_the_state_is_caught_up(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path)
    config = JobConfig("osrm", RunWindow("1998-01-05", "1998-01-12"), UPDATED_AT, line="3")
    found = run(tables, config, GreatCircle(8.0))
    store(spark, found, root, config, tables)
    changed = {"leg_distances": found["leg_distances"].withColumn("distance", F.col("distance") + 1)}
    with monkeypatch.context() as patch:
        patch.setattr(averages, "line_sums", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store(spark, changed, root, config, tables)
    assert spark_rows(averages.read_state(spark, root)) != summed_anew(spark, tables, root)
    averages.refresh(spark, tables, root, config.window)
    assert spark_rows(averages.read_state(spark, root)) == summed_anew(spark, tables, root)


def test_missing_runs_take_the_kept_averages(spark, tables, tmp_path):
    inputs, root = str(tmp_path / "in"), str(tmp_path / "results")
    for name in NAMES:
        getattr(tables, name).write.parquet(f"{inputs}/{name}")
    store(spark, {name: getattr(tables, name) for name in READ_AGAIN}, root, JobConfig("osrm", WINDOW, UPDATED_AT), tables)
    opened = open_tables(spark, inputs, root)
    assert opened.averages("market", WINDOW, ("all",)) is not None
    config = JobConfig("monthly_missing", WINDOW, UPDATED_AT)
    kept, plain = order_lines(opened, config), order_lines(tables, config)
    for name in ("market", "water", "food", "artisan"):
        numbers = [c for c in plain[name].columns if c.endswith("_avg") or c == "avg_distance"]
        both = [spark_rows(f[name].withColumns({c: F.round(c, 6) for c in numbers})) for f in (kept, plain)]
        assert both[0] == both[1]


def test_lines_of_the_same_tables_share_one_join(spark, tables, tmp_path, monkeypatch):
    root, asked, plain = str(tmp_path), [], averages.line_sums
    monkeypatch.setattr(averages, "line_sums", lambda lines, *a: asked.append([line.name for line in lines]) or plain(lines, *a))
    store(spark, {name: getattr(tables, name) for name in READ_AGAIN}, root, JobConfig("osrm", WINDOW, UPDATED_AT), tables)
    assert asked == [["market", "water"], ["food"], ["artisan"]]
    monkeypatch.undo()
    assert spark_rows(averages.read_state(spark, root)) == summed_anew(spark, tables, root)


def test_both_ends_of_a_window_are_read_at_once(spark, tables, tmp_path):
    root, near = str(tmp_path), []
    store(spark, {"leg_distances": tables.leg_distances}, root, JobConfig("osrm", WINDOW, UPDATED_AT), tables)
    by_row = stored_tables(spark, tables, root)
    counted = Tables(lambda name: getattr(tables, name), lambda *a: near.append(a[0]) or by_row.near(*a))
    window = RunWindow("1998-01-05 07:30:00", "1998-01-20 01:00:00")
    found = averages.averages(spark, counted, root, "market", window).where("avg_distance is not null")
    wanted = missing.avg_distance_market(by_row, window, ("all",)).where("avg_distance is not null and warehouse_id is not null")
    rows = [{r[0]: round(r[1], 6) for r in df.select("warehouse_id", "avg_distance").collect()} for df in (found, wanted)]
    assert rows[0] == rows[1] and rows[0] and near == ["leg_distances"]
