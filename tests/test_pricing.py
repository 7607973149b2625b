from __future__ import annotations

from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from legmeter.operators.legs import price_legs, trip_legs
from legmeter.operators.price_store import RememberedPrices, StoredPrices, quadkey, store_prices
from legmeter.operators.pricing import LEG_POINTS, BatchPrices, GreatCircle, TablePrices

LEGS = "id string, from_lon double, from_lat double, to_lon double, to_lat double"
PRICES = "from_lon double, from_lat double, to_lon double, to_lat double, distance double, duration double"


@pytest.fixture(scope="module")
def legs(spark):
    rows = [(str(i), 28.0 + i % 40 / 1000, 41.0, 28.1, 41.0 + i % 7 / 1000) for i in range(2000)]
    return spark.createDataFrame([*rows, ("open", None, None, 28.1, 41.0)], LEGS)


def test_table_meets_on_micro_degrees(spark):
    legs = spark.createDataFrame([("a", 0.1 + 0.2, 41.0, 28.1, 41.0), ("b", 0.300002, 41.0, 28.1, 41.0)], LEGS)
    prices = spark.createDataFrame(
        [(0.3, 41.0, 28.1, 41.0, 900.0, 9.0), (0.3, 41.0, 28.1, 41.0, 700.0, 7.0), (0.3, 41.0, 28.1, 41.0, None, 1.0)],
        PRICES,
    )
    found = {r.id: (r.distance, r.duration) for r in TablePrices(prices).price(legs).collect()}
    assert found == {"a": (700.0, 7.0), "b": (None, None)}


def test_straight_line_has_its_own_label_and_needs_no_shuffle(spark, legs):
    provider = GreatCircle(metres_per_second=10.0)
    assert provider.label == "haversine"
    priced = provider.price(legs)
    assert "Exchange" not in priced._jdf.queryExecution().executedPlan().toString()
    row = priced.filter("id = '0'").first()
    assert row.distance == pytest.approx(8392.0, rel=1e-3) and row.duration == pytest.approx(row.distance / 10)
    assert priced.filter("id = 'open'").first().distance is None


def recording(folder: str):
    """A price function that leaves a note of every call in ``folder``."""

    def ask(batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as note:
            note.write(f"{attempt} {len(batch)}")
        distance = (batch["from_lon"] * 1e6).round()
        late = (distance / 1000).round().astype("int64") % 2 == 1
        never = batch["to_lat"].round(3) == 41.003
        return pd.DataFrame({"distance": distance.mask(late & (attempt == 0)).mask(never), "duration": 1.0})

    return ask


def test_batches_retries_and_single_asking(spark, legs, tmp_path):
    provider = BatchPrices(recording(str(tmp_path)), legs_per_call=50, rounds=2, parallel=2)
    priced = provider.price(legs)
    first = priced.collect()
    calls = [tuple(map(int, note.read_text().split())) for note in tmp_path.iterdir()]
    assert max(size for _, size in calls) <= 50
    assert {attempt for attempt, _ in calls} == {0, 1}
    # 40 starts times 7 ends, each distinct leg once.
    assert sum(size for attempt, size in calls if attempt == 0) == 280
    assert len(first) == 2001
    for row in first:
        if row.id == "open" or round(row.to_lat, 3) == 41.003:
            assert row.distance is None
        else:
            assert row.distance == round(row.from_lon * 1e6)
    assert priced.filter("distance is null").count() == 1 + sum(1 for i in range(2000) if i % 7 == 3)
    assert len(list(tmp_path.iterdir())) == len(calls)


def test_trip_legs_ask_for_all_three_at_once(spark, tmp_path):
    orders = spark.createDataFrame(
        [("a", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
        "order_id string, warehouse_lon double, warehouse_lat double, restaurant_lon double, restaurant_lat double, "
        "to_lon double, to_lat double",
    )
    row = trip_legs(orders, BatchPrices(recording(str(tmp_path)), parallel=1)).first()
    assert (row.store_to_rest, row.rest_to_client, row.client_to_store) == (1e6, 3e6, 5e6)
    assert sorted(n.read_text() for n in tmp_path.iterdir())[0] == "0 3"


def test_half_of_all_legs_alike(spark):
    """One leg holding most rows is asked and looked up once and still priced on every row."""
    same = [(str(i), 28.0, 41.0, 28.1, 41.1) for i in range(5000)]
    other = [(f"x{i}", 28.0 + i / 1000, 41.0, 28.2, 41.1) for i in range(100)]
    frame = spark.createDataFrame(same + other, LEGS)
    prices = frame.dropDuplicates(["from_lon", "to_lon"]).selectExpr(
        "from_lon", "from_lat", "to_lon", "to_lat", "from_lon as distance", "1d as duration"
    )
    assert TablePrices(prices).price(frame).filter("distance = from_lon").count() == 5100


# --- prices kept between runs


def cells(spark, places):
    frame = spark.createDataFrame([(round(x * 1e6), round(y * 1e6)) for x, y in places], "x long, y long")
    return [r.q for r in frame.select(quadkey(F.col("x"), F.col("y")).alias("q")).collect()]


def test_places_near_each_other_have_keys_near_each_other(spark):
    near, next_to, far, corner, outside = cells(spark, [(28.5, 41.0), (28.50001, 41.00001), (-70.0, 41.0), (-180.0, -90.0), (500.0, 99.0)])
    assert len(near) == 20 and set(near) <= set("0123")
    assert near[:17] == next_to[:17] and near[0] != far[0]
    assert corner == "0" * 20 and outside == "3" * 20


def grid(spark, size):
    """A price for each of ``size`` squared starts, ten kilometres apart."""
    rows = [(-60.0 + x / 10, -40.0 + y / 10, -60.0, -40.0, float(x), 1.0) for x in range(size) for y in range(size)]
    return spark.createDataFrame(rows, PRICES)


def test_only_the_places_of_the_legs_are_opened(spark, tmp_path):
    path = str(tmp_path / "prices")
    state = store_prices(grid(spark, 60), path, "1998-01-01", slice_rows=100)
    assert len(state.slices) > 20
    legs = spark.createDataFrame([("a", -60.0 + 7 / 10, -40.0 + 3 / 10, -60.0, -40.0), ("b", -59.999, -39.999, -60.0, -40.0), ("open", None, 1.0, 1.0, 1.0)], LEGS)
    provider = StoredPrices(path).prepared(legs, [LEG_POINTS])
    opened = {name.split("/data/")[1].rsplit("/", 1)[0] for name in provider.side.inputFiles()}
    assert 0 < len(opened) <= 2 < len(state.slices)
    plan = provider.price(legs)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert {r.id: r.distance for r in provider.price(legs).collect()} == {"a": 7.0, "b": None, "open": None}


def test_legs_are_worked_out_once(spark, tmp_path):
    path = str(tmp_path / "prices")
    store_prices(grid(spark, 5), path, "1998-01-01")
    worked = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            worked.add(len(frame))
            yield frame

    legs = spark.createDataFrame([(str(i), -60.0 + i % 5 / 10, -40.0, -60.0, -40.0) for i in range(50)], LEGS).mapInPandas(count, LEGS)
    for provider in (StoredPrices(path), TablePrices(grid(spark, 5)), BatchPrices(lambda batch, attempt: batch.assign(distance=1.0, duration=1.0)[["distance", "duration"]])):
        before = worked.value
        assert price_legs(legs, provider).filter("distance is not null").count() == 50
        assert worked.value - before == 50


def test_a_newer_price_replaces_the_older(spark, tmp_path):
    path = str(tmp_path / "prices")
    legs = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0)], LEGS)
    for metres, seconds in ((500.0, 50.0), (700.0, 30.0)):
        rows = [(1.0, 2.0, 3.0, 4.0, metres, seconds), (1.0, 2.0, 3.0, 4.0, metres + 1, seconds - 1), (1.0, None, 3.0, 4.0, 1.0, 1.0)]
        store_prices(spark.createDataFrame(rows, PRICES), path, "1998-01-01")
        priced = StoredPrices(path).prepared(legs, [LEG_POINTS]).price(legs).first()
        assert (priced.distance, priced.duration) == (metres, seconds - 1)


def test_only_new_stale_and_failed_legs_are_asked_again(spark, tmp_path):
    path, notes = str(tmp_path / "prices"), tmp_path / "notes"
    notes.mkdir()

    def run(legs, now, answers):
        """Legs asked in a run at ``now``, by their start; only those among ``answers`` get a price."""
        folder = notes / now.replace(":", "")
        folder.mkdir()

        def ask(batch, attempt, folder=str(folder), answers=tuple(answers)):
            import os
            import uuid

            with open(os.path.join(folder, uuid.uuid4().hex), "w") as note:
                note.write(" ".join(str(int(x)) for x in batch["from_lon"]))
            return pd.DataFrame({"distance": batch["from_lon"].where(batch["from_lon"].isin(answers)), "duration": 1.0})

        frame = spark.createDataFrame([(str(i), float(i), 1.0, 2.0, 3.0) for i in legs], LEGS)
        provider = RememberedPrices(ask, path, now, max_age=timedelta(days=10), give_up=2, rounds=1, parallel=1)
        found = {int(r.from_lon): r.distance for r in price_legs(frame, provider).collect()}
        assert found == {i: float(i) if i in answers or i in known else None for i in legs}
        known.update(i for i in legs if i in answers)
        return sorted(int(x) for note in folder.iterdir() for x in note.read_text().split())

    known: set[int] = set()
    assert run([1, 2, 3], "1998-01-01", [1, 2]) == [1, 2, 3]
    assert run([1, 2, 3, 4], "1998-01-02", [4]) == [3, 4]  # the new one, and the one that failed once
    assert run([1, 2, 3, 4], "1998-01-03", []) == []  # the failed one is given up
    assert run([1, 3], "1998-01-11 12:00:00", [1]) == [1]  # stale; the failed one was asked on the second
    assert run([1, 2, 3, 4], "1998-01-13", [1, 2, 3, 4]) == [2, 3, 4]
