"""Route codec: known strings, random round trips, odd offsets."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from legmeter.functions.routes import route_offsets, route_points, running_sums
from legmeter.operators.routes import damaged_routes, latest_routes, route_to_points

START = datetime(1998, 1, 10)
SAMPLE = "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
SAMPLE_POINTS = [(0.385, -1.202), (0.407, -1.2095), (0.43252, -1.26453)]


def encode(points: list[tuple[int, int]]) -> str:
    """Test-side writer of the route text, from whole ten-millionths of a degree."""
    text, before = [], (0, 0)
    for point in points:
        for value, last in zip(point, before):
            step = value - last
            rest = step * 2 if step >= 0 else -step * 2 - 1
            while rest > 31:
                text.append(chr(rest % 32 + 95))
                rest //= 32
            text.append(chr(rest + 63))
        before = point
    return "".join(text)


def decode(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    rows = frame.select("i", route_points(F.col("t")).alias("p")).orderBy("i").collect()
    return [None if r.p is None else [(p.lat, p.lon) for p in r.p] for r in rows]


def test_known_text(spark):
    assert decode(spark, [SAMPLE, None, "", "_p~iF~ps|U"]) == [SAMPLE_POINTS, None, [], SAMPLE_POINTS[:1]]


def test_a_cut_route_does_not_leak_into_the_next(spark):
    # The first text ends inside a number, the second after an unpaired latitude.
    assert decode(spark, ["_p~iF~ps|", "_p~iF", SAMPLE]) == [[], [], SAMPLE_POINTS]


def test_damaged_routes_are_null_and_counted(spark):
    long_number, strange, high = "~" * 14 + "?" + "A", "_p~iF\u00e9~ps|U", "_p~iF\x7f~ps|U"
    texts = [SAMPLE, long_number, strange, None, "_p iF~ps|U", high, SAMPLE, "_p~iF~ps|U\n", "_" * 7 + "?A", "_" * 6 + "?A"]
    assert decode(spark, texts) == [SAMPLE_POINTS, None, None, None, None, None, SAMPLE_POINTS, None, None, [(0.0, 1e-7)]]
    frame = spark.createDataFrame([(t,) for t in texts], "encoded_latlons string")
    assert damaged_routes(frame).first().damaged == 6


def test_no_python_decodes(spark):
    routes = spark.createDataFrame([("a", SAMPLE, "2s", START)], "_id_oid string, encoded_latlons string, encoded_time string, start_time timestamp_ntz")
    plan = route_to_points(routes)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_running_sums(spark):
    draw = random.Random(2)
    for stride in (1, 2, 3):
        lists = [[draw.randrange(-9, 10) for _ in range(size)] for size in (0, 1, 2, 3, 4, 5, 8, 9, 31, 32, 33, 100)]
        frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<bigint>")
        found = {r.i: r.s for r in frame.select("i", running_sums(F.col("x"), stride).alias("s")).collect()}
        assert found == {i: [sum(x[k % stride : k + 1 : stride]) for k in range(len(x))] for i, x in enumerate(lists)}


POINT = st.tuples(st.integers(-900_000_000, 900_000_000), st.integers(-1_800_000_000, 1_800_000_000))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(POINT, max_size=20), max_size=12))
def test_round_trip(spark, routes):
    assert decode(spark, [encode(route) for route in routes]) == [
        [(lat / 1e7, lon / 1e7) for lat, lon in route] for route in routes
    ]


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("0;2s;5k", [0.0, 5.0, 10.0]),
        ("2s;", [5.0, None]),
        (";2s", [None, 5.0]),
        ("", None),
        ("-2s", [-5.0]),
        ("2S", [5.0]),
        ("!", [None]),
    ],
)
def test_offsets(spark, text, wanted):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(route_offsets(F.col("t")).alias("o")).first().o == wanted


def points(spark, rows, **options):
    frame = spark.createDataFrame(rows, "_id_oid string, encoded_latlons string, encoded_time string, start_time timestamp_ntz")
    return route_to_points(frame, **options).collect()


def test_points_and_times_pair_up_to_the_shorter(spark):
    found = points(spark, [("long", SAMPLE, "2s", START), ("short", "_p~iF~ps|U", "2s;5k", START)])
    assert sorted((r._id_oid, r.lat, r.time.second) for r in found) == [("long", 0.385, 5), ("short", 0.385, 5)]


def test_no_times_keep_all_points(spark):
    for text in ("", None):
        found = points(spark, [("a", SAMPLE, text, START)])
        assert len(found) == 3 and all(r.time is None for r in found)


def test_zero_offset(spark):
    row = [("a", "_p~iF~ps|U", "0", START)]
    assert points(spark, row)[0].time is None
    assert points(spark, row, zero_offset_is_null=False)[0].time == START


def test_no_points(spark):
    assert points(spark, [("a", "", "2s", START), ("b", None, "2s", START), ("c", None, None, START)]) == []


def test_count_is_the_shorter_length(spark):
    rng = random.Random(4)
    rows, wanted = [], 0
    for i in range(200):
        n_points, n_times = rng.randrange(5), rng.randrange(5)
        route = [(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(n_points)]
        rows.append((str(i), encode(route), ";".join(["2s"] * n_times), START))
        wanted += n_points if n_times == 0 else min(n_points, n_times)
    assert len(points(spark, rows)) == wanted


def test_latest_route_wins(spark):
    schema = "_id_oid string, encoded_latlons string, encoded_time string, start_time timestamp_ntz"
    rows = [("a", "old", "", START), ("a", "new", "", datetime(1998, 1, 11)), ("b", "only", "", None)]
    found = latest_routes(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r._id_oid, r.encoded_latlons) for r in found) == [("a", "new"), ("b", "only")]
