"""Cutting large groups must not change any result."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from legmeter.config import Reasons, RunWindow, SplitPolicy
from legmeter.operators.ordered_groups import OrderedGroups, mark_groups

START = datetime(1998, 1, 1)


def rows_of(seed: int, n: int = 600):
    """A third of all rows in one group without a courier; many ties; some rows without a local time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        warehouse = "W0" if rng.random() < 0.6 else rng.choice(["W1", "W2", None])
        courier = None if warehouse == "W0" and rng.random() < 0.6 else f"C{rng.randrange(4)}"
        moment = START + timedelta(minutes=rng.randrange(0, 4000, 7))
        local = None if rng.random() < 0.15 else moment + timedelta(hours=2)
        day = (local - datetime(1970, 1, 1)).days if local else 2**31 - 1
        rows.append((f"{i:05d}", warehouse, courier, local, moment, day, rng.choice([None, f"O{i}"]), float(i)))
    return rows


SCHEMA = (
    "id string, w string, c string, local timestamp_ntz, moment timestamp_ntz, day int, ref string, x double"
)


def by_hand(rows):
    """Plain Python answer: previous x, next non-null ref, number within the day."""
    groups: dict = {}
    for row in rows:
        groups.setdefault((row[1], row[2]), []).append(row)
    answer = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[3] is None, r[3] or START, r[4], r[0]))
        seen: dict = {}
        for place, row in enumerate(group):
            seen[row[5]] = seen.get(row[5], 0) + 1
            later = next((r[6] for r in group[place + 1 :] if r[6] is not None), None)
            answer[row[0]] = (group[place - 1][7] if place else None, later, seen[row[5]])
    return answer


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("policy", [SplitPolicy(), SplitPolicy(rows=20), SplitPolicy(rows=3)])
def test_pieces_give_the_same_rows(spark, seed, policy):
    rows = rows_of(seed)
    groups = OrderedGroups(["w", "c"], ["local", "moment", "id"], day="day", policy=policy)
    marked = groups.mark(spark.createDataFrame(rows, SCHEMA))
    assert groups.is_split == (policy.rows < 100)
    out = groups.previous(marked, marked, {"before": "x"})
    out = groups.number(out, marked, "n")
    out = groups.next_value(out, marked, "later", "ref")
    found = {r["id"]: (r["before"], r["later"], r["n"]) for r in out.collect()}
    assert found == by_hand(rows)


def test_a_large_group_is_spread(spark):
    rows = rows_of(3, 2000)
    groups = OrderedGroups(["w", "c"], ["local", "moment", "id"], policy=SplitPolicy(rows=50))
    marked = groups.mark(spark.createDataFrame(rows, SCHEMA))
    biggest = marked.groupBy("w", "c", groups.piece).count().agg({"count": "max"}).first()[0]
    whole = marked.groupBy("w", "c").count().agg({"count": "max"}).first()[0]
    assert whole > 600 and biggest < 150


def test_number_order_groups(spark):
    """Whole-number order with nulls, as for courier tasks."""
    rng = random.Random(5)
    rows = [(f"{i:04d}", "G" if i % 3 else f"g{i % 7}", rng.choice([None, *range(50)])) for i in range(500)]
    frame = spark.createDataFrame(rows, "id string, g string, s int")
    results = []
    for policy in (SplitPolicy(), SplitPolicy(rows=10)):
        groups = OrderedGroups(["g"], ["s", "id"], policy=policy)
        marked = groups.mark(frame)
        results.append(sorted(tuple(r) for r in groups.number(marked, marked, "n").select("id", "n").collect()))
    assert results[0] == results[1]


def test_ties_do_not_stop_the_cutting(spark):
    """Two thirds of all rows in one group at one sequence number."""
    rows = [(f"{i:05d}", "G" if i % 3 else f"g{i}", 1) for i in range(3000)]
    groups = OrderedGroups(["g"], ["s", "id"], policy=SplitPolicy(rows=100))
    marked = groups.mark(spark.createDataFrame(rows, "id string, g string, s int"))
    assert marked.filter("g = 'G'").groupBy(groups.piece).count().agg({"count": "max"}).first()[0] < 400
    numbers = groups.number(marked, marked, "n").filter("g = 'G'").orderBy("id").select("n").collect()
    assert [r.n for r in numbers] == list(range(1, 2001))


def test_left_join_with_a_repeated_right_key(spark):
    from legmeter.operators.joins import left_join_any

    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 0), ("z", 1)], "k string, y int")
    wanted = left.join(right, "k", "left")
    assert left_join_any(left, right, "k").columns == wanted.columns
    key = lambda r: tuple((v is None, v) for v in r)
    found = left_join_any(left, right, "k").collect()
    assert sorted(found, key=key) == sorted(wanted.collect(), key=key)


def test_two_groupings_share_one_count(spark):
    frame = spark.createDataFrame(rows_of(7), SCHEMA)
    first = OrderedGroups(["w", "c"], ["local", "moment", "id"], name="a", policy=SplitPolicy(rows=20))
    second = OrderedGroups(["day", "c"], ["moment", "moment", "id"], name="b", policy=SplitPolicy(rows=20), count_by=["c"])
    marked = mark_groups(frame, first, second)
    assert {"_a", "_b"} <= set(marked.columns) and marked.count() == 600


def test_plans_agree_when_split(spark):
    from compare import spark_rows

    from legmeter.catalog.queries import WINDOW, stand_ins
    from legmeter.plans import market, missing, trips, water

    tables, tight = stand_ins(spark, "/root/testdata/sf0.001").tables, SplitPolicy(rows=5)
    pairs = [
        (market.legs_market(tables, WINDOW), market.legs_market(tables, WINDOW, policy=tight)),
        (water.legs_water(tables, WINDOW, Reasons()), water.legs_water(tables, WINDOW, Reasons(), policy=tight)),
        (
            missing.water_missing(tables, WINDOW, Reasons()),
            missing.water_missing(tables, WINDOW, Reasons(), policy=tight),
        ),
        (trips.task_batch_index(tables), trips.task_batch_index(tables, policy=SplitPolicy(rows=2))),
    ]
    for whole, cut in pairs:
        assert spark_rows(whole) == spark_rows(cut)


def test_window_is_half_open():
    window = RunWindow("1998-01-02", "1998-01-03").widened(2, 1)
    assert (window.start, window.end) == (datetime(1998, 1, 1, 22), datetime(1998, 1, 3, 1))
