"""Every query against its SQL answer on the smallest test tables."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows
from handmade import SF_DIR

from legmeter.catalog.oracle import oracle_sql
from legmeter.catalog.queries import QUERIES, upserted

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    found = spark_rows(result)
    wanted = duck_rows(duck, ORACLE[name])
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]
    assert sum(found[1].values()) > 0


def test_entry_runs():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["upsert_market", "upsert_food", "upsert_artisan", "upsert_refill"])
def test_upserted_batches_are_priced_once(spark, name):
    """The batch is read for its keys and for its rows; neither reading prices it again."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "_k_from_lon" not in plan


def test_upserted_keeps_the_rows_of_both_sides(spark):
    layout = "_id_oid string, distance_type string, distance bigint"
    target = spark.createDataFrame([("1", "osrm", 5), ("1", "gps", 6), (None, "osrm", 7), ("x", None, 8)], layout)
    batch = spark.createDataFrame([("1", "osrm", 1), ("1", "osrm", 1), (None, "osrm", 2)], layout)
    found = upserted(target, batch, ["_id_oid", "distance_type"]).collect()
    wanted = [("1", "osrm", 1), ("1", "osrm", 1), (None, "osrm", 2), ("1", "gps", 6), (None, "osrm", 7), ("x", None, 8)]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
