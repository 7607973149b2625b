"""The shared work folder comes from the session; this needs sessions of its own, so it asks a stand-in."""

from __future__ import annotations

import pytest

from legmeter.session import materialise, work_folder


class Fake:
    """Only what ``work_folder`` asks of a session."""

    def __init__(self, setting=None, master="yarn", checkpoint=None):
        self.conf = self
        self.sparkContext = self
        self.setting, self.master, self.checkpoint = setting, master, checkpoint
        self.applicationId = "app"

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.checkpoint


def test_the_setting_names_the_folder():
    first, second = work_folder(Fake("hdfs:///shared/"), "x"), work_folder(Fake("hdfs:///shared/"), "x")
    assert first.startswith("hdfs:///shared/legmeter/x-") and first != second
    assert work_folder(Fake(checkpoint="hdfs:///points"), "x").startswith("hdfs:///points/")


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError):
        work_folder(Fake(), "x")


def test_local_sessions_may_do_without():
    assert work_folder(Fake(master="local[2]"), "x")


def test_written_rows_come_back(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    again = materialise(frame, "t")
    assert again.schema == frame.schema and sorted(again.collect()) == sorted(frame.collect())
    assert "FileScan" in again._jdf.queryExecution().executedPlan().toString()
