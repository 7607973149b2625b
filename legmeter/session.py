"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "legmeter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive planning on; partition counts stay with the cluster unless given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python line of every expression doubles the time to build a plan.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Only a local-mode session may go without the setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="legmeter-")
        base = _LOCAL_FOLDERS[app]
    return f"{base.rstrip('/')}/legmeter/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
