"""Run a SQL text with bound parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame | None:
    """Run ``text`` with ``:name`` parameters and ``{name}`` frames.

    Values are bound, never pasted into the text. A statement without a result set gives ``None``.
    """
    result = spark.sql(text, args=args or {}, **frames)
    return result if result.columns else None


def run_sql_file(spark: SparkSession, path: str | Path, args: dict | None = None, **frames: DataFrame) -> DataFrame | None:
    return run_sql(spark, Path(path).read_text(encoding="utf-8"), args, **frames)
