"""Files on the way in and out: CSV stage, partner feed, load errors, check sheets."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legmeter.config import ERROR_REPORT_ROWS, RunWindow, as_datetime, ntz
from legmeter.functions.text import title_case_columns
from legmeter.functions.timing import within
from legmeter.sources.tables import FEED_LAYOUT

# Defaults and unit repair of the partner feed.
FEED_DELAY_HOURS = 6
FEED_SPAN_MINUTES = 90
FEED_LIMIT = 1000.0
FEED_UNIT = 100000.0
FEED_DIGITS = 4
CORRUPT = "_corrupt_record"


def write_stage(df: DataFrame, path: str) -> None:
    """CSV part files with a header line."""
    df.write.option("header", True).csv(path)


def read_stage(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """Staged rows by position; the header line is skipped, not matched."""
    return spark.read.schema(layout).option("header", True).option("enforceSchema", True).csv(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_number, raw_line`` of text files, numbered from 1 however the files are split among tasks.

    A split knows where it starts and how many lines it has; the lines of the splits before it are added to a line's place
    in its own.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("raw_line"),
    )
    splits = lines.groupBy("file", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = F.sum("_lines").over(Window.partitionBy("file").orderBy("_split")) - F.col("_lines")
    starts = splits.select("file", "_split", "_first", before.alias("_before"))
    return lines.join(starts, ["file", "_split"]).select("file", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line_number"), "raw_line")


def read_stage_checked(spark: SparkSession, path: str, layout: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Staged rows by position with ``file`` and ``line_number``, and one row per rejected line or field.

    The first line of each file is its header; empty lines are no rows. A field must not hold a line break.
    """
    lines = numbered_lines(spark, path)
    rows = lines.where("line_number > 1") if header else lines
    return split_lines(rows.where("trim(raw_line) != ''"), layout, ("file", "line_number"))


def feed_window(mode: str, window: RunWindow) -> RunWindow:
    """The feed lags: unless the mode asks for the window itself, take 90 minutes, six hours back."""
    if mode in ("partner", "gps"):
        return window
    end = as_datetime(window.end).replace(minute=0, second=0) - timedelta(hours=FEED_DELAY_HOURS)
    return RunWindow(end - timedelta(minutes=FEED_SPAN_MINUTES), end)


def read_partner_feed(
    spark: SparkSession,
    path: str,
    window: RunWindow,
    updated_at,
    label: str = "partner",
    period: str = "hourly",
    repair: bool = True,
) -> DataFrame:
    """Partner distances landed as JSON, in km. Daily runs select by start, hourly ones by processing time."""
    raw = spark.read.schema(FEED_LAYOUT).json(path).filter(within(F.col(_moment(period)), window))
    return _feed_rows(raw, updated_at, label, repair)


def _moment(period: str) -> str:
    return "start_time" if period == "daily" else "processed_time"


def _feed_rows(raw: DataFrame, updated_at, label: str, repair: bool) -> DataFrame:
    km = F.col("distance") / 1000.0
    if repair:
        # Some rows arrive in another unit; only mode ``partner`` asks for the repair.
        km = F.when(km > FEED_LIMIT, F.round(km / FEED_UNIT, FEED_DIGITS)).otherwise(km)
    return raw.select(
        "order_id",
        "step",
        km.alias("distance"),
        "domain_type",
        F.lit(label).alias("distance_type"),
        ntz(updated_at).alias("updated_at"),
    )


def split_lines(raw: DataFrame, layout: T.StructType, place: tuple[str, ...] = ("query", "line_number")) -> tuple[DataFrame, DataFrame]:
    """Parse ``raw_line`` of rows that ``place`` tells apart; returns accepted rows and one row per error.

    A line with too few or too many fields is one error without a column; otherwise every field that
    does not fit its type is one.
    """
    texts = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in layout.fields] + [T.StructField(CORRUPT, T.StringType())]
    )
    parsed = raw.withColumn(
        "_fields",
        F.from_csv("raw_line", texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}),
    )
    broken = F.col(f"_fields.{CORRUPT}").isNotNull()
    checks = [
        F.when(
            F.col(f"_fields.{f.name}").isNotNull() & F.col(f"_fields.{f.name}").try_cast(f.dataType).isNull(),
            F.struct(
                F.lit(f.name).alias("colname"),
                F.col(f"_fields.{f.name}").alias("value"),
                F.lit(f"invalid {f.dataType.simpleString()}").alias("err_reason"),
            ),
        )
        for f in layout.fields
    ]
    misshapen = F.struct(
        F.lit(None).cast("string").alias("colname"),
        F.lit(None).cast("string").alias("value"),
        F.lit("wrong number of fields").alias("err_reason"),
    )
    found = parsed.withColumn(
        "_errors", F.when(broken, F.array(misshapen)).otherwise(F.array_compact(F.array(*checks)))
    )
    accepted = found.filter(F.size("_errors") == 0).select(
        *place, *[F.col(f"_fields.{f.name}").try_cast(f.dataType).alias(f.name) for f in layout.fields]
    )
    errors = found.select(*place, "raw_line", F.inline("_errors"))
    return accepted, errors


def load_error_report(errors: DataFrame, loads: DataFrame, rows: int = ERROR_REPORT_ROWS) -> DataFrame:
    """The newest rejected fields with the start time of their load."""
    return (
        errors.join(loads.select("query", "starttime"), "query")
        .orderBy(F.col("starttime").desc(), F.col("query").desc(), "line_number", F.col("colname").asc_nulls_first())
        .limit(rows)
        .select("starttime", "query", "line_number", "colname", "value", "raw_line", "err_reason")
    )


def write_check_tables(folder: str, **results: DataFrame) -> None:
    """One CSV folder per result, with readable column titles, instead of an upsert."""
    for name, rows in results.items():
        sheet = title_case_columns(rows).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        sheet.csv(f"{folder.rstrip('/')}/{name}")
