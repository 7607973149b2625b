"""Exact histogram of encoded document lengths, and what any context limit makes of the corpus.

Documents are counted by their length in ids (the end id counted) inside each task before anything is shuffled,
so the shuffle holds a row per task and distinct length. Suffix sums over the lengths then answer totals,
quantiles and truncated totals. They are taken in two levels (inside spans of lengths, then over the spans), so
no task has to hold all lengths.

Defined results: a null text is empty and has length 1; repeated rows count as often as they stand; an empty
corpus gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legmeter.llm.encoding import encoder

#: Lengths per span of the two-level sums.
SPAN = 1024


def length_histogram(documents: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``length, n_docs`` of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        seen: Counter[int] = Counter()
        for batch in batches:
            seen.update(len(encode.encode_document(body.as_py())) // 4 for body in batch["text"])
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())}
        )

    counted = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "length bigint, n bigint")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limit_table(histogram: DataFrame, span: int = SPAN) -> DataFrame:
    """A row for each distinct length, taken as a context limit.

    ``docs_at_most`` and ``tokens_at_most`` are the documents that fit and their ids, ``docs_above`` those that do
    not, ``truncated_tokens`` the ids left when every document is cut at the limit, ``lost_tokens`` the rest.
    """
    base = histogram.select(
        "length", "n_docs", F.floor(F.col("length") / span).alias("span"), (F.col("length") * F.col("n_docs")).alias("ids")
    )
    spans = base.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum("ids").alias("span_ids"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("span").alias("of_span"),
        F.coalesce(F.sum("span_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("span_ids").over(later), F.lit(0)).alias("later_ids"),
    )
    own = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    above = base.select(
        "length", "n_docs", "ids", "span",
        F.coalesce(F.sum("n_docs").over(own), F.lit(0)).alias("own_docs"),
        F.coalesce(F.sum("ids").over(own), F.lit(0)).alias("own_ids"),
    ).join(spans, F.col("span") == F.col("of_span"))
    totals = base.agg(F.sum("n_docs").alias("all_docs"), F.sum("ids").alias("all_ids"))
    docs_above, ids_above = F.col("own_docs") + F.col("later_docs"), F.col("own_ids") + F.col("later_ids")
    fits = F.col("all_ids") - ids_above
    truncated = fits + F.col("length") * docs_above
    return above.join(F.broadcast(totals)).select(
        "length",
        "n_docs",
        (F.col("all_docs") - docs_above).alias("docs_at_most"),
        docs_above.alias("docs_above"),
        fits.alias("tokens_at_most"),
        truncated.alias("truncated_tokens"),
        (F.col("all_ids") - truncated).alias("lost_tokens"),
        ((F.col("all_docs") - docs_above) / F.col("all_docs")).alias("quantile"),
    )


def quantiles(limits: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, length``: the smallest limit that holds each share of the documents."""
    picks = [F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("quantile") >= s, F.col("length"))).alias("length")) for s in shares]
    return limits.agg(F.array(*picks).alias("found")).select(F.inline("found"))


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context, tokens``: ids left when every document is cut at each of the given limits."""
    sums = [
        F.struct(F.lit(int(c)).cast("bigint").alias("context"), F.sum(F.least(F.col("length"), F.lit(int(c))) * F.col("n_docs")).alias("tokens"))
        for c in limits
    ]
    return histogram.agg(F.array(*sums).alias("found")).select(F.inline("found"))
