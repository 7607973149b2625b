"""Pack documents into sequences of a fixed length by cutting stock.

Each document is encoded once and cut into full sequences and one rest. Pieces are counted by size class
(``UNIT`` ids wide, rounded up); short pieces of one length are bundled first, as many as fill whole units, so that
rounding costs next to nothing at any length. On the driver, column generation solves the linear program over patterns of
classes: its size depends on the number of classes alone, never on the corpus. A knapsack dynamic program prices
new patterns. Pattern counts are rounded down, what is left over is packed first-fit by falling size, and each
class's pieces take the places of their class in the order of their rank. Ranks come from a running count inside
each task plus the counts of the tasks before it, so a size that a third of all documents share is no hot spot.

Defined results: a null text is empty and becomes a piece of one id (the end id); repeated rows are packed as
often as they stand; an empty corpus gives no rows; further columns are not read; a text of any length is cut.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legmeter.llm.encoding import encoder
from legmeter.session import materialise

SEQUENCE = 4096
UNIT = 8
#: Pieces up to this many ids are counted by their length and bundled.
SHORT = 256
#: Column generation stops when the linear program is within this share of its lower bound.
GAP = 1e-3
_MOST_PIVOTS = 6000

_PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, kind int, local_rank bigint"


def _short(sequence: int, unit: int) -> int:
    """A bundle of ``unit`` short pieces must fit."""
    return min(SHORT, sequence // unit)


def cut_documents(documents: DataFrame, tokenizer: str, doc_id: str, text: str, sequence: int, unit: int) -> DataFrame:
    """Pieces of all documents, with their kind and their rank in that kind among the pieces of the same task.

    The kind of a short piece is its length, that of others their size class after ``SHORT``.
    """
    short = _short(sequence, unit)
    plain = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        ranks: Counter[int] = Counter()
        for batch in batches:
            of_row, out = [], {n: [] for n in ("start", "length", "ids_crc32", "doc_tokens", "kind", "local_rank")}
            for row, body in enumerate(batch["text"]):
                ids = memoryview(encode.encode_document(body.as_py()))
                tokens = len(ids) // 4
                for start in range(0, tokens, sequence):
                    length = min(sequence, tokens - start)
                    piece = length if length <= short else short - (-length // unit)
                    of_row.append(row)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
                    out["doc_tokens"].append(tokens)
                    out["kind"].append(piece)
                    out["local_rank"].append(ranks[piece])
                    ranks[piece] += 1
            long = {n: pa.array(v, pa.int32() if n == "kind" else pa.int64()) for n, v in out.items()}
            long["part"] = pa.array([part] * len(of_row), pa.int32())
            names = [x.split()[0] for x in _PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(of_row, pa.int64())), *(long[n] for n in names)], names=["doc_id", *names]
            )

    return plain.mapInArrow(cut, f"doc_id {kind}, {_PIECE}")


def best_pattern(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of sizes ``1..len(value)`` within ``capacity`` that is worth most."""
    gain, worth = np.maximum(value, 0.0), np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        most = min(room, len(gain))
        offers = worth[room - most : room][::-1] + gain[:most]
        choice[room] = best = int(np.argmax(offers))
        worth[room] = offers[best]
    pattern, room = np.zeros(len(value), dtype=np.int64), capacity
    while room > 0:
        size = choice[room] + 1
        if gain[size - 1] > 0:
            pattern[size - 1] += 1
        room -= size
    return float(worth[capacity]), pattern


def cutting_stock(demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[int, dict[int, int]]]:
    """``(times, {size: pieces})`` that place all of ``demand[size - 1]`` pieces of each size exactly."""
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    wanted = demand[sizes - 1].astype(float)
    fits = capacity // sizes
    patterns = [{int(s): int(f)} for s, f in zip(sizes, fits)]
    inverse, level = np.diag(1.0 / fits), wanted / fits
    for _ in range(_MOST_PIVOTS):
        duals = inverse.sum(axis=0)
        value = np.zeros(capacity)
        value[sizes - 1] = duals
        worth, pattern = best_pattern(value, capacity)
        if worth <= 1 + gap:
            break
        column = inverse @ pattern[sizes - 1]
        able = np.flatnonzero(column > 1e-9)
        out = able[np.argmin(level[able] / column[able])]
        step = level[out] / column[out]
        level -= step * column
        level[out] = step
        np.maximum(level, 0.0, out=level)
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        patterns[out] = {int(s): int(pattern[s - 1]) for s in sizes if pattern[s - 1]}
    left = {int(s): int(n) for s, n in zip(sizes, demand[sizes - 1])}
    plan = []
    for times, held in sorted(zip(level, patterns), key=lambda x: -x[0]):
        whole = min([int(times + 1e-6), *(left[s] // n for s, n in held.items())])
        if whole > 0:
            plan.append((whole, held))
            for size, n in held.items():
                left[size] -= whole * n
    bins: list[tuple[dict[int, int], int]] = []
    room = np.empty(0, dtype=np.int64)
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            able = np.flatnonzero(room >= size)
            if not len(able):
                bins.append(({}, 0))
                room, at = np.append(room, capacity), len(bins) - 1
            else:
                at = int(able[np.argmin(room[able])])
            bins[at][0][size] = bins[at][0].get(size, 0) + 1
            room[at] -= size
    return plan + [(1, held) for held, _ in bins]


def pack(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, unit: int = UNIT
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    spark = documents.sparkSession
    pieces = materialise(cut_documents(documents, tokenizer, doc_id, text, sequence, unit), "pieces")
    counts = pieces.groupBy("kind", "part").agg(F.count("*").alias("n"))
    totals = {row.kind: row.n for row in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # a row a kind
    short, capacity = _short(sequence, unit), -(-sequence // unit)
    demand = np.zeros(capacity, dtype=np.int64)
    kinds = []
    for kind, n in sorted(totals.items()):
        length = min(kind, short)
        # So many pieces of one length fill whole units; what is left over is rounded up.
        each = unit // math.gcd(length, unit) if kind <= short else 1
        bundles = n // each if kind <= short else 0
        bundle_class, rest_class = each * length // unit, -(-kind // unit) if kind <= short else kind - short
        first = int(demand[bundle_class - 1]) if bundles else 0
        if bundles:
            demand[bundle_class - 1] += bundles
        kinds.append((kind, each, bundles, bundle_class, first, rest_class, int(demand[rest_class - 1])))
        demand[rest_class - 1] += n - bundles * each
    places, taken, sequences = [], [0] * (capacity + 1), 0
    for times, held in cutting_stock(demand, capacity):
        for size, n in held.items():
            places.append((size, taken[size], taken[size] + times * n, n, sequences))
            taken[size] += times * n
        sequences += times
    # At most a few places for each class, and a row for each kind, whatever the corpus.
    layout = spark.createDataFrame(
        places or [], "size_class int, from_rank bigint, to_rank bigint, each bigint, first_sequence bigint"
    )
    named = spark.createDataFrame(
        kinds or [], "kind int, bundled bigint, bundles bigint, bundle_class int, bundle_rank bigint, rest_class int, rest_rank bigint"
    )
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("kind", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["kind", "part"]).withColumn("nth", F.col("earlier") + F.col("local_rank")).join(F.broadcast(named), "kind")
    inside = F.col("nth") < F.col("bundles") * F.col("bundled")
    ranked = ranked.withColumns(
        {
            "size_class": F.when(inside, F.col("bundle_class")).otherwise(F.col("rest_class")),
            "rank": F.when(inside, F.col("bundle_rank") + F.expr("nth div bundled")).otherwise(F.col("rest_rank") + F.col("nth") - F.col("bundles") * F.col("bundled")),
        }
    )
    at = ranked.join(F.broadcast(layout), "size_class").where("rank >= from_rank and rank < to_rank")
    placed = at.withColumn("sequence_id", F.expr("first_sequence + (rank - from_rank) div each"))
    along = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("size_class"), "rank", "nth")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(along), F.lit(0)).alias("offset"),
    )
