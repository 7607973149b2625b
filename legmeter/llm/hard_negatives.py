"""Hard negatives by an inverted multi-index whose search stops when its answer is certain.

Rows are vectors of whole numbers; a score is their inner product; higher scores come first, ties by smaller id. An
anchor's positives are its first ``POSITIVES`` other rows of the same label. For each of them the answer is the first
``NEGATIVES`` rows of another label whose score is within ``WINDOW`` per cent of the positive's.

1. Each half of the vectors has a codebook of its own, fitted by k-means to the ``SAMPLE`` rows of smallest hash; a
   pair of codewords is a cell. Every row is indexed. Only the codebooks depend on the sample, no answer does.
2. Rows are dealt by cell into shards of about ``SHARD_ROWS``, so that a cell of any size is split; anchors into blocks
   of about ``BLOCK``. Each shard meets each block once for the positives and once for the negatives.
3. In a shard, each half gives a codeword the bound ``anchor . codeword + |anchor| * radius``. A heap walks the cells
   by the sum of both bounds, from the highest. The walk ends when no cell that is left can change the answer: the
   next bound is below the last positive, and for each window below its last negative or its lower end.
4. Answers of shards are merged by rank.

Defined results: rows with a null id, label or vector, an empty vector, a null or non-finite component, one of
``LARGEST`` or more (its scores may not fit a long), or of another dimension than most rows take no part; of rows
that share an id the largest (by label, then vector) counts; a positive of negative score has no negatives; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legmeter.session import materialise

POSITIVES, NEGATIVES = 5, 3
#: Least and greatest score of a negative, in per cent of the positive's.
WINDOW = (50, 95)
#: Codewords of each half, and rows they are fitted to.
CODEWORDS, SAMPLE, ROUNDS = 32, 20_000, 10
#: Rows of the index and anchors that meet in one task.
SHARD_ROWS, BLOCK = 32_768, 4_096
LARGEST = 1 << 27
#: Rows scored in the first step of a walk; each further step takes twice as many.
FIRST_STEP = 512

Codebook = tuple[np.ndarray, np.ndarray]


def whole_numbers(vector: Column, scale: int) -> Column:
    """Each component times ``scale``, rounded down; null if any is missing, not finite or too large."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < LARGEST))
    return F.when(F.coalesce(usable, F.lit(False)) & (F.size(vector) > 0), scaled)


def _usable(rows: DataFrame) -> DataFrame:
    """One row an id, all of the most frequent dimension."""
    whole = rows.where("vec_id is not null and label is not null and vector is not null")
    single = whole.groupBy("vec_id").agg(F.max(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")
    sizes = single.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return single.where(F.size("vector") == (sizes["size"] if sizes else 0))


def _matrix(column: pa.Array | pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.empty((0, 0), kind)


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(1) - 2 * points @ words.T).argmin(1)


def _codewords(points: np.ndarray, size: int) -> np.ndarray:
    points = np.asarray(points, dtype=np.float64)
    draw = np.random.default_rng(13)
    known = np.unique(points, axis=0)
    words = known[np.sort(draw.choice(len(known), min(size, len(known)), replace=False))]
    for _ in range(ROUNDS):
        owner = _nearest(points, words)
        for k in np.unique(owner):
            words[k] = points[owner == k].mean(0)
    return words


def fit_codebooks(rows: DataFrame, codewords: int = CODEWORDS, sample: int = SAMPLE) -> Codebook | None:
    """Codewords of the first and second half of the vectors; nothing if there are no rows."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow()
    if not chosen.num_rows:
        return None
    points = _matrix(chosen["vector"])
    half = points.shape[1] // 2
    return _codewords(points[:, :half], codewords), _codewords(points[:, half:], codewords)


def _indexed(rows: DataFrame, books: Codebook) -> DataFrame:
    """``vec_id, label, vector, cell`` of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    left, right = books

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch["vector"])
            if len(points):
                cell = _nearest(points[:, : left.shape[1]], left) * len(right) + _nearest(points[:, left.shape[1] :], right)
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], batch["vector"], pa.array(cell, pa.int32())], names=["vec_id", "label", "vector", "cell"])

    return rows.select("vec_id", "label", "vector").mapInArrow(
        assign, f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector array<bigint>, cell int"
    )


class Shard:
    """Rows of one shard by cell, with the bounds of its codewords."""

    def __init__(self, table: pa.Table, books: Codebook) -> None:
        cells = np.asarray(table["cell"].combine_chunks())
        order = np.argsort(cells, kind="stable")
        self.vectors = _matrix(table["vector"], np.int64)[order]
        self.ids = np.asarray(table["vec_id"].combine_chunks())[order]
        self.labels = np.asarray(table["label"].combine_chunks())[order]
        cells = cells[order]
        self.books, self.half = books, books[0].shape[1]
        self.width = len(books[1])
        self.starts = np.searchsorted(cells, np.arange(len(books[0]) * self.width + 1)).tolist()
        self.radii, self.present = [], []
        for side, owner in enumerate((cells // self.width, cells % self.width)):
            part = self.vectors[:, : self.half] if not side else self.vectors[:, self.half :]
            apart = np.sqrt(((part - books[side][owner]) ** 2).sum(1))
            radius = np.zeros(len(books[side]))
            np.maximum.at(radius, owner, apart)
            self.radii.append(radius)
            self.present.append(np.unique(owner))
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.exact: dict[type, np.ndarray] = {}

    def _scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products: by floating point as long as every sum is a whole number that it can hold."""
        most = self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor)
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        if kind not in self.exact:
            self.exact[kind] = self.vectors.astype(kind)
        return (self.exact[kind][rows] @ anchor.astype(kind)).astype(np.int64)

    def _bounds(self, anchor: np.ndarray, side: int) -> tuple[list[float], list[int]]:
        """Bounds of the codewords of one half from the highest, and the codewords."""
        part = (anchor[: self.half] if not side else anchor[self.half :]).astype(np.float64)
        words, radius = self.books[side], self.radii[side]
        size = np.sqrt((part**2).sum())
        # A little is added for the rounding of the bound itself.
        slack = 1e-9 * size * (np.sqrt((words**2).sum(1)) + radius) + 1e-6
        bound = (words @ part + size * radius + slack)[self.present[side]]
        order = np.argsort(-bound)
        return bound[order].tolist(), self.present[side][order].tolist()

    def walk(self, anchor: np.ndarray, done: Callable[[float], bool], take: Callable[[np.ndarray, np.ndarray], None]) -> int:
        """Score cells from the highest bound on, until ``done`` for all scores up to the next bound; rows scored."""
        (up, left), (across, right) = self._bounds(anchor, 0), self._bounds(anchor, 1)
        heap, waiting, size, step, scored = [(-(up[0] + across[0]), 0, 0)], [], 0, FIRST_STEP, 0
        while heap:
            bound, i, j = heapq.heappop(heap)
            if size >= step or not size:
                if size:
                    rows = np.concatenate(waiting)
                    take(rows, self._scores(rows, anchor))
                    scored, waiting, size, step = scored + size, [], 0, 2 * step
                if done(-bound):
                    return scored
            # Each cell is reached once: from above, and in the first row from the left.
            if i + 1 < len(left):
                heapq.heappush(heap, (-(up[i + 1] + across[j]), i + 1, j))
            if not i and j + 1 < len(right):
                heapq.heappush(heap, (-(up[0] + across[j + 1]), 0, j + 1))
            cell = left[i] * self.width + right[j]
            low, high = self.starts[cell], self.starts[cell + 1]
            if low < high:
                waiting.append(np.arange(low, high))
                size += high - low
        if size:
            rows = np.concatenate(waiting)
            take(rows, self._scores(rows, anchor))
        return scored + size

    def _first(self, held: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
        best = np.lexsort((ids, -scores))[:most]
        return scores[best], ids[best]

    def positives(self, anchor: np.ndarray, own: int, label, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the first rows of the anchor's label, without the anchor."""
        found = [(np.empty(0, np.int64), self.ids[:0])]

        def take(rows: np.ndarray, scores: np.ndarray) -> None:
            fit = (self.labels[rows] == label) & (self.ids[rows] != own)
            found[0] = self._first(found[0], scores[fit], self.ids[rows[fit]], most)

        self.walk(anchor, lambda bound: len(found[0][0]) == most and bound < found[0][0][-1], take)
        return found[0]

    def negatives(self, anchor: np.ndarray, label, windows: list[tuple[int, int]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores, the first rows of another label in it."""
        found = [(np.empty(0, np.int64), self.ids[:0])] * len(windows)

        def take(rows: np.ndarray, scores: np.ndarray) -> None:
            other = self.labels[rows] != label
            rows, scores = rows[other], scores[other]
            for at, (low, high) in enumerate(windows):
                fit = (scores >= low) & (scores <= high)
                found[at] = self._first(found[at], scores[fit], self.ids[rows[fit]], most)

        def done(bound: float) -> bool:
            return all(bound < low or len(held[0]) == most and bound < held[0][-1] for (low, _), held in zip(windows, found))

        self.walk(anchor, done, take)
        return found


def window_of(score: int, window: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """Least and greatest whole score of a negative: ``window`` per cent of the positive's."""
    return -(-window[0] * score // 100), window[1] * score // 100


def _dealt(index: DataFrame, anchors: DataFrame, shard_rows: int, block: int) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """A function that gives the index and some anchors by ``shard, block``, so that each pair of them meets once."""
    spark = index.sparkSession
    counts = sorted((row["cell"], row["count"]) for row in index.groupBy("cell").count().collect())  # CODEWORDS squared at most
    starts, total = [], 0
    for cell, size in counts:
        starts.append((cell, total, size))
        total += size
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-anchors.count() // block))
    places = spark.createDataFrame(starts, "cell int, first bigint, size bigint")
    spread = F.pmod(F.xxhash64("vec_id"), F.col("size"))
    rows = index.join(F.broadcast(places), "cell").withColumn("shard", F.floor((F.col("first") + spread) / shard_rows).cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("first", "size")

    def deal(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
        placed = asked.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
        return rows, placed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    return deal


def _search(rows: DataFrame, asked: DataFrame, answer: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(answer, schema)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW, codewords: int = CODEWORDS, shard_rows: int = SHARD_ROWS, block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` picks.

    ``vectors`` has ``vec_id``, ``label`` and ``vector``, an array of whole numbers.
    """
    spark = vectors.sparkSession
    rows = materialise(_usable(vectors.select("vec_id", "label", F.col("vector").cast("array<bigint>").alias("vector"))), "vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    answer_schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
    books = fit_codebooks(rows, codewords)
    if books is None:
        return spark.createDataFrame([], answer_schema)
    index = materialise(_indexed(rows, books), "index")
    chosen = rows.where(anchors).select(F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("vector").alias("anchor"))
    deal = _dealt(index, chosen, shard_rows, block)
    ids = pa.int64()

    def seek_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": []}
        if left.num_rows and right.num_rows:
            shard = Shard(left, books)
            for own, label, anchor in zip(right["anchor_id"].to_pylist(), right["anchor_label"].to_pylist(), _matrix(right["anchor"], np.int64)):
                scores, others = shard.positives(anchor, own, label, positives)
                found["anchor_id"] += [own] * len(scores)
                found["positive_id"] += others.tolist()
                found["positive_score"] += scores.tolist()
        return pa.table({name: pa.array(values, ids) for name, values in found.items()})

    part = _search(*deal(chosen), seek_positives, "anchor_id bigint, positive_id bigint, positive_score bigint")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = materialise(part.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives).drop("rank"), "positives")
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = chosen.join(lists, "anchor_id")

    def seek_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": [], "negative_id": [], "negative_score": []}
        if left.num_rows and right.num_rows:
            shard = Shard(left, books)
            for own, label, anchor, pairs in zip(
                right["anchor_id"].to_pylist(), right["anchor_label"].to_pylist(), _matrix(right["anchor"], np.int64), right["positives"].to_pylist()
            ):
                pairs = [p for p in pairs if p["positive_score"] >= 0]
                answers = shard.negatives(anchor, label, [window_of(p["positive_score"], window) for p in pairs], negatives)
                for pair, (scores, others) in zip(pairs, answers):
                    found["anchor_id"] += [own] * len(scores)
                    found["positive_id"] += [pair["positive_id"]] * len(scores)
                    found["positive_score"] += [pair["positive_score"]] * len(scores)
                    found["negative_id"] += others.tolist()
                    found["negative_score"] += scores.tolist()
        return pa.table({name: pa.array(values, ids) for name, values in found.items()})

    part = _search(*deal(asked), seek_negatives, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("anchor_id").cast(kind), F.col("positive_id").cast(kind), F.col("rank").cast("int"), F.col("negative_id").cast(kind), "positive_score", "negative_score"
    )
