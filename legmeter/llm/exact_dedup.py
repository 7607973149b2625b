"""Exact duplicates by a stateful stream whose disk-backed state never expires.

Texts are equal when identical after lower-casing A to Z. Of equal texts the row with the largest id stays.

1. The documents are read as a stream of files. Keyed state in RocksDB holds for every digest (sha256 of the
   normalised text) the stable identifier of the row that stays, its content locator (file and row in the file) and
   how many rows had the digest. There is no watermark, so nothing expires: files that arrive later meet all earlier
   ones, and a stopped run goes on where it was, from the checkpoint. Rows are combined before the shuffle, so a text
   that a third of all rows hold is one row a task.
2. Hits, digests of more than one row, are checked on full bytes. Within a batch every row is compared with the
   batch's best row of its digest; these few are compared with the bytes that the locator in the state names. Should
   texts with one digest differ, their rows are grouped anew by the whole text.
3. Every row looks up its group in the state.

Defined results: a null text counts as empty; a null id is smaller than any other; of rows with equal text and id
one stays, the last by locator; an empty table gives no rows; further columns are not read. The files must not change
between the stream and the decision (files added meanwhile have no decision until the stream has run again).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legmeter.session import materialise, work_folder

#: Settings of the session that runs the stream: state on local disk, backed up to the checkpoint, memory bounded.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Many small stores would each reserve megabytes of disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Bytes of new files in one batch of the stream.
BATCH_BYTES = 1 << 40
#: Bytes of the digest that key the state.
KEY_BYTES = 32


def _located(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def normalised(texts: pa.Array) -> list[bytes]:
    """The texts with A to Z in lower case, as bytes; nulls are empty."""
    return pc.ascii_lower(texts.fill_null("")).cast(pa.large_binary()).to_pylist()


def _digests(rows: DataFrame) -> DataFrame:
    """``doc_id, digest, file, row`` of every row."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([hashlib.sha256(body).digest() for body in normalised(batch["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], found, batch["file"], batch["row"]], names=["doc_id", "digest", "file", "row"])

    return rows.mapInArrow(read, f"doc_id {kind}, digest binary, file string, row bigint")


def _bodies(rows: DataFrame, key_bytes: int, every: bool = False) -> DataFrame:
    """``doc_id, digest, file, row, body``: in each batch the best row of each key, and the rows that differ from it.

    A row of equal bytes needs no further look: whatever holds for the best row's bytes holds for its own.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = normalised(batch["text"])
            digests = [hashlib.sha256(body).digest() for body in bodies]
            ids, places = batch["doc_id"].to_pylist(), zip(batch["file"].to_pylist(), batch["row"].to_pylist())
            ranks = [(i is not None, i, *place) for i, place in zip(ids, places)]
            best: dict[bytes, int] = {}
            for at, digest in enumerate(digests):
                held = best.setdefault(digest[:key_bytes], at)
                if ranks[at] > ranks[held]:
                    best[digest[:key_bytes]] = at
            chosen = [at for at, digest in enumerate(digests) if every or (top := best[digest[:key_bytes]]) == at or bodies[top] != bodies[at]]
            yield pa.RecordBatch.from_arrays(
                [batch[name].take(pa.array(chosen, pa.int64())) if name in ("doc_id", "file", "row")
                 else pa.array([(digests if name == "digest" else bodies)[at] for at in chosen], pa.binary())
                 for name in ("doc_id", "digest", "file", "row", "body")],
                names=["doc_id", "digest", "file", "row", "body"],
            )

    return rows.mapInArrow(read, f"doc_id {kind}, digest binary, file string, row bigint, body binary")


def _keyed(rows: DataFrame, key_bytes: int) -> DataFrame:
    return rows.withColumn("key", F.substring("digest", 1, key_bytes))


_BEST = "max(struct(doc_id, file, row))"


def update_state(
    spark: SparkSession, path: str, checkpoint: str, doc_id: str = "doc_id", text: str = "text",
    key_bytes: int = KEY_BYTES, batch_bytes: int = BATCH_BYTES, batch_files: int | None = None,
) -> None:
    """Stream all files under ``path`` that the state at ``checkpoint`` has not seen into it."""
    session = spark.newSession()
    inherited = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    for key, value in (STATE | inherited).items():
        session.conf.set(key, value)
    # As a pattern the path may also be a single file.
    pattern = path if any(c in path for c in "*?[{") else f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    files = session.readStream.schema(spark.read.parquet(path).schema).option("maxFileAge", "36500d")
    files = files.option("maxFilesPerTrigger", batch_files) if batch_files else files.option("maxBytesPerTrigger", batch_bytes)
    rows = _keyed(_digests(_located(files.parquet(pattern), doc_id, text)), key_bytes)
    state = rows.groupBy("key").agg(F.expr(_BEST).alias("best"), F.count(F.lit(1)).alias("size"))
    # What is kept is the state; no batch needs its changes.
    (
        state.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).start().awaitTermination()
    )


def retained(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key, keep_id, keep_file, keep_row, size`` of every digest in the state."""
    state = spark.read.format("statestore").load(checkpoint).select("key.key", "value.*").toDF("key", "best", "size")
    return state.select(
        "key", F.col("best.doc_id").alias("keep_id"), F.col("best.file").alias("keep_file"), F.col("best.row").alias("keep_row"), "size"
    )


def _clashes(rows: DataFrame, groups: DataFrame, key_bytes: int) -> DataFrame:
    """Keys whose rows do not all have the bytes that the locator names."""
    hits = groups.where("size > 1").select("key", "keep_file", "keep_row")
    probes = materialise(_keyed(_bodies(rows, key_bytes), key_bytes).join(hits, "key").drop("digest", "doc_id"), "probes")
    located = probes.where("file = keep_file and row = keep_row").select("key", F.col("body").alias("kept_body"))
    return probes.join(located, "key").where("body != kept_body").select("key").distinct()


def decide(
    spark: SparkSession, path: str, checkpoint: str, doc_id: str = "doc_id", text: str = "text", key_bytes: int = KEY_BYTES
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row under ``path``, checked on full bytes."""
    rows = _located(spark.read.parquet(path), doc_id, text)
    groups = materialise(retained(spark, checkpoint), "groups")
    clashes = _clashes(rows, groups, key_bytes)
    found = _keyed(_digests(rows), key_bytes)
    answers = found
    apart = None
    if not clashes.isEmpty():
        clashes = materialise(clashes, "clashes")
        bodies = materialise(_keyed(_bodies(rows, key_bytes, every=True), key_bytes).join(clashes, "key"), "bodies")
        exact = bodies.groupBy("key", "body").agg(F.expr(_BEST).alias("best"), F.count(F.lit(1)).alias("size"))
        exact = exact.select("key", "body", F.col("best.doc_id").alias("keep_id"), F.col("best.file").alias("keep_file"), F.col("best.row").alias("keep_row"), "size")
        apart = bodies.join(exact, ["key", "body"]).drop("body")
        answers = found.join(clashes, "key", "left_anti")
    answers = answers.join(groups, "key")
    if apart is not None:
        answers = answers.unionByName(apart)
    return answers.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        F.expr("file = keep_file and row = keep_row").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """The decisions on a folder of documents with a state of its own."""
    checkpoint = work_folder(spark, "state")
    update_state(spark, path, checkpoint, doc_id, text, key_bytes)
    return decide(spark, path, checkpoint, doc_id, text, key_bytes)
