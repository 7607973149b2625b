"""Token ids of a corpus in a fixed-width, bit-packed table with random access.

A row of the table is a block of whole documents: ``payload`` holds their ids back to back, each in the fewest
bits that can hold the vocabulary, lowest bit first; ``doc_ids`` and ``doc_starts`` say where each document
begins in the block, ``part`` and ``first`` where the block begins in the corpus. Blocks lie in ascending
``doc_id`` order. Spark commits the files, so a lost executor costs its tasks only.

Defined results: a null text is empty (it still has its end id); null ids come first; rows that share an id are
kept, ordered by their text; an empty corpus gives an empty table; further columns are not read. A text longer
than a block makes a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legmeter.llm.encoding import encoder

#: A block is closed by the document that takes it to this many ids.
BLOCK_IDS = 1 << 16
#: Ids packed at a time where their width is not a whole number of bytes.
_STEP = 1 << 16


def id_bits(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first; the last byte is padded with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    return b"".join(
        np.packbits(((ids[at : at + _STEP, None] >> places) & 1).astype(np.uint8), bitorder="little").tobytes()
        for at in range(0, len(ids), _STEP)
    )


def unpack_ids(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a payload; only their bytes are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{bits // 8}")[start:stop].astype(np.uint32)
    found = []
    weights = np.left_shift(np.uint32(1), np.arange(bits, dtype=np.uint32))
    for at in range(start, stop, _STEP):
        end = min(at + _STEP, stop)
        low, high = at * bits // 8, -(-end * bits // 8)
        flat = np.unpackbits(np.frombuffer(payload, np.uint8)[low:high], bitorder="little")
        flat = flat[at * bits - low * 8 :][: (end - at) * bits].reshape(-1, bits)
        found.append((flat.astype(np.uint32) * weights).sum(axis=1, dtype=np.uint32))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint32)


def write_token_file(
    documents: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Encode every document and write the packed table to ``path``."""
    ordered = (
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    kind = ordered.schema["doc_id"].dataType.simpleString()
    schema = (
        "part int, block int, first bigint, n_ids bigint, bits int, "
        f"doc_ids array<{kind}>, doc_starts array<bigint>, payload binary"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bits = id_bits(encode.size)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, starts, ids, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            payload = pack_ids(np.frombuffer(b"".join(ids), dtype="<u4"), bits)
            row = [part, block, first, held, bits, doc_ids, starts, payload]
            return pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, types)], names=names)

        names, types = [], []
        for batch in batches:
            if not names:
                names = ["part", "block", "first", "n_ids", "bits", "doc_ids", "doc_starts", "payload"]
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                types += [pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.int64()), pa.binary()]
            for key, body in zip(batch["doc_id"].to_pylist(), batch["text"]):
                found = encode.encode_document(body.as_py())
                doc_ids.append(key)
                starts.append(held)
                ids.append(found)
                held += len(found) // 4
                if held >= block_ids:
                    yield closed()
                    first, block = first + held, block + 1
                    doc_ids, starts, ids, held = [], [], [], 0
        if held:
            yield closed()

    ordered.mapInArrow(pack, schema).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The packed blocks with ``block_start``, the number of ids before each in the corpus."""
    blocks = spark.read.parquet(path)
    # One row per written part: a running sum over them is small at any size of the corpus.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    # A row of two numbers per written file, so it is broadcast rather than the payloads shuffled.
    return blocks.join(F.broadcast(parts), "part").withColumn("block_start", F.col("part_start") + F.col("first"))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the table back: ``doc_id, start, n_tokens, ids_crc32`` of every document in it."""
    blocks = read_blocks(spark, path).select("block_start", "n_ids", "bits", "doc_ids", "doc_starts", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch[name][at] for name in ("block_start", "n_ids", "bits", "doc_starts", "payload")}
                starts = np.array(row["doc_starts"].as_py(), dtype=np.int64)
                ends = np.append(starts[1:], row["n_ids"].as_py())
                bits, payload = row["bits"].as_py(), row["payload"].as_py()
                sums = [
                    zlib.crc32(unpack_ids(payload, bits, low, high).astype("<u4").tobytes())
                    for low, high in zip(starts.tolist(), ends.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_ids"][at].values, pa.array(starts + row["block_start"].as_py()),
                     pa.array(ends - starts), pa.array(sums, type=pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(digest, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Random access: ids ``start`` to ``stop`` of the corpus, from the blocks that hold them."""
    rows = (
        read_blocks(spark, path)
        .where((F.col("block_start") < stop) & (F.col("block_start") + F.col("n_ids") > start))
        .select("block_start", "n_ids", "bits", "payload")
        .orderBy("block_start")
        .toLocalIterator()
    )
    found = [
        unpack_ids(bytes(r.payload), r.bits, max(0, start - r.block_start), min(r.n_ids, stop - r.block_start))
        for r in rows
    ]
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint32)
