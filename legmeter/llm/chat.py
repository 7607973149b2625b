r"""Chat formatting over a prefix tree: turns that conversations share at their start are emitted once.

A conversation is the path of its turns; the key of a node is a digest of the turns down to it, so equal keys
mean equal prefixes and sorting by the path of keys walks the tree depth-first. Conversations are range
partitioned and sorted by (path, id) and each task emits sequences: the ids of every node once, a position id per
token (its depth in the conversation) and, per node, the intervals of its ancestors, which with the node itself
are what its tokens may attend to. A sequence is closed after so many ids or conversations and the next one
repeats the open path, so a first turn or a whole conversation that a third of all rows share is cut into many
sequences in many tasks.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` with control ids for the two marks. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\|`` (in roles also a line end ``\n``), so no text can forge a mark, and the change can be undone.

Defined results: turns are ordered by turn number, role and text, nulls first; a null role or text is empty; a
null conversation id is a conversation like any other; repeated rows are turns like any other; an empty table
gives no rows; further columns are not read. One conversation is held by one task, a sequence by one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legmeter.llm.encoding import encoder

# The marks of the template and their place behind the vocabulary.
START_MARK, END_MARK = "<|im_start|>", "<|im_end|>"
SEQUENCE_IDS = 8192
SEQUENCE_CONVERSATIONS = 1024


def escape(text: str, line: bool = False) -> str:
    """Undone by ``unescape``; ``line`` also takes line ends out, for roles."""
    text = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return text.replace("\n", "\\n") if line else text


def unescape(text: str) -> str:
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0 and found + 1 < len(text):
        out += [text[at:found], "\n" if text[found + 1] == "n" else text[found + 1]]
        at = found + 2
    return "".join(out) + text[at:]


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns, path``: the ordered turns of a conversation and the digest of each of its prefixes."""
    empty = F.lit("")
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), empty).alias("role"),
            F.coalesce(F.col(text).cast("string"), empty).alias("text"),
        ).alias("one"),
    )
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    digest = F.aggregate(
        "turns",
        F.array().cast("array<string>"),
        lambda path, one: F.concat(
            path,
            F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(path, F.lit(-1)), empty), F.lit("\n"), F.length(one["role"]).cast("string"), F.lit("\n"), one["role"], one["text"]), 256)),
        ),
    )
    return gathered.select("conv_id", F.col("turns"), F.when(F.size("turns") > 0, digest).alias("path"))


_SEQUENCE = (
    "ids array<int>, position_ids array<int>, loss_mask binary, node_start array<int>, node_end array<int>, "
    "node_parent array<int>, node_role array<string>, attends array<array<struct<start:int,end:int>>>, leaf array<int>"
)


def format_conversations(
    turns: DataFrame,
    tokenizer: str,
    sequence_ids: int = SEQUENCE_IDS,
    sequence_conversations: int = SEQUENCE_CONVERSATIONS,
    loss_roles: tuple[str, ...] = ("assistant",),
    **columns: str,
) -> DataFrame:
    """Sequences of prefix-tree tokens; ``conv_ids[k]`` ends in node ``leaf[k]`` of its sequence."""
    paths = conversation_paths(turns, **columns)
    kind = paths.schema["conv_id"].dataType.simpleString()
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        start_id, end_id = encode.size, encode.size + 1

        def segments(role: str, text: str) -> tuple[np.ndarray, int, int]:
            head = np.frombuffer(encode.encode(escape(role, line=True) + "\n"), dtype="<u4")
            body = np.frombuffer(encode.encode(escape(text)), dtype="<u4")
            tail = np.frombuffer(encode.encode("\n"), dtype="<u4")
            return np.concatenate([[start_id], head, body, [end_id], tail]), len(head) + 1, len(body)

        class Tree:
            def __init__(self) -> None:
                self.ids, self.positions, self.mask, self.size = [], [], [], 0
                self.start, self.end, self.parent, self.role, self.depth = [], [], [], [], []
                self.path, self.open = [], []
                self.convs, self.leaf = [], []

            def add(self, key, turns, path) -> None:
                shared = 0
                while shared < min(len(path), len(self.path)) and path[shared] == self.path[shared]:
                    shared += 1
                del self.open[shared:]
                for one in turns[shared:]:
                    found, head, body = segments(one["role"], one["text"])
                    above = self.open[-1] if self.open else -1
                    depth = self.depth[above] if above >= 0 else 0
                    mask = np.zeros(len(found), dtype=np.uint8)
                    if one["role"] in loss_roles:
                        mask[head : head + body] = 1
                    self.ids.append(found)
                    self.positions.append(np.arange(depth, depth + len(found)))
                    self.mask.append(mask)
                    self.start.append(self.size)
                    self.size += len(found)
                    self.end.append(self.size)
                    self.parent.append(above)
                    self.role.append(one["role"])
                    self.depth.append(depth + len(found))
                    self.open.append(len(self.start) - 1)
                self.path = path
                self.convs.append(key)
                self.leaf.append(self.open[-1] if self.open else -1)

            def batch(self) -> pa.RecordBatch:
                attends = []
                for parent in self.parent:
                    above = list(attends[parent]) if parent >= 0 else []
                    if above and above[-1]["end"] == self.start[parent]:
                        above[-1] = {"start": above[-1]["start"], "end": self.end[parent]}
                    elif parent >= 0:
                        above.append({"start": self.start[parent], "end": self.end[parent]})
                    attends.append(above)
                flat = lambda parts, t: np.concatenate(parts).astype(t) if parts else np.empty(0, t)
                row = [
                    flat(self.ids, np.int32), flat(self.positions, np.int32), flat(self.mask, np.uint8).tobytes(),
                    self.start, self.end, self.parent, self.role, attends, self.leaf,
                ]
                ints, spans = pa.list_(pa.int32()), pa.list_(pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                types = [ints, ints, pa.binary(), ints, ints, ints, pa.list_(pa.string()), spans, ints]
                names = [x.split()[0] for x in _SEQUENCE.replace("struct<start:int,end:int>", "s").split(", ")]
                arrays = [pa.array([self.convs], pa.list_(conv_type)), *(pa.array([v], t) for v, t in zip(row, types))]
                return pa.RecordBatch.from_arrays(arrays, names=["conv_ids", *names])

        tree, conv_type = Tree(), None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for key, turns, path in zip(batch["conv_id"].to_pylist(), batch["turns"], batch["path"]):
                tree.add(key, turns.as_py(), path.as_py() or [])
                if tree.size >= sequence_ids or len(tree.convs) >= sequence_conversations:
                    yield tree.batch()
                    tree = Tree()
        if tree.convs:
            yield tree.batch()

    return ordered.mapInArrow(emit, f"conv_ids array<{kind}>, {_SEQUENCE}")


def conversation_digests(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Read stored sequences back: turns, loss text and formatted length of every conversation, from ids alone."""
    stored = spark.read.parquet(path).select(
        "conv_ids", "ids", "loss_mask", "node_start", "node_end", "node_parent", "node_role", "leaf"
    )
    kind = stored.schema["conv_ids"].dataType.elementType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        start_id, end_id = encode.size, encode.size + 1

        def text_of(ids: np.ndarray) -> str:
            return encode.decode(ids) if len(ids) else ""

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.array(row["ids"], dtype=np.int64)
                mask = np.frombuffer(row["loss_mask"], dtype=np.uint8)
                known = {-1: (0, hashlib.sha256(), 0, hashlib.sha256(), 0)}
                for at, (low, high, parent) in enumerate(zip(row["node_start"], row["node_end"], row["node_parent"])):
                    own = ids[low:high]
                    close = int(np.flatnonzero(own == end_id)[-1])
                    inner, tail = text_of(own[1:close]), text_of(own[close + 1 :])
                    assert own[0] == start_id
                    role, _, body = inner.partition("\n")
                    n, turns, chars, loss, size = known[parent]
                    turns, loss = turns.copy(), loss.copy()
                    turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                    learned = unescape(text_of(own[mask[low:high] == 1]))
                    loss.update(learned.encode())
                    size += len(START_MARK) + len(inner) + len(END_MARK) + len(tail)
                    known[at] = (n + 1, turns, chars + len(learned), loss, size)
                nodes = [known[leaf] for leaf in row["leaf"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["conv_ids"], batch.schema.field("conv_ids").type.value_type),
                     pa.array([x[0] for x in nodes], pa.int64()),
                     pa.array([x[1].hexdigest() for x in nodes], pa.string()),
                     pa.array([x[2] for x in nodes], pa.int64()),
                     pa.array([x[3].hexdigest() for x in nodes], pa.string()),
                     pa.array([x[4] for x in nodes], pa.int64())],
                    names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                )

    return stored.mapInArrow(
        digest,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
