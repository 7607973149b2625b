"""Remove word sequences that an earlier document already holds, by suffix automata of reference shards.

A window is ``window`` consecutive words of one document; a word goes if a window that covers it also stands in a
document with a smaller id. Steps, each linear in the text:

1. One scan digests each document and takes its anchors: of every window the word string of ``ANCHOR`` words with
   the smallest hash, so equal windows have equal anchors and only about one string in ``window / 3`` is kept.
   Whole copies (equal digests) are settled here: only the first of them goes on.
2. Anchors that two documents share name the candidate windows; these are counted by their hashes, which gives
   each repeated window its first document.
3. The words of first occurrences are the reference. It is dealt into shards of bounded size, each becomes a suffix
   automaton whose states know their first document, and the stretches of later documents stream through the
   shards of their first documents for matching statistics. Only words of maximal spans of at least ``window``
   matched words go, so hashes choose candidates and exact words decide. Shards that many documents stream
   through are repeated over salts; a passage that a third of all documents hold is no hot spot.

Defined results: a null text has no words; documents of fewer words than a window lose nothing; a null id is
never smaller, so its document keeps all and removes nothing elsewhere; rows with the same id do not remove
each other's words and each lose what stands in smaller ids (texts of one id are told apart by a 64-bit hash);
repeated rows are each answered; an empty table gives no rows; further columns are carried
along by ``strip_documents``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.llm.words import Words, document_runs
from legmeter.session import materialise

WINDOW = 50
ANCHOR = 17
#: Words of the reference in one automaton, and words that stream through one copy of it.
SHARD_WORDS = 100_000
STREAM_WORDS = 400_000
#: Words of one piece of a passage.
STRETCH_WORDS = 20_000
#: Bytes of text whose words and windows a task has in memory at a time.
_RUN_BYTES = 1 << 19
#: What tells a row's text from others: rows that share an id are cut each by its own text.
ROW = ("doc_id", "content")


class SuffixAutomaton:
    """Suffix automaton of several word lists; a state knows the first document that holds its strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, length: int, first: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, at: int, symbol: int, old: int) -> int:
        """The state of exactly the longest string at ``at`` followed by ``symbol``."""
        if self.length[old] == self.length[at] + 1:
            return old
        twin = self._state(self.length[at] + 1, self.first[old])
        self.next[twin] = dict(self.next[old])
        self.link[twin], self.link[old] = self.link[old], twin
        while at >= 0 and self.next[at].get(symbol) == old:
            self.next[at][symbol] = twin
            at = self.link[at]
        return twin

    def add(self, symbols: list[int], document: int) -> None:
        """Add a word list; documents must come in ascending order."""
        last = 0
        for symbol in symbols:
            old = self.next[last].get(symbol)
            if old is not None:
                last = self._split(last, symbol, old)
                continue
            fresh, at = self._state(self.length[last] + 1, document), last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = fresh
                at = self.link[at]
            self.link[fresh] = 0 if at < 0 else self._split(at, symbol, self.next[at][symbol])
            last = fresh

    def spans(self, symbols: list[int], least: int, before: int) -> list[tuple[int, int]]:
        """Maximal spans of strings of ``least`` symbols that a document smaller than ``before`` holds."""
        step, link, length, first = self.next, self.link, self.length, self.first
        found: list[tuple[int, int]] = []
        state, matched = 0, 0
        for end, symbol in enumerate(symbols, 1):
            while state and symbol not in step[state]:
                state = link[state]
                matched = length[state]
            target = step[state].get(symbol)
            if target is None:
                matched = 0
                continue
            state, matched = target, matched + 1
            # The shortest suffix that is long enough decides; longer ones cannot stand in more documents.
            while length[link[state]] >= least:
                state = link[state]
                matched = length[state]
            if matched >= least and first[state] < before:
                if found and found[-1][1] >= end - least:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((end - least, end))
        return found


def _sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, by doubling."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _window_anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and the smallest hash of an ``ANCHOR``-word string in it."""
    _, first = words.windows(window)
    if not len(first):
        return first, np.empty(0, dtype=np.uint64)
    size = min(ANCHOR, window)
    grams, at = words.windows(size)
    dense = np.full(len(words.hash), np.iinfo(np.uint64).max, dtype=np.uint64)
    dense[at] = grams
    return first, _sliding_minimum(dense, window - size + 1)[first]


def joined(words: Words, row: int, gone: list[tuple[int, int]] = ()) -> bytes:
    """Words of a document with one space between, without those in the spans ``gone`` (counted in the document)."""
    low, high = int(words.bounds[row]), int(words.bounds[row + 1])
    if low == high:
        return b""
    base = int(words.start[low])
    text = words.data[base : int(words.end[high - 1])].tobytes()
    if not gone:
        return b" ".join(text.split())
    kept = text.split()
    for start, end in sorted(gone, reverse=True):
        del kept[start:end]
    return b" ".join(kept)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def scan(documents: DataFrame, window: int) -> DataFrame:
    """``doc_id, content`` (hash of the text) ``, n_words, body`` (digest of the words) ``, anchors`` of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in document_runs(batch["text"], _RUN_BYTES):
                first, smallest = _window_anchors(words, window)
                cuts = np.searchsorted(first, words.bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(row, words.documents), batch["content"].slice(row, words.documents),
                     pa.array(np.diff(words.bounds).astype(np.int64)),
                     pa.array([hashlib.sha256(joined(words, d)).hexdigest() for d in range(words.documents)]),
                     pa.array([np.unique(smallest[a:b]).view(np.int64) for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64()))],
                    names=["doc_id", "content", "n_words", "body", "anchors"],
                )

    return documents.mapInArrow(read, f"doc_id {kind}, content bigint, n_words bigint, body string, anchors array<bigint>")


def _candidate_windows(candidates: DataFrame, window: int) -> DataFrame:
    """``window, doc_id, content`` of the windows whose anchor another document shares."""
    kind = candidates.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in document_runs(batch["text"], _RUN_BYTES):
                hashes, first = words.windows(window)
                _, smallest = _window_anchors(words, window)
                cuts = np.searchsorted(first, words.bounds)
                for d, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    shared = np.asarray(batch["anchors"][row + d].values).view(np.uint64)
                    found = np.unique(hashes[a:b][np.isin(smallest[a:b], shared)])
                    if len(found):
                        at = pa.array(np.full(len(found), row + d))
                        yield pa.RecordBatch.from_arrays([_signed(found), *(batch[k].take(at) for k in ROW)], names=["window", *ROW])

    return candidates.select(*ROW, "text", "anchors").mapInArrow(read, f"window bigint, doc_id {kind}, content bigint")


def _stretches(candidates: DataFrame, window: int) -> DataFrame:
    """Runs of repeated windows with one first document: ``owner, doc_id, content, start, n_words, words``.

    ``candidates`` has ``doc_id, content, text, found`` with ``found`` the repeated windows of the text and their owners. Runs of
    more than ``STRETCH_WORDS`` are cut; a piece begins ``window - 1`` words before the last one's end, so no window is cut.
    """
    kind = candidates.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in document_runs(batch["text"], _RUN_BYTES):
                hashes, first = words.windows(window)
                cuts = np.searchsorted(first, words.bounds)
                for d, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    found = batch["found"][row + d].values
                    known = np.asarray(found.field("window")).view(np.uint64)
                    order = np.argsort(known)
                    known, owner = known[order], np.asarray(found.field("owner"))[order]
                    place = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                    repeated = known[place] == hashes[a:b]
                    at, owners = np.flatnonzero(repeated), owner[place][repeated]
                    if not len(at):
                        continue
                    breaks = np.flatnonzero((np.diff(at) > 1) | (owners[1:] != owners[:-1])) + 1
                    low, high = at[np.r_[0, breaks]], at[np.r_[breaks - 1, len(at) - 1]] + window
                    low, high, owned = _cut(low, high, owners[np.r_[0, breaks]], window)
                    base = int(words.bounds[d])
                    texts = [
                        words.data[words.start[base + x] : words.end[base + y - 1]].tobytes() for x, y in zip(low, high)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owned), *(batch[k].take(pa.array(np.full(len(low), row + d))) for k in ROW),
                         pa.array(low.astype(np.int64)), pa.array((high - low).astype(np.int64)), pa.array(texts, pa.binary())],
                        names=["owner", *ROW, "start", "n_words", "words"],
                    )

    return candidates.select(*ROW, "text", "found").mapInArrow(
        read, f"owner {kind}, doc_id {kind}, content bigint, start bigint, n_words bigint, words binary"
    )


def _cut(low: np.ndarray, high: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step = STRETCH_WORDS - window + 1
    pieces = np.maximum(-(-(high - low - window + 1) // step), 1)
    inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(low, pieces) + inside * step
    return first, np.minimum(first + STRETCH_WORDS, np.repeat(high, pieces)), np.repeat(owner, pieces)


def _confirmed(stretches: DataFrame, window: int) -> DataFrame:
    """``doc_id, content, spans`` after streaming the stretches of later documents through the automata of first ones."""
    kind = stretches.schema["doc_id"].dataType.simpleString()
    later = F.col("doc_id") > F.col("owner")
    reference, stream = stretches.where(~later), stretches.where(later)
    # The number of shards follows the size of the reference; one row is read.
    size = reference.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("owner", "part"), F.lit(shards)).alias("shard")
    # The reference of a very long first document goes to several shards, and what names it is streamed through all.
    parts = reference.groupBy("owner").agg(F.ceil(F.sum("n_words") / SHARD_WORDS).cast("int").alias("parts"))
    reference = reference.join(parts, "owner").withColumn("part", F.pmod(F.xxhash64("content", "start"), F.col("parts")).cast("int"))
    stream = stream.join(parts, "owner").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    stream, reference = stream.select("*", shard), reference.select("*", shard)
    load = stream.groupBy("shard").agg(F.ceil(F.sum("n_words") / STREAM_WORDS).cast("int").alias("salts"))
    salted = stream.join(load, "shard").withColumn("salt", F.pmod(F.xxhash64("doc_id", "content", "start"), F.col("salts")).cast("int"))
    copied = reference.join(load, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    columns = ("shard", "salt", *ROW, "start", "words")
    dealt = copied.select(*columns, F.lit(True).alias("known")).union(salted.select(*columns, F.lit(False)))

    def match(group: pa.Table) -> pa.Table:
        automaton, symbols = SuffixAutomaton(), {}
        left, right = group.filter(pc.field("known")), group.filter(~pc.field("known"))
        for document, words in sorted(zip(left["doc_id"].to_pylist(), left["words"].to_pylist()), key=lambda x: x[0]):
            automaton.add([symbols.setdefault(w, len(symbols)) for w in words.split()], document)
        rows, spans = [], []
        for at, (document, start, words) in enumerate(zip(right["doc_id"].to_pylist(), right["start"].to_pylist(), right["words"].to_pylist())):
            found = automaton.spans([symbols.get(w, -1) for w in words.split()], window, document)
            if found:
                rows.append(at)
                spans.append([{"start": a + start, "end": b + start} for a, b in found])
        at = pa.array(rows, pa.int64())
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({**{k: right[k].take(at) for k in ROW}, "spans": pa.array(spans, kinds)})

    # The join by shard would do for the groups, but then all salts of a shard were in one task.
    matched = dealt.repartition("shard", "salt").groupBy("shard", "salt").applyInArrow(
        match, f"doc_id {kind}, content bigint, spans array<struct<start:bigint,end:bigint>>"
    )
    return matched.groupBy(*ROW).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeated_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(scanned, spans)``: a row ``doc_id, content, n_words, body, copy_of`` for every document, and the words to remove.

    ``copy_of`` is the smallest id with the same words, for documents of at least ``window`` words; ``spans`` has
    ``doc_id, content, spans`` for documents that are no such copies themselves.
    """
    rows = _rows(documents, doc_id, text)
    scanned = materialise(scan(rows, window), "scan")
    long = scanned.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    # Of rows with the same words one goes on, a text among those of the smallest id.
    heads = long.groupBy("body").agg(F.min(F.struct(*ROW)).alias("head")).select("body", "head.*")
    firsts = heads.select("body", F.col("doc_id").alias("copy_of"))
    settled = materialise(
        scanned.select(*ROW, "n_words", "body", F.when((F.col("n_words") >= window) & F.col("doc_id").isNotNull(), F.col("body")).alias("_body"))
        .join(firsts.withColumnRenamed("body", "_body"), "_body", "left")
        .drop("_body"),
        "copies",
    )
    # Repeated rows have the same anchors; as a set they count once.
    anchors = materialise(long.join(heads, ["body", *ROW]).select(*ROW, F.explode("anchors").alias("anchor")), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    listed = anchors.join(shared.select("anchor"), "anchor").groupBy(*ROW).agg(F.collect_set("anchor").alias("anchors"))
    candidates = materialise(rows.join(listed, list(ROW)), "candidates")
    windows = materialise(_candidate_windows(candidates, window), "windows")
    first = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high")).where("owner < high")
    found = (
        windows.join(first.select("window", "owner"), "window")
        .groupBy(*ROW)
        .agg(F.collect_set(F.struct("window", "owner")).alias("found"))
    )
    stretches = materialise(_stretches(candidates.drop("anchors").join(found, list(ROW)), window), "stretches")
    return settled, _confirmed(stretches, window)


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.col(f"`{text}`").cast("binary")
    return documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("content"), body.alias("text"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def strip_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``documents`` with the repeated words taken out of ``text``: kept words joined by one space.

    Documents that lose nothing keep their text as it was; columns and their order do not change.
    """
    settled, spans = repeated_spans(documents, doc_id, text, window)
    copies = settled.where("doc_id > copy_of").select(*ROW, F.lit(True).alias("copy")).distinct()
    changes = spans.join(copies, list(ROW), "full")
    names = documents.columns
    body = F.col(f"`{text}`").cast("binary")
    packed = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("content"), F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"), body.alias("text"))
    touched = packed.join(changes, list(ROW), "left")
    kept = _without(touched.select("row", "text", "spans", "copy"), window)
    return kept.select(*(F.coalesce("new_text", F.col("row")[n]).cast(documents.schema[n].dataType).alias(n) if n == text else F.col("row")[n].alias(n) for n in names))


def _without(rows: DataFrame, window: int) -> DataFrame:
    kind = rows.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, copies = batch["spans"].to_pylist(), batch["copy"].to_pylist()
            new: list[str | None] = [None] * batch.num_rows
            for at, (gone, copy) in enumerate(zip(spans, copies)):
                if copy and len(batch["text"][at].as_py().split()) >= window:
                    new[at] = ""
                elif gone:
                    kept = batch["text"][at].as_py().split()
                    for start, end in reversed(_merged(gone)):
                        del kept[start:end]
                    new[at] = b" ".join(kept).decode()
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(new, pa.string())], names=["row", "new_text"])

    return rows.mapInArrow(cut, f"row {kind}, new_text string")


def removal_digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document, without moving texts that stay whole."""
    settled, spans = repeated_spans(documents, doc_id, text, window)
    rows = _rows(documents, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, after = [], []
            for body, gone in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                kept = (body or b"").split()
                size = len(kept)
                for start, end in reversed(_merged(gone)):
                    del kept[start:end]
                removed.append(size - len(kept))
                after.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch[k] for k in ROW), pa.array(removed, pa.int64()), pa.array(after)], names=[*ROW, "n_removed", "kept_sha256"]
            )

    changed = rows.join(spans, list(ROW)).mapInArrow(digest, f"doc_id {kind}, content bigint, n_removed bigint, kept_sha256 string")
    changed = changed.dropDuplicates(list(ROW))
    whole = F.coalesce(F.col("doc_id") > F.col("copy_of"), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    return settled.join(changed, list(ROW), "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "body")).alias("kept_sha256"),
    )
