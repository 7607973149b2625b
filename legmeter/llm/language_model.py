"""Log-bilinear language model, trained with noise-contrastive estimation in numpy, and scores of whole texts.

Tokens are words with A-Z folded, and one end per text. The ``HEAD`` most frequent tokens are symbols of their own;
every other token belongs to one of ``CLASSES`` classes by its last letters, and the class is the symbol. A symbol
is predicted from the two before it: ``score(v) = (x1[a] + x2[b]) . t[v] + bias[v]``. A token inside a class has the
class's share of its smoothed count. Probabilities are normalised exactly: because the score adds up over the two
context symbols, the normaliser of all pairs of symbols is one matrix product of two exponentiated tables.

1. Training tokens are counted over all training documents (a distributed count; what it shuffles grows with the
   input). The most frequent ``LEXICON`` counts are broadcast, all others stay in a table.
2. Training runs where the data are: each task takes steps over the texts of its partition from common parameters,
   which are then averaged by tokens seen, row by row; a short round first (one document in ten), then all.
3. Scoring looks frequent tokens up in the lexicon; only the rest is joined with the table of counts.

Defined results: a null text is empty and has one token, its end; repeated rows are scored each on their own; a
null id trains; without any training document all counts are 0; an empty table gives no rows; further columns are
not read. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.llm.words import LOWER, Shared, Words, document_runs, kept_by_process, mix
from legmeter.session import materialise

HEAD, CLASSES = 1536, 512
SYMBOLS = HEAD + CLASSES
#: Most tokens whose counts are broadcast (16 bytes each).
LEXICON = 1 << 18
DIMENSIONS = 24
BATCH, NOISE = 2048, 128
RATE = 0.15
SMOOTHING = 0.1
END = np.uint64(0x5851F42D4C957F2D)
_LN10 = math.log(10)


def _classes(words: Words) -> np.ndarray:
    """Class of each word: a hash of its last three bytes before closing punctuation."""
    last = words.end - 1
    for _ in range(3):
        byte = words.data[last]
        mark = (byte < 48) | ((byte > 57) & (byte < 65))
        last = np.where(mark & (last > words.start), last - 1, last)
    key = words.data[last].astype(np.uint64)
    for back in (1, 2):
        inside = last - back >= words.start
        key |= np.where(inside, words.data[np.maximum(last - back, 0)], 0).astype(np.uint64) << np.uint64(8 * back)
    return (mix(key + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)


def tokens_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes of all tokens of a run of documents, ends included, and where each document starts."""
    starts = words.bounds + np.arange(words.documents + 1)
    hashes = np.full(starts[-1], END, dtype=np.uint64)
    classes = np.zeros(starts[-1], dtype=np.int64)
    place = np.arange(len(words.hash)) + words.row_of_word()
    hashes[place], classes[place] = words.hash, _classes(words)
    return hashes, classes, starts


def count_tokens(training: DataFrame) -> DataFrame:
    """``token, class, n`` over all texts of ``training``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [tokens_of(w)[:2] for _, w in document_runs(batch["text"], table=LOWER)]
            if not seen:
                continue
            hashes, classes = (np.concatenate(x) for x in zip(*seen))
            token, at, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(classes[at].astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["token", "class", "n"],
            )

    counted = training.select("text").mapInArrow(count, "token bigint, class int, n bigint")
    return counted.groupBy("token", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Sorted lexicon with counts and symbols, totals of all tokens and of the tail of each class."""

    token: np.ndarray
    count: np.ndarray
    symbol: np.ndarray
    total: int
    distinct: int
    class_total: np.ndarray
    class_distinct: np.ndarray

    def look_up(self, hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and count of every token; the count is -1 where the lexicon does not know it."""
        if not len(self.token):
            return HEAD + classes, np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.token, hashes), len(self.token) - 1)
        known = self.token[place] == hashes
        symbol = np.where(known, self.symbol[place], -1)
        return np.where(symbol >= 0, symbol, HEAD + classes), np.where(known, self.count[place], -1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded part of ``counts`` that tasks need."""
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    # The least count of the lexicon comes from a histogram of sizes, a row for each sixteenth of a doubling, so no
    # task ever holds more than the lexicon.
    size = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(size.alias("size")).agg(F.count("*").alias("v")).orderBy(F.desc("size")).collect()
    room, least = LEXICON, None
    for step in steps:
        room -= step.v
        if room < 0:
            break
        least = step["size"]
    chosen = counts.where(size >= least) if least is not None else counts.limit(0)
    top = chosen.toArrow().sort_by([("n", "descending"), ("token", "ascending")])
    token, n = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy()
    # The end is always a symbol of its own.
    order = np.argsort(token != END, kind="stable")
    heads = order[:HEAD] if len(order) and token[order[0]] == END else order[: HEAD - 1]
    symbol = np.full(len(token), -1)
    symbol[heads] = np.arange(len(heads))
    tails = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()  # a row per class
    class_total, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    class_total[tails["class"].to_numpy()] = tails["n"].to_numpy()
    class_distinct[tails["class"].to_numpy()] = tails["v"].to_numpy()
    np.subtract.at(class_total, top["class"].to_numpy()[heads], n[heads])
    np.subtract.at(class_distinct, top["class"].to_numpy()[heads], 1)
    place = np.argsort(token)
    return Vocabulary(token[place], n[place], symbol[place], int(totals.total or 0), int(totals.distinct or 0), class_total, class_distinct)


@dataclass
class Parameters:
    """``first`` and ``second`` have a row more than there are symbols, for the start of a text."""

    first: np.ndarray
    second: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    noise: np.ndarray

    def stacked(self) -> np.ndarray:
        return np.concatenate([self.first, self.second, np.c_[self.target]])


def initial(words: Vocabulary, seed: int = 3) -> Parameters:
    draws = np.random.default_rng(seed)
    unigram = np.full(SYMBOLS, SMOOTHING)
    np.add.at(unigram, words.symbol[words.symbol >= 0], words.count[words.symbol >= 0])
    unigram[HEAD:] += words.class_total
    unigram /= unigram.sum()
    rows = [draws.normal(0, 0.1, (SYMBOLS + more, DIMENSIONS)).astype(np.float32) for more in (1, 1, 0)]
    return Parameters(*rows, np.log(unigram).astype(np.float32), unigram)


def _contexts(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each token and the one before that; ``SYMBOLS`` before the start of a text."""
    before = np.r_[SYMBOLS, symbols[:-1]]
    earlier = np.r_[SYMBOLS, SYMBOLS, symbols[:-2]][: len(symbols)]
    begin = starts[:-1]
    before[begin] = SYMBOLS
    earlier[begin] = SYMBOLS
    second = begin + 1
    earlier[second[second < starts[1:]]] = SYMBOLS
    return before, earlier


class Trainer:
    """Noise-contrastive steps with a step size per row (falling with its squared gradients)."""

    def __init__(self, start: Parameters, seed: int) -> None:
        self.p = Parameters(start.first.copy(), start.second.copy(), start.target.copy(), start.bias.copy(), start.noise)
        self.draws = np.random.default_rng(seed)
        self.cumulative = np.cumsum(start.noise)
        self.floor = (np.log(start.noise) + math.log(NOISE)).astype(np.float32)
        self.seen = {n: np.full(len(getattr(self.p, n)), 1e-6, np.float32) for n in ("first", "second", "target", "bias")}
        self.tokens = 0

    def _step(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        rows = rows[order]
        groups = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        total, rows = np.add.reduceat(gradient[order], groups, axis=0), rows[groups]
        size = (total * total).mean(axis=1) if total.ndim > 1 else total * total
        self.seen[name][rows] += size
        rate = RATE / np.sqrt(self.seen[name][rows])
        getattr(self.p, name)[rows] += (rate[:, None] if total.ndim > 1 else rate) * total

    def learn(self, symbols: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        p = self.p
        for low in range(0, len(symbols), BATCH):
            word, a, b = (x[low : low + BATCH] for x in (symbols, before, earlier))
            noise = np.minimum(np.searchsorted(self.cumulative, self.draws.random(NOISE)), SYMBOLS - 1)
            hidden = p.first[a] + p.second[b]
            own = p.target[word]
            margin = (hidden * own).sum(axis=1) + p.bias[word] - self.floor[word]
            pull = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
            false = p.target[noise]
            margin = hidden @ false.T + (p.bias[noise] - self.floor[noise])
            push = 1 / (1 + np.exp(np.clip(-margin, -30, 30)))
            back = pull[:, None] * own - push @ false
            rows = np.r_[word, noise]
            self._step("target", rows, np.concatenate([pull[:, None] * hidden, -(push.T @ hidden)]))
            self._step("bias", rows, np.r_[pull, -push.sum(axis=0)])
            self._step("first", a, back)
            self._step("second", b, back)
            self.tokens += len(word)


def train_round(training: DataFrame, words: Vocabulary, start: Parameters, seed: int) -> Parameters:
    """One round over all texts of ``training``: steps in every task, then the mean by tokens seen."""
    shared = Shared(training.sparkSession, (words, start))
    columns = [f"v{k}" for k in range(DIMENSIONS)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, begin = shared.value
        trainer = Trainer(begin, seed * 1_000_003 + TaskContext.get().partitionId())
        for batch in batches:
            for _, found in document_runs(batch["text"], table=LOWER):
                hashes, classes, starts = tokens_of(found)
                symbols, _ = known.look_up(hashes, classes)
                trainer.learn(symbols, *_contexts(symbols, starts))
        if trainer.tokens:
            rows = trainer.p.stacked() * np.float64(trainer.tokens)
            bias = np.r_[np.zeros(2 * SYMBOLS + 2), trainer.p.bias] * trainer.tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(trainer.tokens))), pa.array(bias),
                 *(pa.array(rows[:, k]) for k in range(DIMENSIONS))],
                names=["row", "tokens", "bias", *columns],
            )

    found = training.select("text").mapInArrow(learn, "row bigint, tokens double, bias double, " + ", ".join(f"{c} double" for c in columns))
    summed = found.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("tokens", "bias", *columns))).toArrow().sort_by("row")
    if not summed.num_rows:
        return start
    tokens = summed["tokens"].to_numpy()
    rows = (np.stack([summed[c].to_numpy() for c in columns], axis=1) / tokens[:, None]).astype(np.float32)
    bias = (summed["bias"].to_numpy() / tokens)[2 * SYMBOLS + 2 :].astype(np.float32)
    return Parameters(rows[: SYMBOLS + 1], rows[SYMBOLS + 1 : 2 * SYMBOLS + 2], rows[2 * SYMBOLS + 2 :], bias, start.noise)


def normalisers(p: Parameters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Score tables of each context symbol, and the log normaliser of every pair of context symbols."""
    near, far = p.first @ p.target.T + p.bias, p.second @ p.target.T
    near_top, far_top = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
    log_z = np.log(np.maximum(np.exp(near - near_top) @ np.exp(far - far_top).T, 1e-30))
    return near, far, log_z + near_top + far_top.T, p.bias


def score_documents(documents: DataFrame, key: list[str], counts: DataFrame, words: Vocabulary, model: Parameters, name: str) -> DataFrame:
    """Columns ``key`` of ``documents`` with ``n_tokens, n_known, train_tokens, base_score, score``."""
    shared = Shared(documents.sparkSession, (words, model))
    fields = [f for f in documents.schema if f.name in key]
    base_floor = math.log10(words.total + SMOOTHING * (words.distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, p = shared.value
        tables = kept_by_process("normalisers")
        if name not in tables:
            tables.clear()
            tables[name] = normalisers(p)
        near, far, log_z, _ = tables[name]
        floor = np.log10(known.class_total + SMOOTHING * (known.class_distinct + 1))
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, found in document_runs(batch["text"], table=LOWER):
                hashes, classes, starts = tokens_of(found)
                symbols, n = known.look_up(hashes, classes)
                before, earlier = _contexts(symbols, starts)
                value = (near[before, symbols] + far[earlier, symbols] - log_z[before, earlier]).astype(float) / _LN10
                base = np.log10(np.maximum(n, 0) + SMOOTHING) - base_floor
                tail = symbols >= HEAD
                value += np.where(tail, np.log10(np.maximum(n, 0) + SMOOTHING) - floor[np.maximum(symbols - HEAD, 0)], 0.0)
                # What the lexicon does not know waits for the table of counts; here it has no part in the sums.
                rare = n < 0
                value -= np.where(rare, math.log10(SMOOTHING), 0.0)
                base -= np.where(rare, math.log10(SMOOTHING), 0.0)
                sums = [np.add.reduceat(x, starts[:-1]) for x in (value, base, (n >= 0).astype(np.int64))]
                cuts = np.searchsorted(np.flatnonzero(rare), starts)
                waiting = hashes[rare].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(at + row, at + row + found.documents)),
                     *(batch[f.name].slice(row, found.documents) for f in fields),
                     pa.array(np.diff(starts).astype(np.int64)), pa.array(sums[2]), pa.array(sums[1]), pa.array(sums[0]),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(waiting))],
                    names=["row", *(f.name for f in fields), "n_tokens", "n_known", "base_score", "score", "rare"],
                )
            at += batch.num_rows

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    scored = documents.select(*key, "text").mapInArrow(
        score, f"row bigint, {types}, n_tokens bigint, n_known bigint, base_score double, score double, rare array<bigint>"
    )
    scored = materialise(scored, "scored")
    rare = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("times"))
    found = rare.join(counts.select("token", "n"), "token", "left")
    logs = F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))
    added = found.groupBy("row").agg(
        F.sum(F.col("times") * logs).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("more_known")
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(added, "row", "left").select(
        *key,
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def score_corpus(documents: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the documents that are not ``held_out`` and score all of them."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("binary").alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = materialise(count_tokens(training), "counts")
    words = vocabulary(counts)
    draw = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(10))
    model = train_round(training.where(draw == 0), words, initial(words), 1)
    model = train_round(training, words, model, 2)
    return score_documents(rows, ["doc_id", "held_out"], counts, words, model, uuid.uuid4().hex)
