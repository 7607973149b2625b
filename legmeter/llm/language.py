"""Language identification: averaged embeddings of hashed subwords under a linear softmax, trained in numpy.

Subwords are the 2- to 4-byte strings of the text with ASCII letters folded, white space kept as one of its
bytes (so word starts and ends count). A text is the average of its subwords' embeddings, so a whole text costs one
histogram and two small matrix products. Training runs on the driver over a bounded sample: at most about
``per_language`` documents of each language and ``MOST_SAMPLES`` in all, chosen by a hash of the document id, each sent
as the histogram of its whole text. Every label that the sample holds can be predicted. A held-back fifth of the sample sets the temperature and the score below which a
prediction is marked as rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0; every other text gets a learned
language, uncertain ones with ``rejected`` true; without any labelled document all are ``und``; repeated rows are
predicted each on their own; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.llm.words import LOWER, SPACE, Shared, arrow_texts
from legmeter.session import materialise

UNKNOWN = "und"
#: log2 of the number of subword buckets.
BUCKET_BITS = 15
#: Bounds of the training sample: documents of one language, and all together.
PER_LANGUAGE = 1500
MOST_SAMPLES = 12_000
#: Bytes looked at in one go.
_STEP = 1 << 20
_FOLD = LOWER.copy()
_FOLD[SPACE] = 32


def subword_histogram(data: np.ndarray) -> np.ndarray:
    """Counts of all hashed 2-, 3- and 4-byte strings of a text."""
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    shift = np.uint32(32 - BUCKET_BITS)
    for low in range(0, max(len(data), 1), _STEP):
        # A string is counted in the piece where it ends; later pieces begin three bytes early.
        ends = [[32]] if low + _STEP >= len(data) else []
        starts = [] if low else [[32]]
        piece = np.concatenate([*starts, _FOLD[data[max(0, low - 3) : low + _STEP]], *ends]).astype(np.uint32)
        gram = piece
        for size in range(2, 5):
            gram = (gram[:-1] << np.uint32(8)) | piece[size - 1 :]
            salt = np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)
            hashed = ((gram[4 - size if low else 0 :] * np.uint32(0x9E3779B1)) ^ salt) * np.uint32(0xC2B2AE35) >> shift
            counts += np.bincount(hashed, minlength=len(counts))
    return counts


def _documents(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = arrow_texts(column)
    for at in range(len(offsets) - 1):
        yield data[offsets[at] : offsets[at + 1]]


@dataclass
class LanguageModel:
    languages: list[str]
    embed: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, histograms: np.ndarray) -> np.ndarray:
        total = histograms.sum(axis=1, keepdims=True)
        logits = (histograms @ self.embed) / np.maximum(total, 1) @ self.out + self.bias
        logits = logits / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True)


def training_sample(labelled: DataFrame, doc_id: str, text: str, lang: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Documents of each language whose id hashes below a share that leaves about ``per_language`` of them.

    All together are at most about ``MOST_SAMPLES``: the more languages there are, the fewer of each.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"), F.xxhash64(F.col(doc_id)).alias("draw")
    )
    shares = materialise(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")  # a row per language
    each = min(per_language, MOST_SAMPLES / max(1, shares.count()))
    keep = F.pmod("draw", F.lit(1 << 30)) < F.ceil(F.lit(each * (1 << 30)) / F.col("n"))
    return rows.join(shares, "lang").where(keep)


def train(sample: DataFrame, dimension: int = 16, epochs: int = 30, least_steps: int = 1500, rate: float = 2.0, batch: int = 64, seed: int = 7) -> LanguageModel | None:
    """Stochastic gradient descent over the histograms of ``sample`` (``lang, text, draw``)."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            buckets, counts = [], []
            for body in _documents(rows["text"]):
                found = subword_histogram(body)
                buckets.append(np.flatnonzero(found).astype(np.int32))
                counts.append(found[buckets[-1]].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [rows["lang"], rows["draw"], pa.array(buckets, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["lang", "draw", "buckets", "counts"],
            )

    rows = sample.select("lang", "draw", "text").mapInArrow(
        featurise, "lang string, draw bigint, buckets array<int>, counts array<int>"
    )
    found = rows.toArrow().sort_by([("draw", "ascending"), ("lang", "ascending")])
    if not found.num_rows:
        return None
    languages = sorted(set(found["lang"].to_pylist()))
    target = np.searchsorted(languages, found["lang"].to_pylist())
    shares = []
    for buckets, counts in zip(found["buckets"], found["counts"]):
        place, weight = np.asarray(buckets.values), np.asarray(counts.values).astype(np.float32)
        shares.append((place, weight / max(1.0, weight.sum())))
    held = np.arange(len(target)) % 5 == 4
    rng = np.random.default_rng(seed)
    size, classes = 1 << BUCKET_BITS, len(languages)
    embed = (rng.standard_normal((size, dimension)) * 0.1).astype(np.float32)
    out, bias = np.zeros((dimension, classes), np.float32), np.zeros(classes, np.float32)
    learn = np.flatnonzero(~held)
    # A small sample is passed over more often.
    epochs = max(epochs, -(-least_steps // max(1, len(learn) // batch)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for rows_of in np.array_split(rng.permutation(learn), max(1, len(learn) // batch)):
            mean = np.stack([weight @ embed[place] for place, weight in (shares[r] for r in rows_of)])
            logits = mean @ out + bias
            logits -= logits.max(axis=1, keepdims=True)
            wrong = np.exp(logits)
            wrong /= wrong.sum(axis=1, keepdims=True)
            wrong[np.arange(len(rows_of)), target[rows_of]] -= 1
            wrong /= len(rows_of)
            back = wrong @ out.T
            out -= step * (mean.T @ wrong)
            bias -= step * wrong.sum(axis=0)
            for at, r in enumerate(rows_of):
                place, weight = shares[r]
                # Buckets are distinct within a document. Shares are small, so embeddings move faster.
                embed[place] -= (50 * step) * np.outer(weight, back[at])
    model = LanguageModel(languages, embed, out, bias, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else learn
    logits = np.stack([shares[r][1] @ embed[shares[r][0]] for r in check]) @ out + bias
    best = None
    for temperature in np.geomspace(0.05, 20, 61):
        scaled = logits / temperature
        scaled -= scaled.max(axis=1, keepdims=True)
        chance = np.exp(scaled) / np.exp(scaled).sum(axis=1, keepdims=True)
        loss = -np.log(chance[np.arange(len(check)), target[check]] + 1e-9).mean()
        if best is None or loss < best[0]:
            best = (loss, float(temperature), chance)
    model.temperature = best[1]
    right = best[2].argmax(axis=1) == target[check]
    # One in a hundred right predictions may be rejected.
    model.reject_below = float(np.quantile(best[2].max(axis=1)[right], 0.01)) if right.any() else 1.0
    return model


def predict(documents: DataFrame, model: LanguageModel | None, doc_id: Column, text: str = "text", **carry: Column) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` and the columns of ``carry`` for every document."""
    rows = documents.select(
        doc_id.alias("doc_id"),
        *(c.alias(n) for n, c in carry.items()),
        F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
        F.col(text).cast("binary").alias("_text"),
    )
    kept = [f for f in rows.schema.fields if not f.name.startswith("_")]
    if model is None:
        return rows.select(
            *(f.name for f in kept), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    shared = Shared(documents.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            languages, scores, texts = [], [], list(_documents(batch["_text"]))
            for low in range(0, len(texts), 64):
                chance = found.scores(np.stack([subword_histogram(x) for x in texts[low : low + 64]]).astype(np.float32))
                languages += [found.languages[k] for k in chance.argmax(axis=1)]
                scores += chance.max(axis=1).tolist()
            for at, letters in enumerate(batch["_letters"].to_pylist()):
                if not letters:
                    languages[at], scores[at] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in kept), pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([s < found.reject_below for s in scores], pa.bool_())],
                names=[*(f.name for f in kept), "lang_pred", "score", "rejected"],
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(score, f"{types}, lang_pred string, score double, rejected boolean")
