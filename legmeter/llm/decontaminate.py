"""Benchmark decontamination by latent semantic retrieval, then subsequence and answer checks.

Texts are words with ASCII letters folded and punctuation dropped, hashed into ``TERMS`` terms. Three scans, none
with a shuffle of texts:

1. Terms are counted over all documents for their inverse frequency.
2. Randomised SVD of all passages (``BLOCK`` words each) by term: every task adds up ``A'(A R)`` of its passages for
   one shared random ``R``; the sums, ``TERMS`` rows whatever the corpus, give the leading right singular vectors
   on the driver (one-pass Nystrom form).
3. Windows of two, four, eight, ... blocks of ``BLOCK`` words, each item in the scale of its own length, slide over
   every whole text; those whose latent vector is close to a benchmark item's are candidates. A candidate counts if
   the longest common subsequence of the item and the window with its margins covers ``LEAST_COMMON`` of the item's
   words and ``LEAST_ANSWER`` of its answer, the last quarter of its words.
4. What the latent vectors pass over is sought in the same scan by words: a subsequence of so many words of an item
   must hold some of its rarest words (its anchors), so every window around enough anchors is checked as well. This
   step alone finds every pair that a check of all windows finds, whatever weight the terms have.

The benchmark is the stated query set: it goes to the tasks in blocks of at most ``MOST_ITEMS`` items.

Defined results: null or empty texts hold nothing; items without a word are never found; every (document, item)
pair is given once, with its best place; repeated rows are each answered; null ids are kept; an empty table or
benchmark gives no rows; further columns are not read. The cosine of an item whose terms all have no weight is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legmeter.llm.words import PLAIN, Shared, Words, document_runs

TERMS = 4096
DIMENSIONS = 128
#: Words of a passage of the decomposition, and of the blocks that windows are made of.
BLOCK = 16
#: Terms that occur more often than in this share of all passages have no weight in the latent vectors. What that
#: hides there, leaks that are themselves frequent or all of a small table, is found by anchors.
MOST_FREQUENT = 0.0125
#: Words up to this share of all words are anchors beyond the number that an item needs.
RARE_WORD = 1 / 1000
LEAST_COSINE = 0.35
#: Share of an item's weighted terms that must stand in the window itself before words are aligned.
LEAST_TERMS = 0.4
LEAST_COMMON, LEAST_ANSWER = 0.65, 0.5
#: Items up to this many words are sought in windows of two blocks, longer ones in four or as many as hold them.
SHORT_ITEM = 24
MOST_ITEMS = 4_096
_RUN_BYTES = 1 << 20


def _terms(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - TERMS.bit_length() + 1)).astype(np.int64)


def _pieces(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each piece of ``size`` words (the last of a document may be shorter), and its document."""
    counts = np.diff(words.bounds)
    pieces = -(-counts // size)
    row = np.repeat(np.arange(words.documents), pieces)
    place = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return words.bounds[row] + place * size, row


def _known(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``hashes`` are among the sorted ``known`` ones, and the places of those there."""
    if not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    at = np.flatnonzero(known[place] == hashes)
    return at, place[at]


def benchmark_words(benchmark: pa.Table) -> np.ndarray:
    """Sorted hashes of the distinct words of all items."""
    texts = pa.array([(t or "").encode() for t in benchmark["text"].to_pylist()], pa.binary())
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(words.hash for _, words in document_runs(texts, table=PLAIN))]))


def term_weights(documents: DataFrame, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inverse passage frequency of every term, and the share of all words that each of ``asked`` (sorted) has."""
    shared = documents.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts, own, passages = np.zeros(TERMS, dtype=np.int64), np.zeros(len(known), dtype=np.int64), 0
        for batch in batches:
            for _, words in document_runs(batch["text"], _RUN_BYTES, PLAIN):
                counts += np.bincount(_terms(words), minlength=TERMS)
                own += np.bincount(_known(known, words.hash)[1], minlength=len(known))
                passages += len(_pieces(words, BLOCK)[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, TERMS + len(known))), pa.array(np.r_[passages, counts, own])], names=["term", "n"]
        )

    summed = documents.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(TERMS + 1 + len(asked))
    found[summed["term"].to_numpy() + 1] = summed["n"].to_numpy()
    counts, own = found[1 : TERMS + 1], found[TERMS + 1 :]
    share = np.maximum(counts, 1) / max(found[0], 1.0)
    return np.where(share > MOST_FREQUENT, 0.0, np.log1p(1 / share)).astype(np.float32), own / max(counts.sum(), 1.0)


def _block_terms(words: Words, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and document of each block, and its weighted terms: ``BLOCK x blocks``, filled up with ``TERMS``."""
    first, row = _pieces(words, BLOCK)
    terms = _terms(words)
    heavy = np.flatnonzero(weights[terms] > 0)
    block = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(terms)]))[heavy]
    place = np.arange(len(heavy)) - np.searchsorted(block, np.arange(len(first)))[block]
    held = np.full((BLOCK, len(first)), TERMS, dtype=np.int32)
    held[place, block] = terms[heavy]
    return first, row, held


def latent_space(documents: DataFrame, weights: np.ndarray, seed: int = 11) -> np.ndarray:
    """``TERMS x DIMENSIONS``: weighted terms to latent coordinates, each scaled by its singular value.

    The random matrix has one sign in each row, so ``A'(A R)`` is a count of term pairs inside passages.
    """
    draws = np.random.default_rng(seed)
    side, sign = draws.integers(0, DIMENSIONS, TERMS), draws.choice([-1.0, 1.0], TERMS)
    shared = documents.sparkSession.sparkContext.broadcast((weights, side, sign))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, column, signs = shared.value
        left, right, column = np.r_[weight, 0.0], np.r_[weight * signs, 0.0], np.r_[column, 0]
        total = np.zeros(TERMS * DIMENSIONS)
        for batch in batches:
            for _, words in document_runs(batch["text"], _RUN_BYTES, PLAIN):
                _, _, held = _block_terms(words, weight)
                size = (held < TERMS).sum(axis=0)
                order = np.argsort(-size, kind="stable")
                held, size = held[:, order], -size[order]
                cells, worth = [], []
                for i in range(BLOCK):
                    for j in range(BLOCK):
                        some = int(np.searchsorted(size, -max(i, j) - 1, "right"))
                        if some:
                            cells.append(held[i, :some].astype(np.int64) * DIMENSIONS + column[held[j, :some]])
                            worth.append(left[held[i, :some]] * right[held[j, :some]])
                if cells:
                    total += np.bincount(np.concatenate(cells), np.concatenate(worth), TERMS * DIMENSIONS)
        found = total.reshape(TERMS, DIMENSIONS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS)), *(pa.array(found[:, k].astype(np.float32)) for k in range(DIMENSIONS))],
            names=["term", *(f"v{k}" for k in range(DIMENSIONS))],
        )

    columns = [f"v{k}" for k in range(DIMENSIONS)]
    rows = documents.mapInArrow(sketch, "term bigint, " + ", ".join(f"{c} float" for c in columns))
    summed = rows.groupBy("term").agg(*(F.sum(c).alias(c) for c in columns)).toArrow().sort_by("term")
    if not summed.num_rows:
        return np.zeros((TERMS, DIMENSIONS), np.float32)
    image = np.stack([summed[c].to_numpy() for c in columns], axis=1).astype(float)
    random = np.zeros((TERMS, DIMENSIONS))
    random[np.arange(TERMS), side] = sign
    # image = A'A R. Its Nystrom form gives the singular vectors without another scan.
    core = random.T @ image
    value, vector = np.linalg.eigh((core + core.T) / 2)
    root = vector / np.sqrt(np.maximum(value, 1e-6 * max(value.max(), 1e-12)))
    left, singular, _ = np.linalg.svd(image @ root, full_matrices=False)
    scale = np.where(singular > 1e-6 * max(singular.max(), 1e-12), 1 / np.maximum(singular, 1e-12), 0.0)
    return (weights[:, None] * left * scale).astype(np.float32)


@dataclass
class Items:
    """Benchmark items: ids, word hashes, latent unit vectors, which terms they hold and how many of weight.

    ``wide`` is the number of blocks of an item's windows. Item ``holders[k]`` of ``bounds[a] <= k < bounds[a + 1]``
    has the anchor ``anchors[a]``, and ``hits`` of its anchors stand around each of its places.
    """

    ids: list
    words: list[np.ndarray]
    vectors: np.ndarray
    members: np.ndarray
    terms: np.ndarray
    wide: np.ndarray
    anchors: np.ndarray
    bounds: np.ndarray
    holders: np.ndarray
    hits: np.ndarray


def least_common(size: int) -> int:
    """Words that a common subsequence with an item of ``size`` words must have."""
    least = int(LEAST_COMMON * size)
    return least if least >= LEAST_COMMON * size else least + 1


def blocks_of(size: int) -> int:
    """Blocks of the windows in which an item of ``size`` words is sought."""
    wide = 2 if size <= SHORT_ITEM else 4
    while wide * BLOCK < size:
        wide *= 2
    return wide


def _anchors(words: list[np.ndarray], known: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors, bounds and holders of all items, and the hits each needs.

    At most ``size - least_common(size)`` places of an item are not in a subsequence that counts. So of any ``n``
    places more than that, at least ``n`` less that number are in it: the rarest words are taken.
    """
    pairs, hits = [], []
    for item, own in enumerate(words):
        rarity = share[np.searchsorted(known, own)]
        order = np.argsort(rarity, kind="stable")
        missing = len(own) - least_common(len(own))
        taken = max(missing + 1, int((rarity <= RARE_WORD).sum()))
        hits.append(taken - missing)
        pairs += [(int(word), item) for word in np.unique(own[order[:taken]])]
    pairs.sort()
    word = np.array([p[0] for p in pairs], dtype=np.uint64)
    anchors, first = np.unique(word, return_index=True)
    holders = np.array([p[1] for p in pairs], dtype=np.int64)
    return anchors, np.r_[first, len(pairs)].astype(np.int64), holders, np.array(hits, dtype=np.int64)


def load_items(benchmark: pa.Table, table: np.ndarray, weights: np.ndarray, known: np.ndarray, share: np.ndarray) -> Items:
    ids, hashes, vectors, members = [], [], [], []
    texts = pa.array([(t or "").encode() for t in benchmark["text"].to_pylist()], pa.binary())
    for row, words in document_runs(texts, table=PLAIN):
        terms = _terms(words)
        for d in range(words.documents):
            own = slice(words.bounds[d], words.bounds[d + 1])
            vector = table[terms[own]].sum(axis=0)
            if words.bounds[d] < words.bounds[d + 1]:
                ids.append(benchmark["item_id"][row + d].as_py())
                hashes.append(words.hash[own])
                vectors.append(vector / max(np.linalg.norm(vector), 1e-12))
                members.append(np.isin(np.arange(TERMS + 1), terms[own][weights[terms[own]] > 0]))
    found = np.array(members, dtype=bool).reshape(-1, TERMS + 1)
    wide = np.array([blocks_of(len(own)) for own in hashes], dtype=np.int64)
    vectors = np.array(vectors, dtype=np.float32).reshape(-1, table.shape[1])
    return Items(ids, hashes, vectors, found, found.sum(axis=1), wide, *_anchors(hashes, known, share))


def common_subsequence(item: list[int], text: list[int]) -> np.ndarray:
    """Which words of ``item`` are in a longest common subsequence with ``text``: ones per prefix, bit-parallel.

    Entry ``k`` is the length of the longest common subsequence of ``item[:k]`` and ``text``.
    """
    places: dict[int, int] = {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for word in text:
        mask = places.get(word)
        if mask:
            taken = row & mask
            row = ((row + taken) | (row - taken)) & full
    bits = ~row & full
    return np.cumsum([0] + [bits >> k & 1 for k in range(len(item))])


def _checked(item: np.ndarray, text: np.ndarray) -> tuple[float, float]:
    """Shares of the item, and of its answer, that a common subsequence covers."""
    words = item.tolist()
    region = text[np.isin(text, item)].tolist()
    if len(region) < LEAST_COMMON * len(words):
        return 0.0, 0.0
    lengths = common_subsequence(words, region)
    answer = words[-max(1, len(words) // 4) :]
    return lengths[-1] / len(words), common_subsequence(answer, region)[-1] / len(answer)


def leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, start, cosine, common, answer`` of every benchmark item found in a document."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, start bigint, cosine double, common double, answer double"
    asked = benchmark.select("item_id", F.col("text").cast("string").alias("text")).toArrow()
    if not asked.num_rows:
        return documents.sparkSession.createDataFrame([], schema)
    known = benchmark_words(asked)
    weights, share = term_weights(rows.select("text"), known)
    table = latent_space(rows.select("text"), weights)
    found = []
    for low in range(0, asked.num_rows, MOST_ITEMS):
        items = load_items(asked.slice(low, MOST_ITEMS), table, weights, known, share)
        shared = Shared(documents.sparkSession, (weights, table, items))
        found.append(rows.mapInArrow(_searcher(shared), schema))
    return reduce(DataFrame.unionAll, found)


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, table, items = shared.value
        table = np.vstack([table, np.zeros((1, table.shape[1]), table.dtype)])
        # Items without a term of weight have no latent vector.
        scales = [(int(wide), np.flatnonzero((items.wide == wide) & (items.terms > 0))) for wide in np.unique(items.wide)]
        for batch in batches:
            out: list[tuple] = []
            for row, words in document_runs(batch["text"], _RUN_BYTES, PLAIN):
                for (d, item), place in sorted(_search_run(words, weights, table, items, scales).items()):
                    out.append((row + d, item, *place))
            if not out:
                continue
            rest = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), *[pa.float64()] * 3), 2)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array([x[0] for x in out], pa.int64())), pa.array([items.ids[x[1]] for x in out]), *rest],
                names=["doc_id", "item_id", "start", "cosine", "common", "answer"],
            )

    return search


def _search_run(words: Words, weights: np.ndarray, table: np.ndarray, items: Items, scales) -> dict[tuple[int, int], tuple]:
    """Best checked place ``start, cosine, common, answer`` of each (document, item) of a run of documents."""
    best: dict[tuple[int, int], tuple] = {}
    if not len(words.hash) or not len(items.ids):
        return best
    first, row, held = _block_terms(words, weights)
    window = np.zeros((len(first), table.shape[1]), dtype=np.float32)
    for terms in held:
        window += table[terms]
    held = np.hstack([held, np.full((BLOCK, int(items.wide.max())), TERMS, dtype=held.dtype)])
    one = window
    width = 1
    for wide, chosen in scales:
        while width < wide:
            # Windows at the end of a document hold what is left of it.
            longer = window.copy()
            same = np.flatnonzero(row[width:] == row[:-width]) if len(row) > width else np.empty(0, np.int64)
            longer[same] += window[same + width]
            window, width = longer, width * 2
        if not len(chosen):
            continue
        norm = np.maximum(np.linalg.norm(window, axis=1), 1e-12)
        cosine = (window @ items.vectors[chosen].T) / norm[:, None]
        at, k = np.nonzero(cosine >= LEAST_COSINE)
        k_item = chosen[k]
        shared = np.zeros(len(at), dtype=np.int32)
        for block in range(wide):
            for terms in held:
                shared += items.members[k_item, terms[at + block]]
        near = np.flatnonzero(shared >= LEAST_TERMS * items.terms[k_item])
        for at, k, item in zip(at[near].tolist(), k[near].tolist(), k_item[near].tolist()):
            d, own = int(row[at]), items.words[item]
            low, high = (int(x) for x in _region(first[at], wide, len(own), words.bounds[d], words.bounds[d + 1]))
            common, answer = _checked(own, words.hash[low:high])
            if common >= LEAST_COMMON and answer >= LEAST_ANSWER and common > best.get((d, item), (0, 0, 0.0))[2]:
                best[d, item] = (int(first[at] - words.bounds[d]), float(cosine[at, k]), float(common), float(answer))
    for d, item, low, high in _near_anchors(words, items):
        least = best.get((d, item), (0, 0, 0.0))[2]
        place = _best_window(words, items.words[item], int(items.wide[item]), d, low, high, least) if least < 1 else None
        if place:
            window = slice(at := int(np.searchsorted(first, place[0])), at + int(items.wide[item]))
            ahead = one[window][row[window] == d].sum(axis=0)
            cosine = float(ahead @ items.vectors[item] / max(float(np.linalg.norm(ahead)), 1e-12))
            best[d, item] = (place[0] - int(words.bounds[d]), cosine, place[1], place[2])
    return best


def _region(first, wide: int, size: int, start: int, end: int):
    """Words ``low:high`` of a document ``start:end`` that are aligned with an item for the window at ``first``."""
    return np.maximum(first - size - BLOCK, start), np.minimum(first + wide * BLOCK + size + BLOCK, end)


def _near_anchors(words: Words, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """``document, item, low, high``: every place of the item there lies between these words."""
    at, anchor = _known(items.anchors, words.hash)
    held = np.diff(items.bounds)[anchor]
    inside = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
    item = items.holders[np.repeat(items.bounds[anchor], held) + inside]
    at = np.repeat(at, held)
    row = np.searchsorted(words.bounds, at, "right") - 1
    group = row * len(items.ids) + item
    order = np.argsort(group, kind="stable")
    at, item, row, group = at[order], item[order], row[order], group[order]
    # A place starts at this hit if as many as it needs follow in one region.
    sizes = np.array([len(own) for own in items.words], dtype=np.int64)
    reach = (items.wide * BLOCK + 2 * (sizes + BLOCK))[item]
    last = np.arange(len(at)) + items.hits[item] - 1
    last_in = np.minimum(last, max(len(at) - 1, 0))
    full = np.flatnonzero((last < len(at)) & (group[last_in] == group) & (at[last_in] - at < reach))
    if not len(full):
        return
    cuts = np.flatnonzero(np.r_[True, (group[full[1:]] != group[full[:-1]]) | (at[full[1:]] - at[full[:-1]] > 2 * reach[full[1:]])])
    for k, stop in zip(full[cuts].tolist(), full[np.r_[cuts[1:], len(full)] - 1].tolist()):
        yield int(row[k]), int(item[k]), int(at[k] - reach[k]), int(at[stop] + reach[k])


def _best_window(words: Words, own: np.ndarray, wide: int, d: int, low: int, high: int, least: float) -> tuple[int, float, float] | None:
    """First word, ``common`` and ``answer`` of the best window from ``low`` to ``high`` that covers more than ``least``."""
    start, end = int(words.bounds[d]), int(words.bounds[d + 1])
    low = start + max(low - start, 0) // BLOCK * BLOCK
    begin, stop = max(low - len(own) - BLOCK, start), min(high + (wide + 1) * BLOCK + len(own), end)
    distinct, times = np.unique(own, return_counts=True)
    at, kind = _known(distinct, words.hash[begin:stop])
    at += begin
    first = np.arange(low, min(high, end), BLOCK)
    lows, highs = _region(first, wide, len(own), begin, stop)
    froms, tos = np.searchsorted(at, lows), np.searchsorted(at, highs)
    # No subsequence is longer than the words in common, each as often as both hold it.
    count = tos - froms
    for k in np.flatnonzero(count >= least_common(len(own))).tolist():
        count[k] = np.minimum(np.bincount(kind[froms[k] : tos[k]], minlength=len(times)), times).sum()
    enough = np.flatnonzero(count >= least_common(len(own)))
    inner = np.searchsorted(at, first[enough] + wide * BLOCK) - np.searchsorted(at, first[enough])
    found = None
    for k in enough[np.lexsort((-inner, -count[enough]))].tolist():
        if count[k] <= least * len(own):
            break
        common, answer = _checked(own, words.hash[lows[k] : highs[k]])
        if common >= LEAST_COMMON and answer >= LEAST_ANSWER and common > least:
            found, least = (int(first[k]), float(common), float(answer)), float(common)
    return found


def drop_leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` in which no benchmark item was found; columns do not change.

    The text alone decides, told by a 64-bit hash: rows that share an id, or have none, go or stay each by its own text.
    """
    key = F.xxhash64(F.col(f"`{text}`").cast("binary"))
    found = leaks(documents.select(key.alias("_key"), F.col(f"`{text}`").alias("_text")), benchmark, "_key", "_text")
    return documents.join(found.select(F.col("doc_id").alias("_gone")).distinct(), key == F.col("_gone"), "left_anti")
