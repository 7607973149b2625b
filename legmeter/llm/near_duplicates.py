"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A shingle is five consecutive words (all words of a shorter text). Its weight is its count in the document times
an inverse document frequency that lies between ``LEAST_IDF`` and 1: shingles in less than ``COMMON`` of all
documents weigh 1, the more common ones less. Which shingles are common is counted over all documents; there can
be only ``2 * mean length / COMMON`` of them, and at most the ``MOST_COMMON`` most frequent are broadcast.

1. Each document takes ``BANDS * ROWS`` weighted samples and as many of its plain set of shingles; a pair agrees in each
   with the probability of its weighted or plain Jaccard similarity. Documents with equal shingles form one class and go
   on as one.
2. Documents that agree in a whole band are candidates. Small buckets give all their pairs. In a large one every
   member first meets ``PIVOTS`` members that are most central (whose bands lead to the largest buckets), so a group of
   n copies costs a multiple of n, not its square.
3. Candidates are verified on the whole texts: similar are those whose weighted or plain Jaccard similarity of shingles
   is at least 0.8. Links are followed to connected classes.
4. Large buckets that still hold several classes are divided by their next band. Parts that have become small give
   their pairs of different classes. What stays large is a family of texts much alike: its members are compared block by
   block, all with all but those that are in one class already, by products of their shingle tables.
5. Large buckets that hold several classes even then are compared block by block as a whole. So all that agree in a
   band are in one class or have been compared, however large the bucket; pivots and divisions only save comparisons.

Defined results: a text without a word (or a null one) is a class of its own; the class id is the smallest id
of the class; rows that share an id are one document, near to whatever one of them is near to; rows with a null
id are classes of their own with a null class id; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legmeter.llm.words import Words, document_runs, mix
from legmeter.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of the weighted samples, and as many of the plain ones.
BANDS, ROWS = 5, 2
#: Share of all documents from which on a shingle is common, and the least weight of one.
COMMON, LEAST_IDF = 0.01, 0.5
#: Members of a bucket that meet each other; larger buckets meet their pivots first and are divided then.
BUCKET, PIVOTS = 24, 4
#: Samples (of BANDS * ROWS of one kind) that a pair must share to be verified; one of similarity 0.8 fails once in 12,000.
LEAST_SHARED = 3
#: Documents of a block of a family, and shingles of a table at a time.
BLOCK, COLUMNS = 256, 4_096
#: Common shingles that may weigh less than 1: the most frequent ones.
MOST_COMMON = 2_000_000
#: Documents counted together when common shingles are looked for.
BLOCK_DOCUMENTS = 400
_RUN_BYTES = 1 << 20

_DRAWS = np.random.default_rng(20)
_GAMMA = _DRAWS.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_LOG_GAMMA = np.log(_DRAWS.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
_UNIFORM = _DRAWS.random(1 << 16).astype(np.float32)
_INVERSE = (1 / _GAMMA).astype(np.float32)
_SEEDS = _DRAWS.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLAIN_SEEDS = _DRAWS.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a run of documents and the document of each; short documents give one, empty ones none."""
    hashes, first = words.windows(SHINGLE)
    row = words.row_of_word()
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = [mix(words.hash[words.bounds[d] : words.bounds[d + 1]] * np.arange(3, 3 + 2 * counts[d], 2, dtype=np.uint64)).sum(dtype=np.uint64) for d in short]
    hashes = np.concatenate([hashes, np.array(whole, dtype=np.uint64)])
    rows = np.concatenate([row[first], short])
    order = np.lexsort((hashes, rows))
    return hashes[order], rows[order]


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document with their counts, in order of document and hash."""
    fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])] if len(hashes) else np.empty(0, bool)
    at = np.flatnonzero(fresh)
    return hashes[at], rows[at], np.diff(np.r_[at, len(hashes)])


def common_shingles(documents: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common shingles and the weight of each, from counts over all documents.

    A shingle in ``COMMON`` of all documents must be as frequent in some block of documents; those are found
    block by block and then counted exactly.
    """

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(2, math.ceil(COMMON * size)) if size > 1 / COMMON else counts >= COMMON * size
            return pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["shingle", "n"]
            )

        for batch in batches:
            for _, words in document_runs(batch["text"], _RUN_BYTES):
                if size >= BLOCK_DOCUMENTS:
                    yield block()
                    held, size = [], 0
                held.append(_distinct(*shingles(words))[0])
                size += words.documents
        if size:
            yield block()

    guessed = documents.select("text").mapInArrow(likely, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    # A shingle that reaches the share over all documents reaches half of it in the blocks where it is frequent.
    chosen = guessed.where(F.col("n") >= COMMON * total / 2).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").toArrow()["shingle"]
    chosen = np.sort(chosen.to_numpy().view(np.uint64)) if len(chosen) else np.empty(0, np.uint64)
    if not len(chosen):
        return chosen, np.empty(0, np.float32)
    shared = documents.sparkSession.sparkContext.broadcast(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for _, words in document_runs(batch["text"], _RUN_BYTES):
                found = _distinct(*shingles(words))[0]
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                counts += np.bincount(place[known[place] == found], minlength=len(known))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["place", "n"])

    exact = documents.select("text").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.ones(len(chosen))
    frequency[exact["place"].to_numpy()] = exact["n"].to_numpy()
    weight = np.clip(np.log(total / frequency) / math.log(1 / COMMON), LEAST_IDF, 1.0)
    return chosen, weight.astype(np.float32)


def _weights(hashes: np.ndarray, counts: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, idf = common
    weight = counts.astype(np.float32)
    if len(known) and len(hashes):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        weight *= np.where(known[place] == hashes, idf[place], np.float32(1))
    return weight


def weighted_samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples, a row per seed and a column per document; ``starts`` are those of documents."""
    out = np.empty((len(_SEEDS), len(starts)), dtype=np.uint64)
    if not len(starts):
        return out
    log_weight = np.log(weights)
    sizes = np.diff(np.r_[starts, len(hashes)])
    for k, seed in enumerate(_SEEDS):
        bits = mix(hashes ^ seed)
        step = (bits & np.uint64(0xFFFF)).astype(np.int64)
        gamma = _GAMMA[step]
        level = np.floor(log_weight * _INVERSE[step] + _UNIFORM[(bits >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64)])
        offset = level - _UNIFORM[(bits >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int64)]
        rank = _LOG_GAMMA[(bits >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int64)] - gamma * (offset + 1)
        least = np.minimum.reduceat(rank, starts)
        hits = np.flatnonzero(rank == np.repeat(least, sizes))
        chosen = hits[np.searchsorted(hits, starts)]
        out[k] = mix(hashes[chosen] ^ (level[chosen].astype(np.int64).view(np.uint64) << np.uint64(40)) ^ seed)
    return out


def plain_samples(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least hash of each document's shingles, a row per seed and a column per document."""
    if not len(starts):
        return np.empty((len(_PLAIN_SEEDS), 0), dtype=np.uint64)
    return np.stack([np.minimum.reduceat(mix(hashes ^ seed), starts) for seed in _PLAIN_SEEDS])


def signatures(documents: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``doc_id, body`` (digest of the shingles, null without any) ``, samples, bands`` of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for row, words in document_runs(batch["text"], _RUN_BYTES):
                hashes, rows, counts = _distinct(*shingles(words))
                starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, np.int64)
                ends = np.r_[starts[1:], len(rows)].astype(np.int64)
                samples = np.vstack([weighted_samples(hashes, _weights(hashes, counts, known), starts), plain_samples(hashes, starts)])
                body: list[bytes | None] = [None] * words.documents
                kept: list[np.ndarray | None] = [None] * words.documents
                keys: list[np.ndarray | None] = [None] * words.documents
                pair = samples.reshape(2 * BANDS, ROWS, -1)
                bands = mix(pair[:, 0] * np.uint64(3) ^ mix(pair[:, 1])) if len(starts) else pair[:, 0]
                for k, (low, high) in enumerate(zip(starts, ends)):
                    d = int(rows[low])
                    body[d] = hashlib.blake2b(hashes[low:high].tobytes() + counts[low:high].tobytes(), digest_size=16).digest()
                    kept[d] = (samples[:, k] >> np.uint64(33)).astype(np.int32)
                    keys[d] = bands[:, k].view(np.int64) if bands[:, k].flags.contiguous else np.ascontiguousarray(bands[:, k]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(row, words.documents), pa.array(body, pa.binary()),
                     pa.array(kept, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "body", "samples", "bands"],
                )

    return documents.mapInArrow(sign, f"doc_id {kind}, body binary, samples array<int>, bands array<bigint>")


def bucket_members(heads: DataFrame) -> DataFrame:
    """``doc_id, key, n, score, used, bands`` of every member of a bucket of two or more; ``used`` is the band, ``n`` the size."""
    bands = heads.select("doc_id", "bands", F.posexplode("bands").alias("band", "raw"))
    bands = materialise(bands.select("doc_id", "bands", F.array("band").alias("used"), F.xxhash64("band", "raw").alias("key")), "bands")
    sizes = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = bands.join(sizes, "key")
    score = shared.groupBy("doc_id").agg(F.sum("n").alias("score"))
    return materialise(shared.join(score, "doc_id").select("doc_id", "key", "n", "score", "used", "bands"), "members")


def first_pairs(members: DataFrame) -> DataFrame:
    """``hub, doc``: all pairs of small buckets, and the members of large ones with their pivots."""
    small = members.where(F.col("n") <= BUCKET).select("key", "doc_id")
    other = small.select("key", F.col("doc_id").alias("other"))
    pairs = small.join(other, "key").where("doc_id < other").select(F.col("doc_id").alias("hub"), F.col("other").alias("doc"))
    large = members.where(F.col("n") > BUCKET)
    pivots = (
        large.groupBy("key", F.pmod(F.xxhash64("doc_id"), F.lit(PIVOTS)).alias("seat"))
        .agg(F.max(F.struct("score", "doc_id")).alias("top"))
        .select("key", F.col("top.doc_id").alias("hub"))
    )
    stars = large.select("key", "doc_id").join(pivots, "key").where("hub <> doc_id").select("hub", F.col("doc_id").alias("doc"))
    return pairs.union(stars)


def _agreeing(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The distinct ``hub, doc`` pairs that share enough samples of one kind."""
    # One direction for each pair: the hub is the one that was a pivot most often, whichever comes first otherwise.
    pairs = pairs.groupBy(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).agg(F.min("hub").alias("hub"))
    pairs = pairs.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("doc"))
    samples = heads.select("doc_id", "samples").dropDuplicates(["doc_id"])
    mine = samples.select(F.col("doc_id").alias("hub"), F.col("samples").alias("hub_samples"))
    theirs = samples.select(F.col("doc_id").alias("doc"), F.col("samples").alias("doc_samples"))
    size = BANDS * ROWS

    def agree(first: int) -> Column:
        both = F.arrays_zip(*(F.slice(c, first + 1, size).alias(c) for c in ("hub_samples", "doc_samples")))
        return F.size(F.filter(both, lambda z: z["hub_samples"] == z["doc_samples"]))

    return pairs.join(mine, "hub").join(theirs, "doc").where((agree(0) >= LEAST_SHARED) | (agree(size) >= LEAST_SHARED)).select("hub", "doc")


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold two classes or more, with the bucket's size ``n``."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    return members.drop("n").join(sizes.select("key", "n"), "key")


def _divided(members: DataFrame) -> DataFrame:
    """Every member by the next band of its kind as well: members that agree there too stay together."""
    band = F.element_at("used", -1)
    first = F.floor(band / BANDS) * BANDS
    following = (first + (band - first + 1) % BANDS).cast("int")
    return members.select(
        "doc_id", "class", "bands", F.array(following).alias("used"), F.xxhash64("key", following, F.get("bands", following)).alias("key")
    )


def later_pairs(members: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of different classes in the parts of large buckets, and the members ``key, doc_id, class`` of parts that stay large."""
    large = members.where(F.col("n") > BUCKET).drop("score").join(classes, "doc_id", "left")
    mixed = _mixed(large.withColumn("class", F.coalesce("class", "doc_id")))
    parts = materialise(_mixed(_divided(mixed)), "divided")
    small = parts.where(F.col("n") <= BUCKET).select("key", "doc_id", "class")
    other = small.select("key", F.col("doc_id").alias("other"), F.col("class").alias("other_class"))
    pairs = small.join(other, "key").where("doc_id < other and class <> other_class").select(F.col("doc_id").alias("hub"), F.col("other").alias("doc"))
    return pairs, parts.where(F.col("n") > BUCKET).select("key", "doc_id", "class")


def _families(parts: DataFrame) -> DataFrame:
    """``doc_id, class, family`` of the members of parts that stayed large: parts that share members are one family."""
    hubs = parts.groupBy("key").agg(F.min("doc_id").alias("hub"))
    ties = materialise(parts.join(hubs, "key").where("hub <> doc_id").select("hub", "doc_id").distinct(), "ties")
    labels = connected_classes(ties, "hub", "doc_id").select(F.col("node").alias("doc_id"), F.col("label").alias("family"))
    return parts.select("doc_id", "class").distinct().join(labels, "doc_id")


def undecided(members: DataFrame, labels: DataFrame, families: DataFrame | None) -> DataFrame:
    """``doc_id, class, family`` of the large buckets that still hold several classes; the family is the bucket.

    Buckets that lie within one of the ``families`` have been compared, and of equal buckets one is enough.
    """
    large = members.where(F.col("n") > BUCKET).select("key", "doc_id").join(labels.select(F.col("head").alias("doc_id"), F.col("label").alias("class")), "doc_id", "left")
    large = large.withColumn("class", F.coalesce("class", "doc_id"))
    if families is None:
        large = large.withColumn("family", F.lit(None).cast("string"))
    else:
        large = large.join(families.select("doc_id", F.col("family").cast("string")), "doc_id", "left")
    compared = (F.count("family") == F.count("*")) & (F.min("family") == F.max("family"))
    # The sum is one of decimals, which cannot overflow.
    held = F.struct(F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("sum"), F.count("*").alias("n")).alias("held")
    buckets = large.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), compared.alias("compared"), held)
    chosen = buckets.where("low <> high and not coalesce(compared, false)").groupBy("held").agg(F.min("key").alias("key"))
    return large.drop("family").join(chosen.select("key"), "key").select("doc_id", "class", F.col("key").alias("family"))


def _dealt_blocks(members: DataFrame) -> DataFrame:
    """``doc_id, class, family, first, second``: each member in all pairs of blocks that must be compared.

    A large class has blocks of its own, which need not be compared with each other.
    """
    sizes = members.groupBy("family", "class").agg(F.count("*").alias("size"))
    own = F.when(F.col("size") >= BLOCK, F.col("class"))
    sized = sizes.withColumn("own", own)
    totals = sized.groupBy("family", "own").agg(F.sum("size").alias("together"))
    same = (F.col("s.family") == F.col("t.family")) & F.col("s.own").eqNullSafe(F.col("t.own"))
    shape = sized.alias("s").join(totals.alias("t"), same).select("s.family", "s.class", "s.own", F.ceil(F.col("t.together") / BLOCK).alias("blocks"))
    placed = members.join(shape, ["family", "class"]).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    placed = materialise(placed.select("doc_id", "class", "family", "own", F.xxhash64("own", "block").alias("block")), "blocks")
    blocks = placed.select("family", "own", "block").distinct()
    other = blocks.select("family", F.col("own").alias("other"), F.col("block").alias("second"))
    # One row a pair of blocks of a family; pairs of one class are left out.
    pairs = blocks.withColumnRenamed("block", "first").join(other, "family").where("first <= second and not (own is not null and own <=> other)")
    sides = pairs.select("family", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    return placed.drop("own").join(sides, ["family", "block"])


def _tables(sets: list[tuple[np.ndarray, np.ndarray]], common) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Documents by shingles that two of them hold: ``(table, weights, once)``, ``COLUMNS`` at a time.

    A shingle that a document holds k times is there k times, so that products of rows are sums of the lesser counts;
    ``once`` marks the tables of first times, which are the plain sets.
    """
    row = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    hashes, counts = (np.concatenate([np.empty(0, dtype), *(s[k] for s in sets)]) for k, dtype in enumerate((np.uint64, np.int64)))
    time = 1
    while len(hashes):
        names, place, held = np.unique(hashes, return_inverse=True, return_counts=True)
        weights = _weights(names, np.ones(len(names), np.int64), common)
        order = np.argsort(place, kind="stable")
        bounds = np.r_[0, np.cumsum(held)]
        shared = np.flatnonzero(held > 1)
        for low in range(0, len(shared), COLUMNS):
            chosen = shared[low : low + COLUMNS]
            table = np.zeros((len(sets), len(chosen)), dtype=np.float32)
            for column, name in enumerate(chosen):
                table[row[order[bounds[name] : bounds[name + 1]]], column] = 1
            yield table, weights[chosen], time == 1
        time += 1
        again = counts >= time
        hashes, counts, row = hashes[again], counts[again], row[again]


def similar_in_block(sets: list[tuple[np.ndarray, np.ndarray]], common, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs ``i < j`` of documents (distinct shingles, counts) that are similar."""
    weighted = np.zeros((len(sets), len(sets)), dtype=np.float64)
    plain = np.zeros_like(weighted)
    for table, weights, once in _tables(sets, common):
        weighted += (table * weights) @ table.T
        if once:
            plain += table @ table.T
    mass = np.array([float(_weights(h, c, common).sum()) for h, c in sets])
    size = np.array([len(h) for h, _ in sets])
    weighted /= np.maximum(mass[:, None] + mass - weighted, 1e-9)
    plain /= np.maximum(size[:, None] + size - plain, 1)
    # What rounding leaves in doubt is for the exact comparison of one pair.
    return np.nonzero(np.triu(np.maximum(weighted, plain) >= similarity - 1e-3, 1))


def family_links(members: DataFrame, documents: DataFrame, common, similarity: float) -> DataFrame:
    """``hub, doc, similarity``: links between different classes of a family, as many as join them."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    dealt = _dealt_blocks(members).join(documents, "doc_id").select("family", "first", "second", "class", "doc_id", "text")
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def compare(group: pa.Table) -> pa.Table:
        known, sets = shared.value, []
        group = group.combine_chunks().take(np.argsort(group["doc_id"].to_numpy(), kind="stable"))
        for _, words in document_runs(group["text"].combine_chunks(), _RUN_BYTES):
            hashes, rows, counts = _distinct(*shingles(words))
            cuts = np.searchsorted(rows, np.arange(words.documents + 1))
            sets += [(hashes[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]
        ids, joined = group["doc_id"].to_pylist(), group["class"].to_pylist()
        ahead: dict = {}

        def root(label):
            while label in ahead:
                label = ahead[label]
            return label

        found: list[tuple] = []
        for i, j in zip(*similar_in_block(sets, known, similarity)):
            one, two = root(joined[i]), root(joined[j])
            if one != two:
                exact = max(similarities(sets[i], sets[j], known))
                if exact >= similarity:
                    ahead[one] = two
                    found.append((ids[i], ids[j], exact))
        types = (group.schema.field("doc_id").type, group.schema.field("doc_id").type, pa.float64())
        return pa.table({n: pa.array([f[k] for f in found], t) for k, (n, t) in enumerate(zip(("hub", "doc", "similarity"), types))})

    return dealt.groupBy("family", "first", "second").applyInArrow(compare, f"hub {kind}, doc {kind}, similarity double")


def similarities(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], common) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two documents given as (distinct shingles, counts)."""
    both, at, to = np.intersect1d(first[0], second[0], assume_unique=True, return_indices=True)
    mine, theirs = _weights(*first, common), _weights(*second, common)
    shared = float(np.minimum(mine[at], theirs[to]).sum())
    weighted = shared / max(float(mine.sum() + theirs.sum()) - shared, 1e-9)
    return weighted, len(both) / max(len(first[0]) + len(second[0]) - len(both), 1)


def verified_links(pairs: DataFrame, documents: DataFrame, common, similarity: float) -> DataFrame:
    """``hub, doc, similarity`` of the pairs that are similar, compared on their whole texts.

    The texts of a hub's partners stream past the hub's own; hubs with many partners are dealt over salts.
    """
    load = pairs.groupBy("hub").agg(F.ceil(F.count("*") / 256).cast("int").alias("salts"))
    salted = pairs.join(load, "hub").withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int"))
    wanted = salted.select(F.col("doc").alias("doc_id"), "hub", "salt", F.lit(False).alias("leads"))
    leads = load.select(F.col("hub").alias("doc_id"), "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True))
    rows = wanted.union(leads).join(documents, "doc_id")
    dealt = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("leads"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, group, hubs = shared.value, None, []
        for batch in batches:
            out = {"hub": [], "doc": [], "similarity": []}
            keys = list(zip(batch["hub"].to_pylist(), batch["salt"].to_pylist()))
            leads, ids = batch["leads"].to_pylist(), batch["doc_id"].to_pylist()
            for row, words in document_runs(batch["text"], _RUN_BYTES):
                hashes, rows, counts = _distinct(*shingles(words))
                cuts = np.searchsorted(rows, np.arange(words.documents + 1))
                for d in range(words.documents):
                    own = hashes[cuts[d] : cuts[d + 1]], counts[cuts[d] : cuts[d + 1]]
                    if keys[row + d] != group:
                        group, hubs = keys[row + d], []
                    if leads[row + d]:
                        hubs.append(own)
                        continue
                    best = max((max(similarities(hub, own, known)) for hub in hubs), default=0.0)
                    if best >= similarity:
                        out["hub"].append(group[0])
                        out["doc"].append(ids[row + d])
                        out["similarity"].append(best)
            types = (batch.schema.field("hub").type, batch.schema.field("doc_id").type, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    columns = dealt.select("hub", "salt", "leads", "doc_id", "text")
    return columns.mapInArrow(compare, f"hub {kind}, doc {kind}, similarity double")


def connected_classes(links: DataFrame, first: str, second: str) -> DataFrame:
    """``node, label`` with the smallest node of each connected part; rounds grow with the log of its width."""
    ways = links.select(F.col(first).alias("node"), F.col(second).alias("other"))
    ways = materialise(ways.union(ways.select(F.col("other"), F.col("node"))).distinct(), "ways")
    labels = materialise(ways.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        passed = ways.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
        nearer = labels.union(passed).groupBy("node").agg(F.min("label").alias("near"))
        onward = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        renewed = materialise(
            nearer.join(onward, "near").join(labels.withColumnRenamed("label", "old"), "node")
            .select("node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("old")).alias("moved")),
            "labels",
        )
        labels = renewed.select("node", "label")
        if not renewed.where("moved").limit(1).count():
            return labels


def near_duplicate_classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links`` for every row: links are those verified between different texts of the class head."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    common = common_shingles(rows, max(1, rows.count()))
    signed = materialise(signatures(rows, common), "signed")
    bodies = signed.where("body is not null and doc_id is not null")
    firsts = bodies.groupBy("body").agg(F.min("doc_id").alias("head"))
    heads = bodies.join(firsts, "body").where("doc_id = head").dropDuplicates(["body"])
    heads = heads.select("doc_id", "samples", "bands")
    members = bucket_members(heads)
    pairs = materialise(_agreeing(first_pairs(members), heads), "pairs")
    # Whoever is in a large bucket may be needed once more.
    crowded = members.where(F.col("n") > BUCKET).select("doc_id")
    needed = pairs.select(F.explode(F.array("hub", "doc")).alias("doc_id")).union(crowded).distinct()
    # One plan at every size: the list of documents grows with the corpus, so it is not broadcast while it is short.
    texts = materialise(rows.join(needed.hint("merge"), "doc_id"), "texts")
    links = materialise(verified_links(pairs, texts, common, similarity), "links")
    labels = connected_classes(links, "hub", "doc").withColumnRenamed("node", "head")
    if not crowded.isEmpty():
        others, parts = later_pairs(members, labels.select(F.col("head").alias("doc_id"), F.col("label").alias("class")))
        more = verified_links(materialise(_agreeing(others, heads), "pairs"), texts, common, similarity)
        families = None
        if not parts.isEmpty():
            families = materialise(_families(parts), "families")
            more = more.unionByName(family_links(families, texts, common, similarity))
        more = materialise(more.dropDuplicates(["hub", "doc"]), "links")
        labels = _followed(labels, more)
        rest = materialise(undecided(members, labels, families), "undecided")
        if not rest.isEmpty():
            last = materialise(family_links(rest, texts, common, similarity).dropDuplicates(["hub", "doc"]), "links")
            labels, more = _followed(labels, last), more.unionByName(last)
        links = materialise(links.unionByName(more).dropDuplicates(["hub", "doc"]), "links")
    degree = links.select(F.explode(F.array("hub", "doc")).alias("head")).groupBy("head").agg(F.count("*").alias("n_links"))
    classes = firsts.join(labels, "head", "left").join(degree, "head", "left")
    classes = classes.select("body", F.coalesce("label", "head").alias("class"), "n_links")
    found = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("body")).alias("body")).join(classes, "body", "left")
    return found.select("doc_id", F.coalesce("class", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _between_classes(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``one, two``: the pairs of classes that ``links`` join; a document without a label is a class of its own."""
    sides = links.select("hub", "doc")
    for column, side in (("hub", "one"), ("doc", "two")):
        named = labels.select(F.col("head").alias(column), F.col("label").alias(side))
        sides = sides.join(named, column, "left").withColumn(side, F.coalesce(side, column))
    return materialise(sides.where("one <> two").select("one", "two").distinct(), "between")


def _followed(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``head, label`` after further links; only classes that they join are followed once more."""
    further = _between_classes(links, labels)
    if further.isEmpty():
        return labels
    joined = materialise(connected_classes(further, "one", "two").select(F.col("node").alias("label"), F.col("label").alias("_joined")), "joined")
    known = labels.join(joined, "label", "left").select("head", F.coalesce("_joined", "label").alias("label"))
    new = joined.join(labels.select(F.col("head").alias("label")), "label", "left_anti").select(F.col("label").alias("head"), F.col("_joined").alias("label"))
    return materialise(known.unionByName(new), "labels")


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``documents`` whose id is the smallest of its class; columns do not change."""
    classes = near_duplicate_classes(documents, doc_id, text, similarity)
    gone = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
