"""Rows that share an id, groups beyond every bound, and workers without the library."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_text_operators import SMALL, by_count, plain_removal, rows_of, split
from texts import invented

from legmeter.llm import decontaminate, language, near_duplicates, packing, substrings
from legmeter.llm.words import document_runs

ROOT = Path(__file__).resolve().parents[2]
TEXTS = "doc_id bigint, text string"


# --- repeated passages


def plain_rows(rows):
    return [(i, n, gone, digest) for i, n, gone, digest, _ in plain_removal(rows)]


def test_rows_that_share_an_id_are_cut_each_by_its_own_text(spark):
    passage, copy = invented(31, 80), invented(32, 120)
    rows = [
        (1, invented(33, 20) + " " + passage), (2, copy), (20, passage + " " + invented(34, 40)), (20, invented(35, 150)),
        (30, copy), (30, invented(36, 150)), (30, copy), (None, passage), (None, invented(37, 60)), (20, passage + " " + invented(34, 40)),
        (1, invented(38, 70)), (40, invented(38, 70)),
    ]
    table = spark.createDataFrame(rows, TEXTS).repartition(3)
    found = rows_of(substrings.removal_digests(table), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert by_count(found) == by_count(plain_rows(rows))
    want = [(w[0], w[4]) for w in plain_removal(rows)]
    assert by_count(rows_of(substrings.strip_documents(table), "doc_id", "text")) == by_count(want)


@pytest.mark.parametrize("stretch,shard,stream", [(60, 150, 200), (120, 100_000, 300), (20_000, 400, 100)])
def test_long_passages_and_busy_shards_are_split(spark, monkeypatch, stretch, shard, stream):
    monkeypatch.setattr(substrings, "STRETCH_WORDS", stretch)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    monkeypatch.setattr(substrings, "STREAM_WORDS", stream)
    long = invented(41, 1500).split()
    draw = random.Random(4)
    rows = [(0, " ".join(long))]
    for i in range(1, 25):
        at = draw.randrange(1300)
        rows.append((i, " ".join([invented(100 + i, 20), *long[at : at + draw.randrange(30, 200)], invented(200 + i, 20)])))
    table = spark.createDataFrame(rows, TEXTS).repartition(4)
    found = substrings.removal_digests(table)
    assert by_count(rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256")) == by_count(plain_rows(rows))


def test_salts_have_an_exchange_of_their_own(spark):
    rows = [(i, invented(51, 90) + " " + invented(60 + i, 10)) for i in range(6)]
    _, spans = substrings.repeated_spans(spark.createDataFrame(rows, TEXTS))
    assert "hashpartitioning(shard" in (plan := spans._jdf.queryExecution().executedPlan().toString())
    assert any("hashpartitioning(shard" in line and "salt" in line for line in plan.splitlines())


# --- leaks


def test_leaks_are_dropped_row_by_row(spark):
    item = "which river runs through the old town and how long is it from its spring to the sea"
    clean = ["nothing of the kind at all", "something else that is quite clean"]
    rows = [(5, f"we ask: {item}?"), (5, clean[0]), (None, f"once more: {item}"), (None, clean[1]), (None, None), (6, f"we ask: {item}?"), (5, clean[0])]
    benchmark = spark.createDataFrame([(3, item)], "item_id bigint, text string")
    kept = rows_of(decontaminate.drop_leaks(spark.createDataFrame(rows, TEXTS), benchmark), "doc_id", "text")
    assert by_count(kept) == by_count([(5, clean[0]), (None, clean[1]), (None, None), (5, clean[0])])


def test_latent_vectors_alone_find_nine_leaks_in_ten(spark, monkeypatch):
    """Against an alignment of all windows: without the anchors, on the test tables and paraphrases of their items."""
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    draw = random.Random(9)
    rows = [(r.doc_id, r.text or "") for r in table]
    for k, text in enumerate(items.values()):
        words = [w for w in text.split() if draw.random() < 0.85]
        own = rows[draw.randrange(len(rows))][1].split()[:400]
        at = draw.randrange(len(own) + 1)
        rows.append((10_000 + k, " ".join(own[:at] + words + own[at:])))
    whole = spark.createDataFrame(rows, TEXTS)
    both = {(r.doc_id, r.item_id) for r in decontaminate.leaks(whole, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "_near_anchors", lambda words, items: iter(()))
    latent = {(r.doc_id, r.item_id) for r in decontaminate.leaks(whole, benchmark).collect()}
    assert latent <= both and len(both) > len(items)
    recall = len(latent) / len(both)
    print(f"recall of the latent path alone: {recall:.3f} of {len(both)}")
    assert recall >= 0.9


# --- near duplicates


def families(seed, count, members, template_words, changed, pairs, close):
    """Families on a template of which each member changes many words, and pairs of members that differ in few."""
    draw = random.Random(seed)
    rows, planted = [], []
    for f in range(count):
        base = invented(1000 + f, template_words).split()

        def variant(words, n):
            own = list(words)
            for k in draw.sample(range(len(own)), n):
                own[k] = f"x{draw.randrange(10**9)}"
            return own

        texts = [variant(base, changed) for _ in range(members)]
        for k in range(pairs):
            planted.append((len(rows) + k, len(rows) + members + k))
        texts += [variant(texts[k], close) for k in range(pairs)]
        rows += [(len(rows) + k, " ".join(t)) for k, t in enumerate(texts)]
    return rows, planted


def sets_of(rows):
    return {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, split(t)) for i, t in rows)}


def test_pairs_inside_template_families_are_found(spark):
    rows, planted = families(3, 6, 200, 200, 14, 40, 4)
    sets = sets_of(rows)
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    apart = [alike(k, k + 1) for k in range(0, 100)]
    assert np.mean(apart) < 0.65
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, TEXTS).repartition(4)).collect()}
    true = [p for p in planted if alike(*p) >= 0.8]
    recall = sum(found[a] == found[b] for a, b in true) / len(true)
    print(f"recall in template families: {recall:.3f} of {len(true)}; mean similarity inside {np.mean(apart):.2f}")
    assert len(true) > 100 and recall >= 0.98
    wrong = Counter(found.values())
    assert max(wrong.values()) < 60


def test_a_family_that_stays_large_is_compared_block_by_block(spark, monkeypatch):
    """Members of one template at 0.7 to 0.8: too alike to be divided, too different for one class."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 40)
    rows, planted = families(5, 1, 260, 260, 7, 60, 5)
    seen = []
    links = near_duplicates.family_links
    monkeypatch.setattr(near_duplicates, "family_links", lambda *a: seen.append(1) or links(*a))
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, TEXTS).repartition(4)).collect()}
    sets = sets_of(rows)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids[a + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                one, two = sorted((root(a), root(b)))
                label[two] = one
    want = {i: root(i) for i in ids}
    assert seen
    linked = [(a, b) for a in ids for b in ids[a + 1 :] if want[a] == want[b]]
    kept = sum(found[a] == found[b] for a, b in linked) / max(1, len(linked))
    print(f"{len(set(want.values()))} classes, {len(set(found.values()))} found; pairs kept {kept:.4f} of {len(linked)}")
    assert kept >= 0.97
    assert all(want[a] == want[b] for a in ids for b in (found[a],))


def test_pairs_of_a_block_are_those_of_each_pair_alone():
    draws = np.random.default_rng(2)
    pool = np.sort(draws.choice(1 << 40, 300, replace=False).astype(np.uint64))
    common = (pool[::7], draws.uniform(0.5, 1, len(pool[::7])).astype(np.float32))
    base = draws.random(300) < 0.5
    sets = []
    for _ in range(70):
        chosen = base ^ (draws.random(300) < draws.choice([0.02, 0.06, 0.3]))
        sets.append((pool[chosen], draws.choice([1, 1, 1, 2, 5], chosen.sum()).astype(np.int64)))
    want = {(i, j) for i in range(70) for j in range(i + 1, 70) if max(near_duplicates.similarities(sets[i], sets[j], common)) >= 0.8}
    for columns in (16, 4096):
        near_duplicates.COLUMNS, before = columns, near_duplicates.COLUMNS
        found = set(zip(*(x.tolist() for x in near_duplicates.similar_in_block(sets, common, 0.8))))
        near_duplicates.COLUMNS = before
        assert want <= found
        doubtful = found - want
        assert all(max(near_duplicates.similarities(sets[i], sets[j], common)) >= 0.798 for i, j in doubtful)
    assert 20 < len(want) < 2000


def test_a_text_repeated_is_near_the_text_itself(spark):
    text = invented(71, 200)
    rows = [(1, text), (2, " ".join([text] * 5)), (3, invented(72, 200)), (4, " ".join([invented(72, 200)] * 3))]
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, TEXTS)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3}


# --- packing


@pytest.mark.parametrize("low,high", [(1, 1), (3, 9), (20, 60), (1, 700)])
def test_short_pieces_leave_little_padding(spark, monkeypatch, low, high):
    """Texts whose ids are their characters, so that lengths can be chosen."""

    class Plain:
        def encode_document(self, text):
            return np.arange(len(text), dtype="<u4").tobytes()

    monkeypatch.setattr(packing, "encoder", lambda name: Plain())
    draw = random.Random(low)
    rows = [(i, "x" * draw.randint(low, high)) for i in range(20_000 if high < 100 else 3000)]
    found = packing.pack(spark.createDataFrame(rows, TEXTS).repartition(5), "none").collect()
    assert Counter((r.doc_id, r.length) for r in found) == Counter((i, len(t)) for i, t in rows)
    held: dict[int, list] = {}
    for r in found:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    total = sum(len(t) for _, t in rows)
    least = math.ceil(total / packing.SEQUENCE)
    print(f"{low} to {high} ids: {len(held)} sequences, {least} at least")
    assert len(held) <= max(least + 1, math.ceil(least * 1.04))


# --- language


def test_predictions_are_those_of_plain_averages(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    model = language.train(language.training_sample(table, "doc_id", "text", "lang"), epochs=2, least_steps=20)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(table, model, table.doc_id).collect()}
    for row in table.collect():
        if not row.text or not any(c.isalpha() for c in row.text):
            continue
        counts = language.subword_histogram(np.frombuffer(row.text.encode(), np.uint8))
        mean = sum(int(n) * model.embed[bucket].astype(float) for bucket, n in enumerate(counts) if n) / counts.sum()
        logits = [sum(mean[d] * model.out[d, k] for d in range(len(mean))) + model.bias[k] for k in range(len(model.languages))]
        odds = [math.exp((x - max(logits)) / model.temperature) for x in logits]
        best = max(range(len(odds)), key=odds.__getitem__)
        assert found[row.doc_id][0] == model.languages[best]
        assert abs(found[row.doc_id][1] - odds[best] / sum(odds)) < 1e-3


def test_every_label_of_a_small_sample_can_be_predicted(spark):
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{k % 5}" for k in range(30)), f"l{i % 300:03}") for i in range(1200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = language.training_sample(table, "doc_id", "text", "lang")
    assert sample.select("lang").distinct().count() == 300
    bounded = language.training_sample(table, "doc_id", "text", "lang", per_language=1)
    assert bounded.count() < 600


# --- workers without the library

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__
from legmeter.session import build_session
spark = build_session("far", "local[2]", spark__sql__shuffle__partitions="2", spark__driver__memory="3g")
spark.sparkContext.setLogLevel("ERROR")

def known(rows):
    import importlib.util
    yield importlib.util.find_spec("legmeter") is not None

assert not any(spark.sparkContext.parallelize([0], 1).mapPartitions(known).collect()), "workers can import the library"
for name in {names!r}:
    print(name, __spark_entry__.queries()[name](spark, {data!r}).count())
"""


def test_queries_run_where_workers_cannot_import_the_library(tmp_path):
    names = ["op2_lm_scoring", "op6_language_id", "op10_benchmark_decontamination"]
    script = SCRIPT.format(root=str(ROOT), names=names, data=SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert all(name in done.stdout for name in names)


def test_whole_texts_are_read_as_runs():
    import pyarrow as pa

    runs = [words.documents for _, words in document_runs(pa.array([b"a b", b"c" * 50, b""]), 10)]
    assert sum(runs) == 3


def test_near_copies_in_a_large_bucket_meet_whatever_its_other_bands(spark, monkeypatch):
    """All documents agree in one band and in no other, so neither pivots nor divisions bring the pairs together."""
    pairs = [(i, invented(900 + i, 120)) for i in range(30)]
    rows = [row for i, text in pairs for row in ((i, text), (100 + i, text + " end"))]

    def signed(documents, common):
        bands = F.array(F.lit(1).cast("bigint"), *(F.xxhash64("doc_id", F.lit(k)) for k in range(1, 2 * near_duplicates.BANDS)))
        samples = F.array_repeat(F.lit(7), 2 * near_duplicates.BANDS * near_duplicates.ROWS)
        return documents.select("doc_id", F.md5("text").cast("binary").alias("body"), samples.alias("samples"), bands.alias("bands"))

    monkeypatch.setattr(near_duplicates, "signatures", signed)
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    found = near_duplicates.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == {i: i % 100 for i, _ in rows}
    assert all(r.n_links == 1 for r in found)


def test_scans_for_passages_hold_little_text_at_a_time():
    """Words and windows of a batch of any size are worked out for a bounded piece of it."""
    taken = SimpleNamespace(schema=T.StructType().add("doc_id", T.LongType()), mapInArrow=lambda read, kind: read)
    texts = [f"w{i % 997} x{i % 89} " * 500 for i in range(1600)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], names=["doc_id", "content", "text"])
    read = substrings.scan(taken, 50)
    wanted = [len(t.split()) for t in texts]
    sum(b.num_rows for b in read(iter([batch])))
    tracemalloc.start()
    try:
        found = [n for b in read(iter([batch])) for n in b["n_words"].to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == wanted
    assert peak < 40e6 and batch.nbytes > 6e6
