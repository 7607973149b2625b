"""Exact duplicates, Merkle manifest and hard negatives against plain versions in Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F

from legmeter.llm import exact_dedup, hard_negatives, merkle
from legmeter.llm.queries import QUERIES, SQL
from legmeter.session import work_folder

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def small_letters(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle_manifest"])
def test_sql_agrees_on_awkward_rows(spark, awkward, tmp_path, name):
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert spark_rows(QUERIES[name](spark, str(tmp_path))) == duck_rows(con, SQL[name])


# --- exact duplicates


def plain_decisions(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[small_letters(text)].append(doc_id)
    found = Counter()
    for body, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for at, doc_id in enumerate(sorted(ids, key=lambda i: (i is not None, i), reverse=True)):
            found[doc_id, best, len(ids), not at, sha(body)] += 1
    return found


def decisions(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def text_rows(seed, size):
    draw = random.Random(seed)
    texts = [f"{draw.choice(['Text', 'tEXT', 'É text', 'é text', ''])} {draw.randrange(8)}" for _ in range(size)]
    return [(draw.choice([None, *range(300)]), draw.choice([t, t, None])) for t in texts]


@pytest.mark.parametrize("key_bytes", [32, 1, 0])
def test_texts_of_one_digest_are_told_apart_by_their_bytes(spark, key_bytes):
    rows = text_rows(1, 400)
    path = work_folder(spark, "texts")
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(path)
    assert decisions(exact_dedup.exact_duplicates(spark, path, key_bytes=key_bytes)) == plain_decisions(rows)


def test_the_state_outlives_a_run(spark):
    path, state = work_folder(spark, "texts"), work_folder(spark, "state")
    seen = []
    for part in range(3):
        fresh = [(1000 * part + i, text) for i, (_, text) in enumerate(text_rows(part, 60))]
        spark.createDataFrame(fresh, "doc_id bigint, text string").repartition(2).write.mode("append").parquet(path)
        seen += fresh
        exact_dedup.update_state(spark, path, state, batch_files=1)
        assert decisions(exact_dedup.decide(spark, path, state)) == plain_decisions(seen)
    held = exact_dedup.retained(spark, state).agg(F.sum("size")).first()[0]
    assert held == len(seen)


def test_no_documents_give_no_decisions(spark, nothing):
    path = work_folder(spark, "texts")
    nothing.write.parquet(path)
    assert exact_dedup.exact_duplicates(spark, path).count() == 0


# --- Merkle manifest


def plain_manifest(rows):
    """Rows ``doc_id, source, lang, n_chars, text``; the manifest by lists."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """The root of a list of digests, and for each the steps ``(before, after)`` to it."""
        paths = [[] for _ in nodes]
        holds = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            above, held = [], []
            for low in range(0, len(nodes), 16):
                run = nodes[low : low + 16]
                for at in range(len(run)):
                    for i in holds[low + at]:
                        paths[i].append(("".join(run[:at]), "".join(run[at + 1 :])))
                above.append(sha("".join(run)))
                held.append([i for h in holds[low : low + 16] for i in h])
            nodes, holds = above, held
        return (nodes or [None])[0], paths

    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:3])
        inner[name] = climb([x[2] for x in trees[name]])
    root, upper = climb([inner[name][0] for name in names])
    found = Counter()
    for name, above in zip(names, upper):
        for (_, _, digest, row), path in zip(trees[name], inner[name][1]):
            folded = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                folded = leaf((*row[:4], row[4] and small_letters(row[4])))
            steps = path + above
            for before, after in steps:
                folded = sha(before + folded + after)
            proof = sha("".join(before + after for before, after in steps))
            found[row[0], digest, inner[name][0], root, proof, folded, folded == root] += 1
    return found


def manifest_rows(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def source_rows(sizes):
    draw = random.Random(5)
    numbers = iter(draw.sample(range(100_000), sum(sizes.values())))
    return [
        (next(numbers), source, draw.choice([None, "en", "ü"]), draw.choice([None, -3, 17]), draw.choice([None, "", "Über ABC", f"x{draw.random()}"]))
        for source, size in sizes.items() for _ in range(size)
    ]


MANY = {f"s{k}": 1 + k % 3 for k in range(40)}


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 16}, {"a": 17}, {None: 300, "n": 1, "": 33, "é": 256, "z": 257}, {None: 1, "b": 2}, {**MANY, None: 4200}], ids=range(6)
)
def test_manifest(spark, sizes):
    rows = source_rows(sizes)
    table = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert manifest_rows(merkle.manifest(table.repartition(4, "doc_id"))) == plain_manifest(rows)


def test_manifest_of_awkward_and_test_rows(spark, awkward, nothing):
    for table in (awkward, spark.read.parquet(f"{SMALL}/documents.parquet")):
        rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in table.collect()]
        found = manifest_rows(merkle.manifest(table))
        assert found == plain_manifest(rows)
    assert not all(key[-1] for key in found) and any(key[-1] for key in found)
    assert merkle.manifest(nothing).count() == 0


def test_proofs_carry_columns_and_fold_to_the_root(spark, awkward):
    leaves = merkle.table_leaves(awkward).withColumn("steps_taken", F.lit(7))
    proved = merkle.proofs(leaves)
    assert proved.columns == ["doc_id", "leaf", "altered", "steps_taken", "steps", "subroot", "root"]
    folded = proved.select("root", merkle.fold(F.col("leaf"), F.col("steps")).alias("folded")).distinct().collect()
    assert len(folded) == 1 and folded[0].root == folded[0].folded


# --- hard negatives


def plain_negatives(rows, anchors, window=(50, 95)):
    """Rows ``vec_id, label, vector`` of whole numbers, one an id."""
    found = set()
    for own, label, anchor in rows:
        if not anchors(own):
            continue
        scored = sorted((-sum(x * y for x, y in zip(anchor, v)), i, l == label) for i, l, v in rows if i != own)
        for score, positive, _ in [s for s in scored if s[2]][:5]:
            fit = [s for s in scored if not s[2] and window[0] * -score <= 100 * -s[0] <= window[1] * -score][:3]
            found.update((own, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(fit, 1))
    return found


def vector_rows(size, dimension, spread, labels=4):
    draw = np.random.default_rng(size)
    centres = draw.integers(-spread, spread + 1, (5, dimension))
    return [
        (int(i), int(draw.integers(labels)), [int(x) for x in centres[draw.integers(5)] + draw.integers(-spread // 4 - 1, spread // 4 + 2, dimension)])
        for i in draw.permutation(size)
    ]


@pytest.mark.parametrize("size,dimension,spread", [(300, 8, 100), (200, 1, 3), (250, 7, 1), (120, 4, 60_000_000), (90, 6, 30_000)])
def test_hard_negatives(spark, size, dimension, spread):
    rows = vector_rows(size, dimension, spread)
    table = spark.createDataFrame(rows, "vec_id bigint, label int, vector array<bigint>")
    for settings in ({}, {"codewords": 6, "shard_rows": 40, "block": 5}):
        found = hard_negatives.mine(table, F.col("vec_id") % 5 == 0, **settings).collect()
        assert {tuple(r) for r in found} == plain_negatives(rows, lambda i: i % 5 == 0) and len(found) == len(set(found))


def test_hard_negatives_of_a_very_common_vector(spark):
    rows = [(i, i % 3, [5, 5, 1 + (i > 400)]) for i in range(600)]
    table = spark.createDataFrame(rows, "vec_id bigint, label int, vector array<bigint>")
    wanted = plain_negatives(rows, lambda i: i % 50 == 0, window=(50, 100))
    found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0, window=(50, 100), shard_rows=64, block=4)
    assert {tuple(r) for r in found.collect()} == wanted and wanted


def test_rows_that_take_no_part(spark):
    rows = [(i, label, [float(x) / 256 for x in v]) for i, label, v in vector_rows(100, 6, 40)]
    odd = [
        (None, 1, rows[0][2]), (500, None, rows[0][2]), (550, 1, None), (600, 1, []), (650, 1, [1.0] * 5), (700, 1, [1.0] * 5 + [None]),
        (750, 1, [1.0] * 5 + [math.nan]), (800, 1, [1.0] * 5 + [math.inf]), (850, 1, [1e30] * 6), (rows[0][0], -1, [9.0] * 6),
    ]
    table = spark.createDataFrame(rows + odd + rows[3:5], "vec_id bigint, label int, embedding array<double>")
    usable = table.select("vec_id", "label", hard_negatives.whole_numbers(F.col("embedding"), 256).alias("vector"), F.lit(0).alias("cell"))
    found = {tuple(r) for r in hard_negatives.mine(usable, F.col("vec_id") % 5 == 0).collect()}
    assert found == plain_negatives([(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows], lambda i: i % 5 == 0)
    assert hard_negatives.mine(usable.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_a_walk_skips_cells_that_cannot_matter():
    draw = np.random.default_rng(0)
    import pyarrow as pa

    centres = draw.integers(-1000, 1001, (8, 16))
    vectors = centres[np.repeat(np.arange(8), 500)] + draw.integers(-5, 6, (4000, 16))
    words = (centres[:, :8].astype(float), centres[:, 8:].astype(float))
    owner = np.repeat(np.arange(8), 500)
    table = pa.table({"vec_id": np.arange(4000), "label": np.zeros(4000, int), "vector": vectors.tolist(), "cell": owner * 8 + owner})
    shard = hard_negatives.Shard(table, words)
    scores, ids = shard.positives(vectors[0], 0, 0, 5)
    wanted = sorted(((-int(s), i) for i, s in enumerate(vectors @ vectors[0]) if i))[:5]
    assert list(zip((-scores).tolist(), ids.tolist())) == wanted
    least = scores[-1]
    seen = []
    scored = shard.walk(vectors[0], lambda bound: bound < least, lambda rows, _: seen.extend(rows))
    assert scored == len(seen) < 2000
