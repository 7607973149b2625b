"""Each text operator against a plain version in Python, on awkward rows and on the smallest test tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from compare import duck_rows, spark_rows
from pyspark.sql import functions as F
from texts import SCHEMA

import corpus_pipeline
from legmeter.llm import (
    chat, decontaminate, language, language_model, near_duplicates, packing, quality, substrings, token_counts, token_file,
)
from legmeter.llm.encoding import encoder
from legmeter.llm.queries import BYTE_TOKENIZER, QUERIES, SQL, WORD_TOKENIZER
from legmeter.session import work_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def split(text):
    return WORD.findall(text or "")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def by_count(rows):
    return Counter(rows)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def both(spark, awkward):
    return [awkward, documents(spark)]


# --- quality rules


def plain_quality(text):
    words = split(text)
    lines = [x for x in (text or "").split("\n") if split(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            again.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed


def test_quality_measures(spark, awkward):
    for table in both(spark, awkward):
        found = rows_of(quality.judge(table), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert by_count(found) == by_count([(r.doc_id, *plain_quality(r.text)) for r in table.collect()])


def test_quality_filter_keeps_columns_and_agrees_with_the_verdict(awkward, nothing):
    kept = quality.filter_documents(awkward)
    assert kept.columns == awkward.columns
    verdict = {r.doc_id for r in quality.judge(awkward).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    assert quality.filter_documents(nothing).count() == 0 and quality.judge(nothing).count() == 0


def test_quality_rules_reject_junk_and_keep_clean_documents(spark):
    labelled = quality.judge(documents(spark)).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    clean = labelled.where("quality = 1 and not base_failed")
    assert clean.where("not kept").count() == 0
    assert labelled.where("quality = 0 and kept").count() <= 2


# --- language model


def test_stop_words_are_asked_only_of_texts_that_the_list_covers(spark):
    draws = np.random.default_rng(3)

    def text(letters, *often):
        words = ["".join(draws.choice(list(letters), draws.integers(3, 9))) for _ in range(90)]
        return " ".join(often[k % len(often)] if often and k % 10 == 0 else w for k, w in enumerate(words))

    latin = "bcdfghjklm"
    clean = [text("абвгдежзиклмн"), text("αβγδεζηθικλμ"), text("ابتثجحخدذرز"), text("कखगघचछजझाि"), text("가나다라마바사아"), text(latin.upper(), "THE", "AND")]
    # Texts without any listed stop word are in no listed language; those with a few are, and have too few.
    clean += [text(latin), text(latin.upper())]
    junk = [text(latin) + " the", text(latin.upper()) + " UND", text(latin) + " Le"]
    table = spark.createDataFrame(list(enumerate([*clean, *junk])), "doc_id bigint, text string")
    kept = {r.doc_id for r in quality.judge(table).where("kept").collect()}
    assert kept == set(range(len(clean))) == {r.doc_id for r in quality.filter_documents(table).collect()}



def test_language_model_base_and_gain(spark, awkward, nothing):
    for table in both(spark, awkward):
        held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)), F.lit(1)) == 0
        found = language_model.score_corpus(table, held).collect()
        is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        tokens = [(r.doc_id, [*(r.text or "").encode().lower().split(), None]) for r in table.collect()]
        count = Counter(t for i, own in tokens if not is_held(i) for t in own)
        total, distinct = sum(count.values()), len(count)
        floor = math.log10(total + 0.1 * (distinct + 1))
        want = Counter()
        for i, own in tokens:
            base = sum(math.log10(count[t] + 0.1) - floor for t in own)
            want[i, is_held(i), len(own), sum(count[t] > 0 for t in own), total, round(base, 6)] += 1
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want
    unseen = [r for r in found if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert language_model.score_corpus(nothing, F.lit(False)).count() == 0


def test_language_model_probabilities_add_up_to_one():
    words = language_model.Vocabulary(np.empty(0, np.uint64), np.empty(0, int), np.empty(0, int), 10, 5, np.ones(512), np.ones(512))
    model = language_model.initial(words)
    model.target[:] = np.random.default_rng(0).normal(0, 1, model.target.shape)
    near, far, log_z, _ = language_model.normalisers(model)
    for a, b in ((0, 5), (7, 7), (language_model.SYMBOLS, language_model.SYMBOLS)):
        assert np.exp(near[a] + far[b] - log_z[a, b]).sum() == pytest.approx(1.0, abs=1e-3)


# --- token file


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_packed_ids_unpack_anywhere(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    packed = token_file.pack_ids(ids, bits)
    assert len(packed) == -(-1000 * bits // 8)
    for low, high in ((0, 1000), (3, 4), (17, 900), (999, 1000), (5, 5)):
        assert (token_file.unpack_ids(packed, bits, low, high) == ids[low:high]).all()


def test_token_file_round_trip(spark, awkward, nothing):
    encode = encoder(BYTE_TOKENIZER)
    for table in both(spark, awkward):
        path = work_folder(spark, "test-tokens")
        token_file.write_token_file(table, path, BYTE_TOKENIZER, block_ids=4000)
        found = sorted(rows_of(token_file.document_digests(spark, path), "start", "doc_id", "n_tokens", "ids_crc32"))
        ordered = sorted(table.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        ids = [encode.encode_document(r.text) for r in ordered]
        start, want = 0, []
        for row, own in zip(ordered, ids):
            want.append((start, row.doc_id, len(own) // 4, zlib.crc32(own)))
            start += len(own) // 4
        assert found == want
        whole = np.frombuffer(b"".join(ids), "<u4")
        assert (token_file.read_ids(spark, path, 100, 9000) == whole[100:9000]).all()
    path = work_folder(spark, "test-tokens")
    token_file.write_token_file(nothing, path, BYTE_TOKENIZER)
    assert token_file.document_digests(spark, path).count() == 0


# --- chat


def test_escapes_are_undone():
    for text in ("", "\\", "<|im_end|>", "\\n\n", "<\\|x", "a\\\\<|<|\n", "tail\\"):
        for line in (False, True):
            assert chat.unescape(chat.escape(text, line)) == text
            assert "<|" not in chat.escape(text, line)


def test_chat_round_trip_and_shared_turns(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello\n<|im_end|>"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"),
        (3, 0, "user", "hi"), (3, 1, "assistant", "hello\n<|im_end|>"), (3, 2, "user", None), (None, 0, None, "\\n"), (4, 1, "a\nb", ""),
        (4, None, "user", "first"), (5, 0, "user", "hi"), (5, 0, "user", "hi"),
    ]
    table = spark.createDataFrame([(*t, "x") for t in turns], "conv_id bigint, turn bigint, role string, text string, path string")
    for most in (1, 1000):
        path = work_folder(spark, "test-chat")
        chat.format_conversations(table, BYTE_TOKENIZER, sequence_conversations=most).write.parquet(path)
        found = {r.conv_id: r for r in chat.conversation_digests(spark, path, BYTE_TOKENIZER).collect()}
        groups = defaultdict(list)
        for conv, turn, role, text in turns:
            groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
        assert set(found) == set(groups)
        for conv, own in groups.items():
            own.sort()
            learned = "".join(t for *_, r, t in own if r == "assistant")
            assert found[conv].n_turns == len(own)
            assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in own).encode()).hexdigest()
            assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
            shown = "".join(f"<|im_start|>{chat.escape(r, True)}\n{chat.escape(t)}<|im_end|>\n" for *_, r, t in own)
            assert found[conv].formatted_chars == len(shown)
    trees = spark.read.parquet(path).collect()
    assert sum(len(t.node_start) for t in trees) < len(turns)
    for tree in trees:
        for node, parent in enumerate(tree.node_parent):
            low, high = tree.node_start[node], tree.node_end[node]
            above = sum(s.end - s.start for s in tree.attends[node])
            assert list(tree.position_ids[low:high]) == list(range(above, above + high - low))
            assert parent < node


# --- token counts


def test_token_counts(spark, awkward, nothing):
    encode = encoder(BYTE_TOKENIZER)
    for table in both(spark, awkward):
        lengths = sorted(len(encode.encode_document(r.text)) // 4 for r in table.collect())
        histogram = token_counts.length_histogram(table, BYTE_TOKENIZER)
        found = {r.length: r for r in token_counts.limit_table(histogram, span=100).collect()}
        assert {k: r.n_docs for k, r in found.items()} == Counter(lengths)
        for limit, row in found.items():
            assert row.docs_at_most == sum(x <= limit for x in lengths)
            assert row.tokens_at_most == sum(x for x in lengths if x <= limit)
            assert row.truncated_tokens == sum(min(x, limit) for x in lengths)
            assert row.truncated_tokens + row.lost_tokens == sum(lengths)
        totals = rows_of(token_counts.truncated_totals(histogram, [0, 3, 10**9]), "context", "tokens")
        assert totals == [(c, sum(min(x, c) for x in lengths)) for c in (0, 3, 10**9)]
        half = rows_of(token_counts.quantiles(token_counts.limit_table(histogram), [0.5, 1.0]), "length")
        assert half == [(lengths[math.ceil(len(lengths) / 2) - 1],), (lengths[-1],)]
    assert token_counts.limit_table(token_counts.length_histogram(nothing, BYTE_TOKENIZER)).count() == 0


# --- language


def test_subword_histogram_does_not_depend_on_pieces(monkeypatch):
    data = np.frombuffer(("Ab cé\n" * 300).encode(), np.uint8)
    whole = language.subword_histogram(data)
    monkeypatch.setattr(language, "_STEP", 97)
    assert (language.subword_histogram(data) == whole).all()


def test_language_of_held_out_documents(spark, awkward, nothing):
    found = QUERIES["op6_language_id"](spark, SMALL).join(documents(spark).select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in found if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == r.lang for r in unseen) >= 0.97 * len(unseen) > 30
    model = language.train(language.training_sample(documents(spark), "doc_id", "text", "lang"))
    rows = language.predict(awkward, model, F.col("doc_id")).collect()
    assert len(rows) == awkward.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {4, 5, 6, 13}
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.predict(nothing, model, F.col("doc_id")).count() == 0
    assert language.train(language.training_sample(nothing, "doc_id", "text", "lang")) is None
    assert {r.lang_pred for r in language.predict(awkward, None, F.col("doc_id")).collect()} == {"und"}


# --- substrings


def plain_removal(rows, window=50):
    first = {}
    for i, text in rows:
        if i is not None:
            words = split(text)
            for k in range(len(words) - window + 1):
                key = tuple(words[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in rows:
        words, gone = split(text), set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if gone else text))
    return out


def test_substring_removal(spark, awkward, nothing):
    for table in both(spark, awkward):
        want = plain_removal([(r.doc_id, r.text) for r in table.collect()])
        found = rows_of(substrings.removal_digests(table), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert by_count(found) == by_count([w[:4] for w in want])
        stripped = substrings.strip_documents(table)
        assert stripped.columns == table.columns
        assert by_count(rows_of(stripped, "doc_id", "text")) == by_count([(w[0], w[4]) for w in want])
    assert substrings.removal_digests(nothing).count() == 0 and substrings.strip_documents(nothing).count() == 0


def test_suffix_automaton_knows_first_documents():
    automaton = substrings.SuffixAutomaton()
    lists = {1: [1, 2, 3, 1, 2, 3, 4], 3: [9, 1, 2, 3, 1, 5], 7: [2, 3, 1, 5, 5, 5]}
    for document, symbols in lists.items():
        automaton.add(symbols, document)
    for least in (2, 3, 4):
        for before in (2, 4, 8):
            text = [9, 1, 2, 3, 1, 5, 5, 5, 4, 1, 2, 3, 4]
            known = {tuple(s[k : k + least]) for d, s in lists.items() if d < before for k in range(len(s) - least + 1)}
            want = {k + j for k in range(len(text) - least + 1) if tuple(text[k : k + least]) in known for j in range(least)}
            assert {k for a, b in automaton.spans(text, least, before) for k in range(a, b)} == want


# --- packing


def test_packing(spark, awkward, nothing):
    encode = encoder(WORD_TOKENIZER)
    for table in both(spark, awkward):
        found = packing.pack(table, WORD_TOKENIZER).collect()
        want = Counter()
        for row in table.collect():
            ids = encode.encode_document(row.text)
            for start in range(0, len(ids) // 4, 4096):
                piece = ids[4 * start : 4 * (start + 4096)]
                want[row.doc_id, start, len(piece) // 4, zlib.crc32(piece), len(ids) // 4] += 1
        assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
        sequences = defaultdict(list)
        for r in found:
            sequences[r.sequence_id].append((r.offset, r.length))
        for held in sequences.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 4096
    assert 1 - sum(r.length for r in found) / (4096 * len(sequences)) < 0.04
    assert packing.pack(nothing, WORD_TOKENIZER).count() == 0


def test_cutting_stock_places_every_piece_near_the_bound():
    # Sizes of which several fit: the material bound is then close to the best packing.
    demand = np.random.default_rng(5).integers(0, 400, 512) // (1 + np.arange(512) // 64) ** 2
    plan = packing.cutting_stock(demand, 512)
    placed = np.zeros(512, int)
    for times, held in plan:
        assert sum(size * n for size, n in held.items()) <= 512
        for size, n in held.items():
            placed[size - 1] += times * n
    assert (placed == demand).all()
    assert sum(times for times, _ in plan) <= 1.02 * math.ceil((demand * np.arange(1, 513)).sum() / 512)


# --- near duplicates


def plain_classes(rows):
    own = {}
    for i, text in rows:
        words = split(text)
        if i is not None and words:
            own.setdefault(i, set()).update(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
    label = {i: i for i in own}
    ids = sorted(own)
    for _ in ids:
        moved = False
        for a in ids:
            for b in ids:
                if label[a] < label[b] and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]):
                    label[b], moved = label[a], True
        if not moved:
            break
    return label


def test_near_duplicates(spark, awkward, nothing):
    for table in both(spark, awkward):
        rows = table.collect()
        label = plain_classes([(r.doc_id, r.text) for r in rows])
        found = rows_of(near_duplicates.near_duplicate_classes(table), "doc_id", "class_id")
        assert by_count(found) == by_count([(r.doc_id, label.get(r.doc_id, r.doc_id)) for r in rows])
    kept = near_duplicates.keep_one(table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in label.items() if i == c} | {r.doc_id for r in rows if not split(r.text)}
    assert near_duplicates.near_duplicate_classes(nothing).count() == 0


def test_large_groups_of_copies_are_linked_without_all_pairs(spark):
    base = [f"w{k}" for k in range(200)]
    texts = []
    for i in range(300):
        own = list(base)
        own[(i * 7) % 200] = f"x{i}"
        texts.append((i, " ".join(own)))
    table = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = near_duplicates.near_duplicate_classes(table).collect()
    assert {r.class_id for r in found} == {0}
    assert sum(r.n_links for r in found) / 2 < 300 * 299 / 8


def test_weighted_samples_agree_as_often_as_documents_are_similar():
    draws = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        pool = np.sort(draws.integers(1, 1 << 62, 150, dtype=np.uint64))
        weight = draws.random(150).astype(np.float32) + np.float32(0.2)
        one, two = draws.random(150) < 0.9, draws.random(150) < 0.9
        union, shared = weight[one | two].sum(), weight[one & two].sum()
        a = near_duplicates.weighted_samples(pool[one], weight[one], np.array([0]))
        b = near_duplicates.weighted_samples(pool[two], weight[two], np.array([0]))
        agree.append((a == b).mean() - shared / union)
    assert abs(np.mean(agree)) < 0.04


# --- decontamination


def test_common_subsequence():
    lengths = decontaminate.common_subsequence([1, 2, 3, 4, 2], [2, 4, 3, 4, 9, 2])
    assert lengths[-1] == 4 and lengths[0] == 0


def test_leaks_and_paraphrases_are_found(spark, nothing):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    table = documents(spark)
    fold = lambda t: " ".join(re.sub(r"[!-/:-@\[-`{-~]", " ", t or "").lower().split())
    want = {(r.doc_id, i) for r in table.collect() for i, t in items.items() if f" {fold(t)} " in f" {fold(r.text)} "}
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, benchmark).collect()}
    assert want <= found and len(found - want) <= 1
    clean = [r.text for r in table.collect() if r.doc_id not in {d for d, _ in found} and r.text and len(r.text) > 800][:8]
    planted = []
    for k, (item, text) in enumerate(sorted(items.items())[:8]):
        words = text.split()
        words[1::6] = ["changed"] * len(words[1::6])
        planted.append((k, clean[k] + " " + " ".join(words) + " " + clean[k][:200], "x"))
    again = spark.createDataFrame(planted + [(90, None, "x"), (91, "", "x"), (None, clean[0], "x")], "doc_id bigint, text string, item_id string")
    hits = {r.doc_id: r.item_id for r in decontaminate.leaks(again, benchmark).collect()}
    assert hits == {k: item for k, item in enumerate(sorted(items)[:8])}
    assert {r.doc_id for r in decontaminate.drop_leaks(again, benchmark).collect()} == {90, 91, None}
    assert decontaminate.leaks(nothing, benchmark).count() == 0
    assert decontaminate.leaks(table, benchmark.limit(0)).count() == 0


LEAK_SCHEMA = "doc_id bigint, text string"


def drawn(draws, size, words=5000):
    return [f"w{k}" for k in draws.integers(0, words, size)]


def test_an_item_that_a_third_of_all_documents_hold_is_found(spark):
    draws = np.random.default_rng(5)
    item = drawn(draws, 30)
    rows = [(k, " ".join(drawn(draws, 150) + (item if k % 3 == 0 else []) + drawn(draws, 150))) for k in range(120)]
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    found = rows_of(decontaminate.leaks(spark.createDataFrame(rows, LEAK_SCHEMA), benchmark), "doc_id", "item_id", "common")
    assert by_count(found) == by_count([(k, 7, 1.0) for k in range(0, 120, 3)])


def test_a_leak_in_one_short_document_is_found(spark):
    item = "which river runs through the old town and how long is it from its spring to the sea"
    table = spark.createDataFrame([(1, f"we ask: {item}?"), (2, "nothing of the kind")], LEAK_SCHEMA)
    benchmark = spark.createDataFrame([(3, item)], "item_id bigint, text string")
    assert rows_of(decontaminate.leaks(table, benchmark), "doc_id", "item_id", "common") == [(1, 3, 1.0)]
    assert rows_of(decontaminate.drop_leaks(table, benchmark), "doc_id") == [(2,)]


def test_long_items_and_their_paraphrases_are_found(spark):
    draws = np.random.default_rng(6)
    items = {k: drawn(draws, size) for k, size in enumerate((110, 170, 300, 900))}
    rows = [(-k, " ".join(drawn(draws, 400))) for k in range(1, 40)]
    for k, item in items.items():
        changed = [w if i % 10 < 7 else "other" for i, w in enumerate(item)]
        rows += [(10 + k, " ".join(drawn(draws, 90) + item + drawn(draws, 90))), (20 + k, " ".join(drawn(draws, 90) + changed))]
    benchmark = spark.createDataFrame([(k, " ".join(item)) for k, item in items.items()], "item_id bigint, text string")
    found = rows_of(decontaminate.leaks(spark.createDataFrame(rows, LEAK_SCHEMA), benchmark), "doc_id", "item_id")
    assert sorted(found) == sorted((base + k, k) for base in (10, 20) for k in items)


def plain_leaks(words, items):
    """Every (document, item) that some window of the document holds, with the best share: all windows are aligned."""
    found = {}
    for d in range(words.documents):
        start, end = int(words.bounds[d]), int(words.bounds[d + 1])
        for i, own in enumerate(items):
            wide = 2 if len(own) <= 24 else 4
            while wide * 16 < len(own):
                wide *= 2
            for first in range(start, end, 16):
                region = words.hash[max(first - len(own) - 16, start) : min(first + wide * 16 + len(own) + 16, end)]
                common, answer = decontaminate._checked(own, region)
                if common >= 0.65 and answer >= 0.5:
                    found[d, i] = max(found.get((d, i), 0), common)
    return found


def test_leaks_are_those_of_a_check_of_all_windows(spark):
    draws = np.random.default_rng(7)
    vocabulary = np.array([f"v{k}" for k in range(400)])
    chance = 1 / np.arange(1, 401)
    text = lambda n: draws.choice(vocabulary, n, p=chance / chance.sum()).tolist()
    items = [text(n) for n in (1, 2, 5, 9, 15, 24, 25, 40, 64, 65, 90, 140)] + [["v0", "v1", "v2"] * 6]
    rows = []
    for k in range(120):
        item = items[k % len(items)]
        kept = [w for w in item if draws.random() < draws.uniform(0.6, 1)]
        rows.append(" ".join(text(draws.integers(0, 120)) + kept + text(draws.integers(0, 120))))
    words = decontaminate.document_runs
    run = next(words(decontaminate.pa.array([r.encode() for r in rows]), 1 << 24, decontaminate.PLAIN))[1]
    asked = next(words(decontaminate.pa.array([" ".join(i).encode() for i in items]), table=decontaminate.PLAIN))[1]
    hashes = [asked.hash[asked.bounds[k] : asked.bounds[k + 1]] for k in range(len(items))]
    table = spark.createDataFrame(list(enumerate(rows)), LEAK_SCHEMA)
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.common for r in decontaminate.leaks(table, benchmark).collect()}
    assert found == plain_leaks(run, hashes) and len(found) > 100


# --- pipeline and catalogue


def test_every_stage_decides_on_what_the_last_one_kept(spark):
    docs = documents(spark)
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = work_folder(spark, f"test-{name}")
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns
        held[name] = docs.collect(), after.collect()
        docs = after
    ids = lambda rows: {r.doc_id for r in rows}
    before, after = held["quality_rules"]
    assert all(not plain_quality(r.text)[-1] for r in after)
    before, after = held["near_dedup"]
    assert ids(after) == {i for i, c in plain_classes([(r.doc_id, r.text) for r in before]).items() if i == c}
    before, after = held["substring_dedup"]
    want = {w[0]: w[4] for w in plain_removal([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == want
    before, after = held["decontamination"]
    assert 0 < len(ids(before) - ids(after)) < 0.2 * len(before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert ids(packed) == ids(after)
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in whole.collect()} == ids(after)


def test_quality_query_asks_stop_words_of_every_text(spark, tmp_path):
    stuff = [" ".join(f"{c}{k}x" for k in range(60)) for c in ("bcd", "ж", "한", "ZZ")]
    rows = [*enumerate([*stuff, stuff[0] + " the", stuff[1] + " the and"]), (6, stuff[0][:90]), (7, stuff[0] + " the AND"), (None, stuff[1])]
    spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op1_quality_rules"](spark, str(tmp_path))
    assert {r.doc_id for r in found.where("kept").collect()} == {5, 6, 7}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert spark_rows(found) == duck_rows(con, SQL["op1_quality_rules"])


@pytest.mark.parametrize("name", ["op1_quality_rules", "op7_substring_dedup"])
def test_sql_agrees_on_awkward_rows(spark, awkward, tmp_path, name):
    awkward.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert spark_rows(QUERIES[name](spark, str(tmp_path))) == duck_rows(con, SQL[name])


def test_registered_queries():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
