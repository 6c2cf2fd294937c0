"""Operators that map one text to one row: token counts, rules, classifier, decontamination."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from macrotide.llm import byte_cnn, decontamination, quality_rules, token_counts
from tests.conftest import SF_DIR
from tests.llm.conftest import tuples
from tests.llm.queries import run

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def random_text(rng, alphabet, most=120):
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, most)))


# Token counts


def sentencepiece_counts(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(x) for x in model.encode(list(texts))]


def test_pieces_of_pre_tokens_add_up_to_the_library():
    rng = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "日本", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "ﬁ", "1", ".", "😀"]
    texts = ["", " ", "  ", "▁", " a", "a ", "a  ", "\n"] + [random_text(rng, alphabet, 40) for _ in range(800)]
    counter = token_counts.PieceCounter(MODEL, 300)  # a small table, so that it starts anew often
    assert [counter.count(t) for t in texts] == sentencepiece_counts(texts)


def test_token_counts_of_all_documents(spark):
    found = run(spark, "op6_token_counts")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r, n in zip(found, sentencepiece_counts(texts[r.doc_id] for r in found), strict=True):
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_token_counts_of_odd_rows(frame, odd_rows):
    found = tuples(token_counts.token_counts(frame(odd_rows), MODEL), "doc_id", "n_bytes", "n_tokens")
    texts = [r[2] or "" for r in odd_rows]
    wanted = [(r[0], len(t.encode()), n) for r, t, n in zip(odd_rows, texts, sentencepiece_counts(texts), strict=True)]
    assert Counter(found) == Counter(wanted)
    assert token_counts.token_counts(frame([]), MODEL).count() == 0


# Quality rules


def brute_repeats(text, least):
    found = {}
    for i in range(len(text)):
        best = 0
        for j in range(len(text)):
            n = 0
            while i != j and max(i, j) + n < len(text) and text[i + n] == text[j + n]:
                n += 1
            best = max(best, n)
        if best >= least:
            found[i] = best
    return found


def test_repeated_spans_match_brute_force():
    rng = random.Random(2)
    for k in range(250):
        least = rng.choice([8, 16, 32])
        text = random_text(rng, "ab\x00é"[: rng.randint(1, 4)], 80).encode() * (1 + k % 2)
        begins, lengths = quality_rules.repeated_spans(text, least)
        assert dict(zip(begins.tolist(), lengths.tolist(), strict=True)) == brute_repeats(text, least)
        marks = {p for b, n in zip(begins, lengths, strict=True) for p in range(b, b + n)}
        assert quality_rules.covered(begins, lengths) == len(marks)


def base_rules(text):
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    count = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marks = {i + k for i in range(len(words) - 4) if count[tuple(words[i : i + 5])] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(marks) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(marks), failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_rules_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = run(spark, "op9_quality_rules")
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in BASE) == base_rules(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.covered_fraction <= 0.3 and r.longest_repeat <= 1500)


def test_quality_rules_of_odd_rows(frame, odd_rows):
    found = tuples(quality_rules.quality_rules(frame(odd_rows)), "doc_id", *BASE)
    assert Counter(found) == Counter((r[0], *base_rules(r[2] or "")) for r in odd_rows)
    assert quality_rules.quality_rules(frame([])).count() == 0


def test_a_long_repeat_is_rejected_and_clean_text_is_kept(frame):
    rng = random.Random(9)
    words = [random_text(rng, "abcdefgh", 9) or "x" for _ in range(2000)]
    clean = " ".join(words)
    again = clean + " " + " ".join(words[:300])
    judged = dict(tuples(quality_rules.quality_rules(frame([(1, "a", clean), (2, "a", again)])), "doc_id", "kept"))
    assert judged == {1: True, 2: False}


# Quality classifier


def test_classifier_tells_held_out_documents_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = run(spark, "op4_quality_scores", sf_dir)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([a > b for a in good for b in bad])
    assert auc > 0.95


def test_classifier_scores_odd_rows_and_learns_from_few(frame, odd_rows, spark):
    junk, fine = "!! ** !! ** ## %% !! ** !! " * 12, "and then it was as it had been for some time before that. " * 6
    rows = [(k, "a", junk if k % 2 else fine + str(k)) for k in range(100, 180)]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(100, 180)] + [(None, 1), (101, None)], "doc_id bigint, quality int")
    model = byte_cnn.train_quality(frame(rows), labels)
    scores = dict(tuples(byte_cnn.score_quality(frame([(1, "a", junk), (2, "a", fine)]), model), "doc_id", "score"))
    assert scores[1] < 0.3 < scores[2]
    assert len(tuples(byte_cnn.score_quality(frame(odd_rows), model))) == len(odd_rows)
    assert byte_cnn.score_quality(frame([]), model).count() == 0
    assert byte_cnn.keep_quality(frame(odd_rows), 1.0).count() == len(odd_rows)


def test_long_texts_are_learned_from(frame, spark):
    """All texts of label 1 are over the limit for whole texts."""
    rng = random.Random(3)
    fine = ["the river ran past old houses and people spoke of it with care. " * 30 for _ in range(40)]
    junk = ["".join(rng.choice("#%&0123456789!xq ") for _ in range(900)) for _ in range(40)]
    rows = [(k, "a", t) for k, t in enumerate(junk + fine)]
    labels = spark.createDataFrame([(k, int(k >= 40)) for k in range(80)], "doc_id bigint, quality int")
    model = byte_cnn.train_quality(frame(rows), labels, bounds=byte_cnn.TrainingBounds(text_bytes=1024))
    scores = dict(tuples(byte_cnn.score_quality(frame([(1, "a", junk[0]), (2, "a", fine[0])]), model), "doc_id", "score"))
    assert scores[1] < 0.3 < scores[2]
    # Pieces are bytes of the text in order, also where characters have several.
    text = "é日b" * 5000
    found = frame([(7, "a", text), (8, "a", "short")]).select(
        byte_cnn._sampled_bytes(F.col("doc_id"), F.col("text"), 1600).alias("b")
    ).collect()
    pieces = [bytes(found[0].b)[k : k + 100] for k in range(0, 1600, 100)]
    assert len(found[0].b) == 1600 and all(p in text.encode() for p in pieces) and bytes(found[1].b) == b"short"


def test_labels_of_one_kind_or_none_give_a_constant(frame, spark):
    rows = frame([(1, "a", "x y z"), (2, "a", "p q r"), (3, "a", None)])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    good = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id bigint, quality int")
    assert byte_cnn.train_quality(rows, none) == 0.5
    assert byte_cnn.train_quality(rows, good) == 1.0


def test_training_leaves_the_driver_alone(spark, monkeypatch):
    """The driver neither trains nor holds texts of the sample; the weights are those of the sample in order."""
    rows = [(i, ("good words " if i % 2 else "bad bytes ") * 30, i % 2) for i in range(1, 60)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")
    seen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    bounds = byte_cnn.TrainingBounds(epochs=2)
    ordered = sorted(seen, key=lambda r: (r[2], r[0]))
    ones = sum(r[2] for r in seen)
    plain = byte_cnn.ByteCnn().train([r[1].encode() for r in ordered], np.array([r[2] for r in ordered], np.float32), bounds, ones / (len(seen) - ones))

    here = os.getpid()

    def elsewhere(self, *args):
        if os.getpid() == here:
            raise AssertionError("trained in the driver")
        return train(self, *args)

    train = byte_cnn.ByteCnn.train
    monkeypatch.setattr(byte_cnn.ByteCnn, "train", elsewhere)
    found = byte_cnn.train_quality(docs, labels, bounds=bounds)
    assert all(np.allclose(found.weights[k], v, atol=1e-4) for k, v in plain.weights.items())


def test_scores_do_not_depend_on_how_chunks_are_worked_through():
    model = byte_cnn.ByteCnn().start()
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 255, n).astype(np.uint8) for n in (0, 1, 500, 513, 5000, 40_000)]
    data, offsets = np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts]))
    whole = model.scores(data, offsets)
    assert np.allclose(whole, model.scores(data, offsets, at_once=3), atol=1e-6)
    # The last chunk reaches the last byte.
    assert all(model.chunks_of(n)[-1] + model.chunk >= n for n in range(0, 3000, 7))


# Decontamination


def brute_hits(texts, items, width=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: word.findall((t or "").translate(lower))
    patterns = {}
    for item, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - width + 1)) if words else ():
            patterns.setdefault(tuple(words[i : i + width]), set()).add(item)
    found = []
    for text in texts:
        words, hit, named = cut(text), set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in patterns:
                    hit |= set(range(i, i + size))
                    named |= patterns[tuple(words[i : i + size])] - {None}
        found.append((len(words), len(hit), sorted(map(str, named))))
    return found


def decontamination_case(rng):
    items = [(k, " ".join(rng.choice(["a1", "b", "c", "dé", "E"]) for _ in range(rng.randint(0, 18)))) for k in range(14)]
    items += [(3, items[3][1]), (None, items[5][1]), (99, None)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(items)[1] or "" if rng.random() < 0.5 else " ".join(rng.choice("xyzbc") for _ in range(rng.randint(0, 20))) for _ in range(3)]
        texts.append(rng.choice([" ", "-", "\n?", "…! "]).join(parts))
    return items, texts


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_benchmark_hits_match_brute_force(frame, spark, block_bytes):
    items, texts = decontamination_case(random.Random(4))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS spans", "2 AS doc_id")
    docs = frame([(k, "a", t) for k, t in enumerate(texts)])
    found = decontamination.benchmark_hits(docs, benchmark, block_bytes=block_bytes)
    rows = {r.doc_id: r for r in found.collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    for k, (n_words, n_hit, named) in enumerate(brute_hits(texts, items)):
        r = rows[k]
        spans = list(zip(r.spans[::2], r.spans[1::2], strict=True))
        assert (r.n_words, sum(b - a for a, b in spans), r["items"]) == (n_words, n_hit, named)
        # The same words stand at the character offsets of the original.
        original = word.findall(texts[k])
        for (a, b), x, y in zip(spans, r.char_spans[::2], r.char_spans[1::2], strict=True):
            assert word.findall(texts[k][x:y]) == original[a:b]


def test_contaminated_documents_go_and_others_keep_all_columns(frame, odd_rows, spark):
    passage = " ".join(f"w{i}" for i in range(20))
    benchmark = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    docs = frame([*odd_rows, (50, "a", passage), (51, "a", passage + " other" * 1000)])
    kept = decontamination.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([r[0] for r in odd_rows] + [51])
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.drop_contaminated(docs, empty).count() == len(odd_rows) + 2
    assert decontamination.drop_contaminated(frame([]), benchmark).count() == 0


def test_item_digest_is_of_sorted_ids(spark):
    found = run(spark, "op8_benchmark_hits")
    assert any(r.n_items for r in found)
    assert all(r.items_sha256 == hashlib.sha256(b"").hexdigest() for r in found if not r.n_items)
