"""Near duplicates, repeated strings and the language model."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from macrotide.llm import language_model, near_dedup, substring_dedup
from macrotide.llm.components import connected_components
from macrotide.llm.text import span_hashes, text_blocks, word_spans
from tests.conftest import SF_DIR
from tests.llm.conftest import tuples
from tests.llm.queries import run

# Components


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(k, k + 1) for k in range(300, 340)]
    links += [(500, 500 + k) for k in range(1, 60)] + [(7, 7), (None, 3), (3, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            root[max(find(a), find(b))] = min(find(a), find(b))
    found = connected_components(spark.createDataFrame(links + links[:20], "a bigint, b bigint"))
    assert dict(tuples(found)) == {x: find(x) for x in list(root) if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Near duplicates


def signatures(texts, registers):
    for first, last, data, offsets in text_blocks(pa.array(texts), 1 << 30):
        starts, ends = word_spans(data, offsets)
        words = np.diff(np.searchsorted(starts, offsets))
        return near_dedup.bag_minhash(*near_dedup.shingle_weights(span_hashes(data, starts, ends), words), last - first, registers)


def test_signature_estimates_multiset_similarity_without_bias():
    rng = random.Random(1)
    errors = []
    for k in range(40):
        a = [f"w{rng.randint(0, 30)}" for _ in range(100)]
        b = [w if rng.random() < 0.97 else "z" for w in a]
        if k % 2:  # multiplicities that differ
            a, b = a + ["p q r s t"] * rng.randint(1, 30), b + ["p q r s t"] * rng.randint(1, 30)
        a, b = " ".join(a), " ".join(b)
        table = signatures([a, b], 1024)
        errors.append((table[0] == table[1]).mean() - near_dedup.similarity(*(near_dedup.shingles(x.encode()) for x in (a, b))))
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.025


def brute_classes(rows, threshold=0.8):
    bags = [near_dedup.shingles((t or "").encode()) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, _) in enumerate(rows):
        for m, (j, _) in enumerate(rows[:k]):
            if i is not None and j is not None and bags[k] and bags[m] and near_dedup.similarity(bags[k], bags[m]) >= threshold:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((i, find(i)) for i, _ in rows if i is not None)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
    return words


def test_classes_of_chains_borders_and_copies(spark, frame):
    rng = random.Random(6)
    rows, k = [], 0
    for _ in range(6):
        base = [f"b{rng.randint(0, 400)}" for _ in range(150)]
        for _ in range(12):  # chains: each a small step from the one before
            base = edited(rng, base, rng.choice([0, 1, 2, 2, 3]))
            rows.append((k, " ".join(base)))
            k += 1
    rows += [(k + n, rows[5][1]) for n in range(9)] + [(400, "a b c"), (401, "A  b\tC"), (402, "a b d"), (403, ""), (404, None), (405, " ")]
    rng.shuffle(rows)
    found = near_dedup.near_duplicate_classes(frame([(i, "s", t) for i, t in rows]))
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)


def test_a_group_of_edited_copies_is_not_compared_with_itself(spark, frame, monkeypatch):
    """Copies of one text with few or many edits: the few are linked through the original, the
    many to nothing, and most pairs are never made."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    rows += [(k, " ".join(edited(rng, base, rng.choice([1, 2, 3, 5, 6, 8])))) for k in range(1, 260)]
    compared = []
    verify = near_dedup._verify
    monkeypatch.setattr(near_dedup, "_verify", lambda pairs, texts: compared.append(pairs.count()) or verify(pairs, texts))
    found = near_dedup.near_duplicate_classes(frame([(i, "s", t) for i, t in rows]))
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)
    assert sum(compared) < 260 * 260 / 2 / 5


def test_a_text_and_a_hub_are_one_row_whatever_buckets_they_share(frame, monkeypatch):
    rng, seen = random.Random(13), []
    base = [f"b{i}" for i in range(120)]
    rows = [(k, " ".join(edited(rng, base, rng.choice([0, 1, 2, 6])))) for k in range(60)]
    border = near_dedup._border_pairs
    monkeypatch.setattr(near_dedup, "_border_pairs", lambda seats, *others: seen.append(seats.select("node", "hub")) or border(seats, *others))
    found = near_dedup.near_duplicate_classes(frame([(i, "s", t) for i, t in rows]))
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)
    assert seen[0].count() <= 2 * seen[0].distinct().count()  # once a round


def test_hubs_meet_once_and_only_where_a_link_is_possible(frame, monkeypatch):
    """Copies edited too much to be linked stay in their buckets through all rounds, in the end as hubs."""
    rng, kept = random.Random(14), near_dedup._kept
    base, made = [f"b{i}" for i in range(120)], []
    rows = [(0, " ".join(base))]
    for k in range(1, 120):
        words = list(base[: 120 - k % 30])
        for _ in range(3):
            words[rng.randrange(len(words))] = f"e{rng.randrange(20)}"
        rows.append((k, " ".join(words)))

    def counted(df):
        if {"a", "b", "buckets"} <= set(df.columns):
            made.append(df.selectExpr("sum(size(buckets))", "count(1)", "count(DISTINCT a, b)").first())
        return kept(df)

    monkeypatch.setattr(near_dedup, "_kept", counted)
    found = near_dedup.near_duplicate_classes(frame([(i, "s", t) for i, t in rows]))
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)
    later = made[1:]
    assert len(later) > 1 and all(n <= 1.3 * pairs for _, n, pairs in later), made
    assert sum(n for n, _, _ in later) < 2 * made[0][0], made


def test_few_links_stay_in_few_tasks(spark):
    """Where small partitions are not merged, each round would write its files by all of them."""
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        found = connected_components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a bigint, b bigint"))
        assert found.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, found.collect())) == [(k, 0) for k in range(1, 41)]
    finally:
        spark.conf.unset(merge)


def test_an_id_with_two_texts_is_compared_by_both(frame):
    rng, rows = random.Random(4), []
    for k in range(12):
        near, other = ([f"{c}{rng.randint(0, 10**6)}" for _ in range(80)] for c in "no")
        texts = [(1000 + k, " ".join(edited(rng, near, 1))), (1000 + k, " ".join(other))]
        rows += [(k, " ".join(near)), *(texts if k % 2 else texts[::-1])]
    found = near_dedup.near_duplicate_classes(frame([(i, "s", t) for i, t in rows]))
    assert sorted(map(tuple, found.collect())) == brute_classes(rows)


def test_near_duplicates_of_odd_rows(frame, odd_rows):
    found = near_dedup.near_duplicate_classes(frame(odd_rows))
    assert Counter(r.doc_id for r in found.collect()) == Counter(r[0] for r in odd_rows)
    assert all(r.doc_id == r.class_id for r in found.collect() if r.doc_id is not None)
    kept = near_dedup.keep_one_of_class(frame(odd_rows))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, None, 4, 5, 6, 7, None, 8])
    assert near_dedup.near_duplicate_classes(frame([])).count() == 0
    assert near_dedup.keep_one_of_class(frame([])).count() == 0


# Repeated strings


def brute_removal(rows, depth=50):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for p in range(len(t) - depth + 1) if i is not None else ():
            first[t[p : p + depth]] = min(first.get(t[p : p + depth], i), i)
    out = []
    for i, t in texts:
        mark = bytearray(len(t))
        for p in range(len(t) - depth + 1) if i is not None else ():
            if first[t[p : p + depth]] < i:
                mark[p : p + depth] = b"\1" * depth
        spans = sum(m and (p == 0 or not mark[p - 1]) for p, m in enumerate(mark))
        kept = bytes(c for c, m in zip(t, mark, strict=True) if not m)
        out.append((i, len(t), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_removal_matches_brute_force(frame):
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(30, 300))) for _ in range(12)]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p))
            text += p[max(0, a - 150) : a + rng.randint(0, 150)] if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(90))
            text += "ab" * 60 if rng.random() < 0.1 else "x" * rng.randint(0, 130) if rng.random() < 0.05 else ""
        rows.append((rng.choice([i, i, None, 7]) if i % 17 == 0 else i, None if i % 50 == 3 else text))
    rows += rows[40:44]
    docs = frame([(i, "s", t) for i, t in rows])
    for group_bytes in (9000, 1 << 20):
        assert Counter(tuples(substring_dedup.remove_repeats(docs, group_bytes=group_bytes))) == brute_removal(rows)


def test_removal_over_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert Counter(map(tuple, run(spark, "op7_remove_repeats"))) == brute_removal(rows)


def test_removal_from_odd_rows(frame, odd_rows):
    found = Counter(tuples(substring_dedup.remove_repeats(frame(odd_rows))))
    assert found == brute_removal([(i, t) for i, _, t in odd_rows])
    assert substring_dedup.remove_repeats(frame([])).count() == 0


def test_radix_groups_are_equal_windows():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[200:600]
    starts = rng.permutation(2900)[:1500]
    group = rng.integers(0, 3, 1500)
    found = substring_dedup.radix_groups(data, starts, group, 50)
    text = data.tobytes()
    wanted = {}
    for k, (s, g) in enumerate(zip(starts.tolist(), group.tolist(), strict=True)):
        wanted.setdefault((g, text[s : s + 50]), []).append(k)
    assert all(len({found[k] for k in members}) == 1 for members in wanted.values())
    assert len(set(found.tolist())) == len(wanted)


# Language model


def base_scores(rows):
    tokens = [(i, [*(t or "").translate({c: c + 32 for c in range(65, 91)}).split(None), None]) for i, t in rows]
    counts = Counter()
    for i, t in tokens:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(t)
    n, v = counts.total(), len(counts)
    return [
        (i, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in tokens
    ]


def test_language_model_over_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = run(spark, "op3_language_model_scores")
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == sorted(base_scores(rows))
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in found)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_of_odd_rows(frame, odd_rows):
    small = language_model.Settings(n_dishes=20, n_frequent=50)
    found = language_model.score_texts(frame(odd_rows), settings=small)
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found.collect()]
    assert Counter(got) == Counter(base_scores([(i, t) for i, _, t in odd_rows]))
    assert language_model.score_texts(frame([]), settings=small).count() == 0


def test_pairs_of_frequent_words_travel_without_hashes(spark, frame, monkeypatch):
    """What is written for a pair: the number of its place and not a hash where a word is frequent, and
    of rounds before the last only the tables."""
    written, scratch = [], language_model.scratch_dir

    def noted(session, label):
        path = scratch(session, label)
        written.append((label, path))
        return path

    monkeypatch.setattr(language_model, "scratch_dir", noted)
    rng = random.Random(15)
    rows = [(i, "s", " ".join(f"w{int(rng.paretovariate(0.8))}" for _ in range(60))) for i in range(40)]
    small = language_model.Settings(n_dishes=5, n_frequent=10)
    assert language_model.score_texts(frame(rows), settings=small).count() == 40
    pairs = [spark.read.parquet(p) for label, p in written if label == "word-pairs"][0]
    assert set(pairs.columns) == {"context", "dish", "kind", "n", "dish_n"}
    assert pairs.where("context IS NULL AND dish IS NULL").count() > 0 and pairs.where("dish IS NOT NULL AND dish_n IS NULL").count() == 0
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1]
    assert pairs.agg({"n": "sum"}).first()[0] == 61 * (40 - len(held))
    first, last = (spark.read.parquet(p) for label, p in written if label == "seated-pairs")
    assert set(first.columns) == {"classes", "context_place", "opened"} and "classes" not in last.columns
    assert first.count() == last.count() == pairs.count()
    assert last.where("context IS NULL").count() == last.where("context_place >= 0").count() > 0
    assert not any(label == "pair-factors" for label, _ in written)


def test_pairs_are_written_in_packed_rows_of_parts(spark, frame, monkeypatch):
    """Two rows for each part, whatever the pairs, and few bytes for each distinct pair of a batch."""
    written, scratch = [], language_model.scratch_dir

    def noted(session, label):
        written.append((label, scratch(session, label)))
        return written[-1][1]

    monkeypatch.setattr(language_model, "scratch_dir", noted)
    rng = random.Random(3)
    rows = [(i, "s", " ".join(f"w{int(rng.paretovariate(0.6)) % 100_000}" for _ in range(400))) for i in range(200)]
    small = language_model.Settings(n_dishes=50, n_frequent=500, part_rows=5_000)
    assert language_model.score_texts(frame(rows), settings=small).count() == 200
    pairs = [spark.read.parquet(p) for label, p in written if label == "word-pairs"][0].collect()
    learned = [t.split() for i, _, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    distinct = {x for words in learned for x in zip([None, *words], [*words, None], strict=True)}
    assert 2 < len(pairs) <= 2 * -(-401 * len(learned) // 10_000)
    assert sum(r.n for r in pairs) == 401 * len(learned)
    assert sum(len(x or b"") for r in pairs for x in (r.context, r.dish, r.kind, r.dish_n)) < 20 * len(distinct)


def test_word_pair_probabilities_by_brute_force(frame, monkeypatch):
    """Scores of texts whose pairs are learned from once (one table each), in several parts."""
    models, sample, vocabularies, vocabulary_of = [], language_model._sample, [], language_model._vocabulary
    monkeypatch.setattr(language_model, "_sample", lambda *a: models.append(sample(*a)) or models[-1].copy())
    monkeypatch.setattr(language_model, "_vocabulary", lambda *a: vocabularies.append(vocabulary_of(*a)) or vocabularies[-1])
    rng = random.Random(8)
    words = [f"{rng.choice('abcdef')}{k}{rng.choice('xyz')}" for k in range(60)]
    steps = [(a, b) for a in words for b in words]
    rng.shuffle(steps)
    rows = []
    for i in range(60):  # No step twice: texts of two words, each with a begin and an end of its own.
        a, b = steps[i]
        rows.append((i, "s", f"{a}b{i} {a} {b} {b}e{i}"))
    small = language_model.Settings(n_dishes=6, n_frequent=25, part_rows=20)
    found = {r.doc_id: r.score for r in language_model.score_texts(frame(rows), settings=small).collect()}
    texts = {i: [None, *t.split(), None] for i, _, t in rows}
    learned = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    pairs = Counter(p for t in learned.values() for p in zip(t[:-1], t[1:], strict=True))
    assert set(pairs.values()) == {1}
    customers, tables, counts = Counter(), Counter(), Counter()
    for a, b in pairs:
        customers[a] += 1
        tables[a] += 1
        counts[b] += 1
    v, predictive = vocabularies[0], models[-1]

    def about(word):
        hashes, endings, _ = language_model.tokens_of(*text_of(word or ""))
        kind, _ = v.find(hashes[:1], endings[:1])
        return int(kind[0]), int(endings[0])

    d, s = small.words
    for i, t in texts.items():
        wanted = 0.0
        for a, b in zip(t[:-1], t[1:], strict=True):
            kind, ending = about(b)
            inside = 1.0
            if kind >= v.n_dishes:
                inside = counts[b] - v.discount if counts[b] else v.strength + v.discount * v.rare_types[ending]
                inside /= v.strength + v.rare_tokens[ending]
            base = float(predictive[about(a)[0], kind]) * inside
            seen = (a, b) in pairs
            wanted += math.log10(((s + d * tables[a]) * base + seen * (1 - d)) / (s + customers[a]))
        assert math.isclose(found[i], wanted, rel_tol=1e-5), (i, found[i], wanted)


def text_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_words_keep_their_identity_as_contexts(frame):
    """Two held-out texts of the same rare words, which differ only in what follows what."""
    held = [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(k, "s", " ".join(f"x{(k + j) % 60}aa y{(k + j) % 60}bb" for j in range(0, 60, 7))) for k in range(300)]
    rows += [(held[0], "s", "x3aa y3bb x8aa y8bb"), (held[1], "s", "x3aa y8bb x8aa y3bb")]
    small = language_model.Settings(n_dishes=4, n_frequent=10)
    found = {r.doc_id: r for r in language_model.score_texts(frame(rows), settings=small).collect()}
    good, bad = (found[i] for i in held)
    assert good.held_out and bad.held_out and math.isclose(good.base_score, bad.base_score)
    assert good.score > bad.score + 2


def test_predictive_probabilities_sum_to_one(spark):
    """Over all events: each known word, and the unseen words of each ending."""
    rows = spark.createDataFrame(
        [(k, " ".join(f"w{(k * i) % 90}x{i % 7}" for i in range(1, 60))) for k in range(40)], "doc_id bigint, text string"
    )
    settings = language_model.Settings(n_dishes=15, n_frequent=30)
    counts = language_model._word_counts(rows).cache()
    vocabulary = language_model._vocabulary(counts, settings)
    pairs = language_model._class_pairs(rows, spark.sparkContext.broadcast(vocabulary))
    table = language_model._sample(pairs, vocabulary.n_classes, settings)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4)
    rare = counts.toPandas()
    dishes = set(vocabulary.hashes[vocabulary.classes >= 0].view(np.int64).tolist())
    rare = rare[~rare["word"].isin(dishes)]
    for ending, group in rare.groupby("ending"):
        known = (group["n"] - vocabulary.discount).sum()
        new = vocabulary.strength + vocabulary.discount * vocabulary.rare_types[ending]
        assert math.isclose(known + new, vocabulary.strength + vocabulary.rare_tokens[ending])


def test_seating_follows_the_expected_number_of_tables():
    rng = np.random.default_rng(0)
    n, discount, strength = 200, 0.5, 2.0
    # With a base of one, dish and restaurant are the same, so the odds follow its own tables.
    one_by_one = []
    for _ in range(300):
        tables = 1
        for seated in range(1, n):
            tables += rng.random() < strength / (strength + seated - discount * tables)
        one_by_one.append(tables)
    blocks = language_model.seat(np.full(3000, n), np.ones(3000), discount, np.full(3000, strength), rng)
    assert abs(blocks.mean() - np.mean(one_by_one)) < 0.8
