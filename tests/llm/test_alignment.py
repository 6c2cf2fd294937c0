"""Cross-tokenizer alignment against both libraries on whole texts."""

from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter

import public_tokenizers
import pytest

from macrotide.llm import token_alignment as ta

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ends(parts):
    found, at = [], 0
    for p in parts:
        at += len(p)
        found.append(at)
    return found


def by_hand(rows):
    words = ta.Vocabularies(*FILES)
    texts, counts = [], Counter()
    for doc, text in rows:
        a = words.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = words.b.encode(text or "")
        bytes_a, bytes_b = [words.bytes_a[i] for i in a], [words.bytes_b[i] for i in b]
        whole = f" {text}".encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            texts.append((doc, 0, 0, [], ""))
            continue
        at_a, at_b = {e: k for k, e in enumerate(ends(bytes_a))}, {e: k for k, e in enumerate(ends(bytes_b))}
        common = sorted(set(at_a) & set(at_b))
        links = [(a[at_a[e]], b[at_b[e]]) for e in common]
        counts.update(links)
        groups, x, y = [], 0, 0
        for e in common:
            groups.append(",".join(map(str, a[x : at_a[e] + 1])) + "|" + ",".join(map(str, b[y : at_b[e] + 1])))
            x, y = at_a[e] + 1, at_b[e] + 1
        texts.append((doc, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        [(d, n_a, n_b, len(x), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), h) for d, n_a, n_b, x, h in texts],
        key=str,
    )


@pytest.fixture(scope="module")
def rows(odd_rows):
    texts = [
        None, "", " ", "  ", "a  b \n\n c\t", "x▁y z", "<|endoftext|> <s> hi", "no break   space 　 x", "日本語 😀😀 \x1c  x",
        "a \x1c! \x85 b\r\n  ", "tail ", "{\r\n  }", "x" * 5000, "<0x41>", "\x00 nul",
    ]
    return [(i, t) for i, _, t in odd_rows] + [(50 + k, t) for k, t in enumerate(texts)] + [(900 + k % 3, "a group of copies") for k in range(40)]


@pytest.mark.parametrize("settings", [{}, {"run_bytes": 40, "bins": 3}, {"run_bytes": 3000, "bins": 1}])
def test_counts_equal_those_of_whole_texts(spark, rows, settings):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS run", "2 AS bin", "3 AS head").repartition(4)
    assert sorted([tuple(r) for r in ta.align_tokens(df, *FILES, **settings).collect()], key=str) == by_hand(rows)


def test_an_empty_table(spark):
    assert ta.align_tokens(spark.createDataFrame([], "doc_id bigint, text string"), *FILES).collect() == []


def test_packed_numbers_come_back():
    import numpy as np

    for values in ([], [0], [1, 2**40, 7], list(range(1000))):
        assert ta.unpacked(ta.packed(np.array(values, np.int64))).tolist() == values


def _one_run(n_texts, monkeypatch):
    """A run of texts without a chunk in common, and how many chunks each call encoded."""
    words = ta.Vocabularies(*FILES)
    encoded, encode = [], words.encode
    monkeypatch.setattr(words, "encode", lambda texts: encoded.append(len(texts)) or encode(texts))
    run = ta.Run(words, 8)
    run.add(list(range(n_texts)), [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(n_texts)])
    return run, encoded


def test_a_block_of_new_chunks_is_encoded_in_pieces(monkeypatch):
    _, encoded = _one_run(500, monkeypatch)
    assert sum(encoded) == 500 * 40 and max(encoded) <= 4096


def test_writing_a_run_holds_few_arrays_of_its_links(monkeypatch):
    run, _ = _one_run(1000, monkeypatch)
    n_links = sum(r[3] for r in run.rows)
    tracemalloc.start()
    for _ in run.written(0):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * n_links  # bytes
