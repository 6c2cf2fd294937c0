"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words and cut into windows of 13 words; every window is a
pattern of one automaton. Each document is normalised the same way and scanned once; the
place where a match ends gives its words, and these give the place in the original text.

The automaton is built in every task from the windows of one block of items. A test set is
small and fixed, but its size is checked: items are dealt into blocks of at most
``block_bytes`` of window text, and the documents are scanned for one block after another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import text_blocks
from macrotide.session import checkpoint_root

# A-Z become a-z; every other ASCII sign but digits parts words.
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or c in _LETTERS else 32 for c in range(256)
)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = "n_words bigint, spans array<bigint>, char_spans array<bigint>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(text: str | None, width: int) -> list[bytes]:
    """All runs of ``width`` words of an item; a shorter item is one run."""
    words = words_of((text or "").encode())
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def _automaton(patterns: dict[str, tuple[int, list[str]]]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        machine.add_word(pattern, value)
    machine.make_automaton()
    return machine


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_bytes: int) -> Iterator[dict]:
    """Pattern tables of at most ``block_bytes`` of window text, unless one item has more."""
    table: dict[str, tuple[int, list[str]]] = {}
    size = 0
    # Items come one partition at a time and never the documents.
    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in items.toLocalIterator():
        found = set(item_windows(text, width))
        more = sum(map(len, found))
        if table and size + more > block_bytes:
            yield table
            table, size = {}, 0
        size += more
        for window in found:
            # One byte is one character here, so the scan works on bytes.
            key = f" {window.decode('latin-1')} "
            n, items_of = table.setdefault(key, (window.count(b" ") + 1, []))
            if item is not None and item not in items_of:
                items_of.append(item)
    if table:
        yield table


def _scan(docs: DataFrame, text_col: str, patterns: dict) -> DataFrame:
    """One pass: what the block hits is added to what ``_hits`` has."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    @F.arrow_udf(HITS)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machine = _automaton(shared.value) if shared.value else None
        for texts, old in batches:
            found = []
            before = old.to_pylist()
            for first, last, data, offsets in text_blocks(texts):
                whole = data.tobytes()
                found += [
                    _document(whole[a:b], machine, *(hits[k] for k in ("spans", "char_spans", "items")))
                    for a, b, hits in zip(offsets[:-1], offsets[1:], before[first:last], strict=True)
                ]
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.StructArray.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["n_words", "spans", "char_spans", "items"]
            )

    return docs.withColumn("_hits", scan(F.col(text_col).cast("string"), "_hits"))


def _document(
    text: bytes, machine, spans: list[int], char_spans: list[int], items: list[str]
) -> tuple[int, list[int], list[int], list[str]]:
    """Words, and the hit spans as flat (start, end) pairs in words and in characters."""
    words = words_of(text)
    normal = f" {b' '.join(words).decode('latin-1')} " if machine is not None else ""
    ends, widths, named = [], [], set()
    for end, (width, of) in machine.iter(normal) if machine is not None else ():
        ends.append(end)
        widths.append(width)
        named.update(of)
    if not ends:
        return len(words), spans, char_spans, items
    # The space that ends a match stands after its last word.
    after = np.cumsum([len(w) + 1 for w in words])
    stop = np.searchsorted(after, np.array(ends)) + 1
    old = zip(spans[::2], spans[1::2], strict=True)
    hit = merge(sorted([*old, *zip((stop - np.array(widths)).tolist(), stop.tolist(), strict=True)]))
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    chars = [x for a, b in hit for x in (len(text[: places[a][0]].decode()), len(text[: places[b - 1][1]].decode()))]
    return len(words), [x for span in hit for x in span], chars, sorted({*items, *named})


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of sorted half-open spans."""
    found: list[tuple[int, int]] = []
    for a, b in spans:
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]))
        else:
            found.append((a, b))
    return found


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = 13, block_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` with four columns more (replaced, if there): n_words, the hit spans in words
    (``spans``) and in characters of the original (``char_spans``), both as flat start-end pairs,
    and ``items``, the ids with an occurring window.

    Null texts and items have no words. Items with a null id mark words but are not listed.
    Repeated documents keep their rows; of repeated items each id is listed once."""
    blocks = _blocks(benchmark, item_col, item_text_col, width, block_bytes)
    found = docs.withColumn("_hits", F.struct(
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("spans"),
        F.array().cast("array<bigint>").alias("char_spans"), F.array().cast("array<string>").alias("items"),
    ))
    block, following = next(blocks, {}), next(blocks, None)
    while following is not None:
        # One automaton in memory at a time: each pass is written before the next one begins.
        checkpoint_root(docs.sparkSession)
        found = _scan(found, text_col, block).checkpoint()
        block, following = following, next(blocks, None)
    found = _scan(found, text_col, block)
    return found.withColumns({c: F.col(f"_hits.{c}") for c in ("n_words", "spans", "char_spans", "items")}).drop("_hits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they were."""
    names = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_text"))
    found = benchmark_hits(whole, benchmark, text_col="_text", **settings)
    return found.where(~contaminated(span_words(F.col("spans")), F.col("n_words"))).select(*names)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A document is contaminated if a twentieth of its words or more is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def span_words(spans: Column) -> Column:
    """Words in flat start-end pairs."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda total, x: total + x)
