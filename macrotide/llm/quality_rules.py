"""Quality rules: repetition inside a text, found with its suffix array.

For each whole text a suffix array is built by prefix doubling: suffixes are ordered by
their first 8 bytes, then 16, 32 and so on, and only groups still tied are sorted again.
Neighbours of the array that agree in ``min_repeat`` bytes or more form the intervals of
longest common prefixes; the longest one at a position is a repeated substring that cannot
be extended. The union of those spans gives the covered share of the text.

A text is one row and one array: no shuffle, and memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import SPACES, byte_table, rows_of, span_hashes, text_blocks, windows, word_spans

# The symbols that the rules count.
IS_SYMBOL = byte_table(b"#*$%&|<>")

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, n_covered bigint, covered_fraction double, longest_repeat bigint, kept boolean"
)


def repeated_spans(text: bytes, min_repeat: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the longest repeated substring at each byte where one of
    ``min_repeat`` bytes (8 times a power of two) or more begins."""
    n = len(text)
    none = np.zeros(0, np.int64)
    if n <= min_repeat:
        return none, none
    # No text in UTF-8 holds the byte FF, so the padding ties with nothing.
    head = np.ndarray(n, ">u8", text + b"\xff" * 8, strides=(1,)).astype(np.uint64)
    order = np.argsort(head)
    ranked = head[order]
    rank = np.full(n + 1, n, np.int64)
    rank[order] = _group_starts(ranked[1:] != ranked[:-1])
    levels, depth = [(8, rank)], 8
    slots = _tied(rank[order])
    while len(slots):
        if depth < min_repeat:
            wanted = None
        elif depth == min_repeat:
            wanted = slots
        tied = order[slots]
        # A tied suffix never reaches the padding, so tied + depth is at most n.
        key = rank[tied] * np.int64(n + 1) + rank[tied + depth]
        again = np.argsort(key)
        order[slots] = tied[again]
        sorted_key = key[again]
        base = rank[order[slots]]
        fresh = np.empty(len(slots), bool)
        fresh[0], fresh[1:] = True, sorted_key[1:] != sorted_key[:-1]
        starts = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        rank = rank.copy()
        rank[order[slots]] = np.maximum(starts, base)
        depth *= 2
        levels.append((depth, rank))
        slots = slots[_tied(rank[order[slots]])]
    if depth <= min_repeat:
        return none, none
    # Neighbours tied at min_repeat bytes; their common prefix, one level after another.
    same = dict(levels)[min_repeat][order[wanted]]
    pairs = np.flatnonzero((same[1:] == same[:-1]) & (wanted[1:] == wanted[:-1] + 1))
    left, right = order[wanted[pairs]], order[wanted[pairs] + 1]
    common = np.zeros(len(pairs), np.int64)
    for size, ranks in reversed(levels):
        a, b = np.minimum(left + common, n), np.minimum(right + common, n)
        common += size * ((ranks[a] == ranks[b]) & (a < n) & (b < n))
    a, b = left + common, right + common
    inside = (a < n) & (b < n)
    differ = np.zeros(len(pairs), np.uint64)
    differ[inside] = head[a[inside]] ^ head[b[inside]]
    for shift in range(56, 0, -8):
        equal = inside & (differ >> np.uint64(shift) == 0)
        common += equal
        inside = equal
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    begins = np.flatnonzero(longest)
    return begins, longest[begins]


def _group_starts(fresh: np.ndarray) -> np.ndarray:
    """For sorted values, with flags where a value differs from the one before: the first
    place of each value's group."""
    places = np.zeros(len(fresh) + 1, np.int64)
    places[1:] = np.where(fresh, np.arange(1, len(fresh) + 1), 0)
    return np.maximum.accumulate(places)


def _tied(ranks: np.ndarray) -> np.ndarray:
    same = ranks[1:] == ranks[:-1]
    tied = np.zeros(len(ranks), bool)
    tied[1:] |= same
    tied[:-1] |= same
    return np.flatnonzero(tied)


def covered(begins: np.ndarray, lengths: np.ndarray) -> int:
    """Bytes in the union of spans sorted by their starts."""
    if not len(begins):
        return 0
    reach = np.maximum.accumulate(begins + lengths)
    return int((np.minimum(reach, np.append(begins[1:], reach[-1])) - begins).sum())


def _duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip(SPACES):
            seen.add(line)
    return found


def _repeated_words(hashes: np.ndarray, words: np.ndarray, width: int = 5) -> np.ndarray:
    """Words of each row in windows of ``width`` words that its row holds twice or more."""
    n_rows = len(words)
    found = windows(hashes, width)
    if not len(found):
        return np.zeros(n_rows, np.int64)
    row = rows_of(words)
    whole = row[: len(found)] == row[width - 1 :]
    at = np.flatnonzero(whole)
    key, owner = found[at], row[at]
    order = np.lexsort((key, owner))
    k, o = key[order], owner[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    twice = np.zeros(len(k), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(hashes) + 1, np.int64)
    hit = at[order[twice]]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n_rows)


def quality_rules(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = 32,
    max_covered_fraction: float = 0.3, max_longest_repeat: int = 1500,
) -> DataFrame:
    """Counts and verdict for every whole text; one row for each input row.

    ``base_failed``: under 10 words, or over a fifth of them in repeated 5-word windows.
    Otherwise a text is kept unless repeated substrings of ``min_repeat`` bytes or more cover
    over ``max_covered_fraction`` of its bytes or one is longer than ``max_longest_repeat``.

    A null or empty text has no words and fails. Repeated rows and null ids are rows like any
    other. Columns beside the two named ones are not read."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                starts, ends = word_spans(data, offsets)
                words = np.diff(np.searchsorted(starts, offsets))
                leading = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                chars = np.append(0, np.cumsum(leading[ends] - leading[starts]))
                at = np.append(0, np.cumsum(words))
                symbols = np.append(0, np.cumsum(IS_SYMBOL[data]))
                repeated = _repeated_words(span_hashes(data, starts, ends), words)
                whole = data.tobytes()
                rest = []
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    text = whole[a:b]
                    begins, lengths = repeated_spans(text, min_repeat)
                    rest.append((_duplicate_lines(text), covered(begins, lengths), int(lengths.max(initial=0))))
                lines, n_covered, longest = np.array(rest, np.int64).T
                failed = (words < 10) | (100 * repeated > 20 * words)
                fraction = n_covered / np.maximum(1, np.diff(offsets))
                keep = ~failed & (fraction <= max_covered_fraction) & (longest <= max_longest_repeat)
                columns = [
                    words, chars[at[1:]] - chars[at[:-1]], symbols[offsets[1:]] - symbols[offsets[:-1]], lines, repeated,
                    failed, n_covered, fraction, longest, keep,
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *map(pa.array, columns)],
                    names=[f.split()[0] for f in SCHEMA.split(", ")],
                )

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(judge, SCHEMA)
