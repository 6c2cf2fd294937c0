"""Removal of repeated 50-byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered through ``depth`` bytes only, most significant digits first, and groups
that are equal then are exactly the repeated windows. The first digit of a window is its
minimizer: the smallest hash of the 20-byte strings in it. Equal windows have equal
minimizers, and neighbouring windows share theirs, so one *anchor* stands for some 15
windows and one *block* (the bytes of these windows) is shuffled in place of 15 strings.

1. Texts are dealt by a hash of doc_id into groups of about ``group_bytes``. A group sends the
   distinct hashes of its anchors, 5 bytes each, to the bin of that hash.
2. A bin answers each group with the anchors that another document has too.
3. A group sends the distinct blocks of those anchors with their smallest and largest doc_id.
4. A bin collapses equal blocks, radix sorts the windows of unequal blocks of one anchor (8
   bytes for each pass, and only groups still tied), and answers with the smallest doc_id.
5. A group removes what a smaller doc_id has.

Each group sends a hash or block once, however often it holds it, so a passage in a third of
all documents costs one entry for each group. Steps 1, 3 and 5 read one and the same shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import mix, rows_of, span_hashes, text_blocks

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
MINIMIZER = 20
LOW = np.uint64((1 << 40) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def load8(data: np.ndarray) -> np.ndarray:
    """A view of the 8 bytes from each place as one number (fewer places by 7)."""
    return np.ndarray(len(data) - 7, ">u8", data.tobytes(), strides=(1,))


def minimizer_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 20 bytes from each place (places near the end are padded)."""
    words = load8(np.concatenate([data, np.zeros(MINIMIZER + 8, np.uint8)]))
    n = len(data)
    return _minimizer(words[:n], words[8 : n + 8], words[12 : n + 12])


def _minimizer(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mix(mix(first.astype(np.uint64) + second.astype(np.uint64) * _A) + third.astype(np.uint64) * _B) | np.uint64(1)


def sliding(values: np.ndarray, width: int, better) -> np.ndarray:
    """Smallest (or largest) of ``width`` values from each place; fewer at the end."""
    done, found = 1, values
    while done < width:
        step = min(done, width - done)
        further = found.copy()
        if step < len(found):
            better(found[:-step], found[step:], out=further[: len(found) - step])
        found, done = further, done + step
    return found


def blocks_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(row, place of the anchor, its hash, first window, windows) of all anchors. The windows
    that have one anchor as their minimizer follow one another."""
    n, width = len(data), depth - MINIMIZER + 1
    none = np.zeros(0, np.int64)
    if n < depth:
        return none, none, none.astype(np.uint64), none, none
    hashes = minimizer_hashes(data)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)  # bytes to the end of the text
    hashes[left < MINIMIZER] = np.uint64(2**64 - 1)
    low = sliding(hashes, width, np.minimum)
    low[left < depth] = 0
    # An anchor is the minimum of a window that holds it: the largest of their minima.
    high = sliding(low[::-1], width, np.maximum)[::-1]
    at = np.flatnonzero((high == hashes) & (left >= MINIMIZER))
    own = hashes[at]
    first, count = np.full(len(at), -1), np.zeros(len(at), np.int64)
    for back in range(width):
        start = at - back
        hit = (start >= 0) & (low[np.maximum(start, 0)] == own)
        first[hit] = start[hit]
        count += hit
    row = np.searchsorted(offsets, at, "right") - 1
    return row, at, own, first, count


def radix_groups(data: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Group number of each window: windows that begin in one ``group`` and agree in
    ``depth`` bytes share one. Digits of 8 bytes; a window alone in its group is not sorted on."""
    words = load8(np.concatenate([data, np.zeros(8, np.uint8)]))
    result = np.arange(len(starts))
    tied, key = np.arange(len(starts)), group.astype(np.int64)
    for digit in [*range(0, depth - 7, 8), depth - 8]:
        value = words[starts[tied] + digit].astype(np.uint64)
        order = np.lexsort((value, key))
        value, key, tied = value[order], key[order], tied[order]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (key[1:] != key[:-1])
        number = np.cumsum(fresh)
        alone = fresh & np.append(fresh[1:], True)
        tied, key = tied[~alone], number[~alone]
        if not len(tied):
            return result
    fresh = np.ones(len(tied), bool)
    fresh[1:] = key[1:] != key[:-1]
    result[tied] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
    return result


def planes(values: np.ndarray, width: int) -> bytes:
    """Numbers as byte planes, which compress better than whole numbers."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    n = len(data) // width
    found = np.zeros((n, 8), np.uint8)
    found[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return found.view("<u8").reshape(-1)


def signed(ids: np.ndarray) -> np.ndarray:
    """Numbers from int64 planes read back, with their sign."""
    return ids.view(np.int64)


def _bins(hashes: np.ndarray, n_bins: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(n_bins)).astype(np.int64)


def _by_bin(bins: np.ndarray, n_bins: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bins, kind="stable")
    edges = np.searchsorted(bins[order], np.arange(n_bins + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]


def _walk(table: pa.Table, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of a group's texts, with the bytes they lie in and the doc_id of each row."""
    if not table.num_rows:
        return
    ids = table.column("doc_id").combine_chunks().to_numpy(zero_copy_only=False)
    for first, last, data, offsets in text_blocks(table.column("text").combine_chunks()):
        yield ids[first:last], data, offsets, *blocks_of(data, offsets, depth)


def _gather(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after another."""
    begin = np.cumsum(length) - length
    return data[np.repeat(first - begin, length) + np.arange(int(length.sum()))]


def _anchors(n_bins: int, depth: int):
    def send(table: pa.Table) -> pa.Table:
        found = []
        for ids, _, _, row, _, own, _, _ in _walk(table, depth):
            # Distinct (hash, document), so that a hash left twice is one of two documents.
            key, doc = own, ids[row]
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            found.append((key[fresh], doc[fresh]))
        target = table.column("target")[0].as_py()
        rows: list[tuple] = []
        if found:
            key, doc = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            other = np.zeros(len(key), bool)
            other[1:] = (key[1:] == key[:-1]) & (doc[1:] != doc[:-1])
            fresh = np.ones(len(key), bool)
            fresh[1:] = key[1:] != key[:-1]
            # A hash of two documents or more is sent twice: that alone makes it shared.
            twice = np.unique(key[other])
            sent = np.sort(np.concatenate([key[fresh], twice]))
            rows = [(b, target, planes(sent[i] & LOW, 5)) for b, i in _by_bin(_bins(sent, n_bins), n_bins)]
        return _table(rows, {"bin": pa.int64(), "target": pa.int64(), "hashes": pa.binary()})

    return send


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns, strict=True)})


def _shared(table: pa.Table) -> pa.Table:
    """Of a bin: for each group, its hashes that occur twice or more in all."""
    parts = [unplanes(x, 5) for x in table.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(parts))
    same = every[1:] == every[:-1]
    twice = np.unique(every[1:][same])
    rows = []
    for b, target, part in zip(table.column("bin").to_pylist(), table.column("target").to_pylist(), parts, strict=True):
        mine = np.unique(part)
        place = np.minimum(np.searchsorted(twice, mine), max(0, len(twice) - 1))
        mine = mine[twice[place] == mine] if len(twice) else mine[:0]
        if len(mine):
            rows.append((target, b, planes(mine, 5)))
    return _table(rows, {"target": pa.int64(), "bin": pa.int64(), "hashes": pa.binary()})


_BLOCK_KINDS = {
    "bin": pa.int64(), "target": pa.int64(), "content": pa.binary(), "windows": pa.binary(), "anchor": pa.binary(),
    "low": pa.binary(), "high": pa.binary(),
}


def _block_keys(data: np.ndarray, first: np.ndarray, length: np.ndarray, at: np.ndarray, own: np.ndarray) -> np.ndarray:
    """One key from a block's bytes, its anchor's hash and the anchor's place in it. Blocks
    stand in the order of their bytes; a few at a time keep the powers in the hash few."""
    found = np.empty(len(first), np.uint64)
    for i in range(0, len(first), 1 << 14):
        part = slice(i, i + (1 << 14))
        begin, end = int(first[part].min()), int((first[part] + length[part]).max())
        found[part] = span_hashes(data[begin:end], first[part] - begin, first[part] + length[part] - begin)
    return mix(found + mix(own + (at - first).astype(np.uint64) * _B) * _A)


def _blocks(n_bins: int, depth: int):
    def send(texts: pa.Table, shared: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if shared.num_rows and texts.num_rows:
            wanted = np.sort(np.concatenate([
                unplanes(h, 5) | np.uint64(b << 40)
                for b, h in zip(shared.column("bin").to_pylist(), shared.column("hashes").to_pylist(), strict=True)
            ]))
            target = texts.column("target")[0].as_py()
            kept = []
            for ids, data, _, row, at, own, first, count in _walk(texts, depth):
                short = (own & LOW) | (_bins(own, n_bins).astype(np.uint64) << np.uint64(40))
                hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)] == short)
                if len(hit):
                    length = count[hit] + depth - 1
                    kept.append((
                        _block_keys(data, first[hit], length, at[hit], own[hit]), own[hit], ids[row[hit]], count[hit],
                        (at - first)[hit], _gather(data, first[hit], length),
                    ))
            if kept:
                key, own, doc, count, anchor, content = (np.concatenate(x) for x in zip(*kept, strict=True))
                order = np.lexsort((doc, own, key))
                fresh = np.ones(len(order), bool)
                fresh[1:] = (key[order][1:] != key[order][:-1]) | (own[order][1:] != own[order][:-1])
                begins = np.flatnonzero(fresh)
                chosen = order[begins]
                low, high = doc[chosen], doc[order[np.append(begins[1:], len(order)) - 1]]
                # Back in the order of the texts, so that ids of neighbours compress.
                again = np.argsort(chosen)
                chosen, low, high = chosen[again], low[again], high[again]
                begin = np.cumsum(count + depth - 1) - (count + depth - 1)
                for b, i in _by_bin(_bins(own[chosen], n_bins), n_bins):
                    c = chosen[i]
                    rows.append((
                        b, target, _gather(content, begin[c], count[c] + depth - 1).tobytes(), count[c].astype(np.uint8).tobytes(),
                        anchor[c].astype(np.uint8).tobytes(), planes(low[i], 8), planes(high[i], 8),
                    ))
        return _table(rows, _BLOCK_KINDS)

    return send


_RUN_KINDS = {"target": pa.int64(), "keys": pa.binary(), "anchors": pa.binary(), "begin": pa.binary(), "end": pa.binary(), "low": pa.binary()}


def _resolve(depth: int):
    def answer(table: pa.Table) -> pa.Table:
        """Of a bin: for each group's blocks, runs of windows with their smallest doc_id, where
        that is smaller than the group's largest doc_id with the block."""
        columns = table.to_pydict()
        data = np.frombuffer(b"".join(columns["content"]), np.uint8)
        count = np.frombuffer(b"".join(columns["windows"]), np.uint8).astype(np.int64)
        anchor = np.frombuffer(b"".join(columns["anchor"]), np.uint8).astype(np.int64)
        low = signed(np.concatenate([unplanes(x, 8) for x in columns["low"]]))
        high = signed(np.concatenate([unplanes(x, 8) for x in columns["high"]]))
        sender = np.repeat(np.arange(len(columns["windows"])), [len(x) for x in columns["windows"]])
        length = count + depth - 1
        first = np.cumsum(length) - length
        words, at = load8(data), first + anchor
        own = _minimizer(words[at], words[at + 8], words[at + 12])
        key = _block_keys(data, first, length, first + anchor, own)
        # Equal blocks are one, with the smallest doc_id of all.
        order = np.lexsort((key, own))
        k, o = key[order], own[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
        begins = np.flatnonzero(fresh)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(fresh) - 1
        kind_low = np.minimum.reduceat(low[order], begins)
        kind_of = order[begins]
        # Anchors with several unequal blocks: their windows are sorted.
        anchor_fresh = np.ones(len(begins), bool)
        anchor_fresh[1:] = own[kind_of][1:] != own[kind_of][:-1]
        group = np.cumsum(anchor_fresh) - 1
        several = np.flatnonzero(np.bincount(group)[group] > 1)
        run_kind, run_begin, run_end, run_low = [], [], [], []
        simple = np.setdiff1d(np.arange(len(begins)), several, assume_unique=True)
        run_kind.append(simple)
        run_begin.append(np.zeros(len(simple), np.int64))
        run_end.append(count[kind_of[simple]])
        run_low.append(kind_low[simple])
        if len(several):
            number = count[kind_of[several]]
            owner = np.repeat(several, number)
            inner = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
            same = radix_groups(data, first[kind_of[owner]] + inner, group[owner], depth)
            smallest = np.full(len(owner), np.iinfo(np.int64).max)
            np.minimum.at(smallest, same, kind_low[owner])
            smallest = smallest[same]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (smallest[1:] != smallest[:-1])
            edge = np.flatnonzero(new)
            last = np.append(edge[1:], len(owner)) - 1
            run_kind.append(owner[edge])
            run_begin.append(inner[edge])
            run_end.append(inner[last] + 1)
            run_low.append(smallest[edge])
        run_kind, run_begin, run_end, run_low = (np.concatenate(x) for x in (run_kind, run_begin, run_end, run_low))
        by_kind = np.argsort(run_kind, kind="stable")
        from_, to = np.searchsorted(run_kind[by_kind], kind), np.searchsorted(run_kind[by_kind], kind, "right")
        entry = np.repeat(np.arange(len(kind)), to - from_)
        run = by_kind[np.repeat(from_ - np.append(0, np.cumsum(to - from_)[:-1]), to - from_) + np.arange(len(entry))]
        useful = run_low[run] < high[entry]
        entry, run = entry[useful], run[useful]
        rows = []
        edges = np.searchsorted(sender[entry], np.arange(len(columns["target"]) + 1))
        for i, target in enumerate(columns["target"]):
            e, r = entry[edges[i] : edges[i + 1]], run[edges[i] : edges[i + 1]]
            if len(e):
                rows.append((
                    target, planes(key[e], 8), planes(own[e], 8), run_begin[r].astype(np.uint8).tobytes(),
                    run_end[r].astype(np.uint8).tobytes(), planes(run_low[r], 8),
                ))
        return _table(rows, _RUN_KINDS)

    return answer


def _remove(depth: int):
    def remove(texts: pa.Table, runs: pa.Table) -> pa.Table:
        out: list[tuple] = []
        keys = None
        if runs.num_rows:
            columns = runs.to_pydict()
            keys = np.concatenate([unplanes(x, 8) for x in columns["keys"]])
            order = np.argsort(keys)
            keys = keys[order]
            anchors = np.concatenate([unplanes(x, 8) for x in columns["anchors"]])[order]
            begin, end = (np.frombuffer(b"".join(columns[c]), np.uint8).astype(np.int64)[order] for c in ("begin", "end"))
            low = signed(np.concatenate([unplanes(x, 8) for x in columns["low"]]))[order]
        for ids, data, offsets, row, at, own, first, count in _walk(texts, depth):
            edge = np.zeros(len(data) + 1, np.int64)
            if keys is not None and len(at):
                key = _block_keys(data, first, count + depth - 1, at, own)
                from_, to = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
                many = to - from_
                block = np.repeat(np.arange(len(at)), many)
                run = np.repeat(from_ - (np.cumsum(many) - many), many) + np.arange(len(block))
                hit = (anchors[run] == own[block]) & (low[run] < ids[row[block]])
                block, run = block[hit], run[hit]
                np.add.at(edge, first[block] + begin[run], 1)
                np.add.at(edge, first[block] + end[run] + depth - 1, -1)
            gone = np.cumsum(edge[:-1]) > 0
            rises = gone.copy()
            rises[1:] &= ~gone[:-1]
            bounds = offsets[:-1][offsets[:-1] < len(data)]
            rises[bounds] = gone[bounds]
            removed = np.append(0, np.cumsum(gone))[offsets]
            spans = np.append(0, np.cumsum(rises))[offsets]
            kept = data[~gone].tobytes()
            left = offsets - removed
            for i in range(len(ids)):
                out.append((
                    int(ids[i]), int(offsets[i + 1] - offsets[i]), int(removed[i + 1] - removed[i]), int(spans[i + 1] - spans[i]),
                    sha256(kept[left[i] : left[i + 1]]).hexdigest(),
                ))
        return _table(out, {
            "doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
        })

    return remove


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = 50, group_bytes: int = 8 << 20
) -> DataFrame:
    """For each document, what is left when every byte covered by a ``depth``-byte string that
    also starts in a document with a smaller id is removed: n_bytes, n_removed, n_spans
    (maximal removed runs) and the SHA-256 of the rest.

    Bytes are those of UTF-8; a null text is empty. Rows with one id are one document, so they
    take nothing from each other. A null id is neither smaller nor larger than another: such
    rows stay whole and take nothing away. Other columns are not read. ``depth`` is from 28 to 200."""
    chosen = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    total = chosen.agg(F.sum(F.octet_length("text")).cast("bigint")).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    texts = chosen.where("doc_id IS NOT NULL").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(groups)).alias("target"), "doc_id", "text"
    )
    sent = texts.groupBy("target").applyInArrow(_anchors(groups, depth), "bin bigint, target bigint, hashes binary")
    shared = sent.groupBy("bin").applyInArrow(_shared, "target bigint, bin bigint, hashes binary")
    blocks = texts.groupBy("target").cogroup(shared.groupBy("target")).applyInArrow(
        _blocks(groups, depth),
        "bin bigint, target bigint, content binary, windows binary, anchor binary, low binary, high binary",
    )
    runs = blocks.groupBy("bin").applyInArrow(
        _resolve(depth), "target bigint, keys binary, anchors binary, begin binary, end binary, low binary"
    )
    found = texts.groupBy("target").cogroup(runs.groupBy("target")).applyInArrow(_remove(depth), SCHEMA)
    whole = chosen.where("doc_id IS NULL").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
    )
    return found.unionByName(whole)
