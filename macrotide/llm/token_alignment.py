"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often.

Both vocabularies cut a text at least where a space follows a character that is no white
space, so a text is a row of chunks and each distinct chunk is encoded and aligned once
while a task's table has room.

Pairs are counted by external runs. A task works through about ``run_bytes`` of text at a time and
writes its pair-document records as one run: pairs in the order (radix digit of the second
id, second id, first id), documents inside a pair, as compressed byte planes. The heads of the
runs (pairs and their counts, no documents) go to the bins of their digit. A bin merges its heads with a heap,
which gives the corpus count of each pair and, as the second id is the major key, the highest
count of each second id. The counts go back to the runs they came from and are summed there over
the documents of the run. A frequent pair is one entry of each run, so no bin and no run outgrows the others.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import mix, rows_of, text_blocks
from macrotide.session import scratch_dir

SCHEMA = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)
RUN_SCHEMA = "run bigint, bin int, head binary, docs binary, records binary"

SPACE_SIGN = "▁"
# A chunk starts with a space and ends before a space that follows no white space.
CHUNK = re.compile(r" [^ ]*(?:(?<=\s) [^ ]*)*")
_SECOND = 32  # a pair is the second id above so many bits, and the first id in them
LEARNT_AT_ONCE = 4096  # chunks; the tokenizers' own objects of one chunk take about a kilobyte


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


class Vocabularies:
    """The two tokenizers, and the bytes of every id."""

    def __init__(self, first: str, second: str) -> None:
        # A task has one core. Threads of its own would each keep the memory of their part of a batch.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if crossing := [p for p in pieces if re.search(r"[^\s▁]▁", p)]:
            raise ValueError(f"pieces cross chunks, so chunks cannot be encoded apart: {crossing[:3]}")
        self.space = self.b.piece_to_id(SPACE_SIGN)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_SIGN, " ").encode() for i, p in enumerate(pieces)
        ]
        # The visible characters that stand for the bytes: printable ones for themselves, the others from 256 on.
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        added = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = added[i].encode() if i in added else bytes(byte_of[c] for c in piece)
        self.len_a, self.len_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        # Ids as text with the sign behind them: inside a group, and at its end.
        self.names_a, self.ends_a = self._names(len(self.bytes_a), ","), self._names(len(self.bytes_a), "|")
        self.names_b, self.ends_b = self._names(len(self.bytes_b), ","), self._names(len(self.bytes_b), ";")

    @staticmethod
    def _names(n: int, sign: str) -> np.ndarray:
        return np.array([f"{i}{sign}" for i in range(n)], object)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for texts that start with the space the second one adds itself."""
        a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [(x.ids, y if t != " " else [self.space]) for t, x, y in zip(texts, a, b, strict=True)]

    def spells(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = text.encode()
        return b"".join([self.bytes_a[i] for i in a]) == whole == b"".join([self.bytes_b[i] for i in b])


@dataclass
class Aligned:
    """Tokens of both vocabularies and links of each chunk of a batch; the linked pairs of all; the groups of each as text."""

    n_a: np.ndarray
    n_b: np.ndarray
    links: np.ndarray
    pairs: np.ndarray
    names: list[str]


def align(words: Vocabularies, encoded: list[tuple[list[int], list[int]]]) -> Aligned:
    """Chunks that both spell byte for byte, so that their ends meet wherever a chunk ends."""
    n_a, n_b = (np.array([len(pair[k]) for pair in encoded], np.int64) for k in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(pair[k] for pair in encoded), np.int64) for k in (0, 1))
    ends_a, ends_b = np.cumsum(words.len_a[a]), np.cumsum(words.len_b[b])
    last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
    # The place of each token when every group's first tokens stand before its second ones.
    upto_a, upto_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1  # tokens to the end of each group
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    signs = np.empty(len(a) + len(b), object)
    signs[np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]] = np.where(last_a, words.ends_a[a], words.names_a[a])
    signs[np.arange(len(b)) + upto_a[group_b]] = np.where(last_b, words.ends_b[b], words.names_b[b])
    signs, ends = signs.tolist(), np.cumsum(n_a + n_b).tolist()
    names = ["".join(signs[x:y]) for x, y in zip([0, *ends[:-1]], ends, strict=True)]
    links = np.diff(np.concatenate([[0], np.cumsum(last_a)])[np.cumsum(n_a)], prepend=0)
    return Aligned(n_a, n_b, links, b[last_b] << _SECOND | a[last_a], names)


class Run:
    """The aligned chunks of the texts of one run, and the table of chunks they point into."""

    def __init__(self, words: Vocabularies, bins: int) -> None:
        self.words, self.bins = words, bins
        self.clear_table()
        self.clear_texts()

    def clear_table(self) -> None:
        self.known: dict[str, int] = {}
        self.names: list[str] = []
        # By number: tokens (-1: bytes differ), tokens, links.
        self.n_a, self.n_b, self.links, self.pairs, self.chars = array("q"), array("q"), array("q"), array("q"), 0

    def clear_texts(self) -> None:
        self.chunks, self.chunk_counts, self.rows, self.bytes = [], [], [], 0

    def learn(self, chunks: list[str]) -> None:
        encoded = self.words.encode(chunks)
        whole = "".join(chunks).encode()
        good = np.ones(len(chunks), bool)
        if any(b"".join([own[i] for e in encoded for i in e[k]]) != whole for k, own in enumerate((self.words.bytes_a, self.words.bytes_b))):
            good[:] = [self.words.spells(c, *e) for c, e in zip(chunks, encoded, strict=True)]
            # Bytes that differ leave the chunk without tokens, and its texts with it.
            chunks = [c for c, ok in zip(chunks, good, strict=True) if ok] + [c for c, ok in zip(chunks, good, strict=True) if not ok]
            encoded = [e for e, ok in zip(encoded, good, strict=True) if ok]
        found, bad = align(self.words, encoded), len(chunks) - len(encoded)
        self.known.update(zip(chunks, range(len(self.names), len(self.names) + len(chunks)), strict=True))
        self.names += [*found.names, *[""] * bad]
        for own, values, filler in ((self.n_a, found.n_a, -1), (self.n_b, found.n_b, 0), (self.links, found.links, 0)):
            own.frombytes(values.tobytes())
            own.extend([filler] * bad)
        self.pairs.frombytes(found.pairs.tobytes())
        self.chars += sum(map(len, chunks))

    def add(self, ids: list[int | None], texts: list[str | None]) -> None:
        cut = [CHUNK.findall(" " + t) if t else [] for t in texts]
        known = self.known
        missing = list({c for chunks in cut for c in chunks if c not in known})
        for k in range(0, len(missing), LEARNT_AT_ONCE):
            self.learn(missing[k : k + LEARNT_AT_ONCE])
        n_a, n_b, links = (np.frombuffer(own, np.int64) if own else np.zeros(0, np.int64) for own in (self.n_a, self.n_b, self.links))
        for doc_id, text, chunks in zip(ids, texts, cut, strict=True):
            numbers = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
            if (n_a[numbers] < 0).any():
                numbers = numbers[:0]
            digest = ""
            if len(numbers):
                names = self.names
                digest = hashlib.sha256("".join([names[k] for k in numbers.tolist()])[:-1].encode()).hexdigest()
            self.rows.append((doc_id, int(n_a[numbers].sum()), int(n_b[numbers].sum()), int(links[numbers].sum()), digest))
            self.chunks.append(numbers)
            self.chunk_counts.append(len(numbers))
            self.bytes += len(text or "")

    def full(self, run_bytes: int) -> bool:
        return self.bytes >= run_bytes or self.chars >= run_bytes

    def written(self, run: int) -> Iterator[tuple]:
        """The rows of the run: the heads of its bins, then its documents and records. Arrays of an
        entry for each pair and document are the run's largest, so they go as soon as they were used."""
        keys, which = np.unique(np.frombuffer(self.pairs, np.int64) if self.pairs else np.zeros(0, np.int64), return_inverse=True)
        digits = (mix(keys >> _SECOND) % np.uint64(self.bins)).astype(np.int64)
        order = np.argsort(digits, kind="stable")  # inside a digit by second id, then first
        keys, digits = keys[order], digits[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        place = place[which]  # of each link of the table
        del which, order

        links = np.array(self.links, np.int64)
        once = np.concatenate(self.chunks) << 32
        once |= rows_of(np.array(self.chunk_counts, np.int64))
        once, n = np.unique(once, return_counts=True)
        n = n.astype(np.int32)
        chunk, doc = (once >> 32).astype(np.int32), (once & 0xFFFFFFFF).astype(np.uint32)
        del once
        starts, sizes = np.cumsum(links) - links, links[chunk]
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - starts[chunk], sizes)
        cells = place[at].astype(np.int64)
        del at, place, chunk
        cells <<= 32
        cells |= np.repeat(doc, sizes)
        n = np.repeat(n, sizes)
        sort = np.argsort(cells, kind="stable")
        cells, n = cells[sort], n[sort]
        del sort, doc, sizes
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
        cells, n = cells[first], np.add.reduceat(n, first, dtype=np.int64) if len(first) else n.astype(np.int64)
        del first
        pair, doc = cells >> 32, cells & 0xFFFFFFFF
        del cells

        # Pairs of the table that no text of this run holds are left out.
        held = np.bincount(pair, minlength=len(keys))
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, pair, n)
        del pair
        keys, digits, total, held = (x[held > 0] for x in (keys, digits, total, held))
        borders = np.searchsorted(digits, np.arange(self.bins + 1))
        for k, (x, y) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
            if x < y:
                yield run, k, packed(np.concatenate([np.diff(keys[x:y], prepend=0), total[x:y]])), None, None
        steps = np.diff(doc, prepend=0)
        new = np.cumsum(held) - held
        steps[new] = doc[new]
        del doc, new
        columns = list(zip(*self.rows, strict=True))
        table = pa.table([pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns)], names=list("iabgs"))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        yield run, -1, None, sink.getvalue().to_pybytes(), packed(np.concatenate([[len(held)], held, steps, n]))


def write_runs(docs: DataFrame, first: str, second: str, *, id_col: str, text_col: str, bins: int, run_bytes: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, number = Run(Vocabularies(first, second), bins), TaskContext.get().partitionId() << 32
        names = RUN_SCHEMA.replace(",", "").split()[::2]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for row in run.written(number):
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)
            number += 1
            if run.chars >= run_bytes:
                run.clear_table()
            run.clear_texts()

        for batch in batches:
            for begin, end, _, _ in text_blocks(batch.column(1)):
                run.add(*(c.slice(begin, end - begin).to_pylist() for c in batch.columns))
                if run.full(run_bytes):
                    yield from flush()
        if run.rows:
            yield from flush()

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = scratch_dir(docs.sparkSession, "alignment-runs")
    chosen.mapInArrow(rows, RUN_SCHEMA).write.parquet(path)
    return docs.sparkSession.read.schema(RUN_SCHEMA).parquet(path)


def _head(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.split(unpacked(blob), 2)
    return np.cumsum(keys), counts


def _entries(head: bytes, step: int = 4096) -> Iterator[tuple[int, int]]:
    """(pair, count) of a run's head, in pieces, so that only these are Python objects."""
    keys, counts = _head(head)
    for k in range(0, len(keys), step):
        yield from zip(keys[k : k + step].tolist(), counts[k : k + step].tolist(), strict=True)


def merge_heads(group: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts for the heads of one bin: 2 * count + (is it its second id's highest)."""
    keys, totals, answers = array("q"), array("q"), array("q")
    merged = heapq.merge(*map(_entries, group["head"]))
    for _, pairs in groupby(merged, key=lambda entry: entry[0] >> _SECOND):
        first = len(keys)
        for key, same in groupby(pairs, key=itemgetter(0)):
            keys.append(key)
            totals.append(sum(n for _, n in same))
        most = max(totals[first:])
        answers.extend(2 * n + (n == most) for n in totals[first:])
    every, found = np.array(keys, np.int64), np.array(answers, np.int64)
    back = [packed(found[np.searchsorted(every, _head(head)[0])]) for head in group["head"]]
    return pd.DataFrame({"run": group["run"], "bin": group["bin"], "head": back})


def sum_run(group: pd.DataFrame) -> pd.DataFrame:
    """The documents of one run with their counts, from its records and the answers of its bins."""
    group = group.sort_values("bin")
    own = group.iloc[0]
    answers = [unpacked(blob) for blob in group["head"].iloc[1:]]
    answer = np.concatenate(answers) if answers else np.zeros(0, np.int64)
    values = unpacked(own["records"])
    n_pairs = int(values[0])
    held = values[1 : 1 + n_pairs]
    steps, n = np.split(values[1 + n_pairs :], 2)
    pair = rows_of(held)
    sums = np.cumsum(steps.astype(np.int64))
    begin = np.cumsum(held) - held
    doc = sums - (sums[begin] - steps[begin])[pair] if len(steps) else steps
    with pa.ipc.open_stream(own["docs"]) as reader:
        table = reader.read_all()
    best, total = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
    np.add.at(total, doc, n * (answer[pair] >> 1))
    np.add.at(best, doc, n * (answer[pair] & 1))
    found = dict(zip(("doc_id", "n_a", "n_b", "n_groups", "groups_sha256"), table.columns, strict=True))
    frame = pd.DataFrame({k: v.to_pandas(integer_object_nulls=True) for k, v in found.items()})
    return frame.assign(n_links=frame["n_groups"], n_best=best, count_sum=total)[
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    ]


def align_tokens(
    docs: DataFrame, first: str, second: str, *, id_col: str = "doc_id", text_col: str = "text",
    bins: int = 64, run_bytes: int = 8 << 20,
) -> DataFrame:
    """For every whole text: tokens of both vocabularies, the groups their common ends cut, the
    links (pairs of tokens that end together), and what the links' corpus-wide counts sum to.

    ``first`` is a byte-level tokenizer file, ``second`` a piece model; both must exist on every
    executor. No token is empty, so each group has one link. Texts that are null, empty or not given
    back by the bytes of either vocabulary have no tokens: zeros and an empty ``groups_sha256``.
    One row for each input row, repeated rows (each counts) and null ids included; other columns are not
    read; an empty table gives no rows. ``bins`` radix digits should grow with the number of runs."""
    runs = write_runs(docs, first, second, id_col=id_col, text_col=text_col, bins=bins, run_bytes=run_bytes)
    heads = runs.filter(F.col("bin") >= 0).select("run", "bin", "head")
    back = heads.groupBy("bin").applyInPandas(merge_heads, "run bigint, bin int, head binary")
    own = runs.filter(F.col("bin") < 0).select("run", "bin", "head", "docs", "records")
    return own.unionByName(back, allowMissingColumns=True).groupBy("run").applyInPandas(sum_run, SCHEMA)
