"""Hierarchical Pitman-Yor language model with seating sampled by Gibbs sweeps.

Restaurants: one for each preceding word, whatever its frequency; its parent is that of the
word's class. Class restaurants share one parent (the class distribution without context), and each
class of rare words has one for its words. A class is one of the ``n_dishes`` most frequent
words, the end of a text, or the ending (last two bytes, hashed) of all other words. So a word that
never followed another backs off to the classes in context times the word within its class.

* Counts of all words come from one distributed aggregation, counted first in every task.
* Customers of words are pairs of neighbouring words. Each batch of texts sends its distinct pairs
  once, packed, to parts dealt by the word that is not frequent (the context, if both are not; the
  pair, if both are frequent). A part is counted, seated and scored where it was written. The tables
  that its words open are the customers of the class restaurants, sampled anew in each round.
* Customers of classes begin as pairs of classes, as if each customer had a table.
* A sweep takes each context's customers up and seats them again one after another (blocks of
  them, once a dish has many), given the parent's predictive distribution; new tables are the
  parent's customers of the next sweep. Contexts are seated in parallel. Predictive
  probabilities are averaged over the sweeps after ``burn_in``.
* The base of a rare-word restaurant has no atoms: each word has one table, and a new table is
  a word never seen, so the unseen words of one ending are one event.

A part answers each batch with the probability of each pair that the batch sent, in the same order;
the batch's own list of which text has which pair meets the answers by batch. So shuffles follow the
distinct pairs of a batch and its tokens, not texts times parts, and no pair is hot. The texts
are read twice for that; a hash of all pairs of a batch tells whether their rows came in the same order.
With ``s`` and ``d`` for strength and discount, ``N`` customers and ``T`` tables of a context, a word
with ``n`` customers at ``t`` tables has ``((s + d T) parent + n - d t) / (s + N)``. ``N`` is the word's
own count, as every token is a context once.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import LOWER, mix, rows_of, span_hashes, text_blocks, word_spans
from macrotide.session import scratch_dir

ENDINGS = 256
SHARES = 64  # of the contexts, seated in parallel
END_HASH = np.uint64(0x5EED_0F_7E47_E4D1)
BATCH_BYTES = 8 << 20  # of texts that send their pairs together
SLICE = 4096  # frequent words whose tables are added up by one task
COUNT_SCHEMA = "bin bigint, words binary, endings binary, n binary"
CLASS_SCHEMA = "part bigint, pairs binary, n binary"
SENT_SCHEMA = "part bigint, batch bigint, frequent binary, others binary, n_frequent bigint, n_others bigint, told bigint"
#: A row for the pairs of frequent words of a part, and one for its other pairs.
PAIR_SCHEMA = "context binary, dish binary, kind binary, n bigint, dish_n binary"
TABLES = "array<struct<slice:bigint,places:binary,tables:binary>>"
SEATED_SCHEMA = f"classes array<struct<part:bigint,pairs:binary,n:binary>>, context bigint, context_place int, opened {TABLES}"
ANSWER_SCHEMA = "batch bigint, place bigint, scores binary, counts binary, told bigint"
OWN_SCHEMA = "batch bigint, ids binary, nulls binary, sums binary, runs binary, rows binary, told bigint"
SCORE_SCHEMA = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
BATCHES = 1 << 32  # of one partition, at most
CODE_BITS = 40  # of a pair of places
LEVEL = pa.Codec("zstd", compression_level=1)


@dataclass(frozen=True)
class Settings:
    n_dishes: int = 2047
    n_frequent: int = 1 << 16  # words whose counts travel with the tasks
    sweeps: int = 6
    burn_in: int = 3
    context: tuple[float, float] = (0.6, 5.0)  # discount and strength of the contexts
    parent: tuple[float, float] = (0.3, 10.0)
    words: tuple[float, float] = (0.7, 2.0)  # of the contexts of single words
    rounds: int = 2
    part_rows: int = 1 << 19  # word pairs seated by one task
    rare_strength: float = 1.0
    bin_bytes: int = 16 << 20  # of texts, for each bin of words


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as planes of bytes, as many as the largest needs."""
    values = np.ascontiguousarray(values).astype("<u8")
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(values), width) + LEVEL.compress(planes, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    planes = LEVEL.decompress(data[9:], n * width, asbytes=True)
    found = np.zeros((n, 8), np.uint8)
    found[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return found.view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    values = values.astype(np.uint64)
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def bundle(parts: list[bytes]) -> bytes:
    return struct.pack(f"<Q{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def unbundle(data: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<Q", data)
    ends = np.cumsum((8 + 8 * n, *struct.unpack_from(f"<{n}Q", data, 8))).tolist()
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, where each stands once, and the number of each key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


def part_of(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    """The part of each hash, which never falls as hashes rise."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, ending, tokens of each row): the words of each row in order, and its end."""
    starts, ends = word_spans(data, offsets)
    lower = LOWER[data]
    words = np.diff(np.searchsorted(starts, offsets))
    place = np.arange(len(starts)) + rows_of(words)
    hashes = np.full(len(starts) + len(words), END_HASH)
    hashes[place] = span_hashes(lower, starts, ends)
    last = lower[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, lower[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    endings = np.zeros(len(hashes), np.int64)
    endings[place] = ((last * 256 + before) * 40503 >> 6) % ENDINGS
    return hashes, endings, words + 1


def _word_counts(train: DataFrame, n_bins: int = SHARES) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in text_blocks(batch.column(0)):
                hashes, endings, _ = tokens_of(data, offsets)
                for to, x in zip(found, _add_words(hashes, endings, np.ones(len(hashes))), strict=True):
                    to.append(x)
            kinds, endings, n = _add_words(*(np.concatenate(x) for x in found))
            edges = np.searchsorted(part_of(kinds, n_bins), np.arange(n_bins + 1))
            yield _record_batch([
                (b, pack_sorted(kinds[i:j]), pack(endings[i:j]), pack(n[i:j]))
                for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j
            ], COUNT_SCHEMA)

    def add(sent: pa.Table) -> pa.Table:
        words, endings, n = (
            np.concatenate([read(x.as_py()) for x in sent.column(c)])
            for c, read in (("words", unpack_sorted), ("endings", unpack), ("n", unpack))
        )
        words, endings, n = _add_words(words, endings, n)
        return pa.table({"word": words.view(np.int64), "ending": endings.astype(np.int32), "n": n})

    return train.select("text").mapInArrow(count, COUNT_SCHEMA).groupBy("bin").applyInArrow(add, "word bigint, ending int, n bigint")


def _add_words(hashes: np.ndarray, endings: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds, first, back = distinct(hashes)
    return kinds, endings[first], np.bincount(back, n, len(kinds)).astype(np.int64)


@dataclass
class Vocabulary:
    """What every task knows: frequent words by hash, and the totals of the classes."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray  # the dish of a frequent word, or -1
    n_dishes: int
    rare_tokens: np.ndarray  # of each ending
    rare_types: np.ndarray
    discount: float
    strength: float
    tokens: int
    types: int
    endings: np.ndarray  # of the frequent words
    starts: np.ndarray | None = None  # of the words whose hashes share their leading bits

    @property
    def n_classes(self) -> int:
        return self.n_dishes + ENDINGS

    def find(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its place among the frequent words or -1."""
        place = self.places(hashes)
        dish = np.where(place >= 0, self.classes[place], -1)
        return np.where(dish >= 0, dish, self.n_dishes + endings), place

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word among the frequent words, or -1; by the leading bits of its hash."""
        starts = np.searchsorted(self.hashes >> np.uint64(44), np.arange((1 << 20) + 1).astype(np.uint64)) if self.starts is None else self.starts
        self.starts = starts
        leading = (hashes >> np.uint64(44)).astype(np.int64)
        first = starts[leading].astype(np.int32)
        place = np.full(len(hashes), -1, np.int32)
        for step in range(int(np.diff(starts).max())):
            at = np.minimum(first + np.int32(step), np.int32(len(self.hashes) - 1))
            np.copyto(place, at, where=self.hashes[at] == hashes)
        return place

    def class_of(self, place: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """Class of words by place, or by ending where the place is -1."""
        dish = np.where(place >= 0, self.classes[place], -1)
        return np.where(dish >= 0, dish, self.n_dishes + np.where(place >= 0, self.endings[place], ending))


def _vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum((F.col("n") == 1).cast("bigint")), F.lit(0)),
        F.coalesce(F.sum((F.col("n") == 2).cast("bigint")), F.lit(0)),
    ).first()
    end = int(END_HASH.view(np.int64))
    ends = counts.where(F.col("word") == end).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.where(F.col("word") != end).orderBy(F.desc("n"), "word").limit(settings.n_frequent).toPandas()
    per_ending = counts.where(F.col("word") != end).groupBy("ending").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")
    ).toPandas()
    n_words = min(settings.n_dishes, len(top))
    classes = np.full(len(top) + 1, -1)
    classes[: n_words + 1] = np.arange(n_words + 1)
    hashes = np.append(END_HASH, top["word"].to_numpy(np.int64).view(np.uint64))
    numbers = np.append(ends, top["n"].to_numpy(np.int64))
    rare_tokens, rare_types = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    rare_tokens[per_ending["ending"]], rare_types[per_ending["ending"]] = per_ending["n"], per_ending["types"]
    dishes = top.iloc[:n_words]
    np.subtract.at(rare_tokens, dishes["ending"].to_numpy(np.int64), dishes["n"].to_numpy(np.int64))
    np.subtract.at(rare_types, dishes["ending"].to_numpy(np.int64), 1)
    endings = np.append(0, top["ending"].to_numpy(np.int64))
    order = np.argsort(hashes)
    once, twice = total[2], total[3]
    return Vocabulary(
        hashes[order], numbers[order], classes[order], n_words + 1, rare_tokens, rare_types,
        float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.95)), settings.rare_strength, total[0], total[1],
        endings[order],
    )


def _class_pairs(train: DataFrame, shared) -> DataFrame:
    """Pairs of classes over all training tokens, packed by share of the contexts; a text begins in
    the context of an end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = vocabulary.n_classes
        table = np.zeros(size * size, np.int32)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                hashes, endings, lengths = tokens_of(data, offsets)
                dish, _ = vocabulary.find(hashes, endings)
                pair, n = np.unique(_contexts(dish, lengths, vocabulary) * size + dish, return_counts=True)
                table[pair] += n.astype(np.int32)
            # A batch has far fewer tokens than a counter can hold.
            pair = np.flatnonzero(table)
            yield _record_batch(_by_share(pair, table[pair], size), CLASS_SCHEMA)
            table[pair] = 0

    return train.select("text").mapInArrow(count, CLASS_SCHEMA)


def _by_share(pair: np.ndarray, n: np.ndarray, size: int) -> list[tuple]:
    """Rows of sorted pairs of classes and their customers, by share of the contexts."""
    share = pair // size % SHARES
    order = np.argsort(share, kind="stable")
    pair, n = pair[order], n[order]
    edges = np.searchsorted(share[order], np.arange(SHARES + 1))
    return [
        (b, pack_sorted(pair[i:j]), pack(n[i:j])) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j
    ]


def _contexts(dish: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The class before each token; texts are separated by their ends."""
    before = np.empty_like(dish)
    before[1:] = dish[:-1]
    before[np.cumsum(lengths) - lengths] = vocabulary.classes[np.searchsorted(vocabulary.hashes, END_HASH)]
    return before


def _before(values: np.ndarray, lengths: np.ndarray, end) -> np.ndarray:
    """What stands before each token; a text begins after an end."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return before


def pair_hashes(context: np.ndarray, dish: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + dish)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows with at most ``BATCH_BYTES`` of text, or one; numbered by their order in the task."""
    number = TaskContext.get().partitionId() * BATCHES
    for batch in batches:
        for first, last, _, _ in text_blocks(batch.column("text"), BATCH_BYTES):
            yield number, batch.slice(first, last - first)
            number += 1


def _tokens(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, ending, place, tokens of each row) of a batch of texts."""
    found = []
    for _, _, data, offsets in text_blocks(texts):
        hashes, endings, lengths = tokens_of(data, offsets)
        found.append((hashes, endings.astype(np.uint8), vocabulary.places(hashes).astype(np.int32), lengths))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@dataclass
class Pairs:
    """Pairs of a context and a dish, each by its hash, its place (or -1) and its ending."""

    context: np.ndarray
    dish: np.ndarray
    context_place: np.ndarray
    dish_place: np.ndarray
    context_ending: np.ndarray
    dish_ending: np.ndarray

    def __getitem__(self, at) -> Pairs:
        return Pairs(*(x[at] for x in vars(self).values()))

    @property
    def kind(self) -> np.ndarray:
        """Of context and dish, 0: both are frequent; 1: the dish; 2: the context; 3: none."""
        return (self.context_place < 0) + 2 * (self.dish_place < 0).astype(np.int8)


@dataclass
class Dealt:
    """The distinct pairs of a batch, by kind and in the order of their parts. A key is the places or
    the numbers among ``words`` (those that are not frequent) of the two words of a pair."""

    words: np.ndarray
    endings: np.ndarray
    word_edges: np.ndarray
    keys: list[np.ndarray]
    edges: list[np.ndarray]
    begins: np.ndarray  # part by kind, in the order in which pairs are sent
    rank: np.ndarray  # the pair of each token in that order
    told: int  # of all pairs


def _deal(tokens: tuple, vocabulary: Vocabulary, n_parts: int) -> Dealt:
    hashes, endings, place, lengths = tokens
    size, none = np.int64(len(vocabulary.hashes)), np.searchsorted(vocabulary.hashes, END_HASH)
    rare = np.flatnonzero(place < 0)
    words, first, back = distinct(hashes[rare])
    word_endings = endings[rare][first]
    number = np.full(len(place), -1, np.int32)
    number[rare] = back
    before, before_number = _before(place, lengths, none), _before(number, lengths, -1)
    word_edges = np.searchsorted(part_of(words, n_parts), np.arange(n_parts + 1))
    kind = (before < 0) + 2 * (place < 0).astype(np.int8)
    keys, edges, rank = [], [], np.empty(len(place), np.int32)
    for k in range(4):
        at = np.flatnonzero(kind == k)
        if k == 0:
            code = before[at] * size + place[at]
            key = part_of(mix(code.view(np.uint64)), n_parts) << CODE_BITS | code
            bounds = np.arange(n_parts + 1) << CODE_BITS
        elif k == 3:
            key, bounds = before_number[at] * np.int64(len(words)) + number[at], word_edges * len(words)
        else:
            told, other = (before_number, place) if k == 1 else (number, before)
            key, bounds = told[at] * size + other[at], word_edges * size
        found, rank[at] = np.unique(key, return_inverse=True)
        keys.append(found)
        edges.append(np.searchsorted(found, bounds))
    sizes = np.stack([np.diff(e) for e in edges], axis=1)
    begins = (np.cumsum(sizes) - sizes.ravel()).reshape(-1, 4)
    for k in range(4):
        at = np.flatnonzero(kind == k)
        rank[at] += np.repeat(begins[:, k] - edges[k][:-1], sizes[:, k]).astype(np.int32)[rank[at]]
    told = [np.bitwise_xor.reduce(mix(x.view(np.uint64) + np.uint64(i)), initial=np.uint64(0)) for i, x in enumerate((*keys, words))]
    return Dealt(words, word_endings, word_edges, keys, edges, begins, rank, int(np.bitwise_xor.reduce(told).view(np.int64)))


def _send(shared, n_parts: int):
    """All distinct pairs of a batch, and how often each stands in texts to learn from."""

    def send(number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = shared.value
        size = len(vocabulary.hashes)
        tokens = _tokens(batch.column("text"), vocabulary)
        dealt = _deal(tokens, vocabulary, n_parts)
        learned = np.repeat(batch.column("learned").to_numpy(zero_copy_only=False), tokens[-1])
        total = sum(map(len, dealt.keys))
        n = np.bincount(dealt.rank[learned], minlength=total)
        out = []
        for p, (i, j, *_) in enumerate(dealt.begins.tolist()):
            k = int(dealt.begins[p + 1, 0]) if p + 1 < n_parts else total
            code = dealt.keys[0][dealt.edges[0][p] : dealt.edges[0][p + 1]] & ((1 << CODE_BITS) - 1)
            frequent = bundle([pack_sorted(code), pack(n[i:j])]) if i < j else None
            others = _pack_others(dealt, p, n, size) if j < k else None
            if i < k:
                out.append((p, number, frequent, others, int(n[i:j].sum()), int(n[j:k].sum()), dealt.told))
        return _record_batch(out, SENT_SCHEMA)

    return lambda batches: (send(number, batch) for number, batch in _text_batches(batches))


def _pack_others(dealt: Dealt, p: int, n: np.ndarray, size: int) -> bytes:
    """Words that are not frequent once, and for each the pairs of each kind."""
    first, last = dealt.word_edges[p : p + 2]
    found = [pack_sorted(dealt.words[first:last]), pack(dealt.endings[first:last])]
    for k in (1, 2, 3):
        keys = dealt.keys[k][dealt.edges[k][p] : dealt.edges[k][p + 1]]
        word, other = keys // (size if k < 3 else len(dealt.words)), keys % (size if k < 3 else len(dealt.words))
        found.append(pack(np.bincount(word - first, minlength=last - first)))
        found += [pack(other)] if k < 3 else [pack(dealt.words[other]), pack(dealt.endings[other])]
        found.append(pack(n[dealt.begins[p, k] :][: len(keys)]))
    return bundle(found)


def _read_frequent(codes: np.ndarray, vocabulary: Vocabulary) -> Pairs:
    context, dish = codes // len(vocabulary.hashes), codes % len(vocabulary.hashes)
    none = np.zeros(len(codes), np.uint8)
    return Pairs(vocabulary.hashes[context], vocabulary.hashes[dish], context.astype(np.int32), dish.astype(np.int32), none, none)


def _read_others(data: bytes, vocabulary: Vocabulary) -> tuple[Pairs, np.ndarray]:
    found = unbundle(data)
    words, endings = unpack_sorted(found[0]), unpack(found[1]).astype(np.uint8)
    columns, numbers = [], []
    for k, at, more in ((1, 2, 1), (2, 5, 1), (3, 8, 2)):
        which = np.repeat(np.arange(len(words)), unpack(found[at]).astype(np.int64))
        word, ending = words[which], endings[which]
        none, rare = np.zeros(len(which), np.uint8), np.full(len(which), -1, np.int32)
        other = unpack(found[at + 1])
        if k == 3:
            columns.append((word, other, rare, rare, ending, unpack(found[at + 2]).astype(np.uint8)))
        else:
            place = other.astype(np.int32)
            hashes = vocabulary.hashes[place]
            columns.append((word, hashes, rare, place, ending, none) if k == 1 else (hashes, word, place, rare, none, ending))
        numbers.append(unpack(found[at + 1 + more]).view(np.int64))
    return Pairs(*(np.concatenate(x) for x in zip(*columns, strict=True))), np.concatenate(numbers)


def _ask(shared, n_parts: int):
    """Words that are not frequent and follow another such word, for the part of that pair."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch in _text_batches(batches):
            hashes, _, place, lengths = _tokens(batch.column("text"), shared.value)
            at = np.flatnonzero((place < 0) & (_before(place, lengths, 0) < 0))
            part = part_of(_before(hashes, lengths, END_HASH)[at], n_parts)
            _, first, _ = distinct(pair_hashes(part.astype(np.uint64), hashes[at]))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[at][first].view(np.int64)), pa.array(part[first])], names=["word", "part"])

    return ask


def _gather(asked: pa.Table, sent: pa.Table) -> pa.Table:
    """What batches sent to a part, with the counts of the words that it cannot count itself."""
    sent = sent.sort_by("batch")
    words, first, _ = distinct(asked.column("word").to_numpy().view(np.uint64))
    n = asked.column("n").to_numpy()[first]
    out = []
    for name in ("frequent", "others") if len(sent) else ():
        here = sent.filter(sent.column(name).is_valid())
        blobs = here.column(name).to_pylist()
        about = [pack(sent.column("part").to_numpy()[:1]), pack_sorted(here.column("batch").to_numpy()), here.column("told").to_numpy().tobytes()]
        total = sum(here.column(f"n_{name}").to_pylist())
        if name == "frequent":
            out.append((None, None, bundle([*about, *blobs]), total, None))
        else:
            out.append((bundle(blobs), pack_sorted(words), bundle(about), total, pack(n)))
    return pa.Table.from_batches([_record_batch(out, PAIR_SCHEMA)])


@dataclass
class Part:
    """A row of the word pairs: the distinct pairs, how often each is learned from, the counts of their
    dishes, and which of them each batch sent."""

    number: int
    batches: np.ndarray
    told: np.ndarray
    starts: np.ndarray
    pairs: Pairs
    keys: np.ndarray
    back: np.ndarray
    n: np.ndarray
    known: np.ndarray
    context_at: np.ndarray  # of contexts that are not frequent

    @staticmethod
    def read(row: dict, vocabulary: Vocabulary) -> Part | None:
        number, batches, told, *blobs = unbundle(row["kind"])
        if row["context"] is None:
            found = [[unpack(x) for x in unbundle(b)] for b in blobs]
            found = [(np.cumsum(code, dtype=np.uint64).view(np.int64), n.view(np.int64)) for code, n in found]
        else:
            found = [_read_others(b, vocabulary) for b in unbundle(row["context"])]
        if not found:
            return None
        starts = np.cumsum([0] + [len(n) for _, n in found])
        sent = np.concatenate([n for _, n in found])
        if row["context"] is None:
            keys, _, back = distinct(np.concatenate([code for code, _ in found]))
            pairs = _read_frequent(keys, vocabulary)
        else:
            pairs = Pairs(*(np.concatenate(x) for x in zip(*(vars(p).values() for p, _ in found), strict=True)))
            keys, first, back = distinct(pair_hashes(pairs.context, pairs.dish))
            pairs = pairs[first]
        n = np.bincount(back, sent, len(keys)).astype(np.int64)
        known = np.where(pairs.dish_place >= 0, vocabulary.counts[pairs.dish_place], 0)
        context_at = np.zeros(len(n), np.int64)
        if row["context"] is not None:
            own = np.flatnonzero(pairs.context_place < 0)
            words, context_at[own] = np.unique(pairs.context[own], return_inverse=True)
            counts = np.bincount(context_at[own], n[own], len(words)).astype(np.int64)
            for k, words, counts in ((2, words, counts), (3, unpack_sorted(row["dish"]), unpack(row["dish_n"]).view(np.int64))):
                at = np.flatnonzero(pairs.kind == k)
                if len(words):
                    place = np.minimum(np.searchsorted(words, pairs.dish[at]), len(words) - 1)
                    known[at] = np.where(words[place] == pairs.dish[at], counts[place], 0)
        batches, told = unpack_sorted(batches).view(np.int64), np.frombuffer(told, np.int64)
        return Part(int(unpack(number)[0]), batches, told, starts, pairs, keys, back, n, known, context_at)

    def base(self, vocabulary: Vocabulary, predictive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pair of classes of each pair, and what the class gives for the dish."""
        context = vocabulary.class_of(self.pairs.context_place, self.pairs.context_ending)
        dish = vocabulary.class_of(self.pairs.dish_place, self.pairs.dish_ending)
        ending = np.maximum(dish - vocabulary.n_dishes, 0)
        # Words that were never seen are one event of their ending.
        inside = np.where(self.known > 0, self.known - vocabulary.discount, vocabulary.strength + vocabulary.discount * vocabulary.rare_types[ending])
        inside = np.where(dish < vocabulary.n_dishes, 1.0, inside / (vocabulary.strength + vocabulary.rare_tokens[ending]))
        return context * vocabulary.n_classes + dish, predictive[context, dish] * inside

    def of_context(self, values: np.ndarray, at: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Sums of ``values`` (of the pairs ``at``) over the context of each pair; those of frequent
        contexts, which have pairs in other parts, are given."""
        place = self.pairs.context_place
        rare = at[place[at] < 0]
        total = np.bincount(self.context_at[rare], values[place[at] < 0], self.context_at.max() + 1)
        return np.where(place >= 0, frequent[place], total[self.context_at])

    def seat(self, base: np.ndarray, frequent: np.ndarray, turn: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that are learned from, and the tables of each, added up over the sweeps that count.
        Frequent contexts have the tables of the round before. The same input is seated alike."""
        discount, strength = settings.words
        at = np.flatnonzero(self.n)
        # A pair that is learned from once has one table, and so has every dish to begin with.
        total = np.full(len(at), settings.sweeps - settings.burn_in)
        more = np.flatnonzero(self.n[at] > 1)
        again = at[more]
        customers, odds, place = self.n[again], base[again], self.pairs.context_place[again]
        weight = strength + discount * frequent[place]
        rare = np.flatnonzero(place < 0)
        context = self.context_at[again[rare]]
        whole = at[self.pairs.context_place[at] < 0]
        single = np.bincount(self.context_at[whole], self.n[whole] == 1, self.context_at.max() + 1)
        tables, found = np.ones(len(again), np.int64), np.zeros(len(again), np.int64)
        rng = np.random.default_rng([turn, int(self.keys[0]) & 0xFFFFFFFF])
        for sweep in range(settings.sweeps):
            opened = single + np.bincount(context, tables[rare], len(single))
            weight[rare] = strength + discount * opened[context]
            tables = seat(customers, odds, discount, weight, rng)
            if sweep >= settings.burn_in:
                found += tables
        total[more] = found
        return at, total


def _seat_words(shared, settings: Settings, turn: int | None):
    """The tables of each part: of classes, if another round follows, and of contexts that are frequent
    words. Without a turn each pair has one."""

    def seat_words(row: dict) -> pa.RecordBatch:
        vocabulary, predictive, frequent = shared.value
        part = Part.read(row, vocabulary)
        classes, slices, contexts = [], [], None
        if part is not None:
            if turn is None:
                at = np.flatnonzero(part.n)
                tables = np.ones(len(at), np.int64)
            else:
                pair, base = part.base(vocabulary, predictive)
                at, tables = part.seat(base, frequent, turn, settings)
                if turn + 1 < settings.rounds:
                    pair, _, back = distinct(pair[at])
                    n = np.bincount(back, tables, len(pair)).astype(np.int64)
                    classes = [dict(zip(("part", "pairs", "n"), x, strict=True)) for x in _by_share(pair, n, vocabulary.n_classes)]
            if row["context"] is not None:
                contexts = int(part.context_at.max()) + 1
            place = part.pairs.context_place[at]
            n = np.bincount(place[place >= 0], tables[place >= 0], len(vocabulary.hashes)).astype(np.int64)
            for first in range(0, len(n), SLICE):
                place = np.flatnonzero(n[first : first + SLICE])
                if len(place):
                    slices.append({"slice": first // SLICE, "places": pack_sorted(place), "tables": pack(n[first:][place])})
        if contexts is None and row["context"] is not None:
            contexts = 0
        return pa.RecordBatch.from_arrays([
            pa.array([classes], pa.list_(pa.struct({"part": pa.int64(), "pairs": pa.binary(), "n": pa.binary()}))),
            pa.array([contexts], pa.int64()), pa.array([0 if contexts is None else -1], pa.int32()),
            pa.array([slices], pa.list_(pa.struct({"slice": pa.int64(), "places": pa.binary(), "tables": pa.binary()}))),
        ], names=["classes", "context", "context_place", "opened"])

    return lambda batches: (seat_words(row) for batch in batches for row in _rows(batch))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time, so that no more than its arrays are held."""
    for i in range(len(batch)):
        yield batch.slice(i, 1).to_pylist()[0]


def _sample_words(
    pairs: DataFrame, vocabulary: Vocabulary, predictive: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of contexts that are frequent words before and after the last round, and the predictive
    probabilities of the classes in it."""
    spark = pairs.sparkSession
    kept = settings.sweeps - settings.burn_in

    def seated(turn: int | None, needed: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast((vocabulary, None if turn is None else predictive, opened))
        path = scratch_dir(spark, "first-tables" if turn is None else "seated-pairs")
        pairs.mapInArrow(_seat_words(shared, settings, turn), SEATED_SCHEMA).select(*needed).write.parquet(path)
        shared.destroy()
        return spark.read.parquet(path)

    before = opened = None
    opened = _of_frequent(seated(None, ["opened"]), vocabulary)
    for turn in range(settings.rounds):
        if turn:
            predictive = None
            customers = found.select(F.explode("classes").alias("c")).select("c.*")
            predictive = _sample(customers, vocabulary.n_classes, settings, kept)
        # The next round needs the tables of classes, scoring does not.
        needed = ["classes", "context_place", "opened"] if turn + 1 < settings.rounds else ["context", "context_place", "opened"]
        found = seated(turn, needed)
        before, opened = opened, _of_frequent(found, vocabulary) / kept
    return before, opened, predictive


def _of_frequent(seated: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The tables of each frequent word, in the order of the vocabulary, added up slice by slice."""

    def add(slices: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for places, tables in zip(slices.column("places"), slices.column("tables"), strict=True):
            total[unpack_sorted(places.as_py()).view(np.int64)] += unpack(tables.as_py()).view(np.int64)
        return pa.table({"slice": slices.column("slice").slice(0, 1), "tables": pa.array([total.tobytes()], pa.binary())})

    found = np.zeros(-(-len(vocabulary.hashes) // SLICE) * SLICE)
    added = seated.select(F.explode("opened").alias("o")).select("o.*").groupBy("slice").applyInArrow(add, "slice bigint, tables binary")
    for row in added.toArrow().to_pylist():
        found[row["slice"] * SLICE :][:SLICE] = np.frombuffer(row["tables"], np.int64)
    return found[: len(vocabulary.hashes)]


def seat(customers: np.ndarray, base: np.ndarray, discount: float, weight: np.ndarray, rng) -> np.ndarray:
    """Tables of each dish when its customers sit down one after another: a newcomer opens a
    table with odds ``weight * base`` (``weight`` is strength plus discount times all tables)
    against ``seated - discount * tables``. Beyond ten customers, tenths of them sit at once."""
    tables = np.ones(len(customers), np.int64)
    active = np.flatnonzero(customers > 1)
    seated, total = np.ones(len(active), np.int64), customers[active]
    opening, own = (weight * base)[active], np.ones(len(active), np.int64)
    while len(active):
        come = np.minimum(np.maximum(1, seated // 10), total - seated)
        odds = opening / (opening + seated - discount * own)
        own = own + (rng.random(len(own)) < odds if come.max() == 1 else rng.binomial(come, odds))
        seated = seated + come
        done = seated >= total
        tables[active[done]] = own[done]
        active, seated, total, opening, own = (x[~done] for x in (active, seated, total, opening, own))
    return tables


def _seat_part(shared, size: int, sweep: int, settings: Settings):
    discount, strength = settings.context

    def seat_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Seat all customers of a share of the contexts (at most ``size`` dishes each)."""
        parent, all_tables, predict = shared.value
        for row in (r for batch in batches for r in _rows(batch)):
            pair, n = unpack_sorted(row["pairs"]).view(np.int64), unpack(row["n"]).view(np.int64)
            context, dish = pair // size, pair % size
            rng = np.random.default_rng([sweep, row["part"]])
            tables = seat(n, parent[dish], discount, (strength + discount * all_tables)[context], rng)
            here, at = np.unique(context, return_inverse=True)
            total, opened = np.bincount(at, n), np.bincount(at, tables)
            rows = [None] * len(here)
            if predict:
                new = (strength + discount * opened) / (strength + total)
                dense = new[:, None] * parent[None, :]
                dense[at, dish] += (n - discount * tables) / (strength + total[at])
                rows = [r.tobytes() for r in dense.astype(np.float32)]
            customers = np.bincount(dish, tables, size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(here.astype(np.int32)), pa.array(opened.astype(np.int64)),
                pa.array([customers.tobytes()] + [None] * (len(here) - 1), pa.binary()), pa.array(rows, pa.binary()),
            ], names=["context", "opened", "customers", "predictive"])

    return seat_part


def _add_classes(scale: int):
    """Customers of a share of the contexts, which were sent ``scale``-fold."""

    def add(sent: pa.Table) -> pa.Table:
        pair = np.concatenate([unpack_sorted(x.as_py()) for x in sent.column("pairs")])
        n = np.concatenate([unpack(x.as_py()).view(np.int64) for x in sent.column("n")])
        pair, back = np.unique(pair, return_inverse=True)
        n = np.bincount(back, n, len(pair)).astype(np.int64)
        return pa.table({
            "part": sent.column("part").slice(0, 1), "pairs": pa.array([pack_sorted(pair)], pa.binary()),
            "n": pa.array([pack(-(-n // scale))], pa.binary()),
        })

    return add


def _sample(sent: DataFrame, size: int, settings: Settings, scale: int = 1) -> np.ndarray:
    """Averaged predictive probabilities, context by dish."""
    parent_discount, parent_strength = settings.parent
    parent = np.full(size, 1 / size)
    all_tables = np.zeros(size)  # of each context, as the last sweep left them
    mean = np.zeros((size, size), np.float32)
    spark = sent.sparkSession
    # One packed row for each share, which all sweeps read where it is.
    path = scratch_dir(spark, "class-customers")
    sent.groupBy("part").applyInArrow(_add_classes(scale), CLASS_SCHEMA).write.parquet(path)
    grouped = spark.read.parquet(path)
    for sweep in range(settings.sweeps):
        shared = spark.sparkContext.broadcast((parent, all_tables, sweep >= settings.burn_in))

        # As many rows as classes, whatever the corpus.
        found = grouped.mapInArrow(
            _seat_part(shared, size, sweep, settings), "context int, opened bigint, customers binary, predictive binary"
        ).toArrow()
        customers = np.zeros(size, np.int64)
        for part in found.column("customers").to_pylist():
            if part is not None:
                customers += np.frombuffer(part, np.int64)
        context = found.column("context").to_numpy()
        if sweep >= settings.burn_in:
            unseen = np.ones(size, bool)
            unseen[context] = False
            mean[unseen] += parent.astype(np.float32)
            for c, row in zip(context, found.column("predictive"), strict=True):
                mean[c] += np.frombuffer(row.as_py(), np.float32)
        all_tables = np.zeros(size)
        all_tables[context] = found.column("opened").to_numpy()
        del found
        shared.destroy()
        # The driver keeps no more than the mean.
        pa.default_memory_pool().release_unused()
        rng = np.random.default_rng([sweep, SHARES])
        weight = np.full(size, parent_strength + parent_discount * (customers > 0).sum())
        tables = seat(np.maximum(customers, 1), np.full(size, 1 / size), parent_discount, weight, rng)
        tables[customers == 0] = 0
        parent = (customers - parent_discount * tables + (parent_strength + parent_discount * tables.sum()) / size) / (
            parent_strength + customers.sum()
        )
    mean /= settings.sweeps - settings.burn_in
    return mean


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if kind == "binary" else pa.int64()) for c, kind in zip(columns, kinds, strict=True)], names=list(names)
    )


def _answer(shared, settings: Settings):
    """For each batch and part, the probabilities of its pairs in the order sent, and the counts of their
    dishes (plus one; 0 where tasks know them)."""
    discount, strength = settings.words
    turn, kept = settings.rounds - 1, settings.sweeps - settings.burn_in

    def answer(row: dict) -> pa.RecordBatch:
        vocabulary, predictive, before, opened = shared.value
        part = Part.read(row, vocabulary)
        if part is None:
            return _record_batch([], ANSWER_SCHEMA)
        _, base = part.base(vocabulary, predictive)
        at, tables = part.seat(base, before, turn, settings)
        mean = np.zeros(len(part.n))
        mean[at] = tables / kept
        weight = strength + discount * part.of_context(mean[at], at, opened)
        total = strength + part.of_context(part.n[at], at, vocabulary.counts)
        score = np.log10((weight * base + part.n - discount * mean) / total).astype(np.float32).view(np.uint32)[part.back]
        counts = np.where(part.pairs.dish_place >= 0, 0, part.known + 1)[part.back]
        place = 2 * part.number + (row["context"] is not None)
        out = []
        for b, told, i, j in zip(part.batches.tolist(), part.told.tolist(), part.starts[:-1], part.starts[1:], strict=True):
            out.append((b, place, pack(score[i:j]), pack(counts[i:j]), told))
        return _record_batch(out, ANSWER_SCHEMA)

    return lambda batches: (answer(row) for batch in batches for row in _rows(batch))


def _own(shared, n_parts: int):
    """Of each batch: which texts hold its pairs, in the order in which they were sent, and the sums over
    frequent words."""

    def own(number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = shared.value
        base_known = np.log10((vocabulary.counts + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.types + 1)))
        tokens = _tokens(batch.column("text"), vocabulary)
        _, _, place, lengths = tokens
        row, n = rows_of(lengths).astype(np.int32), len(lengths)
        frequent = place >= 0
        seen = frequent & (vocabulary.counts[place] > 0)
        base = np.bincount(row[frequent], base_known[place[frequent]], n)
        sums = np.stack([lengths, np.bincount(row[seen], minlength=n), base])
        del place, frequent, seen
        dealt = _deal(tokens, vocabulary, n_parts)
        del tokens
        runs = np.bincount(dealt.rank)
        begins = np.cumsum(runs) - runs
        # Within a pair rows ascend.
        rows = dealt.rank.astype(np.int64) << 32 | row
        rows.sort()
        rows &= 0xFFFFFFFF
        first = rows[begins]
        rows[1:] -= rows[:-1].copy()
        rows[begins] = first
        ids = batch.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        return _record_batch([(
            number, ids.fill_null(0).to_numpy().tobytes(), null.tobytes(), sums.tobytes(), pack(runs), pack(rows), dealt.told
        )], OWN_SCHEMA)

    return lambda batches: (own(number, batch) for number, batch in _text_batches(batches))


def _add_up(shared):
    """Of a batch of texts: its own sums and all answers, added in the order of the pairs."""

    def add_up(own: pa.Table, answers: pa.Table) -> pa.Table:
        vocabulary = shared.value
        answers = answers.sort_by("place")
        if set(own.column("told").to_pylist()) != set(answers.column("told").to_pylist()):
            raise RuntimeError("the rows came in another order when they were read again: write them to a table first")
        own = own.to_pylist()[0]
        score, counts = (
            np.concatenate([unpack(x.as_py()) for x in answers.column(c)]) for c in ("scores", "counts")
        )
        score = score.astype(np.uint32).view(np.float32).astype(np.float64)
        runs, rows = unpack(own["runs"]).view(np.int64), unpack(own["rows"]).view(np.int64)
        # Rows stand as steps within each pair.
        begins = np.cumsum(runs) - runs
        rows = np.cumsum(rows)
        rows -= np.repeat(np.append(0, rows)[begins], runs)
        ids, null = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["nulls"], bool)
        n_tokens, known, base = np.frombuffer(own["sums"]).reshape(3, -1).copy()
        n = len(n_tokens)
        total = np.bincount(rows, np.repeat(score, runs), n)
        rare = np.repeat(counts > 0, runs)
        count = np.repeat(counts, runs)[rare].view(np.int64) - 1
        known += np.bincount(rows[rare], count > 0, n)
        base += np.bincount(rows[rare], np.log10((count + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.types + 1))), n)
        return pa.table({
            "doc_id": pa.array(ids, mask=null), "n_tokens": pa.array(n_tokens.astype(np.int64)),
            "n_known": pa.array(known.astype(np.int64)), "base_score": pa.array(base), "score": pa.array(total),
        })

    return add_up


def score_texts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row for each text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (both log10 probabilities) and perplexity under the model.

    Learns from rows whose crc32(doc_id as text) mod 5 is not 1; a null id is learned from.
    Words are parted by ASCII white space, A-Z in lower case, and each text has an end as its last
    token. A null text is empty: its one token is the end. Repeated rows are learned from and returned
    as often as they stand; other columns are not read. Words are told apart by 64-bit hashes. Rows must
    come in the same order whenever they are read, as those of files do; if not, an error is raised."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    train = rows.where(~held)
    total = rows.agg(F.sum(F.octet_length("text")).cast("bigint")).first()[0] or 0
    n_bins = max(1, -(-total // settings.bin_bytes))
    path = scratch_dir(spark, "word-counts")
    _word_counts(train, n_bins).write.parquet(path)
    counts = spark.read.parquet(path)
    vocabulary = _vocabulary(counts, settings)
    # At most every other token or so is a new pair.
    n_parts = max(n_bins, -(-vocabulary.tokens // (2 * settings.part_rows)))
    shared = spark.sparkContext.broadcast(vocabulary)
    predictive = _sample(_class_pairs(train, shared), vocabulary.n_classes, settings)
    asked = rows.mapInArrow(_ask(shared, n_parts), "word bigint, part bigint").join(counts.select("word", "n"), "word")
    sent = rows.select("text", (~held).alias("learned")).mapInArrow(_send(shared, n_parts), SENT_SCHEMA)
    path = scratch_dir(spark, "word-pairs")
    asked.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(_gather, PAIR_SCHEMA).write.parquet(path)
    pairs = spark.read.parquet(path)
    before, opened, predictive = _sample_words(pairs, vocabulary, predictive, settings)
    model = spark.sparkContext.broadcast((vocabulary, predictive, before, opened))
    del predictive
    answers = pairs.mapInArrow(_answer(model, settings), ANSWER_SCHEMA)
    own = rows.mapInArrow(_own(shared, n_parts), OWN_SCHEMA)
    return own.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_add_up(shared), SCORE_SCHEMA).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
