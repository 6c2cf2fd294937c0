"""Near-duplicate classes: BagMinHash signatures, bands, and verified multiset overlap.

A text is the multiset of its five-word shingles. The weights (multiplicities) of a shingle
are discretised into unit cells, and cells into dyadic intervals (0,1], (1,2], (2,4], ...
Each interval has a Poisson process whose points carry a time, a register and a cell, all
drawn from a hash of shingle and interval; a point counts if its cell lies below the weight.
A register keeps the earliest point. Two texts agree in a register with the probability of
their weighted Jaccard similarity. A process stops once its time is past every register of its
text, so a shingle costs a point or two, not one for each register.

Signatures are cut into bands. Texts that share a band are candidates, and exact multiset
Jaccard similarity decides. Equal texts are one candidate. Within a bucket not all pairs are
made: all members are compared with a hub; those alike leave the bucket and the others go on
with new hubs, sixteen times as many in each round. Pairs that were not compared are left out only
where no link is possible or needed:

* A member too far from a hub (under 0.6) is by the triangle inequality no link of what is
  close to the hub (0.8). Those in between are compared with these in the end, unless they
  have been linked by then.
* Shingles that no other text of the unsettled buckets has cannot be shared. What is left of two
  texts bounds their similarity, so a text with many edits of its own is settled at once.
  From the second round on these bounds, and what both share with the first hub of their bucket,
  are conditions of the join with the hubs, and two hubs of a bucket meet once.

So no link of a bucket is lost, and a large group of copies does not cost its square. Two texts
often share many buckets and one hub there: what is known of them is one row with these buckets.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.components import connected_components, in_tasks
from macrotide.llm.text import LOWER, SPACES, mix, rows_of, span_hashes, text_blocks, windows, word_spans
from macrotide.session import checkpoint_root, scratch_dir

SHINGLE = 5
SIGNED = "doc_id bigint, digest binary, bands array<bigint>"
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


def shingle_weights(hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, multiplicity) of each distinct shingle of each row. A row of one
    to four words has one shingle, all of them."""
    row = rows_of(words)
    found = windows(hashes, SHINGLE)
    at = np.flatnonzero(row[: len(found)] == row[SHINGLE - 1 :]) if len(found) else np.zeros(0, np.int64)
    first = np.append(0, np.cumsum(words)[:-1])
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    few = [mix(windows(hashes[first[i] : first[i] + words[i]], int(words[i])) + words[i : i + 1].astype(np.uint64) * _B)[0] for i in short]
    owner = np.append(row[at], short)
    key = np.append(found[at], np.array(few, np.uint64))
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(fresh)
    return owner[begins], key[begins], np.diff(np.append(begins, len(key)))


def bag_minhash(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """Earliest point of each register of each row; infinite for rows without shingles."""
    # One process for each interval that begins below the weight.
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    owner, weight = np.repeat(owner, levels), np.repeat(weight, levels)
    state = mix(np.repeat(key, levels) + level.astype(np.uint64) * _A)
    length = np.left_shift(np.int64(1), np.maximum(level - 1, 0))
    start = np.where(level > 0, length, 0)
    rate = registers * length.astype(np.float64)
    time = np.zeros(len(owner))
    table = np.full((n_rows, registers), np.inf)
    while len(owner):
        state = state + _A
        drawn = mix(state)
        time = time - np.log(((drawn >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / rate
        place = mix(drawn + _C)
        register = (place % np.uint64(registers)).astype(np.int64)
        cell = start + ((place >> np.uint64(32)) * length.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        counts = cell < weight
        np.minimum.at(table.reshape(-1), (owner * registers + register)[counts], time[counts])
        on = time <= table.max(axis=1)[owner]
        owner, weight, state, start, length, rate, time = (
            x[on] for x in (owner, weight, state, start, length, rate, time)
        )
    return table


def band_hashes(table: np.ndarray, rows_per_band: int) -> np.ndarray:
    bits = table.view(np.uint64).reshape(len(table), -1, rows_per_band)
    found = np.zeros(bits.shape[:2], np.uint64)
    for k in range(rows_per_band):
        found = mix(found * _A + bits[:, :, k])
    return mix(found + np.arange(bits.shape[1], dtype=np.uint64) * _C).view(np.int64)


def normal_words(text: bytes) -> list[bytes]:
    return text.lower().split()


def similarity(a: Counter, b: Counter) -> float:
    """Multiset Jaccard similarity: sum of the smaller over sum of the larger weights."""
    if len(a) > len(b):
        a, b = b, a
    shared = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return shared / (a.total() + b.total() - shared)


def shingles(text: bytes) -> Counter:
    words = normal_words(text)
    return Counter(tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)) if words)


def _sign(rows: DataFrame, registers: int, rows_per_band: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                starts, ends = word_spans(data, offsets)
                words = np.diff(np.searchsorted(starts, offsets))
                lower = LOWER[data]
                owner, key, weight = shingle_weights(span_hashes(lower, starts, ends), words)
                bands = band_hashes(bag_minhash(owner, key, weight, last - first, registers), rows_per_band)
                whole = lower.tobytes()
                digests = [
                    blake2b(b" ".join(whole[a:b].split()), digest_size=16).digest() if n else None
                    for a, b, n in zip(offsets[:-1], offsets[1:], words, strict=True)
                ]
                values = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)), pa.array(bands.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(digests, pa.binary()), values],
                    names=["doc_id", "digest", "bands"],
                )

    return rows.mapInArrow(sign, SIGNED)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs, from the texts themselves. A hub's shingles are kept from
    one pair to the next, apart for each of its texts if it has several."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[tuple[int, str], Counter] = OrderedDict()

        def of(name: int, text: str) -> Counter:
            key = (name, text)
            if key not in kept:
                kept[key] = shingles(text.encode())
                while len(kept) > 8:
                    kept.popitem(last=False)
            kept.move_to_end(key)
            return kept[key]

        for batch in batches:
            a, b, text_a, text_b = batch.columns
            found = [
                similarity(shingles(ta.as_py().encode()), of(y, tb.as_py()))
                for y, ta, tb in zip(b.to_pylist(), text_a, text_b, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([a, b, pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compare, "a bigint, b bigint, similarity double")


def near_duplicate_classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, registers: int = 128,
    rows_per_band: int = 4,
) -> DataFrame:
    """One row for each document: doc_id and class_id, the smallest id of the texts that
    links of similarity ``threshold`` or more connect to it.

    Words are parted by ASCII white space, A-Z in lower case. Texts with equal words are one
    class whatever their length. A null or empty text, or one of white space, is in no class
    but its own. Rows with a null id get a null class. Repeated ids are one document with
    several texts. Other columns are not read."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = scratch_dir(spark, "signatures")
    _sign(rows, registers, rows_per_band).write.parquet(path)
    signed = spark.read.parquet(path)
    distinct = signed.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands")
    )
    spread = distinct.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low < _high")
    alive = _kept(spread.join(shared.select("bucket"), "bucket", "left_semi").distinct())
    # Texts of candidates, written once: the rounds below shuffle these and not all texts.
    path = scratch_dir(spark, "candidates")
    rows.where("text IS NOT NULL").join(
        alive.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"
    ).select(F.col("doc_id").alias("node"), "text").write.parquet(path)
    texts = spark.read.parquet(path)

    # A text that meets many others comes first as a hub: the original of a group of edited copies.
    sizes = alive.groupBy("bucket").agg(F.count(F.lit(1)).alias("_size"))
    degrees = alive.join(sizes, "bucket").groupBy("node").agg(F.sum("_size").alias("degree"))
    members = alive
    alive = _kept(alive.join(degrees, "node").withColumn("label", F.col("node")))
    known = None  # every pair compared so far
    seats = None  # (node, hub, buckets) of all that met, similarity null where no link was possible
    profiles = labels = first_met = None
    hubs_per_bucket = 1
    while not alive.isEmpty():
        salt = F.pmod(F.xxhash64("node", F.lit(hubs_per_bucket)), F.lit(hubs_per_bucket))
        told = [c for c in alive.columns if c not in ("bucket", "degree")]
        first = F.min_by(F.struct(*told), F.struct(-F.col("degree"), F.xxhash64("node"), "node"))
        hubs = _kept(alive.groupBy("bucket", salt.alias("_salt")).agg(first.alias("_first")).select(
            "bucket", *(F.col(f"_first.{c}").alias("hub" if c == "node" else f"hub_{c}") for c in told)
        ))
        if profiles is None:
            present, possible = alive, F.lit(True)
        else:
            # Two hubs of a bucket meet once, not each as the other's member.
            seated = hubs.select("bucket", F.col("hub").alias("node"), F.lit(True).alias("is_hub"))
            present = _kept(alive.join(seated, ["bucket", "node"], "left").fillna(False, ["is_hub"]))
            possible = _possible(threshold) & (~F.col("is_hub") | (F.col("node") < F.col("hub")))
        here = _kept(_met(present, hubs, possible))
        pairs = here.select("a", "b").distinct()
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        fresh = _kept(_verify(pairs, texts).groupBy("a", "b").agg(F.max("similarity").alias("similarity")))
        known = fresh if known is None else known.unionByName(fresh)
        measured = _kept(here.join(known, ["a", "b"], "left").select("node", "hub", "buckets", "similarity"))
        close = measured.where(F.col("similarity") >= threshold)
        seats = measured if seats is None else seats.unionByName(measured)
        if profiles is not None:
            # Who cannot be linked to a hub may be linked to what is close to it.
            followed = hubs.join(close.select(F.explode("buckets").alias("bucket"), "hub").distinct(), ["bucket", "hub"])
            missed = _met(present, followed, ~_possible(threshold) & ~F.col("is_hub"))
            seats = seats.unionByName(_kept(missed.join(known, ["a", "b"], "left").select("node", "hub", "buckets", "similarity")))
        labels = _joined_labels(labels, fresh.where(F.col("similarity") >= threshold).select("a", "b"))
        # Hubs have met all others; members close to a hub leave too. The rest goes on.
        gone = hubs.select("bucket", F.col("hub").alias("node")).unionByName(
            close.select(F.explode("buckets").alias("bucket"), "node")
        ).distinct()
        rest = _labelled(alive.join(gone, ["bucket", "node"], "left_anti").drop("label"), labels, "node", "label")
        if profiles is None:
            apart = _labelled(_labelled(measured, labels, "node", "_x"), labels, "hub", "_y").where("_x != _y")
            unsettled = apart.select(F.explode("buckets").alias("bucket")).distinct()
            nodes = members.join(unsettled, "bucket", "left_semi").select("node").distinct()
            profiles = _profiles(texts.join(nodes, "node", "left_semi"))
            first_met = _kept(_overlaps(measured, profiles))
        alive = _kept(_crowded(rest, profiles, threshold).join(first_met, ["bucket", "node"], "left"))
        hubs_per_bucket *= 16

    if known is None:
        labels = spark.createDataFrame([], "node bigint, component bigint")
    else:
        border = _border_pairs(seats, labels, profiles, threshold).join(known, ["a", "b"], "left_anti")
        more = _verify(border.checkpoint(), texts)
        labels = _joined_labels(labels, more.where(F.col("similarity") >= threshold).select("a", "b").checkpoint())
    classes = distinct.select("digest", "node").join(labels, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class_id")
    )
    return signed.select("doc_id", "digest").join(classes, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def keep_one_of_class(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns. Rows
    with a null id stay; of rows with one id and one text one stays."""
    classes = near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **settings)
    drop = classes.where("class_id != doc_id").select(F.col("doc_id").alias("_drop")).distinct()
    kept = docs.join(drop, F.col(id_col).cast("bigint") == F.col("_drop"), "left_anti")
    return kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col]).unionByName(
        kept.where(F.col(id_col).isNull())
    )


def _met(members: DataFrame, hubs: DataFrame, which: Column) -> DataFrame:
    """Members and hubs of their buckets, apart so far, that ``which`` admits. A row of two texts has a
    bucket for each band at most. The condition belongs to the join itself, so that only pairs worth a row leave it."""
    met = members.join(hubs, "bucket").where((F.col("node") != F.col("hub")) & (F.col("label") != F.col("hub_label")) & which)
    return met.groupBy("node", "hub").agg(F.collect_set("bucket").alias("buckets")).select(
        "node", "hub", "buckets", F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    )


def _kept(df: DataFrame) -> DataFrame:
    """Written to the shared folder, and read by as many tasks as its rows need. For ids and numbers."""
    df = df.checkpoint()
    return in_tasks(df, df.count())


def _profiles(texts: DataFrame) -> DataFrame:
    """(node, n, own): shingles of each text, and those that no other of the texts has. Equal
    shingles of one text count apart. A node of several texts has none of its own."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                starts, ends = word_spans(data, offsets)
                words = np.diff(np.searchsorted(starts, offsets))
                owner, key, weight = shingle_weights(span_hashes(LOWER[data], starts, ends), words)
                again = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                tokens = mix(np.repeat(key, weight) + again.astype(np.uint64) * _A).view(np.int64)
                edges = np.append(0, np.cumsum(np.bincount(owner, weight, last - first).astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(tokens))],
                    names=["node", "tokens"],
                )

    tokens = texts.select("node", "text").mapInArrow(spread, "node bigint, tokens array<bigint>").checkpoint()
    own = tokens.select("node", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("node")
    ).where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    sizes = tokens.groupBy("node").agg(F.max(F.size("tokens")).alias("n"), F.count(F.lit(1)).alias("_texts"))
    return _kept(sizes.join(own, "node", "left").select(
        "node", "n", F.when(F.col("_texts") == 1, F.coalesce("own", F.lit(0))).otherwise(0).alias("own"),
        (F.col("_texts") == 1).alias("single"),
    ))


def _joined_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components with further links: what is known stands as one link for each node."""
    if labels is None:
        return connected_components(links)
    if links.isEmpty():
        return labels
    return connected_components(links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _labelled(df: DataFrame, labels: DataFrame, node: str, into: str) -> DataFrame:
    """The component of each node, itself if it has no link."""
    names = labels.select(F.col("node").alias(node), F.col("component").alias(into))
    return df.join(names, node, "left").withColumn(into, F.coalesce(into, node))


def _profiled(df: DataFrame, profiles: DataFrame, node: str, prefix: str) -> DataFrame:
    numbers = [F.col(c).alias(f"{prefix}_{c}") for c in ("n", "own", "single")]
    return df.join(profiles.select(F.col("node").alias(node), *numbers), node)


def _reaches(shared: Column, x: str, y: str, threshold: float) -> Column:
    """Whether two texts that share so many shingles at most can have the similarity."""
    enough = shared >= threshold * (F.col(f"{x}_n") + F.col(f"{y}_n") - shared) - 1e-6
    return enough | ~(F.col(f"{x}_single") & F.col(f"{y}_single"))


def _overlaps(measured: DataFrame, profiles: DataFrame) -> DataFrame:
    """(bucket, node, met): the shingles that a member shares with the first hub of its bucket, where
    both are one text. That hub is the same for all members that go on."""
    both = _profiled(_profiled(measured.where("similarity IS NOT NULL"), profiles, "node", "x"), profiles, "hub", "hub")
    shared = F.round(F.col("similarity") / (1 + F.col("similarity")) * (F.col("x_n") + F.col("hub_n")))
    return both.where("x_single AND hub_single").select(F.explode("buckets").alias("bucket"), "node", shared.alias("met"))


def _possible(threshold: float) -> Column:
    """Whether a member and a hub can be linked: they share no more than what both have in common
    with others, nor more than the first hub of the bucket has of both and what both have outside of it."""
    rest, hub_rest = F.col("x_n") - F.col("x_own"), F.col("hub_x_n") - F.col("hub_x_own")
    outside = F.greatest(F.least(rest - F.col("met"), hub_rest - F.col("hub_met")), F.lit(0))
    met = F.least("met", "hub_met") + outside
    known = F.col("met").isNotNull() & F.col("hub_met").isNotNull()
    shared = F.least(rest, hub_rest, F.when(known, met))  # a null counts for nothing
    enough = shared >= threshold * (F.col("x_n") + F.col("hub_x_n") - shared) - 1e-6
    return enough | ~(F.col("x_single") & F.col("hub_x_single"))


def _crowded(rest: DataFrame, profiles: DataFrame, threshold: float) -> DataFrame:
    """Members that can still be linked to a member of another component in their bucket."""

    def mixed(df: DataFrame) -> DataFrame:
        seen = df.groupBy("bucket").agg(
            F.min("label").alias("_low"), F.max("label").alias("_high"), F.min("x_n").alias("_least")
        ).where("_low < _high")
        return df.join(seen.select("bucket", "_least"), "bucket")

    left = F.col("x_n") - F.col("x_own")
    possible = left >= threshold * (F.col("x_n") + F.greatest("_least", left) - left) - 1e-6
    rest = rest.select("bucket", "node", "degree", "label")
    found = mixed(_profiled(rest, profiles, "node", "x")).where(possible | ~F.col("x_single")).drop("_least")
    return mixed(found).select("bucket", "node", "degree", "label", "x_n", "x_own", "x_single")


def _border_pairs(seats: DataFrame, labels: DataFrame, profiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one bucket that no hub has decided: not linked by now, and not too far apart, by
    the triangle inequality of the distance 1 - similarity or by what they can share: what both
    share with the hub, and outside of it what is not their own."""
    reach = 1 - threshold

    def described(df: DataFrame, node: str) -> DataFrame:
        full = _profiled(_labelled(df, labels, node, f"{node}_label"), profiles, node, node)
        total = F.col(f"{node}_n") + F.col("hub_n")
        known = F.col("hub_single") & F.col(f"{node}_single") & F.col("similarity").isNotNull()
        with_hub = F.when(known, F.round(F.col("similarity") / (1 + F.col("similarity")) * total))
        return full.withColumn(f"{node}_hub", F.coalesce(with_hub, F.lit(0)))

    seats = _labelled(_profiled(seats, profiles, "hub", "hub"), labels, "hub", "hub_label")
    close = F.coalesce(F.col("similarity") >= threshold, F.lit(False))
    open_ = described(
        seats.where(~close & F.coalesce(F.col("similarity") >= threshold - reach, F.lit(True))).withColumnRenamed("node", "x"), "x"
    ).where("x_label != hub_label").select("buckets", "hub", "x", "x_label", "x_n", "x_own", "x_single", "x_hub", (1 - F.col("similarity")).alias("far"))
    near = described(
        seats.where(close).join(open_.select("hub").distinct(), "hub", "left_semi").withColumnRenamed("node", "y"), "y"
    ).select(F.col("buckets").alias("_buckets"), F.col("hub").alias("_hub"), "y", "y_label", "y_n", "y_own", "y_single", "y_hub", (1 - F.col("similarity")).alias("close"))
    outside = [F.greatest(F.col(f"{c}_n") - F.col(f"{c}_own") - F.col(f"{c}_hub"), F.lit(0)) for c in ("x", "y")]
    # Where an overlap with the hub is not known, all that is not a text's own may be outside.
    inside = F.when((F.col("x_hub") > 0) & (F.col("y_hub") > 0), F.least("x_hub", "y_hub"))
    shared = F.least(
        F.col("x_n") - F.col("x_own"), F.col("y_n") - F.col("y_own"),
        F.coalesce(inside + F.least(*outside), F.col("x_n").cast("double")),
    )
    # All conditions belong to the join itself, so that only pairs worth comparing leave it.
    both = open_.join(near, (
        (F.col("hub") == F.col("_hub")) & (F.col("x_label") != F.col("y_label")) & F.arrays_overlap("buckets", "_buckets")
        & F.coalesce(F.col("far") - F.col("close") <= reach + 1e-9, F.lit(True)) & _reaches(shared, "x", "y", threshold)
    ))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
