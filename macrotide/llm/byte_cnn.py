"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

Bytes become small vectors; filters of ``width`` bytes slide over overlapping chunks that
together cover the whole text. Each filter is max-pooled within a chunk, and the mean and the
maximum over the chunks are combined into one probability.

The network is trained in one task, on a bounded sample of labelled rows (``TrainingBounds``). Scoring is
one map over all texts; the weights, a few thousand numbers, travel with the task.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import text_bytes

PIECES = 16  # of a long text in the sample


@dataclass(frozen=True)
class TrainingBounds:
    """The sample: rows of each label, in hash order; of a text with more than so many bytes,
    ``PIECES`` pieces that add up to them. A step of the training looks at so many chunks of a
    text, drawn anew in each epoch."""

    rows_per_label: int = 1500
    text_bytes: int = 1 << 16
    chunks: int = 8
    epochs: int = 10


@dataclass
class ByteCnn:
    """Weights, and the shape of the network. Byte 0 also stands for padding."""

    chunk: int = 512
    step: int = 384
    width: int = 8
    stride: int = 2
    depth: int = 8
    filters: int = 32
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int = 7) -> ByteCnn:
        rng = np.random.default_rng(seed)
        self.weights = {
            "bytes": rng.normal(0, 0.5, (256, self.depth)), "filters": rng.normal(0, 0.18, (self.width * self.depth, self.filters)),
            "bias": np.zeros(self.filters), "out": rng.normal(0, 0.1, 2 * self.filters), "prior": np.zeros(1),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        return self

    def chunks_of(self, length: int) -> np.ndarray:
        """Starts of the chunks that cover a text."""
        return np.arange(0, max(1, length - (self.chunk - self.step)), self.step)

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For chunks of bytes: each filter's largest value, and the position that has it."""
        w = self.weights
        vectors = w["bytes"][chunks].reshape(len(chunks), -1)
        n = (self.chunk - self.width) // self.stride + 1
        seen = np.lib.stride_tricks.sliding_window_view(vectors, self.width * self.depth, axis=1)[:, :: self.stride * self.depth]
        values = np.ascontiguousarray(seen).reshape(-1, self.width * self.depth) @ w["filters"]
        values = values.reshape(len(chunks), n, self.filters)
        best = values.argmax(axis=1)
        top = np.take_along_axis(values, best[:, None], axis=1)[:, 0] + w["bias"]
        return np.maximum(top, 0), best

    def logits(self, top: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One number for each text; ``first`` is where each text's chunks begin."""
        counts = np.diff(np.append(first, len(top)))[:, None]
        whole = np.hstack([np.add.reduceat(top, first) / counts, np.maximum.reduceat(top, first)])
        return whole @ self.weights["out"] + self.weights["prior"]

    def cut(self, data: np.ndarray, begin: int, end: int, starts: np.ndarray) -> np.ndarray:
        """Chunks of the text at ``data[begin:end]``, padded with zeros."""
        reach = int(starts[-1]) + self.chunk
        text = np.zeros(reach, np.uint8)
        text[: min(end - begin, reach)] = data[begin : min(end, begin + reach)]
        return np.lib.stride_tricks.sliding_window_view(text, self.chunk)[starts]

    def scores(self, data: np.ndarray, offsets: np.ndarray, at_once: int = 512) -> np.ndarray:
        """Probabilities of whole texts. Chunks are worked through ``at_once``, so memory does
        not follow the length of a text."""
        found, waiting, owners = [], [], []
        tops, firsts, held = [], [], 0

        def flush() -> None:
            nonlocal waiting, held
            if waiting:
                tops.append(self.pooled(np.concatenate(waiting))[0])
                waiting, held = [], 0

        total = 0
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            starts = self.chunks_of(b - a)
            firsts.append(total)
            total += len(starts)
            for k in range(0, len(starts), at_once):
                part = starts[k : k + at_once]
                waiting.append(self.cut(data, a + int(part[0]), b, part - part[0]))
                held += len(part)
                if held >= at_once:
                    flush()
        flush()
        logits = self.logits(np.concatenate(tops), np.array(firsts))
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    def train(self, texts: list[bytes], labels: np.ndarray, bounds: TrainingBounds, odds: float, seed: int = 11) -> ByteCnn:
        """Fit by Adam on the log loss. ``odds``: of label 1 in all labelled rows; the sample
        is balanced, so the constant term is moved to them at the end."""
        rng = np.random.default_rng(seed)
        w = self.start().weights
        first_moment = {k: np.zeros_like(v) for k, v in w.items()}
        second_moment = {k: np.zeros_like(v) for k, v in w.items()}
        step, batch = 0, 64
        total = bounds.epochs * -(-len(texts) // batch)
        for _ in range(bounds.epochs):
            order = rng.permutation(len(texts))
            for k in range(0, len(order), batch):
                chosen = order[k : k + batch]
                parts = []
                for i in chosen:
                    starts = self.chunks_of(len(texts[i]))
                    if len(starts) > bounds.chunks:
                        starts = np.sort(rng.choice(starts, bounds.chunks, replace=False))
                    parts.append(self.cut(np.frombuffer(texts[i], np.uint8), 0, len(texts[i]), starts))
                gradient = self._gradient(parts, labels[chosen])
                step += 1
                rate = 0.01 * (1 - 0.95 * step / total)
                for name, g in gradient.items():
                    first_moment[name] += 0.1 * (g - first_moment[name])
                    second_moment[name] += 0.01 * (g * g - second_moment[name])
                    scale = np.sqrt(second_moment[name] / (1 - 0.99**step)) + 1e-8
                    w[name] -= (rate * first_moment[name] / (1 - 0.9**step) / scale).astype(np.float32)
        w["prior"] += np.float32(np.log(odds) - np.log(labels.mean() / (1 - labels.mean())))
        return self

    def _gradient(self, parts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, len(parts)
        chunks = np.concatenate(parts)
        counts = np.array([len(p) for p in parts])
        first = np.append(0, np.cumsum(counts)[:-1])
        owner = np.repeat(np.arange(n), counts)
        top, best = self.pooled(chunks)
        mean = np.add.reduceat(top, first) / counts[:, None]
        largest = np.maximum.reduceat(top, first)
        error = (1 / (1 + np.exp(-(np.hstack([mean, largest]) @ w["out"] + w["prior"]))) - labels) / n
        back = error[:, None] * w["out"]
        flow = (back[:, : self.filters] / counts[:, None])[owner]
        flow = (flow + back[:, self.filters :][owner] * (top == largest[owner])) * (top > 0)
        # Only the byte window with the largest value of a filter has a gradient.
        places = best[:, :, None] * self.stride + np.arange(self.width)
        window = chunks[np.arange(len(chunks))[:, None, None], places]
        inputs = w["bytes"][window].reshape(len(chunks), self.filters, -1)
        to_bytes = flow[:, :, None] * w["filters"].T[None]
        bytes_gradient = np.zeros_like(w["bytes"])
        np.add.at(bytes_gradient, window.ravel(), to_bytes.reshape(-1, self.depth).astype(np.float32))
        return {
            "bytes": bytes_gradient, "filters": np.einsum("cf,cfi->if", flow, inputs), "bias": flow.sum(axis=0),
            "out": error @ np.hstack([mean, largest]) + 1e-4 * w["out"], "prior": error.sum(keepdims=True),
        }


def held_out(id_col: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _sampled_bytes(row_id: Column, text: Column, limit: int) -> Column:
    """A text of up to ``limit`` bytes; of a longer one a piece from each of its ``PIECES``
    parts, at a place that a hash of the id draws."""
    data, size = text.cast("binary"), F.octet_length(text)
    length, part = max(1, limit // PIECES), F.floor(size / PIECES)
    room = F.greatest(part - length + 1, F.lit(1))
    pieces = [
        F.substring(data, (part * k + F.pmod(F.xxhash64(row_id, F.lit(k)), room) + 1).cast("int"), F.lit(length)) for k in range(PIECES)
    ]
    return F.when(size <= limit, data).otherwise(F.concat(*pieces))


def train_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
    label_col: str = "quality", bounds: TrainingBounds = TrainingBounds(),
) -> ByteCnn | float:
    """The fitted network. If the labels have one value only, the constant probability
    that they give, and 0.5 without any label.

    Rows with a null label or id are not learned from. The sample has the first rows of each
    label in the order of a hash of the id, whatever their length; texts longer than
    ``bounds.text_bytes`` are sampled in pieces."""
    known = labels.select(
        F.col(label_id).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("_label")
    ).where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")
    )
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}  # two rows
    samples = []
    for label in (0, 1):
        # The hash order is taken on ids alone; texts are fetched for the chosen few only.
        ids = known.where(F.col("_label") == label).select("_id").join(
            rows.select("_id"), "_id", "left_semi"
        ).distinct().orderBy(F.xxhash64("_id")).limit(bounds.rows_per_label)
        found = rows.join(F.broadcast(ids), "_id", "left_semi").select(
            F.lit(label).alias("_label"), "_id", _sampled_bytes(F.col("_id"), F.col("_text"), bounds.text_bytes).alias("_bytes")
        )
        samples.append(found.limit(4 * bounds.rows_per_label))
    fitted = _fit(samples[0].unionByName(samples[1]), bounds, totals[1] / totals[0] if len(totals) == 2 else 1.0)
    if isinstance(fitted, ByteCnn):
        return fitted
    return 0.5 if not totals else float(not fitted[0])


def _fit(sample: DataFrame, bounds: TrainingBounds, odds: float) -> ByteCnn | tuple[int, int]:
    """The network trained on a sample (_label, _id, _bytes), or, where a label has no row in it, the rows of each label.
    One task trains, and the driver gets the weights only: of the sample it holds nothing."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        y = np.array([label for label, _, _ in rows], np.float32)
        n_ones, weights = int(y.sum()), io.BytesIO()
        if 0 < n_ones < len(rows):
            np.savez(weights, **ByteCnn().train([text for _, _, text in rows], y, bounds, odds).weights)
        yield pa.RecordBatch.from_pydict({"zeros": [len(rows) - n_ones], "ones": [n_ones], "weights": [weights.getvalue()]})

    found = sample.repartition(1).mapInArrow(fit, "zeros bigint, ones bigint, weights binary").first()
    if found is None or not found.weights:
        return (found.zeros, found.ones) if found else (0, 0)
    with np.load(io.BytesIO(found.weights)) as weights:
        return ByteCnn(weights={name: weights[name] for name in weights.files})


def quality_score(model: ByteCnn | float, text: Column) -> Column:
    """Probability of label 1 for a whole text; null counts as empty."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if isinstance(model, float) or not len(texts):
            return pa.array(np.full(len(texts), model if isinstance(model, float) else 0.0))
        return pa.array(model.scores(*text_bytes(texts)))

    return score(text.cast("string"))


def score_quality(
    docs: DataFrame, model: ByteCnn | float, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score and predicted for every whole text.

    A null or empty text is scored as one chunk of padding. Repeated rows and null ids are
    scored like others; columns beside the two named ones are not read."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
        quality_score(model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(
    docs: DataFrame, model: ByteCnn | float, *, text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""
    return docs.where(quality_score(model, F.col(text_col)) >= threshold)
