"""Token counts: pieces are counted once for each distinct pre-token.

A pre-token is a run of spaces with the word after it. No piece of the vocabulary has a
space after another character (checked when the model is loaded), so no merge crosses
from one pre-token to the next and a text has as many tokens as its pre-tokens together.

Each task keeps the piece counts of the distinct pre-tokens it has met and joins them to
the pre-token frequencies of each text; only the products are summed and no ids are kept.
Distinct pre-tokens are taken per task, not over the whole input: frequencies of all texts
would be as large as the texts and would have to be shuffled, while the counts of a task
fit in a table of ``max_known`` entries, which starts anew when it is full.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import text_blocks

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

# A space is written as this sign inside the vocabulary, and the sign itself is read as a space.
SPACE_SIGN = "▁"
PRE_TOKEN = re.compile(r" +[^ ]*")


class PieceCounter:
    """Pieces of each pre-token, counted once while the table has room."""

    def __init__(self, model_path: str, max_known: int) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        crossing = [
            piece for i in range(self.model.get_piece_size())
            if SPACE_SIGN in (piece := self.model.id_to_piece(i)).lstrip(SPACE_SIGN)
        ]
        if crossing:
            raise ValueError(f"pieces cross pre-tokens, so they cannot be counted apart: {crossing[:3]}")
        self.known: dict[str, int] = {}
        self.max_known = max_known

    def _count(self, pre_tokens: list[str]) -> None:
        if len(self.known) + len(pre_tokens) > self.max_known:
            self.known = {}
        # The model puts a space in front, so one is taken off; a lone space is one piece.
        found = self.model.encode([p[1:] for p in pre_tokens], num_threads=1)
        self.known.update((p, len(ids) if p != " " else 1) for p, ids in zip(pre_tokens, found, strict=True))

    def count(self, text: str) -> int:
        if not text:
            return 0
        frequency = Counter(PRE_TOKEN.findall(" " + text.replace(SPACE_SIGN, " ")))
        missing = [p for p in frequency if p not in self.known]
        if missing:
            self._count(missing)
        if len(self.known) < len(frequency):  # the table began anew for this text
            self._count([p for p in frequency if p not in self.known])
        known = self.known
        return sum(n * known[p] for p, n in frequency.items())


def token_counts(
    docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
    max_known: int = 400_000,
) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has over ``limit`` tokens.

    A null text is empty and has no tokens. One row for each input row, repeated rows and
    null ids included; other columns are not read. ``model_path`` must exist on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path, max_known)
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                whole = data.tobytes()
                tokens = np.array(
                    [counter.count(whole[a:b].decode()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(offsets)), pa.array(tokens),
                     pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(count, SCHEMA)
