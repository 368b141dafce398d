"""Token counts: batch encoding inside Arrow functions that return lengths only.

Arrow batches are cut into parts balanced by bytes (`batch_bytes`). Each text is split at safe boundaries: a
single space between two characters that are no space; runs of spaces stay within a segment. The vocabulary is checked once for pieces that
would cross such a boundary, so the count of a text is the sum over its segments. Equal segments of a batch
are encoded once; frequent ones stay in a bounded cache of the worker.

Defined cases: null text counts as empty (0 bytes, 0 tokens); special strings inside texts are ordinary
text, as the library has it by default; the library's own space mark counts as a space that is no boundary. A text
without a safe boundary is encoded whole. Repeated rows are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import slices, text_buffer

SPACE_MARK = "▁"
BOUNDARY = re.compile(f"(?<=[^ {SPACE_MARK}]) (?=[^ {SPACE_MARK}])")


class SegmentCounter:
    """Counts of whole texts by a sentencepiece model."""

    _open: dict[str, SegmentCounter] = {}

    def __init__(self, model: str, cache_entries: int) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        self.splits = all(set(p) == {SPACE_MARK} or SPACE_MARK not in p[1:] for p in pieces) and self._adds_up()
        self.known: dict[str, int] = {}
        self.cache_entries = cache_entries

    def _adds_up(self) -> bool:
        """The model keeps spaces as they are and puts one in front of a text."""
        whole = self.model.encode("a b  c ", out_type=str)
        return "".join(whole) == f"{SPACE_MARK}a{SPACE_MARK}b{SPACE_MARK * 2}c{SPACE_MARK}"

    @classmethod
    def of(cls, model: str, cache_entries: int) -> SegmentCounter:
        if model not in cls._open:
            cls._open[model] = cls(model, cache_entries)
        return cls._open[model]

    def count(self, texts: list[str]) -> list[int]:
        split: list[list[str]] = []
        for t in texts:
            parts = t.split(" ") if self.splits else [t]
            # empty parts: runs of spaces, or spaces at an end
            split.append(BOUNDARY.split(t) if self.splits and (SPACE_MARK in t or len(parts) > 1 and not all(parts)) else parts)
        known = self.known
        wanted = set().union(*split)
        new = list(wanted.difference(known))
        if len(known) + len(new) > self.cache_entries:
            known = self.known = {w: known[w] for w in wanted if w in known}
        if new:
            known.update(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True))
        get = known.__getitem__
        out = [sum(map(get, parts)) for parts in split]
        for t in new:
            if len(t) > 64:  # whole texts and other rare segments
                del known[t]
        return out


def count_tokens(
    df: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    batch_bytes: int = 1 << 20,
    cache_entries: int = 400_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row. `model`: path of the sentencepiece model on every machine.

    Spark ends an Arrow batch after 64 MB (`spark.sql.execution.arrow.maxBytesPerBatch`) or at the text that passes it;
    within a batch, `batch_bytes` are encoded at once.
    """
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(f"{id_col}_text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = SegmentCounter.of(model, cache_entries)
        for b in batches:
            _, bounds = text_buffer(b.column(1))
            for start, stop in slices(bounds, batch_bytes):
                tokens = np.array(counter.count(b.column(1).slice(start, stop - start).to_pylist()), dtype="i8")
                columns = [b.column(0).slice(start, stop - start), pa.array(np.diff(bounds[start : stop + 1])), pa.array(tokens), pa.array(tokens > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(counted, schema)
