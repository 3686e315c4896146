"""Best-fit packing of documents into sequences, with a bounded number of open bins.

Each partition packs its own documents as they come.  A piece goes to the open
bin with the least free space that holds it; a bitset whose bit f stands for
an open bin with f tokens free finds it in one step.  If none holds it, a bin is
opened, and if too many are open the fullest closes first.  The documents of one
Arrow batch are offered longest first.  No shuffle; memory is one batch of
texts and `OPEN_BINS` bins.

Null text: empty, a piece of the end id alone.  Repeated rows are packed one by
one.  Empty table: no rows.  A text of any length is cut into pieces; only
documents longer than a sequence are cut.  Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from gramloom.llm.wordids import encoder

SEQUENCE = 2048
END = 0
OPEN_BINS = 1 << 16
SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
_ROWS = 1 << 16


class OpenBins:
    """Bins that still take pieces; `take` gives a piece its bin and place."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.with_free: dict[int, list[int]] = defaultdict(list)
        self.bits = 0
        self.open = 0
        self.made = 0

    def _pop(self, free: int) -> int:
        bins = self.with_free[free]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def _push(self, free: int, number: int) -> None:
        if self.open == self.most:
            self._pop((self.bits & -self.bits).bit_length() - 1)
        self.with_free[free].append(number)
        self.bits |= 1 << free
        self.open += 1

    def take(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._pop(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        if free > length:
            self._push(free - length, number)
        return number, self.capacity - free


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int, most: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    bins = OpenBins(capacity, most)
    first = TaskContext.get().partitionId() << 40
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        pieces = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
            raw = np.append(ids, np.uint32(end)).astype("<u4").tobytes()
            total = len(raw) // 4
            for piece, start in enumerate(range(0, total, capacity)):
                part = raw[4 * start : 4 * (start + capacity)]
                pieces.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
        pieces.sort(key=lambda p: -p[3])
        for piece in pieces:
            number, offset = bins.take(piece[3])
            rows.append((*piece, first + number, offset))
            if len(rows) == _ROWS:
                yield out()
                rows.clear()
    if rows:
        yield out()


def pack(docs: DataFrame, path: str, capacity: int = SEQUENCE, end: int = END, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: its document and place there, and its sequence and place there."""
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return texts.mapInArrow(lambda batches: _pack(batches, path, capacity, end, open_bins), SCHEMA)
