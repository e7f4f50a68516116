"""Packing documents into fixed-length sequences by bounded-space online best fit.

Each task takes its documents in the order they come. A fixed number of bins is open at a time;
they stand in lists by their free space, and a bitset has one bit for each free space that some
bin has. The best bin for a piece is the lowest set bit at or above its length. Where none fits, a
new bin opens, and if too many are open the fullest closes first, which is the lowest set bit of
all. A piece is written when its bin closes, so a task holds one batch and its open bins.

The bins open at the end of a task could still be joined with those of other tasks. Their pieces,
and no others, are dealt out anew to few tasks and packed again there by the same rule and with the
same number of open bins. They come in an order that is the hash of where the first pass put them,
which says nothing of their lengths. The pieces of the first pass are staged, so no text is encoded
twice.
"""

from __future__ import annotations

import sys
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import worker_store
from lotline.llm.units import WordEncoder
from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 1024
#: About how many pieces one task packs in the second pass.
AGAIN_PIECES = 100_000

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_FIRST_PIECES = _PIECES.append(pa.field("open", pa.bool_()))


class OpenBins:
    """Best fit among at most ``most`` open bins of ``capacity``."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.bits, self.open = 0, 0
        #: Bins closed since the caller last emptied the list.
        self.closed: list[int] = []
        self.by_free: list[deque[int]] = [deque() for _ in range(capacity)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.popleft()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it that a piece of ``length`` gets."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            chosen, free = self.next, self.capacity
            self.next += 1
        left = free - length
        if left:
            if self.open >= self.most:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        else:
            self.closed.append(chosen)
        return chosen, self.capacity - free


def word_encoder(path: str) -> WordEncoder:
    known = worker_store("word_encoder")
    return known.get(path) or known.setdefault(path, WordEncoder(path))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pack(path: str, capacity: int, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        # Bins of different tasks get numbers of their own.
        bins = OpenBins(capacity, most, TaskContext.get().partitionId() << 40)
        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            for i, doc_id in enumerate(ids_of):
                ids = encoder.encode(texts[i].as_py() or "") + end
                for piece, start in enumerate(range(0, len(ids) // width, capacity)):
                    part = ids[start * width : (start + capacity) * width]
                    crc = zlib.crc32(np.frombuffer(part, encoder.dtype).astype("<u4").tobytes())
                    length = len(part) // width
                    chosen, offset = bins.place(length)
                    row = (doc_id, piece, start, length, crc, chosen, offset, False)
                    waiting.setdefault(chosen, []).append(row)
            yield _batch([row for b in bins.closed for row in waiting.pop(b)], _FIRST_PIECES)
            bins.closed.clear()
        yield _batch([(*row[:-1], True) for rows in waiting.values() for row in rows], _FIRST_PIECES)

    return run


def _pack_again(capacity: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Above the numbers of the first pass.
        bins = OpenBins(capacity, most, (1 << 62) + (TaskContext.get().partitionId() << 40))
        for batch in batches:
            placed = [bins.place(length) for length in batch.column("length").to_pylist()]
            bins.closed.clear()
            for name, values in zip(("sequence_id", "offset"), zip(*placed) if placed else ((), ())):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, _PIECES.field(name), pa.array(values, pa.int64()))
            yield batch

    return run


def packed_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    most: int = OPEN_BINS,
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with the sequence and offset that each one gets.

    A document is its token ids (``path``: a vocabulary file with word ends) and then ``end_id``;
    one of more than ``capacity`` ids is cut into pieces of that length, the last may be shorter;
    very long texts are encoded whole. A null or empty text is the end id alone. Repeated rows are
    packed each; a null doc_id stays null. Other columns are left out, whatever their names. An
    empty table gives no pieces. Neither pass has more than ``most`` bins open in a task.
    """
    first = docs.select("doc_id", "text").mapInArrow(
        _pack(path, capacity, end_id, most), f"{PIECES}, open boolean"
    )
    first = staged(first, "pieces")
    left = first.where("open").drop("open")
    again = (
        left.repartition(left.count() // AGAIN_PIECES + 1)
        # A total order, so that a repeated attempt gives the same sequences.
        .sortWithinPartitions(F.xxhash64("sequence_id", "offset"), "sequence_id", "offset")
        .mapInArrow(_pack_again(capacity, most), PIECES)
    )
    return first.where("NOT open").drop("open").unionByName(again)
