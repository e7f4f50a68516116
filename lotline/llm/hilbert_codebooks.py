"""Product codes of vectors: exact integer codebooks learned over Hilbert-sorted flat blocks.

Vectors become integers and are cut into ``PARTS`` equal parts. Each task takes its vectors in
chunks; for every part position it sorts the chunk's points along a Hilbert curve and keeps them as
flat blocks of ``BLOCK`` points, each with the box around it (min, max) and the sum of its points.
Neighbours on the curve are neighbours in space, so boxes are small.

A round compares boxes with codebook entries first. An entry whose least distance to a box is more
than some other entry's greatest distance to it is nearest to none of the block's points, and
neither is one that the whole box is farther from than from the best entry; the rest is the block's
shortlist. A block with one entry on its list goes to it as a whole, with its stored
sum. The others are compared point by point with their short lists, all blocks with lists of one
length together, in the smallest integer type that holds every distance. Ties go to the lower
index, as the lists are ascending. Sums and counts add up over tasks to PARTS * ENTRIES rows, the
only thing the driver sees; the chunks are written once and never shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors of a chunk, points of a block, and dimensions that the curve runs through.
CHUNK, BLOCK, CURVE_DIMS = 16_384, 32, 16
#: Components beyond this (after scaling) are refused: distances might not fit 64 bits.
LARGEST = 1 << 27


# --- the curve -----------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (integers of ``bits`` bits a dimension)."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(dims):
            turned = (x[i] & top) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    return key


def curve_order(points: np.ndarray) -> np.ndarray:
    """Rows of ``points`` in the order of the curve through their box."""
    spread = points[:, :CURVE_DIMS].astype(np.int64)
    bits = max(1, min(8, 63 // max(1, spread.shape[1])))
    low = spread.min(axis=0)
    width = np.maximum(spread.max(axis=0) - low + 1, 1)
    return np.argsort(hilbert_keys(((spread - low) << bits) // width, bits), kind="stable")


# --- blocks --------------------------------------------------------------------------------------


def narrow(dims: int, largest: int) -> np.dtype:
    """The smallest integer type for points that leaves room for squared distances of a part."""
    return np.dtype(np.int32 if (2 * largest + 2) ** 2 * dims < 1 << 31 else np.int64)


class Blocks:
    """The points of one part of a chunk in curve order, padded to whole blocks."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray, n: int):
        self.points, self.low, self.high, self.sums, self.n = points, low, high, sums, n
        self.counts = np.full(len(points), BLOCK, np.int64)
        self.counts[-1] = n - BLOCK * (len(points) - 1)

    @classmethod
    def of(cls, points: np.ndarray) -> Blocks:
        n, dims = points.shape
        blocks = -(-n // BLOCK)
        padded = np.concatenate([points, np.repeat(points[-1:], blocks * BLOCK - n, axis=0)])
        padded = padded.reshape(blocks, BLOCK, dims)
        sums = padded.sum(axis=1, dtype=np.int64)
        sums[-1] -= (blocks * BLOCK - n) * points[-1].astype(np.int64)
        return cls(padded, padded.min(axis=1), padded.max(axis=1), sums, n)

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """For each block, which entries may be nearest to one of its points."""
        low, high, entries = self.low.astype(np.int64), self.high.astype(np.int64), book.astype(np.int64)
        least = np.zeros((len(self.points), len(book)), np.int64)
        most = np.zeros_like(least)
        for d in range(book.shape[1]):
            below, above = low[:, d, None] - entries[:, d], entries[:, d] - high[:, d, None]
            least += np.maximum(np.maximum(below, above), 0) ** 2
            most += np.maximum(np.abs(below), np.abs(above)) ** 2
        short = least <= most.min(axis=1, keepdims=True)
        # An entry is out as well if all of the box is nearer to the entry of least greatest distance:
        # the difference of the two squared distances is linear, so its greatest value is at a corner.
        best = entries[most.argmin(axis=1)]
        worst = ((best * best).sum(axis=1))[:, None] - (entries * entries).sum(axis=1)
        for d in range(book.shape[1]):
            slope = 2 * (entries[:, d] - best[:, d, None])
            worst += np.maximum(low[:, d, None] * slope, high[:, d, None] * slope)
        return short & (worst >= 0)

    def nearest(self, book: np.ndarray, rows: np.ndarray, short: np.ndarray):
        """Index and distance of the nearest entry for the points of blocks with lists of one length."""
        lists = np.nonzero(short)[1].reshape(len(rows), -1)
        points, gap = self.points[rows], None
        entries = book.astype(points.dtype)[lists]
        for d in range(book.shape[1]):
            off = points[:, :, d, None] - entries[:, None, :, d]
            gap = off * off if gap is None else gap + off * off
        best = gap.argmin(axis=2)
        return np.take_along_axis(lists, best, axis=1), np.take_along_axis(gap, best[:, :, None], axis=2)[:, :, 0]

    def by_length(self, book: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks grouped by the length of their shortlists, a bounded number at a time."""
        short = self.shortlists(book)
        length = short.sum(axis=1)
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                yield int(n), part, short[part]

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and sum of points that each entry is nearest to."""
        counts = np.zeros(len(book), np.int64)
        sums = np.zeros(book.shape, np.int64)
        for n, rows, short in self.by_length(book):
            if n == 1:
                entry = short.argmax(axis=1)
                np.add.at(counts, entry, self.counts[rows])
                np.add.at(sums, entry, self.sums[rows])
                continue
            code, _ = self.nearest(book, rows, short)
            real = np.arange(BLOCK) < self.counts[rows, None]
            code, points = code[real], self.points[rows][real]
            counts += np.bincount(code, minlength=len(book))
            for d in range(book.shape[1]):  # below 2^53, so exact
                sums[:, d] += np.bincount(code, points[:, d], len(book)).astype(np.int64)
        return counts, sums

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point, in curve order."""
        code = np.empty(self.points.shape[:2], np.uint8)
        gap = np.empty(self.points.shape[:2], np.int64)
        for _, rows, short in self.by_length(book):
            code[rows], gap[rows] = self.nearest(book, rows, short)
        return code.reshape(-1)[: self.n], gap.reshape(-1)[: self.n]


# --- chunks --------------------------------------------------------------------------------------

_BLOCKS = {"type": pa.string(), "size": pa.int64()} | {
    name: pa.binary() for name in ("places", "points", "low", "high", "sums")
}


def _integers(vectors: pa.Array) -> np.ndarray:
    """The scaled components, one row a vector."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != lengths[0]).any() or lengths[0] % PARTS or not lengths[0]:
        raise ValueError(f"vectors must have one length, a multiple of {PARTS}; found {sorted(set(lengths.tolist()))[:5]}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / SCALE}")
    return scaled.astype(np.int64).reshape(len(vectors), -1)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            head = batch.slice(0, CHUNK - rows)
            held.append(head)
            rows += head.num_rows
            batch = batch.slice(head.num_rows)
            if rows == CHUNK:
                yield _chunk(held)
                held, rows = [], 0
    if held:
        yield _chunk(held)


def _chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    values = _integers(table.column("embedding").combine_chunks())
    n, dims = len(values), values.shape[1] // PARTS
    kind = narrow(dims, int(np.abs(values).max()))
    columns: dict[str, list[bytes]] = {name: [] for name in ("places", "points", "low", "high", "sums")}
    for part in range(PARTS):
        points = values[:, part * dims : (part + 1) * dims]
        order = curve_order(points)
        blocks = Blocks.of(points[order].astype(kind))
        columns["places"].append(order.astype(np.uint16).tobytes())
        for name in ("points", "low", "high", "sums"):
            columns[name].append(getattr(blocks, name).tobytes())
    ends = pa.array([0, n], pa.int32())
    rows = [pa.ListArray.from_arrays(ends, table.column(c).combine_chunks()) for c in ("vec_id", "label")]
    own = [pa.array([kind.name]), pa.array([n], pa.int64())]
    own += [pa.array([b"".join(x)], pa.binary()) for x in columns.values()]
    return pa.RecordBatch.from_arrays([*rows, *own], names=["vec_id", "label", *_BLOCKS])


def parts_of(chunk: dict, dims: int) -> Iterator[tuple[np.ndarray, Blocks]]:
    """The places and blocks of each part of a staged chunk."""
    n, kind = chunk["size"], np.dtype(chunk["type"])
    blocks = -(-n // BLOCK)
    places = np.frombuffer(chunk["places"], np.uint16).reshape(PARTS, n)
    points = np.frombuffer(chunk["points"], kind).reshape(PARTS, blocks, BLOCK, dims)
    low, high = (np.frombuffer(chunk[c], kind).reshape(PARTS, blocks, dims) for c in ("low", "high"))
    sums = np.frombuffer(chunk["sums"], np.int64).reshape(PARTS, blocks, dims)
    for p in range(PARTS):
        yield places[p], Blocks(points[p], low[p], high[p], sums[p], n)


def _total(books: np.ndarray):
    """Sums of a round over one task: part, entry, position (-1: the count), total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, entries, dims = books.shape
        totals = np.zeros((PARTS, entries, dims + 1), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = {c: batch.column(c)[i].as_py() for c in _BLOCKS}
                for p, (_, blocks) in enumerate(parts_of(chunk, dims)):
                    counts, sums = blocks.totals(books[p])
                    totals[p, :, 0] += counts
                    totals[p, :, 1:] += sums
        part, entry, place = (x.reshape(-1) for x in np.indices(totals.shape))
        used = totals.reshape(-1) != 0
        columns = [part[used], entry[used], place[used] - 1, totals.reshape(-1)[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "place", "total"])

    return run


def _code(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = books.shape[2]
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = {c: batch.column(c)[i].as_py() for c in _BLOCKS}
                codes = np.empty((chunk["size"], PARTS), np.uint8)
                error = np.zeros(chunk["size"], np.int64)
                for p, (places, blocks) in enumerate(parts_of(chunk, dims)):
                    code, gap = blocks.codes(books[p])
                    codes[places, p] = code
                    error[places] += gap
                text = np.frombuffer(codes.tobytes().hex().encode(), f"S{2 * PARTS}").astype(str)
                rows = [batch.column(c).slice(i, 1).flatten() for c in ("vec_id", "label")]
                columns = [*rows, pa.array(text, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


# --- all together --------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector holds finite numbers only."""
    finite = "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')"
    return vectors.select("vec_id", "label", "embedding").where(f"embedding IS NOT NULL AND forall(embedding, {finite})")


def first_books(kept: DataFrame) -> np.ndarray | None:
    """(part, entry, position): the parts of the rows with the smallest vec_ids; None without rows."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES)
    rows = [r["embedding"] for r in first.collect()]  # ENTRIES rows at most
    if not rows:
        return None
    values = _integers(pa.array(rows, pa.list_(pa.float64())))
    return np.ascontiguousarray(values.reshape(len(rows), PARTS, -1).transpose(1, 0, 2))


def next_books(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floor of the mean of its points; unused ones stay."""
    sums = chunks.mapInArrow(_total(books), "part long, entry long, place long, total long")
    totals = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
        totals[r["part"], r["entry"], r["place"] + 1] = r["total"]
    counts = totals[:, :, :1]
    return np.where(counts > 0, totals[:, :, 1:] // np.maximum(counts, 1), books)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """Codes (vec_id, label, code, error) of the usable rows of ``vectors``, and the codebooks.

    ``vectors`` has vec_id, embedding and label; other columns are left out. Rows whose vector is
    null or holds null, NaN or infinite components go. Components are scaled by 256 and rounded
    down. Codebooks start as the parts of the 64 smallest vec_ids (fewer rows: fewer entries; null
    ids come last, repeated ids in the order of their vectors). Every usable row is coded, repeated
    ones each; null ids and labels stay null. ``code`` has two hex digits a part, ``error`` is the
    squared distance to the coded vector. Vectors of different lengths, a length that is no
    multiple of 16, and components beyond half a million fail the run with a ValueError. An empty
    table gives no rows and no codebooks.
    """
    kept = usable(vectors)
    schema = StructType([*kept.select("vec_id", "label").schema.fields]).add("code", "string").add("error", "long")
    books = first_books(kept)
    if books is None:
        return kept.sparkSession.createDataFrame([], schema), None
    kinds = {"type": StringType(), "size": LongType()}
    stored = StructType()
    for field in kept.select("vec_id", "label").schema:
        stored = stored.add(field.name, ArrayType(field.dataType))
    for name in _BLOCKS:
        stored = stored.add(name, kinds.get(name, "binary"))
    chunks = staged(kept.mapInArrow(_chunked, stored), "vector-chunks")
    for _ in range(rounds):
        books = next_books(chunks, books)
    return staged(chunks.mapInArrow(_code(books), schema), "vector-codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the error summed over equal labels, nulls together."""
    sums = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
