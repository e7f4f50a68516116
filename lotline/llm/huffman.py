"""Token ids in files of canonical length-limited Huffman codes.

Steps: documents become token ids, which each task counts as it makes them; the counts are added; package-merge makes code
lengths of at most ``MAX_BITS`` bits from the counts; the documents are range-partitioned by doc_id
and each task writes its part in order. Files list the bit offset of every block of ``BLOCK`` ids,
so blocks decode independently: the reader steps through all blocks of a file together, each step
one table look-up per block.

File: magic, five little-endian 64-bit sizes (vocabulary, ids, blocks, index bytes, stream bytes),
one code length per vocabulary entry, one bit offset per block, the documents (an Arrow stream of
doc_id and n_tokens in order), the bit stream.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotline.llm import files
from lotline.llm.common import worker_store
from lotline.llm.units import ByteEncoder
from lotline.sources.staging import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"LLHUF001"
END_ID = 2
MAX_BITS = 20
BLOCK = 1024
#: Ids after which a file is full.
FILE_IDS = 8_000_000
#: Documents whose ids are counted together.
COUNTED_ROWS = 1000
#: Ids that are turned into bits together; whole blocks.
CHUNK_IDS = 256 * BLOCK


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_bits} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    leaf_first, packages = [], np.zeros(0)
    for _ in range(max_bits):
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        leaf_first.append(order < len(weights))
        both = both[order]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    need, times = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(leaf_first):
        leaves = int(is_leaf[:need].sum())
        times[:leaves] += 1
        need = 2 * (need - leaves)
    lengths[used] = times
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), as in a canonical Huffman code."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        longest = int(size[-1])
        # Left-aligned, each code starts where the one before ends.
        room = np.left_shift(np.int64(1), longest - size)
        codes[order] = ((np.cumsum(room) - room) >> (longest - size)).astype(np.uint64)
    return codes


def to_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after the other, and the bit offset of each."""
    code, size = codes[ids], lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    word, room = at >> 6, 64 - (at & 63)
    over = size - room
    fits = over <= 0
    first = np.where(
        fits, code << np.maximum(-over, 0).astype(np.uint64), code >> np.maximum(over, 0).astype(np.uint64)
    )
    words = np.zeros((int(end[-1]) + 63) // 64 + 1 if len(ids) else 0, np.uint64)
    if len(ids):
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        words[word[begin]] = np.bitwise_or.reduceat(first, begin)
        cut = np.flatnonzero(~fits)
        words[word[cut] + 1] |= code[cut] << (64 - over[cut]).astype(np.uint64)
    stream = words.astype(">u8").tobytes()
    return stream[: (int(end[-1]) + 7) // 8 if len(ids) else 0], at


class Decoder:
    """Look-up tables from the next bits to an id and the length of its code."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(1, int(lengths.max(initial=0)))
        codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        size = lengths[used].astype(np.int64)
        start = codes[used].astype(np.int64) << (self.bits - size)
        order = np.argsort(start)
        room = 1 << (self.bits - size[order])
        self.ids = np.zeros(1 << self.bits, np.int32)
        self.sizes = np.ones(1 << self.bits, np.int64)
        self.ids[: room.sum()] = np.repeat(used[order], room)
        self.sizes[: room.sum()] = np.repeat(size[order], room)

    def decode(self, stream: bytes, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
        """``n`` ids from blocks of ``block`` ids at the given bit offsets, all blocks in step."""
        if not n:
            return np.zeros(0, np.int32)
        padded = stream + bytes(8)
        window = np.ndarray((len(stream) + 5,), ">u4", padded, strides=(1,))
        out = np.empty((block, len(offsets)), np.int32)
        at, last = offsets.astype(np.int64), len(stream) + 4
        mask = (1 << self.bits) - 1
        for step in range(min(block, n)):
            word = window[np.minimum(at >> 3, last)].astype(np.int64)
            key = (word >> (32 - self.bits - (at & 7))) & mask
            out[step] = self.ids[key]
            at += self.sizes[key]
        return out.T.reshape(-1)[:n]


def byte_encoder(path: str) -> ByteEncoder:
    known = worker_store("byte_encoder")
    return known.get(path) or known.setdefault(path, ByteEncoder(path))


def _tokenize(path: str, end_id: int, vocabulary: int | None):
    names = ["doc_id", "n_tokens", "ids"] + ["counts"] * (vocabulary is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        total = np.zeros(vocabulary or 0, np.int64)
        for batch in batches:
            texts = batch.column("text")
            ids = [encoder.encode(texts[i].as_py() or "") + end for i in range(batch.num_rows)]
            sizes = [len(x) // encoder.dtype.itemsize for x in ids]
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
            if vocabulary is not None:
                # Several documents at once: the tally has an entry for every id there is.
                for begin in range(0, len(ids), COUNTED_ROWS):
                    part = np.frombuffer(b"".join(ids[begin : begin + COUNTED_ROWS]), encoder.dtype)
                    total += np.bincount(part, minlength=vocabulary)
                columns.append(pa.nulls(batch.num_rows, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        seen = np.flatnonzero(total)
        if len(seen):
            packed = np.stack([seen, total[seen]]).tobytes()
            none = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([packed], pa.binary())], names=names)

    return run


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``docs`` (doc_id, text) as little-endian ids with the end id; null texts are empty."""
    return docs.select("doc_id", "text").mapInArrow(
        _tokenize(path, end_id, None), "doc_id long, n_tokens long, ids binary"
    )


def tokenized_and_counted(docs: DataFrame, path: str, vocabulary: int, end_id: int = END_ID) -> DataFrame:
    """The rows of ``tokenized``, and one row of each task with ``counts`` alone: how often it has each id."""
    return docs.select("doc_id", "text").mapInArrow(
        _tokenize(path, end_id, vocabulary), "doc_id long, n_tokens long, ids binary, counts binary"
    )


def _width(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, from the ``counts`` of all tasks if there are any, else from the ids.

    Each task here sends one row per id that it has.
    """
    counted = "counts" in tokens.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if counted:
                for packed in batch.column(0):
                    seen, times = np.frombuffer(packed.as_py(), np.int64).reshape(2, -1)
                    total[seen] += times
                continue
            # All documents of a batch at once: the tally has an entry for every id there is.
            for ids in np.array_split(np.frombuffer(b"".join(batch.column(0).to_pylist()), _width(vocabulary)), 8):
                total += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    source = tokens.where("counts IS NOT NULL").select("counts") if counted else tokens.select("ids")
    sums = source.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for row in sums.collect():  # at most one row per vocabulary entry
        counts[row["id"]] = row["n"]
    return counts


def _write(folder: str, shared, vocabulary: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shared.value
        part, number = TaskContext.get().partitionId(), 0
        writer = _FileWriter(lengths)
        for batch in batches:
            ids = batch.column("ids")
            for i in range(batch.num_rows):
                writer.add(np.frombuffer(ids[i].as_py(), _width(vocabulary)), batch.column("doc_id")[i].as_py())
                if writer.n >= file_ids:
                    yield writer.close(folder, part, number)
                    writer, number = _FileWriter(lengths), number + 1
        if writer.sizes:
            yield writer.close(folder, part, number)

    return run


class _FileWriter:
    def __init__(self, lengths: np.ndarray):
        self.lengths, self.codes = lengths, canonical_codes(lengths)
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n = self.n_waiting = self.stream_bytes = 0
        self.stream: list[bytes] = []
        self.offsets: list[np.ndarray] = []

    def add(self, ids: np.ndarray, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.n += len(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= CHUNK_IDS:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint16)
        whole = len(ids) if all_of_it else len(ids) // BLOCK * BLOCK
        for begin in range(0, whole, CHUNK_IDS):
            bits, at = to_bits(ids[begin : min(begin + CHUNK_IDS, whole)], self.codes, self.lengths)
            self.offsets.append(at[::BLOCK] + 8 * self.stream_bytes)
            self.stream.append(bits)
            self.stream_bytes += len(bits)
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self, folder: str, part: int, number: int) -> pa.RecordBatch:
        self._flush(True)
        index = pa.RecordBatch.from_arrays(
            [pa.array(self.doc_ids, pa.int64()), pa.array(self.sizes, pa.int64())],
            names=["doc_id", "n_tokens"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as out:
            out.write_batch(index)
        table, offsets = sink.getvalue().to_pybytes(), np.concatenate(self.offsets)
        path, stream = files.create(folder, ".ids")
        with stream:
            stream.write(MAGIC)
            stream.write(
                np.array([len(self.lengths), self.n, len(offsets), len(table), self.stream_bytes], "<u8").tobytes()
            )
            for piece in (self.lengths.tobytes(), offsets.astype("<u8").tobytes(), table, *self.stream):
                stream.write(piece)
        return pa.RecordBatch.from_arrays(
            [pa.array([path]), pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([self.n], pa.int64())],
            names=["path", "part", "number", "n_ids"],
        )


def write_ids(tokens: DataFrame, folder: str, lengths: np.ndarray, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``tokenized`` rows in ascending doc_id order (null first); returns the manifest.

    The manifest has path, part, number, n_ids and ``before``, the ids of all files before.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)
    # The row number parts a doc_id that very many rows share.
    order = ["doc_id", "row_id"]
    placed = staged(tokens.withColumn("row_id", F.monotonically_increasing_id()), "token-ids") if "row_id" not in tokens.columns else tokens
    manifest = files.committed(
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(_write(folder, shared, len(lengths), file_ids), "path string, part long, number long, n_ids long"),
        "ids-manifest",
    )
    # One row per file, so this window is small.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return manifest.withColumn("before", F.sum("n_ids").over(before) - F.col("n_ids"))


def read_file(path: str) -> tuple[pa.RecordBatch, np.ndarray]:
    """The documents of a file and all its ids."""
    with files.open_to_read(path) as source:
        data = source.readall()
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError(f"{path} is not a file of token ids")
    at = len(MAGIC) + 40
    vocabulary, n, blocks, table, stream = (int(x) for x in np.frombuffer(data[at - 40 : at], "<u8"))
    if len(data) != at + vocabulary + 8 * blocks + table + stream or blocks != -(-n // BLOCK):
        raise ValueError(f"{path}: its sizes do not add up")
    lengths = np.frombuffer(data, np.uint8, vocabulary, at)
    offsets = np.frombuffer(data, "<u8", blocks, at + vocabulary)
    at += vocabulary + 8 * blocks
    with pa.ipc.open_stream(data[at : at + table]) as reader:
        index = reader.read_next_batch()
    return index, Decoder(lengths).decode(data[at + table :], offsets, n, BLOCK)


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index, ids = read_file(row["path"])
                sizes = index.column("n_tokens").to_numpy()
                ends = np.cumsum(sizes)
                plain = ids.astype("<u4")
                crcs = [zlib.crc32(plain[e - s : e].tobytes()) for e, s in zip(ends, sizes)]
                columns = {
                    "doc_id": index.column("doc_id"),
                    "start": pa.array(ends - sizes + row["before"]),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(
                        [ids[e - s : e] for e, s in zip(ends, sizes)], pa.list_(pa.int32())
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return run


def read_ids(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of the files in ``manifest``: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return files.spread(manifest.select("path", "before")).mapInArrow(_read(with_ids), schema)


def round_trip(docs: DataFrame, path: str, vocabulary: int, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text) as files of Huffman codes and read them back.

    ``path`` is a byte-level BPE file of ``vocabulary`` ids. A null or empty text is the end id
    alone; repeated rows are written each, in the order they were read; a text of any length stays in
    one file; other columns are left out, whatever their names; an empty table writes no file and
    gives no rows.
    """
    both = staged(
        tokenized_and_counted(docs, path, vocabulary, end_id).withColumn("row_id", F.monotonically_increasing_id()),
        "token-ids",
    )
    lengths = code_lengths(id_counts(both, vocabulary))
    folder = files.new_folder(docs.sparkSession, "huffman")
    return read_ids(write_ids(both.where("counts IS NULL").drop("counts"), folder, lengths))
