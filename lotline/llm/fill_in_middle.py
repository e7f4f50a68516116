"""Fill-in-the-middle transformation with content-defined chunk memoization.

A document is cut twice at code points and its parts are put in another order. Where a code point
begins is found without decoding the text: a rolling hash over the last ``WINDOW`` bytes cuts the
text into chunks, and equal text gives equal chunks wherever it stands. What a chunk adds is worked
out once per content and kept in a bounded cache of the worker, looked up by the chunk's bytes
themselves, so a shared chunk is the same chunk: how many code points begin in it, whether it holds
a marker, and its first and last bytes, which tell a marker that lies across a boundary. Adding up
the counts finds the chunk that holds a cut; only that one is looked into.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotline.llm.common import worker_store
from lotline.llm.units import Memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = "1"
#: Of a hundred documents, those transformed, and of a hundred of these, those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Bytes the rolling hash sees; a chunk ends where its top bits are zero, after 2^CUT_BITS bytes on average.
WINDOW, CUT_BITS = 32, 8
#: Bytes of the longest chunk, and entries of the cache of chunks.
LONGEST, MEMO_ENTRIES = 4096, 100_000
#: Bytes hashed at once, and bytes of output in one batch.
SEGMENT, OUT_BYTES = 1 << 20, 8 << 20

_CONTINUED = bytes(range(0x80, 0xC0))


def _gear() -> np.ndarray:
    """A 32-bit number for each byte."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """For each place the hash of the ``WINDOW`` bytes that end there (fewer at the start).

    A byte's number is shifted left by one for each byte after it; spans of 1, 2, 4, ... bytes are
    put together from two of half the size.
    """
    h = gear[data]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places in ``data`` right after a window whose hash asks for a cut."""
    gear, found = _gear(), []
    for start in range(0, len(data), SEGMENT):
        before = max(0, start - WINDOW + 1)
        h = rolling_hash(data[before : start + SEGMENT], gear)[start - before :]
        found.append(np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + (start + 1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(places: np.ndarray, size: int) -> list[int]:
    """Ends of the chunks of a text of ``size`` bytes; a window must lie within the text."""
    ends = np.append(places[(places >= WINDOW) & (places < size)], size)
    if np.diff(ends, prepend=0).max() <= LONGEST:
        return ends.tolist()
    out, last = [], 0
    for end in ends.tolist():
        out += [*range(last + LONGEST, end, LONGEST), end]
        last = end
    return out


def summary(chunk: bytes) -> tuple[int, bool, bytes, bytes]:
    """Code points that begin in a chunk, whether it holds a marker, its first and last two bytes."""
    points = len(chunk.translate(None, _CONTINUED))
    return points, any(m in chunk for m in MARKERS), chunk[:2], chunk[-2:]


def place_of(chunk: bytes, count: int) -> int:
    """Where in a chunk the code point begins that ``count`` others of the chunk precede."""
    if count == 0 and chunk[0] & 0xC0 != 0x80:
        return 0
    begins = np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80
    return int(np.flatnonzero(begins)[count])


class Chunked:
    """One text as chunks with their summaries; an empty text has none."""

    def __init__(self, text: bytes, ends: list[int], memo: Memo):
        self.text = text
        self.begins = [0, *ends[:-1]][: len(ends)]
        self.chunks = [text[a:b] for a, b in zip(self.begins, ends)]
        self.known = [memo[c] for c in self.chunks]
        self.points = [0, *accumulate(k[0] for k in self.known)]
        self.n = self.points[-1]

    def marked(self) -> bool:
        """Is there a marker anywhere, also across boundaries?"""
        before = b""
        for chunk, (_, inside, head, tail) in zip(self.chunks, self.known):
            if inside or any(m in before + head for m in MARKERS):
                return True
            before = tail if len(chunk) > 1 else (before + tail)[-2:]
        return False

    def byte_of(self, point: int) -> int:
        """The byte at which code point number ``point`` begins; the end for the number of all."""
        if point == self.n:
            return len(self.text)
        at = bisect_right(self.points, point) - 1
        return self.begins[at] + place_of(self.chunks[at], point - self.points[at])


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers from the seed and the decimal doc_id (null: no digits)."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed_text(text: bytes, ends: list[int], doc_id: int | None, seed: str, memo: Memo):
    """n, form, code points of prefix and middle (null if plain), and the output."""
    parts = Chunked(text, ends, memo)
    n = parts.n
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= TRANSFORMED or parts.marked():
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = parts.byte_of(first), parts.byte_of(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        form, out = "spm", b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    else:
        form, out = "psm", b"".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])
    return n, form, first, second - first, out


_TYPES = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}


def _transform(seed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_store("fill_in_middle")
        memo = known.get(0) or known.setdefault(0, Memo(summary, MEMO_ENTRIES))
        for batch in batches:
            rows = batch.column("source_row")
            ids, texts = rows.field("doc_id").to_pylist(), rows.field("text").cast(pa.binary())
            held, out, at = 0, [], 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or b""
                ends = chunk_ends(cut_places(np.frombuffer(text, np.uint8)), len(text)) if text else []
                out.append(transformed_text(text, ends, ids[i], seed, memo))
                held += 2 * len(text)
                if held > OUT_BYTES or i == batch.num_rows - 1:
                    yield _rows(rows.slice(at, len(out)), out)
                    held, at, out = 0, i + 1, []

    return run


def _rows(source: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    *small, texts = zip(*out)
    columns = [source, *[pa.array(c, t) for c, t in zip(small, _TYPES.values())], pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["source_row", *_TYPES, "output"])


def transformed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, others) as ``source_row`` with n, form, prefix_chars,
    middle_chars and output.

    ``n`` counts code points. The cuts and the form follow from ``seed`` and doc_id alone, so
    repeated rows give the same output; a null doc_id counts as no digits. A null or empty text, and
    one that holds a marker, stays plain: its output is the text itself (null: empty). Texts of any
    length are chunked whole; a task holds one batch of rows. Columns of ``docs`` are kept inside
    ``source_row``, so their names clash with nothing. An empty table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("source_row"))
    kinds = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    schema = StructType([*rows.schema.fields])
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(_transform(seed), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.

    The parts hold no marker, so the first of each kind divides them.
    """
    body = F.substring(output, 4, 2**31 - 1)

    def divided(first: bytes):
        one = F.substring_index(body, first.decode(), 1)
        rest = F.substring(body, F.char_length(one) + 4, F.char_length(body))
        two = F.substring_index(rest, MIDDLE.decode(), 1)
        return one, two, F.substring(rest, F.char_length(two) + 4, F.char_length(rest))

    prefix, suffix, middle = divided(SUFFIX)
    suffix2, prefix2, middle2 = divided(PREFIX)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix2, middle2, suffix2))
    )
