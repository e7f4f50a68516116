"""Web archives as Zstandard-compressed WARC: a writer, and the reader that checks them.

An archive (``.warc.zst``) starts with a skippable frame that holds its dictionary, then has one
frame per record. The writer trains each archive's dictionary from its own first records; an
archive with too little text to train on has none, and no such frame.

The reader walks the frames by their block headers, so each frame is cut out exactly, and checks:
frame sizes, one record to a frame, the version line, the needed headers, Content-Length against
the block, the closing blank lines, the HTTP length and the payload's SHA-1.

Of pages with equal payloads one is stored as a response; the others revisit it and carry no
payload. Which one is decided by a count per payload with map-side combining, joined back to the
pages; a payload that a third of all pages share sends one row per map task, and AQE splits its
side of the join.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DATE = "2026-01-01T00:00:00Z"
DICTIONARY_BYTES = 32 << 10
#: Records that an archive's dictionary is trained on, by their bytes.
SAMPLE_BYTES = 2 << 20
#: Record bytes (not compressed) after which an archive is full.
ARCHIVE_BYTES = 512 << 20
LEVEL = 3
#: Payloads of at least so many bytes may be revisited.
REVISIT_FROM = 0

RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, archive string, position long"
)


class ArchiveError(ValueError):
    """An archive that breaks its format."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -------------------------------------------------------------------------------------


def header_safe(text: str) -> str:
    """``text`` with what would end a header line percent-encoded."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    name = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    lines.append(f"WARC-Date: {DATE}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_safe(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}")
    # An extension field: a revisit has no payload to measure.
    lines.append(f"X-Payload-Length: {len(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _fields(head: bytes, first: str) -> dict[str, str]:
    try:
        lines = head.decode("utf-8").split("\r\n")
    except UnicodeDecodeError as error:
        raise ArchiveError(f"the headers are not UTF-8: {error.reason}") from error
    if lines[0] != first:
        raise ArchiveError(f"starts with {lines[0][:40]!r}, not {first!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"no header: {line[:60]!r}")
        fields[name.lower()] = value.strip()
    return fields


def _length(fields: dict[str, str], name: str) -> int:
    text = fields.get(name.lower(), "")
    if not (text.isascii() and text.isdigit()):
        raise ArchiveError(f"{name} is {text[:40]!r}")
    return int(text)


def parse_record(data: bytes) -> dict:
    """The one record that ``data`` holds; raises ArchiveError where it breaks the format."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ArchiveError("the headers do not end")
    fields = _fields(data[:end], VERSION)
    for name in NEEDED:
        if name.lower() not in fields:
            raise ArchiveError(f"no {name}")
    size, begin = _length(fields, "Content-Length"), end + 4
    if len(data) != begin + size + 4 or data[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length is {size}, the frame has {len(data) - begin - 4}")
    block = data[begin : begin + size]
    inner = block.find(b"\r\n\r\n")
    if inner < 0:
        raise ArchiveError("the HTTP headers do not end")
    http = _fields(block[:inner], "HTTP/1.1 200 OK")
    payload, stated = block[inner + 4 :], _length(fields, "X-Payload-Length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if _length(http, "Content-Length") != stated:
        raise ArchiveError("the lengths of the payload differ")
    if kind == "response":
        if len(payload) != stated:
            raise ArchiveError(f"the payload has {len(payload)} of {stated} bytes")
        if base32_sha1(payload) != digest:
            raise ArchiveError("the payload does not have its digest")
    elif kind == "revisit":
        if payload or fields.get("warc-profile") != REVISIT_PROFILE or "warc-refers-to" not in fields:
            raise ArchiveError("not a revisit of an identical payload")
    else:
        raise ArchiveError(f"WARC-Type is {kind[:40]!r}")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "payload_bytes": stated,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


# --- frames --------------------------------------------------------------------------------------


class FrameReader:
    """Cuts a stream of archive bytes into frames, holding one frame and one read at a time."""

    def __init__(self, source, read_bytes: int = 1 << 20):
        self.source, self.read_bytes = source, read_bytes
        self.buffer, self.begin, self.position = b"", 0, 0

    def _have(self, size: int) -> bool:
        """Whether ``size`` bytes follow, after reading as many as that needs."""
        missing = size - (len(self.buffer) - self.begin)
        if missing > 0:
            more = [self.buffer[self.begin :]]
            while missing > 0 and (data := self.source.read(max(missing, self.read_bytes))):
                more.append(data)
                missing -= len(data)
            self.buffer, self.begin = b"".join(more), 0
        return missing <= 0

    def _number(self, at: int, size: int) -> int:
        if not self._have(at + size):
            raise ArchiveError("the archive ends inside a frame")
        return int.from_bytes(self.buffer[self.begin + at : self.begin + at + size], "little")

    def _frame_size(self) -> int:
        magic = self._number(0, 4)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC & 0xFFFFFFF0:
            return 8 + self._number(4, 4)
        if magic != FRAME_MAGIC:
            raise ArchiveError(f"no frame starts at byte {self.position}")
        flags = self._number(4, 1)
        single = flags >> 5 & 1
        content = (1 if single else 0, 2, 4, 8)[flags >> 6]
        at = 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + content
        last = False
        while not last:
            block = self._number(at, 3)
            last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
            if kind == 3:
                raise ArchiveError("a reserved block")
            at += 3 + (1 if kind == 1 else size)
        return at + (4 if flags >> 2 & 1 else 0)

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        """Position and bytes of each frame."""
        while self._have(1):
            size = self._frame_size()
            if not self._have(size):
                raise ArchiveError("the archive ends inside a frame")
            at, frame = self.position, self.buffer[self.begin : self.begin + size]
            self.begin += size
            self.position += size
            yield at, frame


def load_dictionary(frame: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary in a leading skippable frame, which may itself be compressed."""
    content = frame[8:]
    if content[:4] == FRAME_MAGIC.to_bytes(4, "little"):
        content = zstandard.ZstdDecompressor().decompress(content)
    if content[:4] != DICTIONARY_MAGIC:
        raise ArchiveError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(content)


def read_archive(source, read_bytes: int = 1 << 20) -> Iterator[tuple[int, dict]]:
    """Position and record of each frame of an archive."""
    plain = zstandard.ZstdDecompressor()
    for at, frame in FrameReader(source, read_bytes):
        if int.from_bytes(frame[:4], "little") & 0xFFFFFFF0 == SKIPPABLE_MAGIC & 0xFFFFFFF0:
            if at == 0 and frame[:4] == SKIPPABLE_MAGIC.to_bytes(4, "little"):
                plain = zstandard.ZstdDecompressor(dict_data=load_dictionary(frame))
            continue
        try:
            stated = zstandard.frame_content_size(frame)
            data = plain.decompress(frame, allow_extra_data=False) if stated >= 0 else plain.decompressobj().decompress(frame)
        except zstandard.ZstdError as error:
            raise ArchiveError(f"byte {at}: {error}") from error
        if stated >= 0 and stated != len(data):
            raise ArchiveError(f"byte {at}: the frame has {len(data)} of {stated} bytes")
        try:
            yield at, parse_record(data)
        except ArchiveError as error:
            raise ArchiveError(f"byte {at}: {error}") from error


class ArchiveWriter:
    """One archive; the first records wait until the dictionary is trained."""

    def __init__(self, folder: str):
        self.folder, self.waiting, self.size = folder, [], 0
        self.path = self.stream = self.compressor = None
        self.records = 0

    def add(self, record: bytes) -> None:
        self.size += len(record)
        self.records += 1
        if self.compressor:
            self.stream.write(self.compressor.compress(record))
        else:
            self.waiting.append(record)
            if self.size >= SAMPLE_BYTES:
                self._start()

    def _start(self) -> None:
        self.path, self.stream = files.create(self.folder, ".warc.zst")
        options = {"level": LEVEL, "write_checksum": True}
        try:
            # Fixed parameters: one pass over the sample.
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting, k=256, d=8)
        except zstandard.ZstdError:  # too little text
            self.compressor = zstandard.ZstdCompressor(**options)
        else:
            content = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
            self.stream.write(SKIPPABLE_MAGIC.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
            self.compressor = zstandard.ZstdCompressor(dict_data=trained, **options)
        for record in self.waiting:
            self.stream.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> pa.RecordBatch:
        if not self.compressor:
            self._start()
        self.stream.close()
        return pa.RecordBatch.from_pydict({"path": [self.path], "records": pa.array([self.records], pa.int64())})


# --- Spark ---------------------------------------------------------------------------------------


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = ArchiveWriter(folder)
        for batch in batches:
            pages, urls, keepers, payloads = (batch.column(c) for c in ("page_id", "url", "keeper", "payload"))
            for i in range(batch.num_rows):
                page, keeper = pages[i].as_py(), keepers[i].as_py()
                revisit = keeper is not None and keeper != page
                archive.add(make_record(page, urls[i].as_py(), payloads[i].as_py() or b"", keeper, revisit))
                if archive.size >= archive_bytes:
                    yield archive.close()
                    archive = ArchiveWriter(folder)
        if archive.records:
            yield archive.close()

    return run


def with_keeper(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``pages`` with the payload and, of equal payloads, the largest page_id as ``keeper``.

    Payloads that nothing else equals, and those of fewer than ``revisit_from`` bytes, have no
    keeper. Payloads are compared by length and SHA-1, which a WARC revisit names as well.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keys = [F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")]
    shared = (
        pages.select("page_id", *keys)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & (F.col("size") >= revisit_from))
        .select("digest", "size", "keeper")
    )
    wide = pages.select("page_id", "url", payload.alias("payload"), *keys)
    return wide.join(shared, ["digest", "size"], "left").select("page_id", "url", "payload", "keeper")


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = REVISIT_FROM, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html); returns the manifest."""
    rows = with_keeper(pages, revisit_from)
    return files.committed(
        rows.mapInArrow(_write(folder, archive_bytes), "path string, records long"), "archives"
    )


def _read(with_payload: bool, read_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with files.open_to_read(path) as source:
                    for at, record in read_archive(source, read_bytes):
                        rows.append(record | {"archive": path, "position": at})
                        size += len(record["payload"] or b"") if with_payload else 200
                        if size >= 8 << 20:
                            yield _batch(rows, with_payload)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, with_payload)

    return run


def _batch(rows: list[dict], with_payload: bool) -> pa.RecordBatch:
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string()}
    types |= {"refers_to": pa.int64(), "url": pa.string(), "archive": pa.string(), "position": pa.int64()}
    types |= {"payload": pa.binary()} if with_payload else {}
    return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in types.items()})


def read_archives(manifest: DataFrame, with_payload: bool = False, read_bytes: int = 1 << 20) -> DataFrame:
    """The checked records of the archives that ``manifest`` (path) lists."""
    schema = RECORDS + ", payload binary" * with_payload
    return files.spread(manifest.select("path")).mapInArrow(_read(with_payload, read_bytes), schema)


def round_trip(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read the records back.

    A null html is an empty payload. Of equal payloads the row with the largest page_id is the
    response; rows that repeat that page_id are responses too. A null page_id is below all others,
    is written as such and read back as null. A null url has no target header; control characters
    and blanks in a url are percent-encoded. A payload of any length is one record, held by one task
    while it is written; other columns are left out, whatever their names. An empty table writes no
    archive and gives no rows.
    """
    folder = files.new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, revisit_from))
