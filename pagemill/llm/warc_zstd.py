"""Archives of WARC records compressed with Zstandard, a dictionary in front.

A file begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself compressed or not; each record is one frame of its own. The
reader takes the dictionary from there and checks every record: its version
line and required headers, that its block has the declared length and is
followed by two line ends, that a frame holds one record, and the payload's digest.

Payloads that occur more than once are stored once: the record with the smallest id is the response,
the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store
from pagemill.sources import files

# fixed values of the format
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_URI = "urn:pagemill:page:"
RECORD_DATE = "2024-01-01T00:00:00Z"  # the tables give no time of capture
ARCHIVE_BYTES = 32 << 20  # of records before compression
DICTIONARY_BYTES = 64 << 10
TRAINING_RECORDS = 256  # a dictionary is trained on the first records of its archive, so many at most
_READ = 1 << 20
_PIECE = 1 << 14  # given to the decompressor at once; what it leaves is copied
_SALTS = 16  # tasks that the rows of one payload are dealt to


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_text(value: str) -> str:
    """A value that fits on a header line."""
    return " ".join(value.split("\n")).replace("\r", " ")


def record(
    record_id: str, kind: str, uri: str | None, payload: bytes, refers_to: str | None
) -> bytes:
    """One WARC record: an HTTP response with the payload, or a revisit without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {RECORD_DATE}",
        *([f"WARC-Target-URI: {_header_text(uri)}"] if uri else []),
        *([f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"] if refers_to else []),
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading skippable frame, and its dictionary; empty where samples are too few to train."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, [s[:8192] for s in samples])
    except zstandard.ZstdError:
        return b"", None
    data = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(data).to_bytes(4, "little") + data, trained


def archive(records: list[bytes]) -> bytes:
    """The bytes of an archive."""
    step = max(1, len(records) // TRAINING_RECORDS)
    front, trained = dictionary_frame(records[::step])
    compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
    return front + b"".join(compressor.compress(r) for r in records)


@dataclass
class Record:
    offset: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    error: str | None = None

    def header(self, name: str) -> str | None:
        return self.headers.get(name.lower())


def parse(offset: int, data: bytes) -> Record:
    """A record from its frame's content, with an error if anything is not as it must be."""
    out = Record(offset)
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        out.error = "no version line"
        return out
    if not gap:
        out.error = "headers are cut off"
        return out
    name = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:  # a continued value
            out.headers[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            out.error = "a header line without a name"
            return out
        out.headers[name] = value.strip()
    missing = [h for h in REQUIRED if not out.header(h)]
    length = out.header("Content-Length") or ""
    if missing:
        out.error = f"no {missing[0]}"
    elif not (length.isascii() and length.isdigit() and len(length) < 19):
        out.error = "Content-Length is no number"
    elif int(length) + 4 != len(rest):
        out.error = f"Content-Length is {length}, the block and its end have {len(rest)} bytes"
    elif not rest.endswith(b"\r\n\r\n"):
        out.error = "no end of record"
    else:
        out.block = rest[:-4]
    return out


def payload_of(r: Record) -> bytes:
    """What follows the HTTP headers, of an HTTP message; else the block."""
    if "application/http" in (r.header("Content-Type") or ""):
        return r.block.partition(b"\r\n\r\n")[2]
    return r.block


class _Input:
    """Buffered forward reading of a stream of frames, from the beginning of one to that of the next."""

    def __init__(self, stream):
        self._stream, self._data, self._at, self._before = stream, bytearray(), 0, 0

    @property
    def offset(self) -> int:
        return self._before + self._at

    def need(self, n: int) -> bool:
        while len(self._data) - self._at < n:
            got = self._stream.read(_READ)
            if not got:
                return False
            self._data += got
        return True

    def peek(self, start: int, n: int) -> bytes:
        return bytes(self._data[self._at + start : self._at + start + n])

    def drop(self, n: int) -> None:
        self._at += n
        if self._at >= _READ:
            self._before += self._at
            del self._data[: self._at]
            self._at = 0

    def find(self, mark: bytes) -> bool:
        """Go on to the next place with the mark, if there is one."""
        while self.need(len(mark)):
            place = self._data.find(mark, self._at)
            if place >= 0:
                self.drop(place - self._at)
                return True
            self.drop(len(self._data) - self._at - len(mark) + 1)
        return False


def _frame(source: _Input, trained: zstandard.ZstdCompressionDict | None) -> tuple[bytes, int]:
    """Content and length of the frame that begins here; an error if there is no whole one."""
    unit = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
    out, used = [], 0
    while not unit.eof:
        if not source.need(used + 1):
            raise zstandard.ZstdError("the archive ends within a frame")
        given = source.peek(used, _PIECE)
        out.append(unit.decompress(given))
        used += len(given) - (len(unit.unused_data) if unit.eof else 0)
    return b"".join(out), used


def read_archive(stream) -> Iterator[Record]:
    """Records of an archive, in order. What cannot be read is a record with an error; after a
    damaged frame reading goes on at the next frame that has a faultless record."""
    source = _Input(stream)
    trained, first, lost = None, True, False
    mark = FRAME_MAGIC.to_bytes(4, "little")
    while source.need(1):
        if lost and not source.find(mark):
            return
        if not source.need(4):
            yield Record(source.offset, error="the archive ends within a frame")
            return
        magic = int.from_bytes(source.peek(0, 4), "little")
        if magic in SKIPPABLE_FRAMES:
            if not source.need(8) or not source.need(
                8 + (size := int.from_bytes(source.peek(4, 4), "little"))
            ):
                yield Record(source.offset, error="the archive ends within a skippable frame")
                lost = True
                source.drop(1)
                continue
            if magic == DICTIONARY_FRAME and first:
                content = source.peek(8, size)
                try:
                    if content[:4] == mark:
                        reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content))
                        content = reader.read()
                    trained = zstandard.ZstdCompressionDict(content)
                except zstandard.ZstdError as e:
                    yield Record(source.offset, error=f"the dictionary cannot be read: {e}")
                    return
            source.drop(8 + size)
            first = False
            continue
        first = False
        try:
            content, used = _frame(source, trained)
            found = parse(source.offset, content)
        except zstandard.ZstdError as e:
            used, found = 1, Record(source.offset, error=f"a frame cannot be read: {e}")
            if not lost:  # one record for all that is damaged in a row
                yield found
            lost = True
        else:
            if not (lost and found.error):
                yield found
                lost = False
        source.drop(used)


def _every_salt() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long")))


def _with_kinds(pages: DataFrame, smallest: int) -> DataFrame:
    """Adds payload (binary), payload_key and refers_to: the smallest page_id with the payload."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    keyed = rows.withColumn("payload_key", F.sha1("payload")).withColumn(
        "dear", F.length("payload") >= smallest
    )
    # combined before the shuffle: a payload of a third of all rows is a row a task
    least = (
        keyed.where("dear").groupBy("payload_key").agg(F.min("page_id").alias("first_id"),
                                                        F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    # full payloads are shuffled: those of a frequent one to several tasks
    joined = keyed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS))).join(
        least.withColumn("salt", _every_salt()),
        ["payload_key", "salt"],
        "left",
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def write_pages(
    pages: DataFrame,
    place: str,
    smallest_revisit: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row of pages (page_id, url, html); one row an archive: path, n_records.

    Of rows with equal payloads of at least `smallest_revisit` bytes, the one
    with the smallest page_id is the response. Rows that repeat that page_id are responses
    too, and a row without page_id revisits it, if there is a page_id at all. A null html
    is an empty payload, a null url no target. Other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flushed() -> pd.DataFrame:
            path = store.write_file(place, archive(held))
            return pd.DataFrame({"path": [path], "n_records": [len(held)]})

        uri = lambda i: f"{RECORD_URI}{i}"
        for batch in batches:
            for page, url, payload, refers in batch.itertuples(index=False):
                kind = "response" if refers is None else "revisit"
                target = None if refers is None else uri(refers)
                held.append(record(uri("none" if page is None else page), kind, url, payload, target))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    rows = _with_kinds(pages, smallest_revisit).select(
        F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string")
    )
    return store.written(rows.mapInPandas(run, "path string, n_records long"), "archives")


READ = (
    "path string, offset long, record_id string, record_type string, target string, "
    "refers_to string, payload_digest string, payload binary, error string"
)


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of the archives (a column `path`); errors are rows, not exceptions.

    A task reads an archive as a stream and holds one record at a time and a bounded batch of
    rows. The digest of a response's payload is checked; a revisit has no payload.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                with files.open_input(path) as stream:
                    for r in read_archive(stream):
                        rows.append((path, *_row(r)))
                        size += len(r.block)
                        if size >= 8 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return store.dealt(archives.select("path")).mapInPandas(run, READ)


def _row(r: Record) -> tuple:
    bare = lambda v: v.strip("<>") if v else None
    kind, error, payload = r.header("WARC-Type"), r.error, None
    digest = (r.header("WARC-Payload-Digest") or "").partition("sha1:")[2] or None
    if error is None and kind == "response":
        payload = payload_of(r)
        if digest and base32_sha1(payload) != digest.upper():
            error = "the payload has another digest"
    return (
        r.offset,
        bare(r.header("WARC-Record-ID")),
        kind,
        r.header("WARC-Target-URI"),
        bare(r.header("WARC-Refers-To")),
        digest,
        payload,
        error,
    )


def page_id(uri: Column) -> Column:
    return F.regexp_extract(uri, f"^{RECORD_URI}(-?[0-9]+)$", 1).try_cast("long")


def pages_of(records: DataFrame, archives: DataFrame | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records.

    A revisit has the size of the payload it refers to, whose digest must be its own. A record
    with an error, or an archive of `archives` (path, n_records) with another number of
    records, raises ValueError: no record is left out silently.
    """
    rows = store.written(
        records.select(
            "path",
            "offset",
            "error",
            page_id(F.col("record_id")).alias("page_id"),
            F.length("payload").cast("long").alias("own_bytes"),
            "payload_digest",
            "record_type",
            page_id(F.col("refers_to")).alias("refers_to"),
        ),
        "archive-records",
    )
    bad = rows.where("error IS NOT NULL").select("path", "offset", "error").first()
    if bad:
        raise ValueError(f"{bad.path} at {bad.offset}: {bad.error}")
    if archives is not None:
        read = rows.groupBy("path").agg(F.count("*").alias("n_read"))
        other = (
            archives.join(read, "path", "left")
            .where(F.coalesce("n_read", F.lit(0)) != F.col("n_records"))
            .first()
        )
        if other:
            raise ValueError(f"{other.path} has {other.n_read or 0} of {other.n_records} records")
    responses = (
        rows.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.first("own_bytes").alias("referred_bytes"))
        .withColumn("salt", _every_salt())
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("path", "offset"), F.lit(_SALTS)))
    return salted.join(responses, ["refers_to", "payload_digest", "salt"], "left").select(
        "page_id",
        F.coalesce("own_bytes", "referred_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
