"""Records of one byte range of a WARC or ARC archive (helper that runs inside tasks)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from pagemill.functions.html import decode_page

CHUNK = 128 * 1024
MAX_PAYLOAD_BYTES = (1 << 31) - (1 << 20)  # what a binary value of Arrow and Spark can hold
_INFLATE_STEP = 1024 * 1024
_MAX_LINE = 1024 * 1024

# Fixed values of the two archive formats and of gzip.
_GZIP_MAGIC = b"\x1f\x8b\x08"
_WARC_START = b"WARC/"
_ARC_LINE = re.compile(rb"\S+ \S+ \d{14} \S+ (?:\S+ )*\d+\s*\Z")
_ARC_START = re.compile(rb"[a-z][a-z0-9+.-]*:\S* \S+ \d{14} \S+ (?:\S+ )*\d+\r?\n")
_WARC_SYNC = re.compile(rb"\r\n\r\n(WARC/\d+\.\d+\r\n)")
_HTTP_TYPES = ("response", "request", "revisit")


class ArchiveError(Exception):
    """The archive, or a record in it, cannot be read."""


class _Stream:
    """Forward reader that knows which gzip member (or byte) it stands at."""

    def __init__(self, raw: BinaryIO, start: int, gzipped: bool):
        raw.seek(start)
        self.raw, self.gzipped = raw, gzipped
        self.offset = start  # file offset of the next byte to decompress
        self.tail = b""  # bytes read from the file, not yet decompressed
        self.inflate = None
        self.member = start
        self.buffer, self.at = b"", 0

    def fill(self) -> bool:
        """Make bytes available; they always come from a single member."""
        while self.at >= len(self.buffer):
            if not self.gzipped:
                self.offset += len(self.buffer)
                self.buffer, self.at = self.raw.read(CHUNK), 0
                if not self.buffer:
                    return False
                continue
            if self.inflate is None:
                while len(self.tail) < len(_GZIP_MAGIC):
                    more = self.raw.read(CHUNK)
                    if not more:
                        break
                    self.tail += more
                if not self.tail:
                    return False
                if not self.tail.startswith(_GZIP_MAGIC):
                    raise ArchiveError(f"no gzip member at byte {self.offset}")
                self.inflate = zlib.decompressobj(31)
                self.member = self.offset
            data = self.tail or self.raw.read(CHUNK)
            try:
                out = self.inflate.decompress(data, _INFLATE_STEP)
            except zlib.error as e:
                raise ArchiveError(f"gzip member at byte {self.member}: {e}") from None
            if self.inflate.eof:
                rest = self.inflate.unused_data
                self.inflate = None
            else:
                rest = self.inflate.unconsumed_tail
                if not data and not out:
                    raise ArchiveError(f"gzip member at byte {self.member} is truncated")
            self.offset += len(data) - len(rest)
            self.tail = rest
            self.buffer, self.at = out, 0
        return True

    def position(self) -> int:
        return self.member if self.gzipped else self.offset + self.at

    def read(self, size: int) -> bytes:
        parts = []
        while size and self.fill():
            part = self.buffer[self.at : self.at + size]
            self.at += len(part)
            size -= len(part)
            parts.append(part)
        if size:
            raise ArchiveError("archive ends inside a record")
        return b"".join(parts)

    def skip(self, size: int) -> None:
        while size and self.fill():
            step = min(size, len(self.buffer) - self.at)
            self.at += step
            size -= step
        if size:
            raise ArchiveError("archive ends inside a record")

    def header_line(self, limit: int | None) -> bytes:
        """A line of a header block that ends within `limit` bytes; too long a line is an error."""
        line = self.line(_MAX_LINE if limit is None else min(_MAX_LINE, limit))
        if len(line) == _MAX_LINE and not line.endswith(b"\n"):
            raise ArchiveError(f"header line of more than {_MAX_LINE} bytes at byte {self.position()}")
        return line

    def line(self, limit: int = _MAX_LINE) -> bytes:
        """Up to and including the next newline; at most `limit` bytes."""
        parts, left = [], limit
        while left and self.fill():
            end = self.buffer.find(b"\n", self.at, self.at + left)
            stop = end + 1 if end >= 0 else min(len(self.buffer), self.at + left)
            parts.append(self.buffer[self.at : stop])
            left -= stop - self.at
            self.at = stop
            if end >= 0:
                break
        return b"".join(parts)


def _header_block(stream: _Stream, limit: int | None) -> tuple[dict[str, str], int]:
    """Header fields up to the blank line (first value of a name wins) and bytes used."""
    fields: dict[str, str] = {}
    used, last = 0, None
    while limit is None or used < limit:
        line = stream.header_line(None if limit is None else limit - used)
        used += len(line)
        text = line.strip(b"\r\n")
        if not text:
            break
        if text[:1] in b" \t" and last is not None:
            fields[last] += " " + decode_page(text.strip())
            continue
        name, colon, value = decode_page(text).partition(":")
        last = None
        if colon and name.strip().lower() not in fields:
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields, used


def _record_start(stream: _Stream) -> bool:
    """Move past blank lines to the next record; False at the end of the archive."""
    while stream.fill():
        if stream.buffer[stream.at] not in b"\r\n":
            return True
        stream.at += 1
    return False


def _dechunk(body: bytes) -> bytes:
    """Undo chunked transfer coding; a body that is not really chunked stays as it is."""
    parts, at = [], 0
    while at < len(body):
        end = body.find(b"\n", at)
        size_text = body[at : end if end >= 0 else len(body)].split(b";")[0].strip()
        if end < 0 or not re.fullmatch(rb"[0-9a-fA-F]+", size_text):
            return body if not parts else b"".join(parts)
        size = int(size_text, 16)
        if size == 0:
            break
        parts.append(body[end + 1 : end + 1 + size])
        at = end + 1 + size
        if body[at : at + 2] == b"\r\n":
            at += 2
        elif body[at : at + 1] == b"\n":
            at += 1
    return b"".join(parts)


def _inflate_body(body: bytes, bits: int, limit: int) -> bytes:
    """Decompress all members; a body that does not start like compressed data stays as it is.

    Of a body that is cut off or damaged further on, what can be read counts.
    """
    parts, rest, left = [], body, limit
    while rest:
        inflate = zlib.decompressobj(bits)
        try:
            parts.append(inflate.decompress(rest, left + 1))
        except zlib.error:
            if parts:
                break
            if bits == 15:  # "deflate" is also used for raw deflate streams
                return _inflate_body(body, -15, limit)
            return body
        left -= len(parts[-1])
        if left < 0:
            raise ArchiveError(f"payload larger than {limit} bytes")
        rest = inflate.unused_data if inflate.eof else b""
    return b"".join(parts)


def _payload(body: bytes, http: dict[str, str], limit: int) -> bytes:
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = _dechunk(body)
    encoding = http.get("content-encoding", "").lower().strip()
    if encoding in ("gzip", "x-gzip"):
        return _inflate_body(body, 31, limit)
    if encoding == "deflate":
        return _inflate_body(body, 15, limit)
    if encoding == "br":
        try:
            import brotli
        except ImportError:
            raise ArchiveError("payload is br-encoded and no decoder is installed") from None
        try:
            body = brotli.decompress(body)
        except brotli.error as e:
            raise ArchiveError(f"br payload: {e}") from None
        if len(body) > limit:
            raise ArchiveError(f"payload larger than {limit} bytes")
    return body


def is_html_response(rec_type: str, http: dict[str, str] | None) -> bool:
    return (
        rec_type in ("response", "resource")
        and http is not None
        and "html" in http.get("content-type", "")
    )


def is_gzip(raw: BinaryIO) -> bool:
    raw.seek(0)
    return raw.read(len(_GZIP_MAGIC)) == _GZIP_MAGIC


def first_member(raw: BinaryIO, start: int, end: int, gzipped: bool) -> int | None:
    """First place in [start, end) that looks like the start of a record, or None.

    A look-alike inside a payload is possible, so callers compare this with
    where the range before it really ended.
    """
    overlap = 4 if not gzipped else 0
    at = max(start - overlap, 0)
    raw.seek(at)
    window = raw.read(CHUNK)
    while window and at < end:
        if gzipped:
            hit = window.find(_GZIP_MAGIC)
            while hit >= 0 and at + hit < end:
                if len(window) - hit < 4096:
                    window += raw.read(CHUNK)
                try:
                    head = zlib.decompressobj(31).decompress(window[hit : hit + 65536], 2048)
                except zlib.error:
                    head = b""
                if head.startswith(_WARC_START) or _ARC_START.match(head):
                    return at + hit
                hit = window.find(_GZIP_MAGIC, hit + 1)
            keep = len(_GZIP_MAGIC) - 1
        else:
            for match in _WARC_SYNC.finditer(window):
                if start <= at + match.start(1) < end:
                    return at + match.start(1)
            keep = 32
        more = raw.read(CHUNK)
        if not more:
            return None
        drop = max(len(window) - keep, 0)
        window = window[drop:] + more
        at += drop
    return None


def read_range(
    raw: BinaryIO, start: int, end: int | None, html_only: bool, with_payload: bool = True,
    max_payload: int = MAX_PAYLOAD_BYTES,
) -> Iterator[tuple]:
    """Rows of the records that start in [start, end); end None means to the end.

    Yields ("record", offset, type, content type, http headers, payload,
    number, at) and at last ("split", first offset, next offset), with None for a range without
    records and for the end of the archive.
    """
    gzipped = is_gzip(raw)
    first = 0
    if start > 0:
        first = first_member(raw, start, end, gzipped)
        if first is None:
            yield "split", None, None
            return
    stream = _Stream(raw, first, gzipped)
    member, ordinal = None, 0
    while _record_start(stream):
        place = stream.position()
        if end is not None and place >= end:
            yield "split", first, place
            return
        ordinal = ordinal + 1 if gzipped and place == member else 0
        member = place
        at = stream.offset if ordinal else place  # compressed bytes read so far; never goes back
        line = stream.line()
        if line.startswith(_WARC_START):
            warc, _ = _header_block(stream, None)
            rec_type = warc.get("warc-type", "").lower()
            length = warc.get("content-length", "")
            has_http = rec_type in _HTTP_TYPES or warc.get("content-type", "").startswith(
                "application/http"
            )
        elif _ARC_LINE.match(line):
            fields = decode_page(line).split()
            length = fields[-1]
            header = fields[0].startswith("filedesc:")
            rec_type = "warcinfo" if header else "response"
            has_http = fields[0].startswith(("http:", "https:"))
        else:
            raise ArchiveError(f"no record header at byte {place}")
        if not re.fullmatch(r"[0-9]{1,18}", length):
            raise ArchiveError(f"record without a length at byte {place}")
        left = int(length)
        http, head = None, b""
        if has_http and left:
            head = stream.line(min(left, _MAX_LINE))
            left -= len(head)
            if head.startswith(b"HTTP/") or rec_type == "request":
                http, used = _header_block(stream, left)
                left -= used
        if html_only and not is_html_response(rec_type, http):
            stream.skip(left)
            continue
        payload = None
        if with_payload:
            if left > max_payload:
                raise ArchiveError(f"payload of {left} bytes at byte {place}")
            payload = stream.read(left)
            if http is not None:
                payload = _payload(payload, http, max_payload)
            else:
                payload = head + payload  # not an HTTP message after all
        else:
            stream.skip(left)
        content_type = http.get("content-type") if http is not None else None
        yield "record", place, rec_type, content_type, http, payload, ordinal, at
    yield "split", first, None
