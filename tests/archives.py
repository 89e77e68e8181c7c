"""Archive bytes for tests."""

import gzip
import os

from pagemill.sources.archive_fixture import http_block, warc_record

HTML = {"Content-Type": "text/html"}


def page(i: int, words: int = 40) -> bytes:
    return f"<html><body><article>page {i} {'word ' * words}</article></body></html>".encode()


def response(body: bytes, headers: dict = HTML, uri: str = "http://x.example/") -> bytes:
    return warc_record("response", uri, http_block(headers, body), "application/http; msgtype=response")


def warcinfo() -> bytes:
    return warc_record("warcinfo", "", b"software: test\r\n", "application/warc-fields")


def members(*records: bytes, level: int = 6) -> bytes:
    return b"".join(gzip.compress(r, level) for r in records)


def nested_archive(rows: int = 40) -> bytes:
    """A record whose payload is itself an archive, stored so that its members show."""
    inner = members(*(response(page(1000 + i)) for i in range(rows)))
    return gzip.compress(response(inner, {"Content-Type": "application/octet-stream"}), 0)


def put(folder, name: str, data: bytes) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(str(folder), name)
    with open(path, "wb") as f:
        f.write(data)
    return path
