import io
import urllib.request

import pyarrow as pa
import pyarrow.fs as pafs
import pytest

from pagemill.sources import files
from pagemill.sources.archive_fixture import batch_rows, copy_start
from pagemill.sources.archive_reader import read_range
from pagemill.sources.fetch import copy_file
from tests.archives import members, page, put, response


def test_local_uris():
    assert files.local_path("/a/b") == files.local_path("file:/a/b") == files.local_path("file:///a/b") == "/a/b"
    assert files.local_path("s3a://b/c") is None


def test_listing(tmp_path):
    put(tmp_path, "b", b"22")
    put(tmp_path, "a", b"1")
    put(tmp_path, ".hidden", b"x")
    (tmp_path / "dir").mkdir()
    assert files.list_files(str(tmp_path)) == [(str(tmp_path / "a"), 1), (str(tmp_path / "b"), 2)]
    assert files.list_files(str(tmp_path / "a")) == [(str(tmp_path / "a"), 1)]
    with pytest.raises(FileNotFoundError):
        files.list_files(str(tmp_path / "none"))


def test_other_file_systems(tmp_path, monkeypatch):
    """Any URI with a scheme goes through pyarrow; here one that stands for a local folder."""
    data = members(*(response(page(i)) for i in range(20)))
    put(tmp_path / "in", "a.gz", data)
    (tmp_path / "x").mkdir()
    local = pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem())
    monkeypatch.setattr(files, "_remote", lambda uri: (local, uri.split("://", 1)[1]))
    assert files.list_files("mem://in") == [("mem://in/a.gz", len(data))]
    assert files.size_text("mem://in/a.gz") == str(len(data))
    with files.open_input("mem://in/a.gz") as raw:
        rows = list(read_range(raw, 0, None, True)) + list(read_range(raw, 1000, 2000, True))
    assert len(rows) > 21
    assert copy_file("mem://in/a.gz", "mem://x/out.gz", "1") == len(data)
    assert (tmp_path / "x" / "out.gz").read_bytes() == data
    for call in (files.open_input, files.size_text):
        with pytest.raises(FileNotFoundError):
            call("mem://none")


class _Answer(io.BytesIO):
    headers = {"Content-Length": "7"}


def test_http(tmp_path, monkeypatch):
    seen = []

    def urlopen(request, timeout):
        method = request.get_method() if hasattr(request, "get_method") else "GET"
        seen.append((method, timeout))
        return _Answer(b"content")

    monkeypatch.setattr(urllib.request, "urlopen", urlopen)
    assert files.size_text("https://x.example/a") == "7"
    assert copy_file("https://x.example/a", str(tmp_path / "a"), "1") == 7
    assert (tmp_path / "a").read_bytes() == b"content"
    assert seen == [("HEAD", 20), ("GET", 300)]


def test_a_short_answer_is_no_copy(tmp_path, monkeypatch):
    monkeypatch.setattr("pagemill.sources.fetch.open_input", lambda url: _Answer(b"cont"))
    with pytest.raises(OSError, match="4 of 7"):
        copy_file("https://x.example/a", str(tmp_path / "a"), "1")
    assert not list(tmp_path.iterdir())


def test_a_failed_copy_leaves_nothing(tmp_path, monkeypatch):
    class Broken(io.BytesIO):
        def read(self, size=-1):
            if self.tell():
                raise OSError("connection lost")
            return super().read(3)

    monkeypatch.setattr("pagemill.sources.fetch.open_input", lambda url: Broken(b"content"))
    put(tmp_path, "a", b"older copy")
    with pytest.raises(OSError):
        copy_file("x://a", str(tmp_path / "a"), "1")
    assert [p.name for p in tmp_path.iterdir()] == ["a"]
    assert (tmp_path / "a").read_bytes() == b"older copy"


class _Chunks(io.BytesIO):
    def read(self, size=-1):
        assert 0 < size <= 1 << 20, "a file must not be read whole"
        return super().read(size)


@pytest.mark.parametrize("missing", [0, 40, (1 << 20) + 3])
def test_cut_copies_hold_a_chunk(missing):
    data = bytes(range(256)) * 12_001
    sink = io.BytesIO()
    copy_start(_Chunks(data), sink, missing)
    assert sink.getvalue() == data[: len(data) - missing]


def test_few_rows_of_a_batch_are_objects_at_once():
    batch = pa.RecordBatch.from_pydict({"payload": ["x" * 1000] * 500, "n": list(range(500))})
    taken = []

    class Slices:
        nbytes = batch.nbytes

        def __len__(self):
            return len(batch)

        def slice(self, at, step):
            taken.append(min(step, len(batch) - at))
            return batch.slice(at, step)

    rows = list(batch_rows(Slices(), at_once=50_000))
    assert rows == batch.to_pylist() and max(taken) <= 50
