"""ZIP ranges against archives of the standard library, WARC round trips, revisits."""

import hashlib
import io
import zipfile

import pytest

from firmweave.llm import warc_zip as W
from firmweave.llm.common import read_files, scratch_path


def ranges(content):
    return W.ZipRanges(lambda at, n: content[at : at + n], len(content))


@pytest.mark.parametrize("wide", [False, True])
def test_members_of_any_archive(wide, monkeypatch):
    if wide:  # the standard library then writes ZIP64 records for small archives
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    sink = io.BytesIO()
    parts = {f"d/é{i}": bytes([i]) * (i * 7) for i in range(9)}
    with zipfile.ZipFile(sink, "w") as z:
        for name, data in parts.items():
            with z.open(name, "w", force_zip64=wide) as f:
                f.write(data)
        z.writestr("packed", b"x" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 a comment that looks like an end record" + b"\0" * 40
    for content in (sink.getvalue(), b"leading bytes" * 0 + sink.getvalue()):
        z = ranges(content)
        assert set(z.members) == {*parts, "packed"}
        for name, data in parts.items():
            at = z.start_of(name)
            assert content[at : at + z.members[name].size] == data and z.members[name].packed_size == len(data)
        with pytest.raises(ValueError):
            z.start_of("packed")


def test_no_archive():
    with pytest.raises(ValueError):
        ranges(b"plain bytes")


def test_count_beyond_the_old_record():
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        for i in range(65_600):
            z.writestr(zipfile.ZipInfo(str(i)), b"")
    assert len(ranges(sink.getvalue()).members) == 65_600


ROWS = [
    (1, "http://a/x y\r\nEvil: 1", "short"), (2, None, "short"), (3, "u", None), (4, "u", "é" * 800), (9, "v", "é" * 800),
    (5, "w", "é" * 800), (7, "z", "b" * 1000), (7, "z", "b" * 1000), (6, "z", "b" * 1000), (None, "q", "b" * 1000),
    (None, None, None), (8, "", "a\r\n\r\nb" * 300), (10, "u", "c" * 999), (11, "u", "c" * 999),
]


@pytest.mark.parametrize("archive_bytes", [12_000_000, 600])
def test_round_trip(spark, archive_bytes):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, size string")
    path = scratch_path(spark, "t")
    W.write_archives(df, path, archive_bytes=archive_bytes)
    got = sorted((repr((r.page_id, r.record_type, r.refers_to, r.declared_bytes, r.declared_digest, r.payload and bytes(r.payload))) for r in W.read_archives(spark, path).collect()))
    expected = []
    for page_id, _, html in ROWS:
        data = (html or "").encode()
        same = [i for i, _, h in ROWS if (h or "") == (html or "") and i is not None]
        n = sum((h or "") == (html or "") for _, _, h in ROWS)
        revisit = len(data) >= 1000 and n > 1 and page_id != max(same)
        expected.append(repr((page_id, "revisit" if revisit else "response", max(same) if revisit else None, len(data), hashlib.sha1(data).hexdigest(), None if revisit else data)))
    # an empty payload comes back as empty bytes
    assert [g.replace("b''", "None") for g in got] == [e.replace("b''", "None") for e in sorted(expected)]
    urls = {r.page_id: r.url for r in W.read_archives(spark, path).collect()}
    assert urls[1] == "http://a/x%20y%0D%0AEvil:%201" and urls[2] is None


def test_the_files_are_plain_zip_archives(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    path = scratch_path(spark, "t")
    W.write_archives(df, path)
    n = 0
    for r in read_files(spark, path).collect():
        with zipfile.ZipFile(io.BytesIO(bytes(r.content))) as z:
            assert z.testzip() is None and z.comment == b"\n"
            n += len(z.read(W.INDEX_MEMBER).splitlines())
    assert n == len(ROWS)


def test_no_rows(spark):
    path = scratch_path(spark, "t")
    W.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert W.read_archives(spark, path).count() == 0
