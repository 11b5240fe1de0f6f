"""Archives as an exact round trip, by every reader."""

import gzip
import hashlib
import io
import zlib

import pytest

from millrace.llm import warc
from millrace.runtime import work_folder

SCHEMA = "page_id bigint, url string, html string, file string, offset int"
LONG = "<p>" + "ä" * 60


def rows():
    out = [(i, f"http://x.example/{i}?a=%20\r\nb", f"{LONG} {i % 7}") for i in range(10, 60)]
    out += [(100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (None, "u", f"{LONG} 1")]
    out += [(5, "v", f"{LONG} 3"), (200, "w", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (201, "w", "x" * 3_000_000), out[0], out[0]]
    return out


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA).repartition(4)
    first = {}
    for page, _, html in rows():
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    want = []
    for page, url, html in rows():
        data = (html or "").encode()
        other = first.get(html) if page is not None else None
        again = other is not None and page > other
        digest = hashlib.sha256(data).hexdigest()
        want.append((page, url, "revisit" if again else "response", other if again else None, len(data), digest))
    got = [tuple(r) for r in warc.archived(pages).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_members_stand_alone(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA).repartition(2)
    folder = work_folder(spark, "warc-test")
    written = warc.write_archives(pages, folder)
    index = warc.normalise(written, folder).collect()
    assert len(index) == len(rows())
    for r in index:
        system, path = warc._place(r.file)
        with system.open_input_file(path) as f:
            whole = f.read()
        assert gzip.decompress(whole)
        one = zlib.decompressobj(31)
        data = one.decompress(whole[r.offset : r.offset + r.length])
        assert one.eof and not one.unused_data and data.startswith(b"WARC/1.1\r\n")


def test_stream_of_several_members_and_broken_files():
    parts = [warc.record(i, "u", b"p" * i, "00") for i in range(5)]
    data = gzip.compress(parts[0] + parts[1]) + gzip.compress(b"".join(parts[2:]))
    found = list(warc.records_of(warc.inflated(io.BytesIO(data))))
    assert [len(p) for _, p in found] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        list(warc.records_of(iter([parts[4][:-6]])))
    with pytest.raises(ValueError):
        list(warc.records_of(iter([b"no record\r\n\r\n"])))


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
