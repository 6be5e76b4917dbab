from __future__ import annotations

import hashlib

import pytest
import zstandard
from pyarrow import fs

from tablecheck.llm import warc
from tablecheck.llm.common import staged


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "gleich " * 100 + "</p>"
    rows = [(i, f"http://a.example/{i}", big) for i in (7, 3, 9)]
    rows += [(20, None, None), (21, "http://b.example/\r\nX: y%", ""), (22, "u", "kurz"), (23, "u", "kurz")]
    rows += [(3, "again", big), (None, "no key", big), (30, "long", "é" * 400_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS record_id", "'y' AS payload_digest", "1 AS first_id"
    )


@pytest.fixture(scope="module")
def archive(spark, pages, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    planned = warc.plan_records(pages, "page_id", "url", "html")
    index = staged(warc.write_bundles(planned, folder, frame_bytes=300, bundle_bytes=4_000))
    return folder, index


def test_reads_back_what_was_written(archive, pages):
    folder, index = archive
    records = warc.read_bundles(index.select("bundle").distinct(), folder).collect()
    assert len(records) == pages.count()
    by_id = {}
    for x in records:
        by_id.setdefault(x.record_id, []).append(x)
    big = by_id[3][0]
    assert [x.record_type for x in by_id[3]] == ["response", "response"]
    for other in (7, 9, None):
        (x,) = by_id[other]
        assert (x.record_type, x.refers_to, x.payload) == ("revisit", 3, None)
        assert (x.payload_digest, x.payload_bytes) == (big.payload_digest, big.payload_bytes)
    assert [by_id[i][0].record_type for i in (20, 21, 22, 23)] == ["response"] * 4
    assert by_id[20][0].payload == b"" and by_id[20][0].target_uri is None
    assert by_id[21][0].target_uri == "http://b.example/\r\nX: y%"
    assert bytes(by_id[30][0].payload) == ("é" * 400_000).encode()
    for x in records:
        if x.payload is not None:
            assert hashlib.sha256(x.payload).hexdigest() == x.payload_digest


def test_frames_are_independent_and_in_the_seek_table(archive):
    folder, index = archive
    rows = index.collect()
    assert len({(x.bundle, x.frame) for x in rows}) > 3
    for row in rows:
        with fs.LocalFileSystem().open_input_file(f"{folder}/{row.bundle}") as stream:
            sizes = warc.seek_table(stream)
            assert sum(x for x, _ in sizes[: row.frame]) == row.frame_offset
            stream.seek(row.frame_offset)
            data = zstandard.ZstdDecompressor().decompress(stream.read(row.frame_bytes))
        assert len(data) == sizes[row.frame][1]
        fields, _, end = warc.parse_record(data, row.record_offset)
        assert end - row.record_offset == row.record_bytes
        assert fields["WARC-Type"] == row.record_type


def test_standard_decompression_skips_the_seek_table(archive):
    folder, index = archive
    with open(f"{folder}/{index.first().bundle}", "rb") as file:
        with zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True) as reader:
            assert reader.read().count(b"WARC/1.1\r\n") > 0


def test_fetch_by_identifier(archive):
    folder, index = archive
    found = warc.fetch_records(index.where("record_id IN (9, 30)"), folder).collect()
    assert {x.record_id: x.record_type for x in found} == {9: "revisit", 30: "response"}


def test_empty_table(spark, pages, tmp_path):
    planned = warc.plan_records(pages.limit(0), "page_id", "url", "html")
    assert warc.write_bundles(planned, str(tmp_path)).count() == 0


def test_damage_is_noticed():
    _, record = warc._record(1, "u", b"x" * 200, "0" * 64, None)
    with pytest.raises(ValueError, match="damaged"):
        warc.read_record(*warc.parse_record(record, 0)[:2])
