"""WARC bundles: exact round trip, revisits, seek tables and random access."""

from __future__ import annotations

import base64
import hashlib
import io

import zstandard

from opinara.llm.warc import fetch, frames_of, read_frames, seek_table, write_bundles

ROWS = [
    (1, "http://a/\r\nx", "same", 5), (2, None, "same", 5), (3, "u", "same", 5), (3, "u", "same", 5), (4, "u", None, 5), (5, "u", "", 5),
    (6, "u", "é" * 100_000, 5), (7, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", 5), (None, "u", "lone", 5), (None, "u", "same", 5),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int")


def test_round_trip_and_revisits(spark):
    index = write_bundles(frame(spark), frame_bytes=600)
    got = read_frames(frames_of(spark, index)).collect()
    assert len(got) == len(ROWS)
    largest = {"same": 3, "": 5}
    want = []
    for page, url, html, _ in ROWS:
        text = html or ""
        refers = largest.get(text) if largest.get(text) != page else None
        raw = text.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        fixed = url and url.replace("\r", "%0D").replace("\n", "%0A")
        want.append((page, fixed, "revisit" if refers else "response", refers, len(raw), digest, b"" if refers else raw))
    key = lambda r: str(r)
    assert sorted([(r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in got], key=key) == sorted(want, key=key)
    assert all(r.verified for r in got if r.record_type == "response")


def test_frames_are_independent_and_index_points_into_them(spark):
    index = write_bundles(frame(spark), frame_bytes=600).collect()
    for bundle in {r.bundle for r in index}:
        data = open(bundle.removeprefix("file:"), "rb").read()
        assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        table = seek_table(bundle)
        for r in (r for r in index if r.bundle == bundle):
            start, packed, size = table[r.frame]
            assert (start, packed) == (r.frame_start, r.frame_bytes)
            raw = zstandard.ZstdDecompressor().decompress(data[start : start + packed])
            assert len(raw) == size and raw[r.start : r.start + r.length].startswith(b"WARC/1.1\r\n")


def test_small_payloads_are_all_responses(spark):
    got = read_frames(frames_of(spark, write_bundles(frame(spark), min_bytes=5))).collect()
    assert all(r.record_type == "response" for r in got)


def test_random_access_reads_only_its_frames(spark):
    index = write_bundles(frame(spark), frame_bytes=1)
    got = fetch(index, spark.createDataFrame([(6,), (6,), (99,)], "page_id long")).collect()
    assert [r.page_id for r in got] == [6] and bytes(got[0].payload) == ("é" * 100_000).encode()


def test_empty_table(spark):
    assert read_frames(frames_of(spark, write_bundles(frame(spark).limit(0)))).count() == 0
