"""WARC round trip, chunked reading and revisits."""

import base64
import hashlib
import io
import zlib

import pytest

from strata.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, first string"
BIG = "é<p>" * 900
ROWS = [(3, "http://a/ö b", BIG), (1, None, BIG), (2, "u\r\nInjected: x", "small"), (4, "u", None), (5, "u", ""),
        (6, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", BIG), (None, "u", "only"), (7, "u", "small"), (7, "u", "small")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    df = spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA).repartition(3)
    manifest, root = warc.write_archives(spark, df, min_revisit_bytes=least, file_bytes=500)
    chunks = warc.read_chunks(spark, manifest, root, chunk_bytes=64)
    got = warc.records(chunks).collect()
    assert len(got) == len(ROWS)
    first = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        f = first.get(h or "") if i is not None else None
        revisit = f is not None and f != i
        want.append((None if i is None else str(i), len((h or "").encode()), digest(h),
                     "revisit" if revisit else "response", str(f) if revisit else None))
    assert sorted(((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) \
        == sorted(want, key=str)
    rows = [r for r in chunks.collect() if r.record_type == "response"]
    for key in {(r.file, r.record) for r in rows}:
        mine = sorted((r for r in rows if (r.file, r.record) == key), key=lambda r: r.chunk)
        assert [r.chunk for r in mine] == list(range(len(mine)))
        sha = hashlib.sha1()
        for r in mine:
            sha.update(r.data)
            assert len(r.data) <= 64 and r.digest_so_far == warc.bare_digest(sha.digest())
    urls = {r.record_id: r.url for r in got}
    assert urls["3"] == "http://a/ö b" and urls["1"] == "about:blank" and urls["2"] == "u\r\nInjected: x"


def test_urls_come_back_unchanged_and_record_ids_are_unique():
    urls = ["http://a/b%20c", "http://a/b c", "http://a/ö", "http://a/%zz", "a:%", "x'y", "%C3%A4 ä", "http://a/?q=1&r=%2F#f"]
    raw = b"".join(warc.record_head("7", u, 0, digest(""), None) + b"\r\n\r\n" for u in urls)
    raw += warc.record_head(None, "u", 0, digest(""), "7", urls[0]) + b"\r\n\r\n"
    got = list(warc.records_of(io.BytesIO(zlib.compress(raw, 6, 31)), 64))
    assert [r[2] for r in got[:-1]] == urls and got[-1][1] is None and got[-1][4] == "7"
    ids = [x for x in raw.decode().split("\r\n") if x.startswith("WARC-Record-ID")]
    assert len(set(ids)) == len(urls) + 1
    assert "WARC-Target-URI: http://a/b%20c" in raw.decode() and "WARC-Refers-To-Target-URI: http://a/b%20c" in raw.decode()


def test_empty_table(spark):
    manifest, root = warc.write_archives(spark, spark.createDataFrame([], SCHEMA))
    assert warc.records(warc.read_chunks(spark, manifest, root)).collect() == []


def test_damage_raises():
    raw = warc.record_head("1", "u", 5, digest("hello"), None) + b"hello" + b"\r\n\r\n"
    gz = lambda b: zlib.compress(b, 6, 31)
    assert [r[8] for r in warc.records_of(io.BytesIO(gz(raw)), 2)] == [b"he", b"ll", b"o"]
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gz(raw.replace(b"hello", b"jello"))), 2))
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gz(raw[:-6])), 2))
