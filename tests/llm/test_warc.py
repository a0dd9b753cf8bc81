import hashlib

import pytest

from clinicflow.llm import warc

PAGES = "page_id long, url string, html string, payload string"


def expected(rows):
    by = {}
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page_id is not None:
            by[payload] = max(by.get(payload, page_id), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        origin = by.get(payload)
        revisit = origin is not None and page_id != origin
        digest = hashlib.sha1(payload).hexdigest()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", origin if revisit else None))
    return sorted(out, key=str)


def test_round_trip_edge_cases(spark):
    big, long_text = "x\r\n\r\nWARC/1.1\r\n" * 100, "é\n<p>" * 200_000
    rows = [
        (1, "u1", None, "c"), (2, "u2", "", "c"), (3, "u3", big, "c"), (9, "u9", big, "c"), (9, "u9", big, "c"),
        (4, "u4\r\nX: y", "short", None), (5, None, "short", None), (6, "u6", long_text, None), (7, "u7", long_text, None),
        (8, "u8", "y" * 999, None), (10, "u10", "y" * 999, None), (None, "n", big, None), (None, "n", "z" * 2000, None),
    ]
    df = spark.createDataFrame(rows, PAGES)
    got = warc.round_trip(df, with_payload=True, segment_bytes=10_000, records_per_file=3).collect()
    keys = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(keys, key=str) == expected(rows)
    assert all(r.intact for r in got)
    texts = {r.page_id: bytes(r.payload) for r in got if r.payload is not None}
    assert texts[7] == long_text.encode() and texts[9] == big.encode()
    assert {r.url for r in got if r.page_id == 4} == {"u4%0D%0AX: y"}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 5000):
        assert warc.unchunked(warc.chunked(payload, 7)) == payload
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_a_lost_segment_is_seen(spark, tmp_path):
    row = {"page_id": 1, "url": "u", "digest": hashlib.sha1(b"a" * 5000).hexdigest(), "payload": b"a" * 5000, "refers_to": None}
    records = warc.record_segments(row, "2026-01-01T00:00:00Z", 1000)
    del records[2]
    (tmp_path / "x.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in reversed(records)))
    assert [r.intact for r in warc.read_archives(spark, str(tmp_path)).collect()] == [False]
