from __future__ import annotations

import gzip
import hashlib

import pytest

from strata.llm import warc
from strata.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_id string, digest string, row_no int"


def page(page_id, html, url="http://a.example/x"):
    return (page_id, url, html, "clash", "clash", 7)


LONG = "".join(f"<p>é日本 \r\n\r\n{k} WARC/1.1\r\n</p>" for k in range(4_000))
PAGES = [
    page(1, "a" * 100), page(2, "a" * 100), page(5, "a" * 100), page(3, "b" * 99), page(4, "b" * 99),
    page(6, None), page(7, ""), page(8, None, None), page(9, LONG), page(10, LONG, "x\r\nWARC-Type: evil"),
    page(None, "c" * 200), page(11, "c" * 200), page(12, "d" * 150), page(12, "d" * 150), page(None, "e" * 300),
    page(13, "\U0001f600" * 5_000), page(14, "é" * 50),
]


def expected(pages):
    first = {}
    for p in pages:
        if p[0] is not None:
            first[p[2]] = min(p[0], first.get(p[2], p[0]))
    out = []
    for p in pages:
        data = (p[2] or "").encode()
        again = len(data) >= 100 and p[0] != first.get(p[2])
        kind = ("revisit", first[p[2]]) if again else ("response", None)
        out.append((p[0], len(data), hashlib.sha256(data).hexdigest(), *kind))
    return out


def by_value(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def test_roundtrip(spark):
    got = warc.roundtrip(spark.createDataFrame(PAGES, SCHEMA))
    rows = [tuple(r)[:5] for r in got.collect()]
    assert by_value(rows) == by_value(expected(PAGES))
    assert got.filter("error is not null").count() == 0


def test_payloads_come_back_whole(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), path, segment_bytes=1_000)
    records = warc.read_records(spark, path)
    assert records.filter("kind = 'continuation'").count() > 100
    assert records.filter("length(block) > 1000").count() == 0
    responses, revisits = warc.read_archives(spark, path)
    payloads = {bytes(r["payload"]) for r in responses.collect()}
    assert payloads == {(p[2] or "").encode() for p in PAGES}
    assert revisits.count() + responses.count() == len(PAGES)


def test_segments_in_any_order_and_damage():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"x" * 10_000)
    parts = [(1, None, block[:4_000]), (2, None, block[4_000:8_000]), (3, len(block), block[8_000:])]
    assert warc.message_payload(parts[::-1]) == b"x" * 10_000
    for broken in (parts[:2], parts[1:], [*parts, parts[1]], [*parts[:2], (3, len(block) + 1, block[8_000:])]):
        with pytest.raises(ValueError):
            warc.message_payload(broken)
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab")
    with pytest.raises(ValueError):
        warc.unchunked(b"zz\r\n")


def test_damaged_archive_is_reported():
    record = next(warc.records_of(1, "u", "d", "text", None, 0, 100)).encode() + b"\r\n\r\n"
    rows = list(warc.parse_archive(record + record[:-20]))
    assert [r[1] for r in rows] == ["response", "damaged"] and rows[1][-1]


def test_damage_keeps_the_records_around_it(spark, tmp_path):
    records = [next(warc.records_of(k, f"u{k}", "d", f"text {k} " * 30, None, 0, 16_384)).encode() + b"\r\n\r\n" for k in range(6)]
    length = records[3].split(b"Content-Length: ")[1].split(b"\r\n")[0]
    records[1] = records[1][:-200]
    records[3] = records[3].replace(b"Content-Length: " + length, b"Content-Length: abc")
    records[4] = records[4].replace(b"Content-Type", b"WARC-Segment-Number: q\r\nContent-Type", 1)
    (tmp_path / "part-0.warc").write_bytes(b"".join(records))
    (tmp_path / "part-1.gz").write_bytes(gzip.compress(records[5] + records[0] * 50)[:-30])
    responses, revisits = warc.read_archives(spark, str(tmp_path))
    rows = responses.collect()
    whole = [r["target_uri"] for r in rows if r["payload"] is not None and r["target_uri"] != "u0"]
    assert sorted(whole) == ["u2", "u5", "u5"] and revisits.count() == 0
    assert {r["target_uri"] for r in rows if r["error"]} >= {"u1", "u3", "u4", None}
    assert all((r["payload"] is None) == (r["error"] is not None) for r in rows)


def test_chunks_and_cuts_never_split_a_character():
    data = "aé日\U0001f600".encode() * 50
    for most in (4, 5, 7):
        bounds = [0, *warc.cuts(data, most), len(data)]
        parts = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        assert all(len(p) <= most and p.decode() is not None for p in parts)
        assert warc.unchunked(warc.chunked(data, most)) == data


def test_empty_table(spark):
    assert warc.roundtrip(spark.createDataFrame([], SCHEMA)).count() == 0
