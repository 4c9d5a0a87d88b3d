import base64
import gzip
import hashlib
import os

import pytest

from subscope.llm import warc
from subscope.session import scratch_path

SCHEMA = "page_id long, url string, html string, content string, original long, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "c", 1, "p") for i, u, h in rows], SCHEMA).repartition(3)


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        own = first.get(b)
        revisit = own is not None and own != i
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "revisit" if revisit else "response", own if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (3, "http://a", "<p>one</p>"), (1, "http://b", "<p>one</p>"), (2, None, None), (4, "http://c\r\nX: y", ""),
    (5, "http://d", "é日本😀" * 50), (6, "http://e", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (7, "http://ü", "\r\n\r\n"), (None, "http://f", "<p>one</p>"), (None, "http://g", "alone"), (8, "http://h", "twice"),
    (8, "http://h", "twice"), (9, "u", "l" * 3000), (10, "v", "l" * 3000), (11, "w", "\n" * 70),
]


@pytest.mark.parametrize("chunk, block", [(1 << 20, 4 << 20), (16, 200), (7, 1)])
def test_round_trip(spark, chunk, block):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.with_types(pages(spark, ROWS)), path, chunk, block)
    got = [tuple(r) for r in warc.read_records(spark, path).collect()]
    assert sorted(got, key=str) == expected(ROWS)


def test_small_payloads_may_all_be_responses(spark):
    typed = warc.with_types(pages(spark, ROWS), least_bytes=100)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(typed, path)
    assert sorted((tuple(r) for r in warc.read_records(spark, path).collect()), key=str) == expected(ROWS, 100)


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.with_types(pages(spark, [])), path)
    assert warc.read_records(spark, path).collect() == []


def test_chunks_carry_growing_digests(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.with_types(pages(spark, [(1, "u", "abcdefghij")])), path, chunk=4)
    rows = sorted(warc.read_chunks(spark, path).collect(), key=lambda r: r.chunk_no)
    assert [bytes(r.data) for r in rows] == [b"abcd", b"efgh", b"ij"]
    ends = (b"abcd", b"abcdefgh", b"abcdefghij")
    assert [r.payload_digest for r in rows] == [base64.b32encode(hashlib.sha1(e).digest()).decode() for e in ends]
    assert [r.total_bytes for r in rows] == [None, None, 10]


def test_files_are_plain_archives_and_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(warc.with_types(pages(spark, [(1, "u", "payload here")])), path)
    name = next(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".gz"))
    raw = gzip.open(name).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"payload here\r\n\r\n")
    with pytest.raises(ValueError, match="damaged"):
        list(warc.chunks_in(gzip.compress(raw.replace(b"payload here", b"payload herd"))))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.chunks_in(gzip.compress(raw[:-20])))
    # Members of a gzip file follow each other.
    assert len(list(warc.chunks_in(gzip.compress(raw) + gzip.compress(raw)))) == 2
