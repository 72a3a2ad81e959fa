from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from talkatlas.llm import warc

SCHEMA = "page_id long, url string, html string, record string, chunk int"


def pages(spark):
    big = "".join(f"<p>{k} é\r\n\n" for k in range(30_000))
    bodies = [None, "", "a", "a\n", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", big, big, big + "x", "x" * 200_000, "dup", "dup", "dup", "é" * 70_000]
    rows = [(10 + k, None if k == 3 else f"http://h/{k}\nx", b, "r", k) for k, b in enumerate(bodies)]
    rows += [(None, "u", "dup", "r", 0), (None, "u", "only null ids", "r", 0), (21, "u", "dup", "r", 0)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_round_trip(spark, tmp_path):
    rows, frame = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_archives(frame.repartition(3), path)
    chunks = warc.read_chunks(spark, path)
    found = warc.records(chunks).collect()
    assert len(found) == len(rows) and all(r.intact for r in found)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    last: dict[str, int] = {}
    for i, _, b, *_ in rows:
        if i is not None:
            last[b or ""] = max(i, last.get(b or "", i))
    want = []
    for i, _, b, *_ in rows:
        response = last.get(b or "", i) == i
        want.append((i, len((b or "").encode()), digest(b), "response" if response else "revisit", None if response else last[b or ""]))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    texts: dict[str, list] = {}
    for c in chunks.where("record_type = 'response'").collect():
        texts.setdefault(c.record, []).append((c.chunk, c.bytes, c.length, c.digest, c.page_id))
    body = {i: b or "" for i, _, b, *_ in rows}
    for parts in texts.values():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        data = b""
        for _, piece, length, running, _ in parts:
            assert len(piece) <= warc.CHUNK
            data += piece
            assert length == len(data) and running == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if parts[0][4] is not None:
            assert data == body[parts[0][4]].encode()
    assert max(map(len, texts.values())) > 4


def test_files_follow_the_format(spark, tmp_path):
    _, frame = pages(spark)
    warc.write_archives(frame.coalesce(1), str(tmp_path / "w"), chunk=1000)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(tmp_path / "w").glob("part-*.gz")))
    kinds = []
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        size = int(fields[b"Content-Length"])
        assert size <= 1000 and data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]
        kinds.append(fields[b"WARC-Type"])
        assert (fields[b"WARC-Type"] == b"continuation") == (int(fields.get(b"WARC-Segment-Number", 1)) > 1)
    assert {*kinds} == {b"response", b"revisit", b"continuation"}


def test_small_payloads_may_stay_responses(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "dup"), (2, "u", "dup")], "page_id long, url string, html string")
    warc.write_archives(frame, str(tmp_path / "w"), min_bytes=4)
    assert {r.record_type for r in warc.records(warc.read_chunks(spark, str(tmp_path / "w"))).collect()} == {"response"}


@pytest.mark.parametrize("with_bytes", [True, False])
def test_empty_table(spark, tmp_path, with_bytes):
    _, frame = pages(spark)
    warc.write_archives(frame.limit(0), str(tmp_path / "w"))
    assert warc.read_chunks(spark, str(tmp_path / "w"), with_bytes).count() == 0


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, body: bytes, *lines: str, end: str = "\r\n", size: int | str | None = None) -> bytes:
    head = ["WARC/1.0", f"WARC-Type: {kind}", *lines, f"Content-Length: {len(body) if size is None else size}", "", ""]
    return end.join(head).encode() + body + b"\r\n\r\n"


def read(spark, folder, *archives: bytes):
    folder.mkdir()
    for k, data in enumerate(archives):
        (folder / f"{k}.warc.gz").write_bytes(gzip.compress(data))
    return warc.read_chunks(spark, str(folder))


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    page, odd = b"<p>caf\xc3\xa9</p>\n", bytes(range(256)) * 3
    archive = (
        record("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:info>", "Content-Type: application/warc-fields")
        + record("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <urn:uuid:ask>", "Content-Type: application/http; msgtype=request")
        + record("response", http + page, "warc-record-id:<urn:uuid:a>", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1(page)}", "WARC-Target-URI: http://h/", " ?folded")
        + record("resource", odd, "WARC-Record-ID: <urn:uuid:b>", f"WARC-Block-Digest: SHA1:{hashlib.sha1(odd).hexdigest()}", end="\n")
        + record("response", page, "WARC-Record-ID: <urn:uuid:c>", f"WARC-Payload-Digest: sha1:{sha1(b'other')}")
        + record("response", page, "WARC-Record-ID: <urn:uuid:d>", "WARC-Payload-Digest: md5:00")
        + record("revisit", b"", "WARC-Record-ID: <urn:uuid:e>", "WARC-Refers-To: <urn:uuid:a>", f"WARC-Payload-Digest: sha1:{sha1(page)}")
        + record("metadata", b"", "X-Page-ID: no number")
    )
    rows = {r.record: r for r in warc.records(read(spark, tmp_path / "w", archive)).collect()}
    assert {k: r.record_type for k, r in rows.items()} == {
        "info": "warcinfo", "ask": "request", "a": "response", "b": "resource", "c": "response", "d": "response", "e": "revisit", None: "metadata",
    }
    assert {k: r.intact for k, r in rows.items()} == {"info": None, "ask": None, "a": True, "b": True, "c": False, "d": None, "e": True, None: None}
    assert (rows["a"].payload_bytes, rows["a"].payload_digest, rows["a"].url) == (len(page), sha1(page), "http://h/ ?folded")
    assert (rows["b"].payload_bytes, rows["b"].payload_digest) == (len(odd), sha1(odd))
    assert (rows["e"].payload_digest, rows["e"].payload_bytes, rows["e"].refers_record) == (sha1(page), None, "a")
    assert rows["ask"].payload_bytes == 0 and rows["info"].payload_bytes == 13 and rows[None].page_id is None


def test_large_records_leave_in_chunks_and_the_http_header_may_be_cut(spark, tmp_path):
    page = b"".join(b"%d\r\n\r\n" % k for k in range(60_000))
    http = b"HTTP/1.1 200 OK\r\nX: " + b"y" * (warc.CHUNK - 24) + b"\r\n\r\n"  # its end lies on the border of two chunks
    archive = record("response", http + page, "WARC-Record-ID: <a>", "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{sha1(page)}")
    chunks = read(spark, tmp_path / "w", archive)
    rows = sorted(chunks.collect(), key=lambda r: r.chunk)
    assert len(rows) > 6 and max(len(r.bytes) for r in rows) <= warc.CHUNK and [r.chunk for r in rows] == list(range(len(rows)))
    assert b"".join(r.bytes for r in rows) == page and warc.records(chunks).first().intact


def test_broken_records_are_rejected_and_the_others_read(spark, tmp_path):
    good = record("response", b"abc\n", "WARC-Record-ID: <good>", f"WARC-Payload-Digest: sha1:{sha1(b'abc' + chr(10).encode())}")
    cut = record("response", b"x" * 50, "WARC-Record-ID: <cut>", f"WARC-Payload-Digest: sha1:{sha1(b'x' * 50)}")[:-30]
    header = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <header>\r\n"
    endless = record("response", b"abc", "WARC-Record-ID: <endless>", size="many")
    first = record("response", b"abc", "WARC-Record-ID: <first>", "WARC-Segment-Number: 1")
    archives = [good.replace(b"good", b"g%d" % k) for k in range(6)]
    bad = [cut, header, endless + archives[0], first + archives[1], archives[2] + first, first.replace(b"first", b"next") + first]
    rows = warc.records(read(spark, tmp_path / "w", *bad, *archives[3:]).coalesce(1)).collect()
    assert sorted((r.record, bool(r.intact)) for r in rows) == sorted(
        [(f"g{k}", True) for k in range(6)] + [(x, False) for x in ("cut", "header", "endless", "first", "first", "first", "next")]
    )


def test_what_is_written_states_base32(spark, tmp_path):
    _, frame = pages(spark)
    warc.write_archives(frame, str(tmp_path / "w"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "w").glob("part-*.gz"))
    assert f"WARC-Payload-Digest: sha1:{sha1(b'dup')}\r\n".encode() in data and f"sha1:{sha1(b'')}\r\n".encode() in data


def test_a_plain_file_is_not_read_in_pieces(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(record("response", b"abc\n" * 200_000, "WARC-Record-ID: <a>"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        with pytest.raises(Exception, match="must be gzipped"):
            warc.read_chunks(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert warc.records(warc.read_chunks(spark, str(tmp_path / "w"))).first().payload_bytes == 800_000
