"""Archives written and read back, whole records and chunks."""

import gzip
import hashlib
import os

import pytest

from clicktrail.llm import catalog, warc
from tests.llm.helpers import tables

SCHEMA = "page_id long, url string, html string, value string, k int, payload string, refers_to string"
LONG = "<p>Ünïcode 日本 \r\n\r\nWARC/1.1\r\n</p>" * 300


def pages():
    rows = [
        (1, "http://a/1", "<p>short</p>"), (2, "http://a/2", "<p>short</p>"), (3, None, None), (4, "", ""),
        (5, "http://a/ b\r\nX: y", LONG), (9, "http://a/9", LONG), (7, "http://a/7", LONG), (9, "http://a/9", LONG),
        (10, "u", "x" * 1000), (11, "u", "x" * 1000), (12, "u", "y" * 999), (13, "u", "y" * 999), (None, "u", "x" * 1000),
        (None, "u", "z" * 2000), (None, "v", "z" * 2000), (14, "u", "\r\n" * 4000), (15, "u", "tail\r\n\r"),
    ]
    return rows


def expected(rows):
    keepers = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page_id is not None:
            keepers[payload] = max(page_id, keepers.get(payload, page_id))
    found = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        keeper = keepers.get(payload)
        other = keeper if keeper is not None and keeper != page_id else None
        kind = "revisit" if other is not None else "response"
        found.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, other))
    return sorted(found, key=str)


def table_of(spark, rows):
    return spark.createDataFrame([(*row, "v", 1, "p", "r") for row in rows], SCHEMA)


def test_query(spark, tmp_path):
    folder = tables(spark, tmp_path / "t", pages=table_of(spark, pages()))
    assert sorted(map(tuple, catalog.warc(spark, folder).collect()), key=str) == expected(pages())


@pytest.mark.parametrize("chunk", [64, 1001, 1 << 20])
def test_chunks_make_the_payload(spark, tmp_path, chunk):
    path = f"{tmp_path}/archive"
    warc.write_warc(table_of(spark, pages()).coalesce(2), path, chunk=chunk)
    rows = [row for row in warc.read_warc(spark, path).collect() if row["record_type"] == "response"]
    payloads, parts = [], []
    for row in rows:
        parts.append(bytes(row["data"]))
        assert len(parts) == row["chunk"] and len(parts[-1]) <= chunk
        assert row["payload_digest"] == hashlib.sha1(b"".join(parts)).hexdigest()
        assert row["payload_bytes"] == len(b"".join(parts))
        if row["last"]:
            payloads.append((row["page_id"], b"".join(parts)))
            parts = []
    want = [row[0] for row in expected(pages()) if row[3] == "response"]
    assert sorted(map(str, want)) == sorted(str(page_id) for page_id, _ in payloads) and not parts
    texts = {(page_id, (html or "").encode()) for page_id, _, html in pages()}
    assert set(payloads) <= texts


def test_archive_is_well_formed(spark, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(table_of(spark, pages()[:6]).coalesce(1), path)
    name = next(name for name in os.listdir(path) if name.endswith(".gz"))
    data = gzip.open(f"{path}/{name}").read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://a/%20b%20%20X:%20y\r\n" in data
    records = list(warc._records(iter([data])))
    assert len(records) == 6
    # The stream may be cut anywhere.
    pieces = iter([data[k : k + 7] for k in range(0, len(data), 7)])
    assert list(warc._records(pieces)) == records


def test_damaged_payload_is_reported():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabcd"
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\n"
        f"WARC-Payload-Digest: sha1:{'0' * 40}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    with pytest.raises(ValueError, match="differs"):
        list(warc._chunks(iter([head.encode() + block + b"\r\n\r\n"]), True))
    with pytest.raises(ValueError, match="ends within"):
        list(warc._records(iter([head.encode()])))


def test_empty_table(spark, tmp_path):
    assert catalog.warc(spark, tables(spark, tmp_path / "t")).collect() == []
