"""Writing pages to WARC archives, and reading archives as a table of chunks.

How: payloads are cut into chunks of `CHUNK` bytes. The first chunk goes into a
response record, each further one into a continuation record of its own (WARC
1.1, record segmentation), so a row, a line of a file and a task's buffers hold
one chunk, however long the payload is. Of records with equal payloads of at
least `MIN_REVISIT` bytes the one with the largest id is the response; the
others become revisit records without payload. Who revisits whom is settled on
rows of digests before any payload moves.

Archives are written by Spark's text writer: it ends each row with the line
feed that a record ends with. So they go to any store that Spark can write, and
a lost executor's files are written again and committed once. They are read the
same way; a whole-file gzip archive is one task's stream of lines. The reader
carries the SHA-1 of a payload from chunk to chunk and compares it with the
record's header at the last one.

Rules: a NULL html is empty. A NULL id is kept and read back as NULL; such a
record can revisit another one, and is a response where no record with an id
has its payload. Rows with the same id and payload that are the largest are all
responses. Control characters of a URL become %20.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.llm.common import batch_of

CHUNK = 1 << 20
MIN_REVISIT = 1000

# Fixed values of the WARC 1.1 standard.
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"

CHUNK_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, chunk int, data binary, "
    "payload_bytes long, payload_digest string, last boolean"
)


def _id(column: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit(NO_ID)), F.lit(">"))


def _lines(*lines: Column | str | None) -> Column:
    """Header lines, each ended by CR LF; those that are NULL are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(x) if isinstance(x, str) else x, F.lit("\r\n")), F.lit("")) for x in lines])


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def revisits(pages: DataFrame, min_revisit: int) -> DataFrame:
    """(page_id, sha1, n, refers_to) of the records that revisit another one."""
    large = pages.where(F.col("n") >= min_revisit).select("page_id", "sha1", "n", "check")
    same = ["sha1", "n", "check"]
    groups = large.groupBy(*same).agg(F.max("page_id").alias("refers_to"), F.count("*").alias("size"))
    shared = groups.where((F.col("size") > 1) & F.col("refers_to").isNotNull()).drop("size")
    return large.join(shared, same).where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()


def warc_records(
    pages: DataFrame, date: str, chunk: int, min_revisit: int, id_col: str, url_col: str, html_col: str
) -> DataFrame:
    """One row per WARC record: its bytes without the last line feed, as `value`."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    named = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col), "[\\x00-\\x20\\x7f]", "%20").alias("url"),
        payload.alias("payload"),
    )
    digested = named.select(
        "*",
        F.octet_length("payload").cast("long").alias("n"),
        F.sha1("payload").alias("sha1"),
        F.xxhash64("payload").alias("check"),
    )
    again = revisits(digested.drop("payload", "url"), min_revisit).select(
        F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), F.col("check").alias("r_check"), "refers_to"
    )
    joined = digested.join(
        again,
        F.col("page_id").eqNullSafe(F.col("r_id"))
        & (F.col("sha1") == F.col("r_sha1"))
        & (F.col("check") == F.col("r_check")),
        "left",
    )
    revisit = F.col("refers_to").isNotNull()
    chunks = F.when(revisit, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n") / chunk))).cast("int")
    split = joined.withColumn("chunks", chunks).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("chunks"))))

    first, segmented = F.col("k") == 1, F.col("chunks") > 1
    part = F.when(revisit, F.lit(b"")).otherwise(F.substring("payload", (F.col("k") - 1) * chunk + 1, F.lit(chunk)))
    http = F.when(
        first,
        _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", _field("Content-Length", F.col("n")), ""),
    ).otherwise(F.lit(""))
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    segment_id = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(NO_ID)),
                          F.lit("#"), F.col("k").cast("string"), F.lit(">"))
    header = _lines(
        VERSION,
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, _id(F.col("page_id"))).otherwise(segment_id)),
        f"WARC-Date: {date}",
        _field("WARC-Target-URI", F.col("url")),
        F.when(first, _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))),
        F.when(revisit, _field("WARC-Refers-To", _id(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {IDENTICAL}")),
        F.when(segmented, _field("WARC-Segment-Number", F.col("k"))),
        F.when(~first, _field("WARC-Segment-Origin-ID", _id(F.col("page_id")))),
        F.when(segmented & (F.col("k") == F.col("chunks")),
               _field("WARC-Segment-Total-Length", F.col("n"))),
        F.when(first, F.lit("Content-Type: application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(http) + F.octet_length(part)),
        "",
    )
    whole = F.concat(header.cast("binary"), http.cast("binary"), part, F.lit(b"\r\n\r"))
    return split.select(whole.cast("string").alias("value"))


def write_warc(
    pages: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    chunk: int = CHUNK,
    min_revisit: int = MIN_REVISIT,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write gzip archives to the folder `path`; `date` is every record's WARC-Date."""
    records = warc_records(pages, date, chunk, min_revisit, id_col, url_col, html_col)
    records.write.option("compression", "gzip").text(path)


# --- reading ----------------------------------------------------------------------------


def _records(buffers: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record in a stream of bytes."""
    held = b""
    for buffer in buffers:
        held, at = held + buffer if held else buffer, 0
        while True:
            end = held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            first, *lines = held[at:end].decode().split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError(f"not a WARC record: {first[:40]!r}")
            fields = dict(line.split(": ", 1) for line in lines)
            block = end + 4
            stop = block + int(fields["Content-Length"])
            if stop + 4 > len(held):
                break
            yield fields, held[block:stop]
            at = stop + 4
        held = held[at:]
    if held:
        raise ValueError("the archive ends within a record")


def _page(name: str | None) -> int | None:
    found = name and name.removeprefix("<urn:page:").rstrip(">").split("#")[0]
    return int(found) if found and found != NO_ID else None


def _chunks(stream: Iterator[bytes], with_data: bool) -> Iterator[tuple]:
    """Rows of CHUNK_SCHEMA; the digest so far goes from chunk to chunk of a record."""
    origin, digest, size, number, expected = {}, None, 0, 0, 0
    for fields, block in _records(stream):
        kind = fields["WARC-Type"]
        if kind != "continuation":
            head = block.find(b"\r\n\r\n") + 4
            http, block = block[:head].decode(), block[head:]
            expected = int(http.split("Content-Length: ", 1)[1].split("\r\n", 1)[0])
            origin, digest, size, number = fields, hashlib.sha1(), 0, 0
        elif fields["WARC-Segment-Origin-ID"] != origin.get("WARC-Record-ID"):
            raise ValueError("a continuation doesn't follow its record")
        number += 1
        digest.update(block)
        size += len(block)
        declared = origin["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = origin["WARC-Type"] == "revisit"
        last = revisit or size == expected
        if last and not revisit and digest.hexdigest() != declared:
            raise ValueError(f"{origin['WARC-Record-ID']}: the payload differs from its digest")
        yield (
            _page(origin["WARC-Record-ID"]),
            origin.get("WARC-Target-URI"),
            origin["WARC-Type"],
            _page(origin.get("WARC-Refers-To")),
            number,
            block if with_data else None,
            expected if revisit else size,
            declared if revisit else digest.hexdigest(),
            last,
        )


def read_warc(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """One row per chunk: page_id, url, record_type, refers_to, chunk (from 1), data,
    payload_bytes and payload_digest up to and with this chunk, last.

    A revisit is one row with the length and digest of the payload it stands
    for. Without `with_data` the column `data` is NULL.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("line"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
        names = [field.split()[0] for field in CHUNK_SCHEMA.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return batch_of([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        stream = (b"\n".join(batch.column(0).to_pylist()) + b"\n" for batch in batches if len(batch))
        rows, size = [], 0
        for row in _chunks(stream, with_data):
            rows.append(row)
            size += len(row[5] or b"") + 200
            if size > 8 << 20:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)

    return lines.mapInArrow(parse, CHUNK_SCHEMA)
