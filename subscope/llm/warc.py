"""WARC archives as a chunked record table.

Writing: a page becomes one record, or, where its payload exceeds a chunk, a segmented
record: one row per record key and chunk number, each at most a chunk long, with the digest
of the payload up to its end. Rows are packed into blocks and written as gzip text files
whose separator is the end of a WARC record, so any WARC reader can take them.

Reading: files are decompressed piece by piece and cut at Content-Length. A row per chunk
carries its bytes only if the record has several; these are brought together by record key,
sorted by chunk number and digested as they stream by. No payload is joined in memory on
the way back, and every stored digest is checked.

Defined cases: a NULL payload is empty; pages with a NULL id are archived and returned with
a NULL id, and are never referred to while a page with an id has the same payload; pages
that repeat the smallest id of a payload are all responses; an empty table gives an empty
archive; extra columns are not archived. Line ends in addresses are percent-encoded.
"""

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import plain
from ..session import scratch_path
from . import common

CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20
BLOCKS_PER_FILE = 8
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # the pages carry no time of capture
VERSION = "WARC/1.1"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"

CHUNK_SCHEMA = (
    "record_key string, chunk_no long, page_id long, record_type string, refers_to long, "
    "total_bytes long, payload_digest string, chunk_bytes long, data binary"
)
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(sha) -> str:
    return base64.b32encode(sha.digest()).decode("ascii")


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Add what a record refers to: the smallest page id with the same payload.

    Only payloads that occur twice are joined back. They are a table of their own, so
    Spark knows its size: small ones are broadcast, and otherwise both sides are plain
    shuffles, whose large partitions adaptive execution splits.
    """
    pages = pages.select(
        plain(id_col).cast("long").alias("page_id"),
        plain(url_col).cast("string").alias("url"),
        F.coalesce(plain(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    keyed = pages.withColumn("content", F.unhex(F.sha1("payload")))
    sized = keyed.where(F.octet_length("payload") >= least_bytes) if least_bytes else keyed
    groups = sized.groupBy("content").agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    repeated = groups.where("n > 1 and original is not null").select("content", "original")
    repeated = common.checkpointed(repeated, "repeated-payloads")
    joined = keyed.join(repeated, "content", "left")
    if least_bytes:
        small = F.octet_length("payload") < least_bytes
        joined = joined.withColumn("original", F.when(~small, F.col("original")))
    refers = F.when(F.col("page_id").isNull() | (F.col("original") != F.col("page_id")), F.col("original"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def _safe(value: str | None) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    inner = name[len("<urn:page:") : -1]
    return None if inner == "none" else int(inner)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + END).encode("utf-8") + block


def records_of(key: str, page_id, url, payload: bytes, refers_to, chunk: int):
    """The WARC records of one page, chunk by chunk, without their trailing line ends."""
    sha = hashlib.sha1()
    pieces = max(1, -(-len(payload) // chunk))
    common_headers = [("WARC-Date", DATE), ("WARC-Target-URI", _safe(url)), ("X-Record-Key", key)]
    http = (HTTP + f"\r\nContent-Length: {len(payload)}" + END).encode("utf-8")
    if refers_to is not None:
        for at in range(0, len(payload), chunk):
            sha.update(payload[at : at + chunk])
        yield _record(
            [
                ("WARC-Type", "revisit"),
                ("WARC-Record-ID", _name(page_id)),
                ("WARC-Refers-To", _name(refers_to)),
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                *common_headers,
                ("X-Payload-Length", str(len(payload))),
                ("WARC-Payload-Digest", "sha1:" + digest_of(sha)),
                ("Content-Type", "application/http;msgtype=response"),
            ],
            http,
        )
        return
    for number in range(pieces):
        part = payload[number * chunk : (number + 1) * chunk]
        sha.update(part)
        headers = [("WARC-Type", "continuation" if number else "response"), *common_headers]
        if number:
            headers.append(("WARC-Record-ID", _name(page_id)[:-1] + f":segment:{number + 1}>"))
            headers.append(("WARC-Segment-Origin-ID", _name(page_id)))
        else:
            headers.append(("WARC-Record-ID", _name(page_id)))
            headers.append(("Content-Type", "application/http;msgtype=response"))
        if pieces > 1:
            headers.append(("WARC-Segment-Number", str(number + 1)))
        if number == pieces - 1:
            headers.append(("X-Payload-Length", str(len(payload))))
        # The digest of the payload so far; the last one is that of the whole.
        headers.append(("WARC-Payload-Digest", "sha1:" + digest_of(sha)))
        yield _record(headers, part if number else http + part)


def write_archives(typed: DataFrame, path: str, chunk: int = CHUNK_BYTES, block: int = BLOCK_BYTES) -> None:
    """Write pages with ``refers_to`` as gzip WARC files of a few blocks each."""

    def run(batches):
        task = TaskContext.get().partitionId()
        rows, waiting, size = 0, [], 0
        for batch in batches:
            ids, urls, refers = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
            payloads = batch.column("payload")
            for i in range(len(batch)):
                payload = payloads[i].as_buffer() if payloads[i].is_valid else b""
                for record in records_of(f"{task}-{rows}", ids[i], urls[i], memoryview(payload), refers[i], chunk):
                    if waiting and size + len(record) > block:
                        yield _block(waiting)
                        waiting, size = [], 0
                    waiting.append(record)
                    size += len(record)
                rows += 1
        if waiting:
            yield _block(waiting)

    payload = F.col("payload").cast("binary").alias("payload")
    blocks = typed.select("page_id", "url", payload, "refers_to").mapInArrow(run, "value binary")
    # Chunks are cut between bytes, so a block need not be valid text; its bytes are kept.
    blocks.select(F.col("value").cast("string")).write.options(
        lineSep=END, compression="gzip", maxRecordsPerFile=BLOCKS_PER_FILE
    ).text(path)


def _block(records: list[bytes]) -> pa.RecordBatch:
    joined = END.encode("ascii").join(records)
    return pa.RecordBatch.from_arrays([pa.array([joined], pa.binary())], names=["value"])


class _Stream:
    """Bytes of a gzip file, decompressed as they are asked for."""

    def __init__(self, content):
        self.content, self.at = memoryview(content), 0
        self.inflate = zlib.decompressobj(31)
        self.buffer = b""

    def _more(self) -> bool:
        if self.inflate.eof:
            rest = self.inflate.unused_data
            if not rest and self.at >= len(self.content):
                return False
            self.inflate = zlib.decompressobj(31)
            source = rest
        else:
            source = self.inflate.unconsumed_tail
        if not source:
            source = self.content[self.at : self.at + READ_BYTES]
            self.at += len(source)
            if not len(source):
                return False
        self.buffer += self.inflate.decompress(source, READ_BYTES)
        return True

    def header(self) -> str | None:
        """The lines up to an empty one; None at the end of the file."""
        while (found := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("an archive ends within a record")
                return None
        out, self.buffer = self.buffer[:found], self.buffer[found + 4 :]
        return out.decode("utf-8")

    def body(self, length: int):
        """``length`` bytes, in pieces."""
        while length:
            if not self.buffer and not self._more():
                raise ValueError("an archive ends within a record")
            part, self.buffer = self.buffer[:length], self.buffer[length:]
            length -= len(part)
            if part:
                yield part


def chunks_in(content) -> "list":
    """Rows of CHUNK_SCHEMA of one archive file, in order."""
    stream = _Stream(content)
    while (head := stream.header()) is not None:
        lines = head.lstrip("\r\n").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        kind, length = fields["WARC-Type"], int(fields["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        number = int(fields.get("WARC-Segment-Number", 1))
        if kind != "continuation":
            http = stream.header()
            length -= len(http.encode("utf-8")) + 4
        total = fields.get("X-Payload-Length")
        total = None if total is None else int(total)
        several = number > 1 or "WARC-Segment-Number" in fields
        data, sha, size = [], hashlib.sha1(), 0
        for part in stream.body(length):
            sha.update(part)
            size += len(part)
            if several:
                data.append(part)
        if kind == "response" and not several and (digest_of(sha) != digest or size != total):
            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        # A record ends with two line ends, which the block may share with its file.
        for _ in stream.body(4):
            pass
        refers = fields.get("WARC-Refers-To")
        yield (
            fields["X-Record-Key"],
            number,
            _page(fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])),
            kind,
            None if refers is None else _page(refers),
            total,
            digest,
            size,
            b"".join(data) if several else None,
        )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of all archive files in a folder."""
    schema = T.StructType.fromDDL(CHUNK_SCHEMA)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(f.name, kinds[{"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())]) for f in schema.fields])

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row in chunks_in(content.as_buffer()):
                    rows.append(row)
                    held += 200 + len(row[-1] or b"")
                    if held > BLOCK_BYTES:
                        yield _rows(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, CHUNK_SCHEMA)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)], schema=schema
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its chunks come by in order and their digest goes on."""
    names = [f.name for f in T.StructType.fromDDL(CHUNK_SCHEMA).fields]

    def run(batches):
        key, sha, size, base, number = None, None, 0, None, 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                row = dict(zip(names, row))
                if row["data"] is None:
                    out.append((row["page_id"], row["total_bytes"], row["payload_digest"], row["record_type"], row["refers_to"]))
                    continue
                if row["record_key"] != key:
                    key, sha, size, base, number = row["record_key"], hashlib.sha1(), 0, row["page_id"], 0
                number += 1
                sha.update(row["data"])
                size += row["chunk_bytes"]
                if number != row["chunk_no"] or digest_of(sha) != row["payload_digest"]:
                    raise ValueError(f"damaged or missing chunk {number} of page {base}")
                if row["total_bytes"] is not None:
                    if size != row["total_bytes"]:
                        raise ValueError(f"page {base} has {size} bytes")
                    out.append((base, size, digest_of(sha), "response", None))
            if out:
                yield _rows(out, pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))

    chunks = read_chunks(spark, path).repartition("record_key").sortWithinPartitions("record_key", "chunk_no")
    return chunks.mapInArrow(run, RECORD_SCHEMA)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(with_types(common.table(spark, sf_dir, "pages")), path)
    return read_records(spark, path)


OP4_SQL = """
with p as (
  select page_id, encode(coalesce(html, '')) as b from pages
), h as (
  select page_id, octet_length(b) as n, sha1(b) as hex, min(page_id) over (partition by b) as original from p
), bits as (
  select *, list_transform(range(32), lambda i:
    (strpos('0123456789abcdef', substr(hex, ((i * 5) // 4 + 1)::int, 1)) - 1) * 16
    + case when (i * 5) // 4 + 2 <= 40 then strpos('0123456789abcdef', substr(hex, ((i * 5) // 4 + 2)::int, 1)) - 1 else 0 end
  ) as two from h
)
select page_id, n::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((two[i + 1] // (case (i * 5) % 4 when 0 then 8 when 1 then 4 when 2 then 2 else 1 end)) % 32 + 1)::int, 1)), '') as payload_digest,
  case when page_id = original then 'response' else 'revisit' end as record_type,
  case when page_id = original then null else original end as refers_to
from bits
"""
