"""WARC output and input as a chunked record table.

A record is a run of rows (archive, seq, chunk_no): the first row carries the WARC and HTTP headers,
every row a bounded piece of the payload and the SHA-1 of the payload up to its end, the last row
closes the record. Writing and reading look at one piece at a time. The bytes of an archive are the
concatenation, by seq and chunk_no, of ``head``, ``data`` and after a last row CR LF CR LF.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

CHUNK, LEAST, OUT_BYTES = 64 << 10, 1000, 2 << 20
#: Revisits (100 bytes each) that are sent to all executors; more are joined by their ids and digests.
SENT_ROWS = 500_000
CLOSE = b"\r\n\r\n"
TABLE = pa.schema([("archive", pa.int32()), ("seq", pa.int64()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("head", pa.binary()), ("data", pa.binary()), ("digest", pa.string())])
TABLE_SQL = "archive int, seq long, chunk_no int, last boolean, head binary, data binary, digest string"


def _record(page: int | None, digest: str, more: str = "") -> str:
    """Id of a record, from its page and payload; of rows without page_id from their place as well."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}{more}')}>"


def _info(archive: int, date: str) -> bytes:
    """The record at the head of an archive that says what it is."""
    body = b"software: readloom\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {_record(None, '', f'archive {archive}')}", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + CLOSE + body + CLOSE


def _head(page: int | None, url: str | None, kind: str, refers: int | None, digest: str, size: int, key: str, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    clean = lambda s: "".join(" " if c < " " else c for c in s)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {key}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {clean(url)}"] if url is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest}"]
    lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record(refers, digest)}", f"X-Refers-To-Page-Id: {refers}"] if kind == "revisit" else []
    lines += [f"X-Page-Id: {page}"] if page is not None else []
    length = len(http) + (size if kind == "response" else 0)
    return "\r\n".join([*lines, "Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]).encode() + CLOSE + http


def _records(chunk: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]):
        archive, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            pages, urls, kinds, refers, digests = (b.column(c).to_pylist() for c in ("page_id", "url", "kind", "refers_to", "digest"))
            html = b.column("html")
            for i in range(b.num_rows):
                body = memoryview(html[i].as_buffer() or b"")
                head = _head(pages[i], urls[i], kinds[i], refers[i], digests[i], len(body), _record(pages[i], digests[i], "" if pages[i] is not None else f"/{archive}/{seq}"), date)
                body = body if kinds[i] == "response" else body[:0]
                running, n = hashlib.sha1(), max(1, -(-len(body) // chunk))
                for k in range(n):
                    piece = body[k * chunk : (k + 1) * chunk]
                    running.update(piece)
                    held.append((archive, seq, k, k == n - 1, None if k else head, piece.tobytes(), running.hexdigest()))
                    size += len(piece) + 300
                    if size > OUT_BYTES:
                        yield _rows(held)
                        held, size = [], 0
                seq += 1
        if held:
            yield _rows(held)

    return run


def _rows(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), TABLE)], schema=TABLE)


def write(pages: DataFrame, path: str, least: int = LEAST, chunk: int = CHUNK, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` (page_id, url, html; other columns are ignored) to ``path``.

    Of records with equal payloads of ``least`` bytes or more, that with the largest page_id is a
    response and the others are revisits of it, without payload. A null html is an empty payload. Rows
    that repeat the largest page_id are all responses; rows without page_id are revisits of a row that
    has one, else responses. An empty table gives an archive without records.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    digest, size = F.sha1("html"), F.octet_length("html")
    facts = pages.select("page_id", digest.alias("digest"), size.alias("size")).where(F.col("size") >= least)
    groups = facts.groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    types = shared.table(facts.join(groups, ["digest", "size"]).where("not (page_id <=> first)").select("page_id", "digest", "size", "first").distinct(), "types")
    # Payloads stay where they are if what is known of the revisits is small enough to be sent to them.
    few = types.count() <= SENT_ROWS
    p, t = pages.withColumn("digest", digest).alias("p"), (F.broadcast(types) if few else types).alias("t")
    joined = p.join(t, F.col("p.page_id").eqNullSafe(F.col("t.page_id")) & (F.col("p.digest") == F.col("t.digest")), "left")
    kind = F.when(F.col("t.first").isNull(), "response").otherwise("revisit")
    records = joined.select("p.page_id", "p.url", "p.html", "p.digest", kind.alias("kind"), F.col("t.first").alias("refers_to"))
    records.mapInArrow(_records(chunk, date), TABLE_SQL).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]):
    """Digest and length of records that come as several rows, each piece looked at once."""
    now, running, size, out = None, None, 0, []
    for b in batches:
        for a, s, k, last, data in zip(*(b.column(c).to_pylist() for c in ("archive", "seq", "chunk_no", "last", "data"))):
            if (a, s) != now:
                now, running, size, want = (a, s), hashlib.sha1(), 0, 0
            if k != want:
                raise ValueError(f"record {a}/{s}: piece {want} is missing")
            running.update(data)
            size, want = size + len(data), want + 1
            if last:
                out.append((a, s, size, running.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([],) * 4, (pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=["archive", "seq", "size", "sha1"])
        out = []


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    One row per record that was written, repeated ones each; a row without page_id or url comes back without;
    an archive without records gives no rows.
    Digest and length of a response are those of the payload as read, and are held against its
    headers; those of a revisit come from its headers. Raises where a payload does not fit.
    """
    table = spark.read.schema(TABLE_SQL).parquet(path)
    head = F.decode("head", "UTF-8")
    field = lambda name: F.nullif(F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)", 1), F.lit(""))
    top = table.where("chunk_no = 0").select(
        "archive", "seq", "last", field("X-Page-Id").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"), field("WARC-Type").alias("record_type"), field("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("said"), F.regexp_extract(head, r"(?s)\r\n\r\nHTTP/.*?Content-Length: (\d+)", 1).cast("long").alias("long"), F.sha1("data").alias("sha1"), F.octet_length("data").cast("long").alias("size"),
    )
    pieces = table.where("not (chunk_no = 0 and last)").select("archive", "seq", "chunk_no", "last", "data").repartition("archive", "seq").sortWithinPartitions("archive", "seq", "chunk_no")
    whole = pieces.mapInArrow(_digests, "archive int, seq long, size long, sha1 string")
    shown = ["page_id", "url", "record_type", "refers_to", "said", "long", "sha1", "size"]
    long = top.where("not last").drop("sha1", "size").join(whole, ["archive", "seq"], "left").select(*shown)
    every = top.where("last").select(*shown).unionByName(long)
    revisit = F.col("record_type") == "revisit"
    fits = F.when(revisit | (F.col("sha1").eqNullSafe(F.col("said")) & F.col("size").eqNullSafe(F.col("long"))), F.col("said")).otherwise(F.raise_error(F.concat(F.lit("payload does not fit its record: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?")))).cast("string"))
    return every.select("page_id", "url", F.col("long").alias("payload_bytes"), fits.alias("payload_digest"), "record_type", "refers_to")


def archive_bytes(spark: SparkSession, path: str, archive: int, date: str = "2024-01-01T00:00:00Z") -> Iterator[bytes]:
    """The WARC file of one archive, piece by piece, with a warcinfo record at its head."""
    yield _info(archive, date)
    for r in spark.read.schema(TABLE_SQL).parquet(path).where(F.col("archive") == archive).orderBy("seq", "chunk_no").toLocalIterator():
        yield bytes(r.head or b"") + bytes(r.data) + CLOSE * r.last


def parse(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], int, str]]:
    """(headers, bytes of the block, SHA-1 of the payload behind its HTTP headers) of each record of a WARC file.

    Blocks are read a piece at a time. Raises where a record is cut off or does not begin as one.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:20]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        left = size = int(headers["Content-Length"])
        digest = hashlib.sha1()
        if headers.get("Content-Type", "").startswith("application/http"):
            while left and (line := stream.readline(left)):
                left -= len(line)
                if not line.strip():
                    break
        while left:
            piece = stream.read(min(chunk, left))
            if not piece:
                raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut off")
            digest.update(piece)
            left -= len(piece)
        yield headers, size, digest.hexdigest()
