"""WARC archives with revisit resolution.

1. Headers (id, URL, payload length, SHA-1) are taken from the pages; only
   they are shuffled, by payload digest, to find the first capture of each
   payload.  The per-digest minimum is combined before the shuffle, so a
   payload that a third of all pages share is no hot key.
2. Later captures become revisit records: the list of them (headers only) is
   written once and joined to the pages.
3. Each task writes its pages as gzip members (one per record) of archives
   of bounded size in the shared folder, with fresh headers.  File names,
   record ids and bytes depend on the rows alone, so a repeated attempt
   writes the same file again.
4. The archives are read back as streams, record by record; the payloads'
   digests are computed again, and revisits are joined to the responses they
   refer to by record id.

Defined cases: a null payload is empty; equal payloads under the least size
are all responses; a row with a null id, and rows repeated under one id, stay
responses when their id is the payload's smallest (a null id refers to
nothing and nothing refers to it); a null URL is written as an empty one.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import make_folder, publishing, resolve, stored, table_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of Spark's base 32 and the letters of the standard's alphabet.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Date of the records when the caller gives none.
DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 256 << 20

READ_SCHEMA = (
    "record_id string, record_type string, page_id long, uri string, payload_bytes long, payload_digest string, "
    "refers_to_id string, archive string"
)


def digest32(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary column."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), DIGITS, LETTERS)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        digest32(payload).alias("payload_digest"),
    )


def revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Captures whose payload an earlier capture (smaller id) has: page_id, payload_digest, original, original_url."""
    wide = headers.filter(F.col("payload_bytes") >= least_bytes)
    first = (
        wide.filter(F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.min(F.struct("page_id", "url")).alias("o"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", F.col("o.page_id").alias("original"), F.col("o.url").alias("original_url"))
    )
    return (
        wide.select("page_id", "payload_digest")
        .join(first, "payload_digest")
        .filter(F.col("page_id") > F.col("original"))
        .distinct()
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record(page_id, url, payload: bytes, digest: str, original, original_url, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = original is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(original, digest)}",
            f"WARC-Refers-To-Target-URI: {_clean(original_url or '')}",
            f"WARC-Refers-To-Date: {date}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = DATE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write deduplicated archives to ``folder``; returns the list of them (archive, records, bytes)."""
    make_folder(folder)
    rows = captures(pages, id_col, url_col, payload_col)
    later = stored(revisits(rows.drop("payload"), least_bytes), "revisits")
    # a null id never equals one of `later`, so such rows stay responses
    rows = rows.join(later, ["page_id", "payload_digest"], "left")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        records = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        done, nth = next(records, None), 0
        while done is not None:
            name, n, size = f"part-{task:05d}-{nth:05d}.warc.gz", 0, 0
            with publishing(f"{folder}/{name}") as out:
                while done is not None and (n == 0 or size < archive_bytes):
                    z = zlib.compressobj(3, zlib.DEFLATED, 31)
                    raw = _record(
                        done["page_id"], done["url"], done["payload"], done["payload_digest"],
                        done["original"], done["original_url"], date,
                    )
                    member = z.compress(raw) + z.flush()
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    done = next(records, None)
            nth += 1
            yield pa.RecordBatch.from_pylist([{"archive": name, "records": n, "bytes": size}])

    return stored(rows.mapInArrow(archive, "archive string, records long, bytes long"), "archives")


def parse(stream) -> Iterator[dict]:
    """Records of an uncompressed WARC stream: headers (lower-case names) and block."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends inside a record")
        yield head | {"block": block}


def _row(rec: dict, archive: str) -> dict:
    http, _, payload = rec["block"].partition(b"\r\n\r\n")
    digest = rec["warc-payload-digest"].removeprefix("sha1:")
    if rec["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"{rec['warc-record-id']}: payload digest {found}, header {digest}")
        size = len(payload)
    else:
        fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
    page = rec.get("x-page-id")
    return {
        "record_id": rec["warc-record-id"], "record_type": rec["warc-type"],
        "page_id": None if page is None else int(page), "uri": rec.get("warc-target-uri"),
        "payload_bytes": size, "payload_digest": digest, "refers_to_id": rec.get("warc-refers-to"), "archive": archive,
    }


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder`` (``READ_SCHEMA``); each archive is read as a stream by one task."""
    # only paths are taken here; the content column is not read
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.strip().split(" ")[0] for c in READ_SCHEMA.split(",")]
        kinds = [pa.int64() if c.strip().endswith("long") else pa.string() for c in READ_SCHEMA.split(",")]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for uri in (u for b in batches for u in b.column("path").to_pylist()):
            fs, path = resolve(uri)
            with fs.open_input_stream(path, compression=None) as raw:
                rows = []
                for rec in parse(io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)):
                    rows.append(_row(rec, path.rsplit("/", 1)[1]))
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(records, READ_SCHEMA)


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``refers_to``, the page of the response that a revisit refers to."""
    responses = (
        records.filter("record_type = 'response' and page_id is not null")
        .select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
        .distinct()
    )
    again = records.filter("record_type = 'revisit'").join(responses, "refers_to_id", "left")
    plain = records.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(again)


def deduplicate(pages: DataFrame, least_bytes: int = 0, **columns) -> DataFrame:
    """Write the pages' archives into the shared folder, read them back and resolve the revisits."""
    spark = pages.sparkSession
    folder = table_path(spark, "warc")
    write(pages, folder, least_bytes=least_bytes, **columns)
    return resolved(stored(read(spark, folder), "warc-records"))
