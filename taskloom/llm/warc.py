"""WARC archives with revisit records in place of repeated payloads.

Headers alone (page_id, digest, size) are shuffled by payload digest to find the first page of each payload; pages
then learn by page_id whether they revisit another one, and each task writes one archive with fresh headers. Read
back, revisit records are joined to their original responses, so that every page has its payload again.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, materialize, reading, scratch, slices, writing

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC 1.1 standard


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; with refers_to a revisit record, whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip stream, one record in memory at a time."""
    with gzip.open(stream) as text:
        while line := text.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"a record begins with {line[:40]!r}")
            head = {}
            while (line := text.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(":")
                head[name.lower()] = value.strip()
            block = text.read(int(head["content-length"]))
            if hashlib.sha256(block).hexdigest() != head["warc-block-digest"].removeprefix("sha256:"):
                raise ValueError(f"block of {head['warc-record-id']} is damaged")
            text.read(4)
            yield head, block


def find_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload (of at least least_bytes) an earlier page has."""
    headers = pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size")).where(F.col("size") >= least_bytes).select("page_id", "digest")
    first = headers.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").select("digest", "refers_to")
    return headers.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write `html` of pages (page_id, url, html, any others) as gzip WARC files under folder; returns path, n_records.

    Null html counts as empty, a null url as an empty one. Payloads of fewer than least_bytes are always responses.
    Of equal payloads the smallest page_id is the response; rows that repeat that page_id are responses too. A null
    page_id is never referred to, and revisits if a page with an id has its payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    revisits = find_revisits(rows, least_bytes).select(F.col("page_id").alias("r_page_id"), F.col("digest").alias("r_digest"), "refers_to")
    headed = rows.withColumn("digest", F.sha2("payload", 256))
    full = headed.join(revisits, F.col("page_id").eqNullSafe(F.col("r_page_id")) & (F.col("digest") == F.col("r_digest")), "left").select("page_id", "url", "payload", "digest", "refers_to")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with writing(path) as out:
            for held in (h for b in parts for h in slices(b, 8 << 20, "payload")):
                for row in zip(*(held.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    out.write(gzip.compress(build_record(*row, date), 5, mtime=0))
                    n += 1
        yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64())})

    return materialize(full.mapInArrow(write, "path string, n_records long"), f"{folder}-manifest")


#: Columns of a record as it is read.
RECORD = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "url": pa.string()}


def _records(spark: SparkSession, manifest: DataFrame, payloads: bool) -> DataFrame:
    """A row for each record of the archives; payloads: with the block of each response (null for a revisit)."""
    todo = manifest.where("n_records > 0").select("path")
    kinds = RECORD | ({"payload": pa.binary()} if payloads else {})

    def parse(head, block):
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = head["warc-type"] == "revisit"
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        digest = stated if revisit else hashlib.sha256(payload).hexdigest()
        if digest != stated:
            raise ValueError(f"payload of {head['warc-record-id']} is damaged")
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")) if revisit else len(payload)
        ids = (int(head[k]) if k in head else None for k in ("x-page-id", "x-refers-to-page-id"))
        row = (*ids, size, digest, head["warc-type"], head["warc-target-uri"])
        return (*row, None if revisit else payload) if payloads else row

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in parts for p in b.column("path").to_pylist()):
            with reading(path) as stream:
                rows = (parse(head, block) for head, block in read_records(stream))
                for held in batches(rows, 8 << 20, lambda row: 200 + (len(row[6] or b"") if payloads else 0)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.values())], list(kinds))

    schema = "page_id long, refers_to long, payload_bytes long, payload_digest string, record_type string, url string"
    return todo.repartition(max(1, manifest.count())).mapInArrow(read, schema + (", payload binary" if payloads else ""))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record of the archives.

    Sizes and digests of responses are taken from the payload itself, those of revisits from their headers. A file is
    read record by record and given on in batches of some 8 MB (more where one payload has more).
    """
    return _records(spark, manifest, False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def resolve_revisits(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload of every record; a revisit has the payload of the response it refers to.

    Revisits are joined to responses by digest and page, narrow rows first: only responses that a revisit names are
    joined, and each of those once for each of its revisits. A revisit whose response is in none of the archives has a
    null payload, as has one that names a page of another digest. No records: no rows.
    """
    rows = materialize(_records(spark, manifest, True), scratch(spark, "records"))
    revisits = rows.where("record_type = 'revisit'").select("page_id", "url", "record_type", "refers_to", F.col("payload_digest").alias("digest"))
    named = revisits.select(F.col("refers_to").alias("n_page"), F.col("digest").alias("n_digest")).distinct()
    responses = rows.where("record_type = 'response'").select(F.col("page_id").alias("o_page"), F.col("payload_digest").alias("o_digest"), "payload")
    # rows that repeat a page_id with one payload are equal here, one of them is enough
    originals = responses.join(named, (F.col("o_page") == F.col("n_page")) & (F.col("o_digest") == F.col("n_digest")), "left_semi").dropDuplicates(["o_page", "o_digest"])
    met = revisits.join(originals, (F.col("refers_to") == F.col("o_page")) & (F.col("digest") == F.col("o_digest")), "left")
    columns = ("page_id", "url", "record_type", "refers_to", "payload")
    return rows.where("record_type = 'response'").select(*columns).unionAll(met.select(*columns))


def archive_pages(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write pages as archives in the shared space and read them back, one row per page."""
    folder = scratch(spark, "warc")
    return read_archives(spark, write_archives(spark, pages, folder, **options))
