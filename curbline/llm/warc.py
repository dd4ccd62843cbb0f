"""WARC archives: revisit resolution and deduplicated rewriting.

Archives are read record by record as streams. Only headers are shuffled, by payload digest: of the
records of one payload the response with the smallest page_id stays, the others become revisits of it.
The archives are then read a second time beside the decisions for them, which are sorted as the records lie
in the file, and written anew: payloads go from file to file and never through a shuffle.

A file counts once the index lists it: tasks write under names of their own and emit an index row per
record, and Spark commits the rows of one attempt only. Files of lost attempts are never read.

Defined cases: a null html is an empty payload; payloads under ``SMALL`` bytes are never made revisits; a
null page_id comes last among equals and a null url leaves its header out; of repeated page_ids one is the
response and the others refer to it; a revisit whose original is in no archive stays as it is; line breaks in
a url are escaped; a page of any length is one record; an empty table gives no archives; further columns are
not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import cut
from curbline.session import work_dir

#: Payloads below this size cost less than a revisit record.
SMALL = 100
#: Payload bytes after which a new archive file begins.
ROLL_BYTES = 16_000_000
#: The capture time written where a table has none.
EPOCH = "1970-01-01T00:00:00Z"
#: Fixed value of the WARC standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = (
    "path string, position long, record_id string, record_type string, page_id long, url string, date string, "
    "payload_bytes long, payload_digest string, refers_to_record string"
)
NAMES = [field.split()[0] for field in HEADERS.split(", ")]
ARROW = pa.schema([(n, pa.int64() if f.endswith("long") else pa.string()) for n, f in zip(NAMES, HEADERS.split(", "))])


def open_folder(uri: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def header_value(value: object) -> str:
    return str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain_value(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def to_record(head: dict, fields: dict, block: bytes) -> bytes:
    """One WARC record: the fields it had, under what its new head says."""
    fresh = {
        "warc-type": head["record_type"],
        "warc-record-id": f"<{head['record_id']}>",
        "warc-date": head["date"] or EPOCH,
        "warc-target-uri": None if head["url"] is None else header_value(head["url"]),
        "x-page-id": head["page_id"],
        "warc-payload-digest": None if head["payload_digest"] is None else f"sha256:{head['payload_digest']}",
        "warc-refers-to": None if head["refers_to_record"] is None else f"<{head['refers_to_record']}>",
        "warc-profile": PROFILE if head["record_type"] == "revisit" else None,
        "content-length": len(block),
    }
    dropped = {"warc-block-digest", "warc-truncated"}  # of the old block
    lines = [f"{name}: {value}" for name, value in (fields | fresh).items() if value is not None and name not in dropped]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def from_stream(stream: BinaryIO) -> Iterator[tuple[dict, dict, bytes, bytes]]:
    """Head, all fields, HTTP head and payload of each record, as they lie in an unpacked archive.

    Records that are no response or revisit have their whole block for a payload, and no digest.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError("the archive ends inside a record")
        kind = fields["warc-type"]
        http, payload, length, digest = b"", block, len(block), None
        if kind in ("response", "revisit"):
            http, border, payload = block.partition(b"\r\n\r\n")
            http += border
            length, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if kind == "revisit":
            sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            length = int(sizes[0]) if sizes else None
            digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
        page, url, refers = (fields.get(name) for name in ("x-page-id", "warc-target-uri", "warc-refers-to"))
        head = {
            "record_id": fields["warc-record-id"].strip("<>"),
            "record_type": kind,
            "page_id": None if page is None else int(page),
            "url": None if url is None else plain_value(url),
            "date": fields.get("warc-date"),
            "payload_bytes": length,
            "payload_digest": digest,
            "refers_to_record": None if refers is None else refers.strip("<>"),
        }
        yield head, fields, http, payload


def read_archive(path: str) -> Iterator[tuple[dict, dict, bytes, bytes]]:
    """The records of one archive file, packed or not."""
    system, place = open_folder(path)
    with system.open_input_stream(place, compression=None, buffer_size=1 << 20) as raw:
        yield from from_stream(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw))


class ArchiveWriter:
    """Writes records to files of a folder, a new one after ``ROLL_BYTES``, and keeps their headers."""

    def __init__(self, folder: str, level: int) -> None:
        self.folder, self.level = folder, level
        self.task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        self.files, self.file, self.index = 0, None, []

    def write(self, head: dict, fields: dict, block: bytes) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{self.task}-{self.files:05d}.warc.gz"
            system, place = open_folder(self.path)
            system.create_dir(place.rpartition("/")[0], recursive=True)
            self.file = system.open_output_stream(place, compression=None, buffer_size=1 << 20)
            self.files, self.held, self.position = self.files + 1, 0, 0
        packer = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # a gzip member for each record
        self.file.write(packer.compress(to_record(head, fields, block)) + packer.flush())
        self.index.append(head | {"path": self.path, "position": self.position})
        self.position, self.held = self.position + 1, self.held + len(block)
        if self.held >= ROLL_BYTES:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None

    def taken(self) -> pa.RecordBatch:
        rows, self.index = self.index, []
        return pa.RecordBatch.from_pylist(rows, ARROW)


def fresh_id() -> str:
    return f"urn:uuid:{uuid.uuid4()}"


def write_pages(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write a response record for each ``page_id, url, html`` row; the index of the records."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, level)
        for batch in batches:
            for row in range(batch.num_rows):
                page, url, html = (column[row].as_py() for column in batch.columns)
                payload = html or b""
                head = {
                    "record_id": fresh_id(),
                    "record_type": "response",
                    "page_id": page,
                    "url": url,
                    "date": EPOCH,
                    "payload_bytes": len(payload),
                    "payload_digest": hashlib.sha256(payload).hexdigest(),
                    "refers_to_record": None,
                }
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                writer.write(head, {"content-type": "application/http; msgtype=response"}, http.encode() + payload)
            yield writer.taken()
        writer.close()

    rows = pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("binary"))
    return cut(rows.mapInArrow(pack, HEADERS), "warc-index")


def read_headers(paths: DataFrame) -> DataFrame:
    """Headers of all records of the archives in column ``path``; sizes and digests of the payloads read."""
    files = cut(paths.select("path").distinct(), "warc-files")
    tasks = max(1, min(files.count(), 8 * paths.sparkSession.sparkContext.defaultParallelism))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows = []
                for position, (head, *_) in enumerate(read_archive(path)):
                    rows.append(head | {"path": path, "position": position})
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, ARROW)

    return cut(files.repartition(tasks).mapInArrow(scan, HEADERS), "warc-headers")


def resolve(headers: DataFrame, small: int = SMALL) -> DataFrame:
    """The headers with what each record becomes: ``becomes`` and ``original`` (a record_id)."""
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("record_id"))
    originals = cut(
        headers.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= small))
        .groupBy("payload_digest")
        .agg(F.min_by("record_id", order).alias("original")),
        "warc-originals",
    )
    found = headers.join(originals, "payload_digest", "left")
    large = F.coalesce(F.col("payload_bytes") >= small, F.lit(False))
    repeated = large & (F.col("original") != F.col("record_id"))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        *NAMES,
        F.when(revisit | F.coalesce(repeated, F.lit(False)), "revisit").otherwise(F.col("record_type")).alias("becomes"),
        F.when(revisit, F.coalesce("original", "refers_to_record")).when(repeated, F.col("original")).alias("original"),
    )


def rewrite(decisions: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write the archives anew by the decisions, with fresh headers; the index of the new records."""
    most = 4 * decisions.sparkSession.sparkContext.defaultParallelism
    tasks = 2 * max(1, min(decisions.select("path").distinct().count(), most))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, level)
        path, records = None, iter(())
        for batch in batches:
            for choice in batch.to_pylist():
                if choice["path"] != path:
                    path, records = choice["path"], read_archive(choice["path"])
                head, fields, http, payload = next(records)
                if head["record_id"] != choice["record_id"]:
                    raise ValueError(f"the decisions do not fit {path}")
                fresh = head | {"record_type": choice["becomes"], "refers_to_record": choice["original"]}
                writer.write(fresh, fields, http if choice["becomes"] == "revisit" else http + payload)
            yield writer.taken()
        writer.close()

    ordered = (
        decisions.select("path", "position", "record_id", "becomes", "original")
        .repartition(tasks, "path")
        .sortWithinPartitions("path", "position")
    )
    return cut(ordered.mapInArrow(pack, HEADERS), "warc-index")


def deduplicate_archives(paths: DataFrame, folder: str, small: int = SMALL) -> DataFrame:
    """Write deduplicated copies of the archives in column ``path``; the index of the new records.

    Records keep their ids, so that a revisit of another collection still finds its original.
    """
    return rewrite(resolve(read_headers(paths), small), folder)


def with_originals(headers: DataFrame) -> DataFrame:
    """Headers with the revisits' payload size and digest, and the original's page_id, from the original."""
    original = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("original"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"),
        F.col("payload_digest").alias("original_digest"),
    )
    revisits = headers.filter("record_type = 'revisit'").join(
        original, F.col("refers_to_record") == F.col("original"), "left"
    )
    plain = headers.filter("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = [c for c in NAMES if not c.startswith("payload")]
    return plain.select(*columns, "payload_bytes", "payload_digest", "refers_to").unionByName(
        revisits.select(
            *columns,
            F.coalesce("original_bytes", "payload_bytes").alias("payload_bytes"),
            F.coalesce("original_digest", "payload_digest").alias("payload_digest"),
            "refers_to",
        )
    )


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Pages written as archives, deduplicated, and read back: a row for each page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = write_pages(pages, work_dir(spark, "warc-raw"))
    slim = deduplicate_archives(raw, work_dir(spark, "warc-slim"))
    return with_originals(read_headers(slim)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = f"""
with sized as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest
  from pages
), firsts as (
  select *, case when payload_bytes >= {SMALL}
    then min(page_id) over (partition by payload_digest) else page_id end as first_id
  from sized
)
select page_id, payload_bytes, payload_digest,
  case when first_id = page_id then 'response' else 'revisit' end as record_type,
  case when first_id <> page_id then first_id end as refers_to
from firsts
"""
