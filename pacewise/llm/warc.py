"""WARC archives: one gzip member per record, and a reader that goes through them in order.

Tasks write archives to a folder that driver and executors share. A payload that
occurs again is written as a revisit record, which has the headers and digests but
not the payload. The reader inflates member by member in small steps, takes each
block by its Content-Length and compares its digests.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewise.llm.store import shared_folder, ship_package, stored

#: An archive is closed when it has reached this size.
ARCHIVE_BYTES = 64 << 20
#: Shorter payloads are never written as revisits.
REVISIT_BYTES = 100
READ_BYTES = 64 << 10
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of pages go by this name and their id.
NAME = "urn:page"
WRITTEN = "path string, n_records long, n_bytes long"
RECORDS = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


class Record(NamedTuple):
    record_id: str
    record_type: str
    target_uri: str | None
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def record_name(page_id: object) -> str:
    """The record's name: what can't stand in a URI is percent-coded, no id leaves it off."""
    return NAME if page_id is None else f"{NAME}:{quote(str(page_id), safe='')}"


def record_bytes(
    record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None = None
) -> bytes:
    """One record as a gzip member; with `refers_to` a revisit without the payload."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # White space and control characters would break the header.
        head.append(f"WARC-Target-URI: {re.sub(r'[\s\x00-\x1f\x7f%]', lambda m: quote(m[0]), url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return squeeze.compress(data) + squeeze.flush()


def members(file: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a file, each as its inflated pieces, read on demand."""
    rest = file.read(READ_BYTES)

    def pieces() -> Iterator[bytes]:
        nonlocal rest
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            if not rest:
                rest = file.read(READ_BYTES)
                if not rest:
                    raise ValueError("the archive ends inside a record")
            piece = inflate.decompress(rest, READ_BYTES)
            rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            if piece:
                yield piece

    while rest or (rest := file.read(READ_BYTES)):
        member = pieces()
        yield member
        for _ in member:
            pass


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _until_blank(pieces: Iterator[bytes], held: bytes) -> tuple[bytes, bytes]:
    while (end := held.find(b"\r\n\r\n")) < 0:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError("a record has no end of its header")
        held += piece
    return held[:end], held[end + 4 :]


def read_record(pieces: Iterator[bytes], with_payload: bool = True) -> Record:
    """Parse one member; its block and payload must have the digests that the header says."""
    raw, held = _until_blank(pieces, b"")
    if not raw.startswith(b"WARC/"):
        raise ValueError("a member is no WARC record")
    head = _headers(raw)
    missing = int(head["content-length"])
    block = hashlib.sha256()

    def framed() -> Iterator[bytes]:
        nonlocal held, missing
        while missing:
            held = held or next(pieces, b"")
            if not held:
                raise ValueError("a block is shorter than its Content-Length")
            piece, held = held[:missing], held[missing:]
            missing -= len(piece)
            block.update(piece)
            yield piece

    body = framed()
    http, first = _until_blank(body, b"")
    payload, kept, size = hashlib.sha256(), [], 0
    while first is not None:
        payload.update(first)
        size += len(first)
        if with_payload:
            kept.append(first)
        first = next(body, None)
    if (held + b"".join(pieces)) != b"\r\n\r\n":
        raise ValueError("a record does not end after its block")
    revisit = head["warc-type"] == "revisit"
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    if head["warc-block-digest"] != f"sha256:{block.hexdigest()}":
        raise ValueError(f"block digest of {head['warc-record-id']} differs")
    if not revisit and payload.hexdigest() != digest:
        raise ValueError(f"payload digest of {head['warc-record-id']} differs")
    full = int(_headers(http)["content-length"])
    if not revisit and size != full:
        raise ValueError(f"payload length of {head['warc-record-id']} differs")
    uri, refers = head.get("warc-target-uri"), head.get("warc-refers-to")
    return Record(
        head["warc-record-id"].strip("<>"),
        head["warc-type"],
        None if uri is None else unquote(uri),
        None if refers is None else refers.strip("<>"),
        full,
        digest,
        b"".join(kept) if with_payload and not revisit else None,
    )


def _mounted(folder: str) -> str:
    path = re.sub(r"^file:(//)?(?=/)", "", folder)
    if "://" in path:
        raise ValueError(f"archives need a folder that all machines mount, not {folder}")
    return path


def first_copies(rows: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, digest) that revisit an earlier one, with its id as refers_to.

    Groups of equal payloads are found by partial aggregation over (id, digest, size).
    """
    slim = rows.select("page_id", "digest", "payload_bytes")
    first = (
        slim.where(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("first_digest"), "refers_to")
    )
    return (
        slim.join(first, F.col("digest") == F.col("first_digest"))
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
        .select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to")
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record for every row to new archives in `folder`: path, n_records, n_bytes.

    The record with the smallest id of those with an equal payload of REVISIT_BYTES or
    more is a response, the others revisit it; so are, but for its own repetitions, rows
    without an id, and where no row has one, all are responses. A null payload is empty.
    Archives are named by task attempt and the result lists those of the attempts that
    counted, so a lost executor costs its tasks and nothing else.
    """
    spark, path = pages.sparkSession, _mounted(folder)
    ship_package(spark)
    html = F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        html.alias("payload"),
        F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
    )
    again = stored(first_copies(rows), "revisits")
    ready = rows.join(
        again,
        F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")),
        "left",
    ).select("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        os.makedirs(path, exist_ok=True)
        file, done = None, []

        def close() -> None:
            done.append((file.name, records, file.tell()))
            file.close()

        for batch in batches:
            for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):05d}"
                    file, records = open(f"{path}/{name}.warc.gz", "xb"), 0
                file.write(
                    record_bytes(
                        record_name(page_id),
                        url,
                        payload,
                        digest,
                        None if refers is None else record_name(refers),
                    )
                )
                records += 1
                if file.tell() >= ARCHIVE_BYTES:
                    close()
                    file = None
        if file is not None:
            close()
        columns = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["path", "n_records", "n_bytes"],
        )

    return stored(ready.mapInArrow(write, WRITTEN), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives in column `path`, each archive read once from its begin.

    Columns as in RECORDS; payload is null for revisits and without `with_payload`. A
    broken archive or a wrong digest ends the job with an error that names the record.
    """
    ship_package(archives.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string()))
             for n, t in (x.split() for x in RECORDS.split(", "))]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                with open(path, "rb") as file:
                    for member in members(file):
                        held.append(read_record(member, with_payload)._asdict())
                        size += held[-1]["payload_bytes"] if with_payload else 100
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    spread = archives.select("path").repartition(
        int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path"
    )
    return spread.mapInArrow(read, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write `pages`, read the archives back, and return what they say of each page.

    page_id, payload_bytes, payload_digest, record_type, refers_to and target_uri; ids
    have the type that they had. An empty table gives an empty result.
    """
    folder = folder or shared_folder(spark, "warc")
    kind = pages.schema["page_id"].dataType

    def named(c: str) -> Column:
        """The id that follows the first name, coded by record_name(); null without one."""
        coded = F.substring(c, len(NAME) + 2, 1 << 30)
        return F.when(F.col(c).startswith(f"{NAME}:"), F.url_decode(coded)).cast(kind)

    return read_archives(write_archives(pages, folder), with_payload=False).select(
        named("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        named("refers_to").alias("refers_to"),
        "target_uri",
    )
