"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent frames of several records each, and a seek table in a
skippable frame at its end. The index maps a record to its frame and to where it starts
in the frame's records, so that one record costs one frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import checkpointed, new_folder, stored, table
from .files import located, published

#: Equal payloads of at least so many bytes are kept once.
LEAST_REVISIT = 1000
#: Record bytes after which a frame ends.
FRAME_BYTES = 1 << 18
#: Digests of repeated payloads are broadcast up to this many; beyond, they are shuffled.
BROADCAST_DIGESTS = 500_000
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Fixed values of the archive format.
VERSION, BREAK = b"WARC/1.1", b"\r\n"
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _headers(pairs: list[tuple[str, str]]) -> bytes:
    return b"".join(f"{name}: {value}".encode() + BREAK for name, value in pairs)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    page = name.removeprefix("<urn:page:").removesuffix(">")
    return None if page == "null" else int(page)


def record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """A response record, or a revisit record without the payload if refers_to is set."""
    http = b"HTTP/1.1 200 OK" + BREAK + _headers([
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size)),
    ]) + BREAK
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        head += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", SAME)]
    return VERSION + BREAK + _headers(head) + BREAK + block + BREAK + BREAK


def parsed(data: memoryview) -> dict:
    """What the record that data starts with says of its page. The digest and the size of
    a response are those of the payload that is there."""
    head, body = _split(data)
    block = body[:int(head["Content-Length"])]
    http, payload = _split(block)
    revisit = head["WARC-Type"] == "revisit"
    return {
        "page_id": _page(head["WARC-Record-ID"]),
        "payload_bytes": int(http["Content-Length"]) if revisit else len(payload),
        "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit
        else hashlib.sha1(payload).hexdigest(),
        "record_type": head["WARC-Type"],
        "refers_to": _page(head["WARC-Refers-To"]) if revisit else None,
    }


def _split(data: memoryview) -> tuple[dict[str, str], memoryview]:
    """The headers before the first empty line, and what follows it."""
    size = 1 << 12
    while (end := bytes(data[:size]).find(BREAK + BREAK)) < 0:
        if size >= len(data):
            raise ValueError("a record's head has no end")
        size *= 4
    lines = bytes(data[:end]).decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), data[end + 4:]


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packer = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        table, held, rows, size = [], [], [], 0
        with published(f"{folder}/{part:06d}.warc.zst") as out:

            def flush() -> pa.RecordBatch:
                raw = b"".join(held)
                packed = packer.compress(raw)
                out.write(packed)
                table.append((len(packed), len(raw)))
                batch = pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * len(rows), pa.int32()),
                    "frame": pa.array([len(table) - 1] * len(rows), pa.int32()),
                    "page_id": pa.array([x[0] for x in rows], pa.int64()),
                    "start": pa.array([x[1] for x in rows], pa.int64()),
                    "size": pa.array([x[2] for x in rows], pa.int64()),
                })
                held.clear()
                rows.clear()
                return batch

            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "payload_bytes", "digest", "refers_to",
                )]
                for row in zip(*columns, strict=True):
                    data = record(*row)
                    rows.append((row[0], size, len(data)))
                    held.append(data)
                    size += len(data)
                    if size >= FRAME_BYTES:
                        yield flush()
                        size = 0
            if held:
                yield flush()
            entries = b"".join(struct.pack("<II", *x) for x in table)
            footer = struct.pack("<IBI", len(table), 0, SEEKABLE)
            out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)

    return write


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes page_id (long), url and html of pages as bundles; returns the index: part,
    frame, page_id, and start and size in the frame's records.

    A null html is empty, a null url too. Of equal payloads of LEAST_REVISIT bytes or more,
    the rows of the largest page_id are responses, the others refer to it; a null page_id
    is smaller than all, and payloads with null ids only are all responses."""
    body = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    body = body.withColumn("digest", F.sha1("payload")).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    latest = checkpointed(
        body.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    if latest.count() <= BROADCAST_DIGESTS:
        latest = F.broadcast(latest)
    ready = body.join(latest, ["digest", "payload_bytes"], "left").withColumn(
        "refers_to", F.when(~F.col("latest").eqNullSafe(F.col("page_id")), F.col("latest"))
    ).select(
        "page_id", "url", "payload_bytes", "digest", "refers_to",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
    )
    index = ready.mapInArrow(
        _writer(folder), "part int, frame int, page_id long, start long, size long"
    )
    return stored(index, "warc-index")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, path, file, spots, here, data = zstandard.ZstdDecompressor(), None, None, [], None, None
        for batch in batches:
            out = []
            for part, frame, start, size in zip(*(
                batch.column(c).to_pylist() for c in ("part", "frame", "start", "size")
            ), strict=True):
                if (part, frame) != here:
                    if part != path:
                        if file:
                            file.close()
                        system, name = located(f"{folder}/{part:06d}.warc.zst")
                        file, path = system.open_input_file(name), part
                        spots = seek_table(file)
                    at, packed = spots[frame]
                    file.seek(at)
                    here, data = (part, frame), memoryview(unpacker.decompress(file.read(packed)))
                out.append(parsed(data[start:start + size]))
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()),
                ("refers_to", pa.int64()),
            ]))

    return read


def seek_table(file) -> list[tuple[int, int]]:
    """(offset, packed size) of the frames of an open bundle."""
    end = file.size()
    file.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(end - 9 - 8 * count)
    frames, at = [], 0
    for packed, _ in struct.iter_unpack("<II", file.read(8 * count)):
        frames.append((at, packed))
        at += packed
    return frames


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index name; each frame is unpacked once."""
    ordered = index.repartition("part", "frame").sortWithinPartitions("part", "frame", "start")
    return ordered.mapInArrow(
        _reader(folder),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    return read(write(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder), folder)


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT payload_digest, max(page_id) AS latest FROM p
      WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN latest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM p LEFT JOIN l USING (payload_digest)
"""
