"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm.common import new_path, written

# fixed values of the seekable format: a skippable frame that ends in a footer
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, file string, frame_at long, frame_bytes long, record_at long, record_bytes long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers of one record, its payload, and the payload's length as the HTTP head states it."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda name: int(x) if (x := headers.get(name, "")[len("<urn:page:") : -1]) else None
    if headers["WARC-Type"] == "response" and (len(payload) != stated or f"sha1:{payload_digest(payload)}" != headers["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return {
        "page_id": number("WARC-Record-ID"), "payload_bytes": stated, "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": headers["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *frame) for frame in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, plain bytes) of each frame, read from the end of the bundle only."""
    store, path = arrow_fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        total = f.size()
        count, _, magic = struct.unpack("<IBI", f.read_at(9, total - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {uri}")
        sizes = struct.unpack(f"<{2 * count}I", f.read_at(8 * count, total - 9 - 8 * count))
    out, at = [], 0
    for packed, plain in zip(sizes[::2], sizes[1::2], strict=True):
        out.append((at, packed, plain))
        at += packed
    return out


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = 1 << 20, level: int = 3) -> DataFrame:
    """One bundle per non-empty partition of ``records`` (page_id, url, payload, refers_to, revisit); returns the index.

    Records fill frames of ``frame_bytes`` plain bytes or one longer record; every frame is compressed by itself. A retried
    task writes a bundle of another name, and the index, which Spark commits, names the one that counts.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        packer, out = zstandard.ZstdCompressor(level=level, write_checksum=True), None
        frames: list[tuple[int, int]] = []
        plain, places, at = bytearray(), [], 0

        def flush() -> pd.DataFrame:
            nonlocal at, plain, places
            packed = packer.compress(bytes(plain))
            out.write(packed)
            frames.append((len(packed), len(plain)))
            rows = pd.DataFrame([(p, name, at, len(packed), *where) for p, *where in places], columns=["page_id", "file", "frame_at", "frame_bytes", "record_at", "record_bytes"])
            rows["page_id"] = rows["page_id"].astype("Int64")
            at, plain, places = at + len(packed), bytearray(), []
            return rows

        for batch in batches:
            for page, url, payload, to, revisit in zip(batch["page_id"], batch["url"], batch["payload"], batch["refers_to"], batch["revisit"], strict=True):
                page, to = (None if pd.isna(x) else int(x) for x in (page, to))
                record = warc_record(page, url, payload, to, revisit)
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                if plain and len(plain) + len(record) > frame_bytes:
                    yield flush()
                places.append((page, len(plain), len(record)))
                plain += record
        if out is not None:
            if plain:
                yield flush()
            out.write(seek_table(frames))
            out.close()

    # ids stay exact beside nulls: they travel as text
    texts = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return written(texts.mapInPandas(write, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the index, a frame at a time: seek, decompress that frame, and cut out its records."""
    out = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    columns = [c.split()[0] for c in out.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for file, at, size, places in zip(batch["file"], batch["frame_at"], batch["frame_bytes"], batch["places"], strict=True):
                with store.open_input_file(f"{base}/{file}") as f:
                    plain = unpacker.decompress(f.read_at(size, at))
                rows = [parse_record(plain[p["record_at"] : p["record_at"] + p["record_bytes"]]) for p in places]
                frame = pd.DataFrame([[r[c] for c in columns] for r in rows], columns=columns)
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    frames = index.groupBy("file", "frame_at", "frame_bytes").agg(F.collect_list(F.struct("record_at", "record_bytes")).alias("places"))
    return frames.mapInPandas(read, out)


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0, **settings) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC bundles and return their index.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest id is a response and the others
    revisit it. Ids are compared on digests, folded per task, and only the revisits are joined back, by page, so a payload that
    a third of all pages share meets in no task. A null html is an empty payload, a null url has no target header; a null
    id is smaller than any other and revisits if its payload is shared; rows that repeat an id and its payload have
    one role, so copies of the largest are all responses. An empty table writes no bundle.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    roles = pages.where(F.octet_length("payload") >= least_bytes).select("page_id", "digest")
    largest = roles.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1 AND refers_to IS NOT NULL")
    revisits = roles.join(largest, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = revisits.groupBy(F.col("page_id").alias("page"), F.col("digest").alias("same")).agg(F.max("refers_to").alias("refers_to"))
    joined = pages.join(revisits, F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("same")), "left")
    return write_bundles(joined.select("page_id", "url", "payload", "refers_to", F.col("refers_to").isNotNull().alias("revisit")), folder, **settings)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    return read_bundles(archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder)
