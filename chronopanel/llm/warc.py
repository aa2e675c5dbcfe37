"""Web archives as seekable Zstandard bundles.

``write_warc`` writes one record per row. Records are grouped into
independent frames; a file's footer lists the frames, and its index maps
each record id to (frame, offset inside the frame, length), so
``read_record`` decompresses one frame. Rows with equal payloads of at least
``min_bytes`` are stored once: the one with the smallest id is the
``response``, the others are ``revisit`` records that refer to it.

Defined cases: a null payload is an empty one; null ids sort after all
others, so a row without id is a response only where no row of its group has
an id; rows that repeat the smallest id are each a response; an empty table
writes no file; other columns are ignored. A record longer than a frame's
target has a frame of its own.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .seekable import SeekableReader, SeekableWriter
from .store import commit_file, filesystem, shared_folder, written

FRAME_BYTES = 1 << 18
DATE = "2000-01-01T00:00:00Z"  # the tables hold no capture time


def record_uri(row_id: int | None) -> str:
    return f"<urn:x-row:{'none' if row_id is None else row_id}>"


def _id_of(uri: str) -> int | None:
    tail = uri[len("<urn:x-row:"):-1]
    return None if tail == "none" else int(tail)


def record(row_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit's block keeps the HTTP header, so the
    length of the payload it stands for is known without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_uri(row_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if url is not None:
        lines.insert(3, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_uri(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record and its payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} fails its digest")
    return {"id": _id_of(fields["WARC-Record-ID"]), "type": fields["WARC-Type"], "length": length, "digest": digest,
            "refers_to": _id_of(fields["WARC-Refers-To"]) if revisit else None, "url": fields.get("WARC-Target-URI"),
            "payload": None if revisit else payload}


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _write_partition(folder: str, frame_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part, index, n = first.column("part")[0].as_py(), [], 0

        def fill(out):
            nonlocal n
            file, held, size = SeekableWriter(out), [], 0

            def flush():
                nonlocal held, size
                if held:
                    file.frame(b"".join(held))
                held, size = [], 0

            def every():
                yield first
                yield from batches

            for b in every():
                for row in b.to_pylist():
                    raw = record(row["id"], row["url"], row["payload"], base32(bytes.fromhex(row["hex"])), row["refers_to"])
                    if size and size + len(raw) > frame_bytes:
                        flush()
                    index.append(f"{'none' if row['id'] is None else row['id']}\t{len(file.frames)}\t{size}\t{len(raw)}")
                    held.append(raw)
                    size += len(raw)
                    n += 1
            flush()
            file.close("\n".join(index).encode())

        path = commit_file(folder, f"part-{part:06d}.warc.zst", fill)
        yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], names=["path", "n_records"])

    return write


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the bundles; returns the manifest (path, n_records).

    The rows meet their group's smallest id in one shuffle by digest. The
    groups are summed on the map side first, and a group that holds many
    rows is split by the adaptive skew join, so its rows are written by
    several tasks."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("hex", F.sha1("payload"))
    groups = (rows.where(F.octet_length("payload") >= min_bytes)
              .groupBy("hex").agg(F.min("id").alias("smallest"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and smallest is not null").select("hex", "smallest"))
    groups = written(groups, "warc-groups")
    told = (rows.join(groups, "hex", "left")
            .select(F.spark_partition_id().alias("part"), "id", "url", "payload", "hex",
                    F.when(F.coalesce(F.col("id") != F.col("smallest"), F.col("smallest").isNotNull()), F.col("smallest")).alias("refers_to")))
    return written(told.mapInArrow(_write_partition(folder, frame_bytes), "path string, n_records long"), "warc-manifest")


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column("path").to_pylist():
            fs, inner = filesystem(path)
            with fs.open_input_file(inner) as f:
                file = SeekableReader(f)
                rows, frame, plain = [], None, b""
                for line in file.index.decode().split("\n"):
                    _, k, at, size = line.split("\t")
                    if k != frame:
                        if rows:
                            yield _table(rows)
                        rows, frame, plain = [], k, file.frame(int(k))
                    rows.append(parse(plain[int(at): int(at) + int(size)]))
                if rows:
                    yield _table(rows)


def _table(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("length", pa.int64()),
                        ("digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every record: id, url, type, length and digest of its full payload,
    refers_to, payload (null for revisits). Digests and checksums are checked."""
    n = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(n, "path").mapInArrow(
        _read_files, "id long, url string, type string, length long, digest string, refers_to long, payload binary")


def read_record(path: str, row_id: int | None) -> dict | None:
    """One record of a bundle, by its id, decompressing only its frame."""
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as f:
        file = SeekableReader(f)
        for line in file.index.decode().split("\n"):
            key, k, at, size = line.split("\t")
            if key == ("none" if row_id is None else str(row_id)):
                return parse(file.frame(int(k))[int(at): int(at) + int(size)])
    return None


def warc_bundles(spark: SparkSession, pages: DataFrame) -> DataFrame:
    manifest = write_warc(pages, shared_folder(spark, "warc"))
    return read_warc(manifest).select(F.col("id").alias("page_id"), F.col("length").alias("payload_bytes"),
                                      F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


# SHA-1 in base 32: each of the 32 letters covers 5 of the 160 bits (20 hex
# digits hold 16 letters, so the digest is cut into two halves of 80 bits).
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS hex FROM p),
bits AS (SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', hex[i+1]) - 1) AS nib,
         min(page_id) OVER (PARTITION BY hex) AS lowest FROM d),
b AS (SELECT *, flatten(list_transform(nib, lambda x: [(x >> 3) & 1, (x >> 2) & 1, (x >> 1) & 1, x & 1])) AS bit FROM bits)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16*bit[5*i+1] + 8*bit[5*i+2] + 4*bit[5*i+3] + 2*bit[5*i+4] + bit[5*i+5]]), '') AS payload_digest,
  CASE WHEN page_id = lowest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> lowest THEN lowest END AS refers_to
FROM b
"""
