"""WARC records in ZIP-packaged archives, written by tasks and range-read without extraction.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` (one gzip
member per WARC record) and ``indexes/index.cdxj`` (a JSON line per record with
its offset and length).  Each writing task streams the rows of its partition
into archives of about ``archive_bytes`` under a folder that all executors
share, by any URI that pyarrow's file systems know (file, hdfs, s3, gs).  File
names are unique per attempt and only those listed in the written manifest are
read, so a retried or speculative task leaves at most an unlisted file.

Reading parses the end record, the ZIP64 locator and end record and the
central directory from the file's tail, finds the stored members, reads the
index, and turns it into ranges of neighbouring records that Spark deals out;
a task fetches its ranges with one read each.

Equal payloads are found by their SHA-1 and length with a partial aggregation;
the join back splits hot payloads.

Defined results: a null payload is empty; the largest id of a group of equal
payloads is the response (all rows that tie at it are), a null id is smaller
than any other; payloads under ``min_revisit_bytes`` are all responses; an
empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm.passages import stored
from caliper.session import scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
RECORD = "id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight groups of 20 bits, each four digits of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# --- ZIP -------------------------------------------------------------------------------------------------------

class ZipWriter:
    """Stored members streamed to a sink that only appends; ZIP64 fields where sizes ask for them or ``zip64`` is set."""

    def __init__(self, sink, zip64: bool = False):
        self.sink, self.at, self.zip64, self.entries = sink, 0, zip64, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.begun, self.crc, self.size = name.encode(), self.at, 0, 0
        # sizes follow in a data descriptor (flag bit 3) and in the central directory
        self._put(struct.pack("<4s5H3I2H", b"PK\3\4", 45, 8, 0, 0, 33, 0, 0, 0, len(self.name), 0) + self.name)

    def write(self, data: bytes) -> None:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._put(data)

    def end(self) -> None:
        wide = "Q" if self.size > 0xFFFFFFFE else "I"
        self._put(struct.pack(f"<4sI2{wide}", b"PK\7\x08", self.crc, self.size, self.size))
        self.entries.append((self.name, self.crc, self.size, self.begun))

    def close(self) -> None:
        first = self.at
        for name, crc, size, begun in self.entries:
            big = self.zip64 or size > 0xFFFFFFFE or begun > 0xFFFFFFFE
            extra = struct.pack("<2H3Q", 1, 24, size, size, begun) if big else b""
            small = (0xFFFFFFFF,) * 3 if big else (size, size, begun)
            self._put(struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 8, 0, 0, 33, crc, small[0], small[1],
                                  len(name), len(extra), 0, 0, 0, 0, small[2]) + name + extra)
        length, n = self.at - first, len(self.entries)
        if self.zip64 or first > 0xFFFFFFFE or length > 0xFFFFFFFE or n > 0xFFFE:
            at = self.at
            self._put(struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, length, first))
            self._put(struct.pack("<4sIQI", b"PK\6\7", 0, at, 1))
            n, length, first = 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF
        self._put(struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, n, n, length, first, 0))


def zip_members(read_at, size: int) -> dict[str, tuple[int, int]]:
    """``name -> (offset of its bytes, length)`` of the stored members, from ``read_at(offset, length)``."""
    tail_at = max(0, size - 65_557)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20:end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\5\6", 0, end)              # the signature may occur inside the comment
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    n, length, first = struct.unpack_from("<H2I", tail, end + 10)
    if 0xFFFF == n or 0xFFFFFFFF in (length, first):
        at = struct.unpack("<4sIQI", read_at(tail_at + end - 20, 20))
        if at[0] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        wide = read_at(at[2], 56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        n, length, first = struct.unpack_from("<3Q", wide, 32)
    directory, at, out = read_at(first, length), 0, {}
    for _ in range(n):
        sig, _, _, flags, method, _, _, _, packed, full, n_name, n_extra, n_comment, _, _, _, begun = struct.unpack_from("<4s6H3I5H2I", directory, at)
        if sig != b"PK\1\2":
            raise ValueError("broken central directory")
        name = directory[at + 46:at + 46 + n_name].decode()
        extra, k = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, m = struct.unpack_from("<2H", extra, k)
            if kind == 1:                                 # 64-bit values of the fields that are all ones, in this order
                wide = list(struct.unpack_from(f"<{m // 8}Q", extra, k + 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                begun = wide.pop(0) if begun == 0xFFFFFFFF else begun
            k += 4 + m
        at += 46 + n_name + n_extra + n_comment
        if method == 0 and not flags & 1:
            head = read_at(begun, 30)
            if head[:4] != b"PK\3\4":
                raise ValueError(f"no local header for {name}")
            out[name] = (begun + 30 + sum(struct.unpack_from("<2H", head, 26)), full)
    return out


# --- WARC ------------------------------------------------------------------------------------------------------

def warc_record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    block = b"" if revisit else HTTP + payload
    name = lambda x: f"<urn:x-page:{'null' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page)}", f"WARC-Date: {DATE}",
            *([] if url is None else ["WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url)]),
            *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"] if revisit else []),
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[:int(h["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2] if block else b""
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response" and b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {h['warc-record-id']} does not have its digest")
    page = lambda x: None if x is None or x == "null" else x
    ident = lambda x: page(x[len("<urn:x-page:"):-1]) if x else None
    return {"id": ident(h["warc-record-id"]), "url": h.get("warc-target-uri"), "record_type": kind, "refers_to": ident(h.get("warc-refers-to")),
            "payload_digest": digest, "payload_bytes": int(h["x-payload-length"]), "payload": payload if kind == "response" else None}


def _writer(folder: str, archive_bytes: int, zip64: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        sink = None

        def close():
            z.end()
            z.begin(INDEX)
            z.write("".join(index).encode())
            z.end()
            z.close()
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([z.at], pa.int64()), pa.array([len(index)], pa.int64())],
                                              ["path", "bytes", "records"])

        for batch in batches:
            for r in batch.to_pylist():
                if sink is None:
                    name = f"{uuid.uuid4().hex}.wacz"
                    sink = store.open_output_stream(f"{base}/{name}")
                    z, index, at = ZipWriter(sink, zip64), [], 0
                    z.begin(DATA)
                raw = warc_record(r["id"], r["url"], (r["payload"] or "").encode(), r["digest"], r["refers_to"], r["revisit"])
                gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = gz.compress(raw) + gz.flush()
                z.write(packed)
                index.append(json.dumps({"offset": at, "length": len(packed), "url": r["url"], "digest": r["digest"]}) + "\n")
                at += len(packed)
                if at >= archive_bytes:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()
    return run


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 0, archive_bytes: int = 256 << 20, zip64: bool = False) -> DataFrame:
    """Write every row as a WARC record; returns the written manifest ``path, bytes, records``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    # written, so that the join shuffles both sides and may split a payload that many pages share
    first = stored(rows.groupBy("digest", "n").agg(F.max("id").alias("keep")), "payloads")
    marked = rows.join(first, ["digest", "n"]).withColumn(
        "revisit", ~F.col("id").eqNullSafe(F.col("keep")) & (F.col("n") >= min_revisit_bytes))
    marked = marked.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", F.col("keep").cast("string").alias("refers_to"), "revisit")
    manifest = f"{folder}/manifest"
    marked.mapInArrow(_writer(f"{folder}/archives", archive_bytes, zip64), "path string, bytes long, records long").write.parquet(manifest)
    return spark.read.parquet(manifest)


def _range_reader(uri: str):
    store, path = pafs.FileSystem.from_uri(uri)
    f = store.open_input_file(path)
    return f, lambda at, n: f.read_at(n, at)


def _directories(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                f, read_at = _range_reader(uri)
                with f:
                    members = zip_members(read_at, f.size())
                    index = read_at(*members[INDEX]).decode()
                begin, out = members[DATA][0], []
                for line in index.split("\n")[:-1]:
                    r = json.loads(line)
                    if not out or out[-1][1] + r["length"] > range_bytes or out[-1][0] + out[-1][1] != begin + r["offset"]:
                        out.append([begin + r["offset"], 0, []])
                    out[-1][1] += r["length"]
                    out[-1][2].append(r["length"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(out), pa.string()), pa.array([x[0] for x in out], pa.int64()),
                     pa.array([x[2] for x in out], pa.list_(pa.int64()))], ["path", "begin", "lengths"])
    return run


def _records(with_payload: bool):
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                f, read_at = _range_reader(r["path"])
                with f:
                    raw = read_at(r["begin"], sum(r["lengths"]))
                at, out = 0, []
                for n in r["lengths"]:
                    out.append(parse_record(zlib.decompress(raw[at:at + n], 31)))
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if k == "payload" and not with_payload else x[k] for x in out], t) for k, t in zip(names, types)], names)
    return run


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = 4 << 20, with_payload: bool = True) -> DataFrame:
    """Every record of the archives of a manifest ``path, bytes``, by range reads.

    Paths and ranges are tiny rows that stand for much reading, so their
    partitions are numbered by the bytes to read (a given number is not
    coalesced by AQE).
    """
    size, count = archives.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    cores = spark.sparkContext.defaultParallelism
    ranges = archives.select("path").repartition(max(1, min(count, 4 * cores)), "path").mapInArrow(
        _directories(range_bytes), "path string, begin long, lengths array<long>")
    tasks = max(1, min(size // (256 << 10), 2 * cores), size // (16 * range_bytes))
    return ranges.repartition(int(tasks), "path", "begin").mapInArrow(_records(with_payload), RECORD)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    manifest = write_archives(spark, pages, scratch_path(spark, "warc"))
    out = read_archives(spark, manifest, with_payload=False)
    return out.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


OP2_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, upper(sha1(b)) AS hex FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(generate_series(0, 31), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, (1 + 5 * (k // 4))::INTEGER, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM g
"""
