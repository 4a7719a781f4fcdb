"""Web archives as WARC records inside stored ZIP members, read back by ranges.

Writing: each task packs its rows into ZIP files in the shared folder. A file holds
``archive/data.warc.gz`` (one gzip member per record, so a record can be read
alone) and ``indexes/index.cdx`` (a JSON line per record with its offset and length
inside the archive). Members are stored, not compressed, and carry ZIP64 fields.
File names are unique to the task attempt; the manifest, a written table, names
only the files of attempts that succeeded, so retries leave no double records.

Reading: the end record, its ZIP64 locator and record and the central directory are
parsed here from the file's tail; members are found through their local headers,
and records come by range reads at index offsets. Nothing is extracted.

Of records with equal payloads of at least ``min_bytes`` bytes, those with the
smallest key are responses and the others revisits that refer to it; smaller ones
are all responses. A null payload is empty. Where a smallest key repeats, each of
its rows is a response. Records without a key come last; equal payloads of null
keys only are all responses. A null url becomes an ``urn:page:`` one.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import map_arrow, shared_folder, skew_join, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
TARGET_BYTES = 64 << 20         # of an archive, after which a task starts the next
READ_AHEAD = 4 << 20            # bytes of neighbouring records that one range read takes
DATE = "1970-01-01T00:00:00Z"   # records carry no capture time


def record(key, url, payload: bytes, digest: str, refers_to, size: int) -> bytes:
    """One WARC/1.1 record. A revisit has no payload but names it."""
    name = "null" if key is None else str(key)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Target-URI: {(url or 'urn:page:' + name).replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if refers_to is not None else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


class ZipReader:
    """Stored members of a ZIP or ZIP64 file, read by ranges of a random-access file."""

    def __init__(self, f):
        self.f, self.size = f, f.size()
        tail_at = max(0, self.size - 65_557)        # longest comment and the end record
        tail = self._range(tail_at, self.size - tail_at)
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of central directory")
        n, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
        if n == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF or tail[max(0, at - 20):at][:4] == b"PK\x06\x07":
            locator = self._range(tail_at + at - 20, 20)
            if locator[:4] == b"PK\x06\x07":
                end = self._range(struct.unpack("<Q", locator[8:16])[0], 56)
                if end[:4] != b"PK\x06\x06":
                    raise ValueError("no ZIP64 end record")
                n, length, start = struct.unpack("<QQQ", end[32:56])
        self.members = dict(self._directory(self._range(start, length), n))

    def _range(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    @staticmethod
    def _directory(d: bytes, n: int):
        at = 0
        for _ in range(n):
            if d[at:at + 4] != b"PK\x01\x02":
                raise ValueError("bad central directory entry")
            method, = struct.unpack("<H", d[at + 10:at + 12])
            packed, size, nl, el, cl = struct.unpack("<IIHHH", d[at + 20:at + 34])
            header, = struct.unpack("<I", d[at + 42:at + 46])
            name = d[at + 46:at + 46 + nl].decode()
            extra, x = d[at + 46 + nl:at + 46 + nl + el], 0
            while x + 4 <= len(extra):
                kind, m = struct.unpack("<HH", extra[x:x + 4])
                if kind == 1:           # 64-bit fields, present in this order where the 32-bit one is full
                    v = list(struct.unpack(f"<{m // 8}Q", extra[x + 4:x + 4 + m // 8 * 8]))
                    size = v.pop(0) if size == 0xFFFFFFFF else size
                    packed = v.pop(0) if packed == 0xFFFFFFFF else packed
                    header = v.pop(0) if header == 0xFFFFFFFF else header
                x += 4 + m
            yield name, (method, packed, size, header)
            at += 46 + nl + el + cl

    def start(self, name: str) -> tuple[int, int]:
        """File offset and length of a stored member's bytes."""
        method, packed, _, header = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
        local = self._range(header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("bad local header")
        nl, el = struct.unpack("<HH", local[26:30])
        return header + 30 + nl + el, packed

    def read(self, name: str) -> bytes:
        return self._range(*self.start(name))


def _open(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1) if path.startswith("file:/") else "file://" + path)


def roles(df: DataFrame, key: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """(key, url, payload, size, digest, refers_to) of each row."""
    kind = dict(df.dtypes)[key]
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    # narrow rows only: one aggregate row for each payload that occurs twice
    first = (rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"))
             .where((F.col("copies") > 1) & F.col("first").isNotNull()))
    other = F.col("key").isNull() | (F.col("key") != F.col("first"))
    return (skew_join(rows, first.select("digest", "first"), "digest", "left")
            .select("key", "url", "payload", "size", "digest", F.when(F.col("first").isNotNull() & other, F.col("first")).cast(kind).alias("refers_to")))


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Write archives of the rows of ``roles``; returns the manifest (path, records)."""
    def run(batches):
        fs, base = _open(folder)
        z = out = member = None
        index, at, path = [], 0, None

        def close():
            member.close()
            with z.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
                f.write("".join(json.dumps(x) + "\n" for x in index).encode())
            z.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(index)], pa.int64())], names=["path", "records"])
        for b in batches:
            for key, url, payload, size, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if z is None:
                    path = f"pages-{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{base}/{path}")
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    member = z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                    index, at = [], 0
                raw = gzip.compress(record(key, url, payload, digest, refers, size), 1, mtime=0)
                member.write(raw)
                index.append({"offset": at, "length": len(raw)})
                at += len(raw)
                if at >= TARGET_BYTES:
                    yield close()
                    z = None
        if z is not None:
            yield close()
    return stored(map_arrow(rows.select("key", "url", "payload", "size", "digest", "refers_to"), run, "path string, records bigint"), "manifest")


def read(manifest: DataFrame, folder: str, key: str, kind: str) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to, url, payload) of every record."""
    def number(urn: str):
        s = urn[len("<urn:page:"):-1]
        return None if s == "null" else int(s) if kind in ("bigint", "int", "smallint", "tinyint") else s

    def run(batches):
        fs, base = _open(folder)
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{path}") as f:
                    z = ZipReader(f)
                    index = [json.loads(x) for x in z.read(INDEX).splitlines()]
                    if len(index) != records:
                        raise ValueError(f"{path}: {len(index)} of {records} records")
                    start, _ = z.start(DATA)
                    i = 0
                    while i < len(index):
                        j, first = i, index[i]["offset"]
                        while j < len(index) and index[j]["offset"] + index[j]["length"] - first <= READ_AHEAD or j == i:
                            j += 1
                        block = z._range(start + first, index[j - 1]["offset"] + index[j - 1]["length"] - first)
                        out = [[] for _ in range(7)]
                        for x in index[i:j]:
                            head, payload = parse_record(gzip.decompress(block[x["offset"] - first:x["offset"] - first + x["length"]]))
                            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                            size, refers = int(head["X-Payload-Length"]), head.get("WARC-Refers-To")
                            if refers is None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                                raise ValueError(f"{path}: payload differs from its digest")
                            for c, v in zip(out, (number(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers and number(refers),
                                                  head["WARC-Target-URI"], payload), strict=True):
                                c.append(v)
                        t = b.schema.field(0).type and (pa.int64() if kind in ("bigint", "int", "smallint", "tinyint") else pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array(out[0], t), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string()),
                                                          pa.array(out[4], t), pa.array(out[5], pa.string()), pa.array(out[6], pa.binary())],
                                                         names=[key, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])
                        i = j
    t = "bigint" if kind in ("bigint", "int", "smallint", "tinyint") else "string"
    # a number of its own keeps adaptive execution from merging the tiny rows: a task an archive
    spread = manifest.repartitionByRange(max(1, manifest.count()), "path")
    return map_arrow(spread, run, f"`{key}` {t}, payload_bytes bigint, payload_digest string, record_type string, refers_to {t}, url string, payload binary")


def archive(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 100, folder: str | None = None) -> DataFrame:
    """Write one record per row, then read the archives back."""
    folder = folder or shared_folder(df.sparkSession, "archives")
    manifest = write(roles(df, key, url, html, min_bytes), folder)
    return read(manifest, folder, key, dict(df.dtypes)[key])
