"""Web archives: WARC records in ZIP packages, written and range-read by Spark tasks.

``write_archives`` packs pages into ZIP files of stored (uncompressed) members
``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdxj`` (offset and length of
each record). ``read_archives`` finds the end-of-central-directory record at the end of each
file (the ZIP64 one if there is one), parses the central directory, locates the stored
members and reads single records by their byte ranges; nothing is extracted.

Pages with equal payloads of at least ``MIN_REVISIT_BYTES``: the one with the smallest page_id is
written in full (``response``), the others as ``revisit`` records that refer to it.

Files go to the shared folder through its file system, each attempt of a task under names of
its own; only files listed in the committed manifest are read, so a lost or repeated
task leaves no half-written or doubled record.

Cases: null html is an empty payload. Rows that repeat the smallest page_id of their payload are all
responses; a null page_id is larger than any other. Urls may be null; one with control
characters (line ends) is percent-encoded in its header and reads back as it was. An empty table gives an empty
result; other columns are not read. Memory is one Arrow batch and one archive of ``ARCHIVE_BYTES``.

Hot payloads are counted by partial sums and looked up by a broadcast of fewer than 1000 digests.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import left_join_counted, materialize, shared_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 * 1024 * 1024
RECORD_DATE = "2024-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_ESCAPED = "X-Target-URI-Encoding: percent"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    return int(urn[10:-1]) if urn[10:-1] else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {RECORD_DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None and _CONTROL.search(url):  # would break the header; escaped as a whole, so it reads back as it was
        head += [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=')}", _ESCAPED]
    elif url is not None:
        head.append(f"WARC-Target-URI: {url}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, payload (None for a revisit) and the payload's full length and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    url = h.get("WARC-Target-URI")
    if _ESCAPED in lines:
        url = unquote(url)
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = h["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {h['WARC-Record-ID']} is damaged")
    return {"page_id": _page(h["WARC-Record-ID"]), "url": url, "record_type": h["WARC-Type"],
            "payload_bytes": size, "payload_digest": digest, "payload": None if revisit else payload,
            "refers_to": _page(h["WARC-Refers-To"]) if revisit else None}


def build_archive(records: list[tuple[str, bytes]]) -> bytes:
    """A ZIP package of (index key, gzip member) pairs."""
    out, index, offset = io.BytesIO(), [], 0
    for key, member in records:
        index.append(f"{key} {RECORD_DATE} {json.dumps({'offset': offset, 'length': len(member)})}\n")
        offset += len(member)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for name, data in ((DATA, b"".join(m for _, m in records)), (INDEX, "".join(index).encode())):
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


class ZipReader:
    """Members of a ZIP file by byte ranges. ``read(offset, length)`` reads the file."""

    def __init__(self, read, size: int):
        self.read, self.members = read, {}
        tail_at = max(0, size - 65_557)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            locator = read(tail_at + end - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            (at,) = struct.unpack_from("<Q", locator, 8)
            count, length, start = struct.unpack_from("<QQQ", read(at, 56), 32)
        directory, at = read(start, length), 0
        for _ in range(count):
            if directory[at:at + 4] != b"PK\x01\x02":
                raise ValueError("bad central directory")
            (method,) = struct.unpack_from("<H", directory, at + 10)
            stored, full, n, e, c = struct.unpack_from("<IIHHH", directory, at + 20)
            (header,) = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46:at + 46 + n].decode()
            extra, p = directory[at + 46 + n:at + 46 + n + e], 0
            while p + 4 <= len(extra):  # the ZIP64 field holds those values that don't fit, in this order
                kind, width = struct.unpack_from("<HH", extra, p)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, p + 4))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    header = next(wide) if header == 0xFFFFFFFF else header
                p += 4 + width
            self.members[name] = (method, header, stored)
            at += 46 + n + e + c

    def locate(self, name: str) -> tuple[int, int]:
        """File offset and length of a stored member's data."""
        method, header, stored = self.members[name]
        if method != 0:
            raise ValueError(f"{name} isn't stored")
        n, e = struct.unpack_from("<HH", self.read(header, 30), 26)
        return header + 30 + n + e, stored

    def records(self) -> Iterator[bytes]:
        """The records that the index lists, each read by its range."""
        data_at, _ = self.locate(DATA)
        index_at, index_size = self.locate(INDEX)
        for line in self.read(index_at, index_size).decode().splitlines():
            spot = json.loads(line.split(" ", 2)[2])
            yield gzip.decompress(self.read(data_at + spot["offset"], spot["length"]))


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and first: the page whose payload a revisit repeats."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    groups = materialize(
        p.where(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1"), "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    return left_join_counted(p, groups, ["digest"], "n", total)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's URI; a path without a scheme is on the cluster's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def write_archives(typed: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records; returns the manifest: path, size, n_records."""
    spark = typed.sparkSession
    folder = folder or shared_path(spark, "archives")
    folder = _qualified(spark, folder)
    columns = ["page_id", "url", "html", "digest", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)

        def close(records: list) -> pa.RecordBatch:
            path, data = f"{root}/{uuid.uuid4().hex}.wacz", build_archive(records)
            with store.open_output_stream(path) as f:
                f.write(data)
            return pa.RecordBatch.from_pydict({"path": [path], "size": pa.array([len(data)], pa.int64()),
                                               "n_records": pa.array([len(records)], pa.int64())})

        held, size = [], 0
        for b in batches:
            for page_id, url, html, digest, first in zip(*[b.column(i) for i in range(5)], strict=True):
                page_id, first, payload = page_id.as_py(), first.as_py(), html.as_py()
                revisit = first is not None and first != page_id
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = make_record(page_id, url.as_py(), payload, digest.as_py(), first, revisit)
                member = pack.compress(raw) + pack.flush()
                held.append((_urn(page_id), member))
                size += len(member)
                if size >= archive_bytes:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    binary = [F.col("html").cast("binary").alias("html") if c == "html" else F.col(c) for c in columns]
    manifest = typed.select(*binary).mapInArrow(run, "path string, size bigint, n_records bigint")
    return materialize(manifest.withColumn("folder", F.lit(folder)), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives in the manifest; without ``payloads`` these are checked, not returned."""
    schema = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to bigint" + ", payload binary" * payloads)
    types = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], t) for k, t in types.items()})

        for b in batches:
            for path, size, n, folder in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                store, _ = pafs.FileSystem.from_uri(folder)
                with store.open_input_file(path) as f:
                    rows, count, held = [], 0, 0
                    for raw in ZipReader(lambda at, k, f=f: f.read_at(k, at), size).records():
                        rows.append(parse_record(raw))
                        count, held = count + 1, held + len(raw)
                        if held > ARCHIVE_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                    if count != n:
                        raise ValueError(f"{path}: {count} of {n} records")
                    if rows:
                        yield batch(rows)

    return manifest.select("path", "size", "n_records", "folder").repartition(parts).mapInArrow(run, schema)
