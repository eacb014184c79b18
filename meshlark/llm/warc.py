"""WARC archives: a writer that turns equal payloads into revisits, and a Spark data source that reads them.

Every record is a gzip member of its own. The writer adds the member's lengths as the extra field ``sl``,
so that the reader, which decodes a record's headers first, can seek past a payload that is not wanted.
Members without that field, and archives that are not compressed, are read as well.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull, StringStartsWith

from ._work import col, materialise, open_fs, scratch, small_side, tidy

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
MAGIC = b"\x1f\x8b\x08"
#: Bytes between places where a reader may begin, and how much less than a scan's partition, plain, one of an archive is.
MARK_BYTES, COMPRESSION = 1 << 20, 4

SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, content_type string, content_length long, payload_digest string, payload_bytes long, payload binary"
#: Named fields of a record's header, by column.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "content_type": "content-type"}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member with its compressed and plain lengths in the extra field ``sl``; from 4 GiB on, where that is too
    narrow, without."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 10 + 2 + 12 + len(body) + 8
    if total >= 1 << 32:
        return MAGIC + b"\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    return MAGIC + b"\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit that has only the response's HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        return record(fields, http + payload)
    return record([*fields, ("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)], http)


def write_pages(
    pages: DataFrame, path: str | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    dedup_min_bytes: int = 0, max_file_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Writes an archive of one record per row under ``path`` (by default in the shared folder); returns the path.

    Of rows with equal payloads (by SHA-1) of at least ``dedup_min_bytes``, that with the smallest id is the
    response; the others revisit it. A null html is an empty payload; a null url leaves the target out; a row
    without id is never referred to; ids are integers, others stop the job at Spark's cast; rows that repeat the smallest id are each a response. Other columns are
    ignored; an empty table makes an archive without records.

    Tasks write under names of their own and report them, with a place where a record begins every MARK_BYTES; the
    report is a Parquet table which Spark commits. Readers open only the files it lists, so what a lost or repeated task
    leaves is never read, and begin at those places, so that a file is many tasks' work.
    """
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    src = pages.select(col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"), F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("sha1", F.sha1("payload"))
    firsts = src.where(F.octet_length("payload") >= dedup_min_bytes).groupBy("sha1").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("sha1", "first")
    firsts, _ = materialise(firsts, "warc-repeats")
    rows = firsts.count()
    if rows:
        src = src.join(small_side(firsts, rows), "sha1", "left")
        long_enough = F.octet_length("payload") >= dedup_min_bytes
        src = src.withColumn("refers", F.when(long_enough & ~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    else:
        src = src.withColumn("refers", F.lit(None).cast("long"))

    mark_bytes = MARK_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(path)
        fs.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0
        marks: list[int] = []
        done = []
        for b in batches:
            for page_id, url, payload, sha1, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name, size, n, marks = f"{uuid.uuid4().hex}.warc.gz", 0, 0, []
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    info = member(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(info)
                    size += len(info)
                if size - (marks[-1] if marks else 0) >= mark_bytes:
                    marks.append(size)
                m = member(page_record(page_id, url, payload, base64.b32encode(bytes.fromhex(sha1)).decode(), refers, date))
                out.write(m)
                size, n = size + len(m), n + 1
                if size >= max_file_bytes:
                    out.close()
                    done.append((name, size, n, marks))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n, marks))
        cols = list(zip(*done, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.int64()))], names=["name", "bytes", "records", "marks"])

    src.select("id", "url", "payload", "sha1", "refers").mapInArrow(tidy(write), "name string, bytes long, records long, marks array<long>").write.parquet(f"{path}/_files")
    return path


@dataclass
class Files(InputPartition):
    """Ranges of files: path, first byte, and the byte before which records begin (None: to the end)."""

    ranges: list[tuple[str, int, int | None]]


class _Source:
    """Sequential reader of a range of an archive file; knows where the next record starts."""

    def __init__(self, stream, start: int = 0, stop: int | None = None):
        self.f, self.size, self.at = stream, stream.size() if stop is None else stop, start

    def records(self, wanted, payload: bool) -> Iterator[tuple[dict, bytes | None]]:
        """(headers, block) of records whose headers are wanted; the block is None unless payload is asked for."""
        while self.at < self.size:
            self.f.seek(self.at)
            head = self.f.read(3)
            if head == MAGIC:
                found = self._member(wanted, payload)
            elif head[:3] == b"WAR":
                found = self._plain(wanted, payload)
            elif head.strip(b"\r\n") != head:
                self.at += len(head) - len(head.lstrip(b"\r\n"))
                continue
            else:
                raise ValueError(f"no WARC record at byte {self.at}")
            if found:
                yield found

    def _member(self, wanted, payload):
        self.f.seek(self.at)
        head = self.f.read(12)
        flags, skip, start = head[3], None, 10
        if flags & 4:
            extra = self.f.read(struct.unpack("<H", head[10:12])[0])
            start = 12 + len(extra)
            k = 0
            while k + 4 <= len(extra):
                n = struct.unpack("<H", extra[k + 2 : k + 4])[0]
                if extra[k : k + 2] == b"sl" and n == 8:
                    skip = struct.unpack("<I", extra[k + 4 : k + 8])[0]
                k += 4 + n
        self.f.seek(self.at + start)
        for bit in (8, 16):  # name and comment, each ended by a zero byte
            if flags & bit:
                while self.f.read(1) not in (b"\0", b""):
                    start += 1
                start += 1
        start += 2 * bool(flags & 2)
        self.f.seek(self.at + start)
        z, out, read, headers, want, at = zlib.decompressobj(-15), bytearray(), 0, None, False, -1
        while not z.eof:
            chunk = self.f.read(1 << 12 if headers is None else 1 << 18)
            if not chunk:
                raise ValueError(f"the record at byte {self.at} is cut short")
            read += len(chunk)
            piece = z.decompress(chunk)
            if headers is None or want and payload:
                out += piece
            if headers is None and (at := out.find(b"\r\n\r\n")) >= 0:
                headers = parse_headers(bytes(out[:at]))
                want = wanted(headers)
                if skip and not (want and payload):
                    self.at += skip
                    return (headers, None) if want else None
        self.at += start + read - len(z.unused_data) + 8
        if headers is None:
            raise ValueError("a gzip member holds no WARC record")
        if not want:
            return None
        return headers, bytes(out[at + 4 : at + 4 + int(headers["content-length"])]) if payload else None

    def _plain(self, wanted, payload):
        self.f.seek(self.at)
        out = b""
        while (at := out.find(b"\r\n\r\n")) < 0:
            chunk = self.f.read(1 << 12)
            if not chunk:
                raise ValueError(f"the record at byte {self.at} is cut short")
            out += chunk
        headers = parse_headers(out[:at])
        n, start = int(headers["content-length"]), self.at + at + 4
        self.at = start + n + 4
        if not wanted(headers):
            return None
        if not payload:
            return headers, None
        self.f.seek(start)
        return headers, self.f.read(n)


def parse_headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        k, _, v = line.partition(":")
        last = k.strip().lower()
        out[last] = v.strip()
    return out


def value(headers: dict[str, str], column: str) -> str | None:
    v = headers.get(HEADERS[column])
    return v[1:-1] if v and column in ("record_id", "refers_to") and v[0] == "<" else v


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.target = int(options.get("partitionBytes", 128 << 20))
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)) and f.attribute[0] in HEADERS and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            v = value(headers, f.attribute[0])
            if isinstance(f, IsNull):
                ok = v is None
            elif isinstance(f, IsNotNull):
                ok = v is not None
            elif isinstance(f, EqualTo):
                ok = v is not None and v == f.value
            elif isinstance(f, In):
                ok = v is not None and v in f.value
            else:
                ok = v is not None and v.startswith(f.value)
            if not ok:
                return False
        return True

    def partitions(self):
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSelector, FileType

        fs, root = open_fs(self.path)
        listed = fs.get_file_info(f"{root}/_files").type == FileType.Directory
        if fs.get_file_info(root).type == FileType.File:
            ranges = [(root, 0, None, 0)]
        elif listed:
            schema = pa.schema([("name", pa.string()), ("bytes", pa.int64()), ("marks", pa.list_(pa.int64()))])
            t = ds.dataset(f"{root}/_files", filesystem=fs, format="parquet", schema=schema).to_table()
            ranges = [(f"{root}/{n}", x, y, y - x) for n, b, m in zip(*(t[c].to_pylist() for c in schema.names), strict=True) for x, y in zip([0, *(m or [])], [*(m or []), b], strict=True)]
        else:
            ranges = [(i.path, 0, None, i.size) for i in fs.get_file_info(FileSelector(root)) if re.search(r"\.warc(\.gz)?$", i.path)]
        out: list[Files] = []
        room = 0
        for path, start, stop, size in sorted(ranges, key=lambda r: r[:2]):
            if not out or size > room:
                out.append(Files([]))
                room = self.target
            last = out[-1].ranges[-1] if out[-1].ranges else None
            if last and last[0] == path and last[2] == start:
                out[-1].ranges[-1] = (path, last[1], stop)
            else:
                out[-1].ranges.append((path, start, stop))
            room -= size
        return out or [Files([])]

    def read(self, partition):
        fs, _ = open_fs(self.path)
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (x.split() for x in SCHEMA.split(", "))])
        rows: list[tuple] = []
        held = 0
        for path, start, stop in partition.ranges:
            with fs.open_input_file(path) as f:
                for headers, block in _Source(f, start, stop).records(self.wanted, self.payload or self.verify):
                    rows.append(self.row(headers, block))
                    held += len(block or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    def row(self, headers: dict[str, str], block: bytes | None) -> tuple:
        length = int(headers["content-length"])
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        body = size = None
        if block is not None:
            http, body = "", block
            if headers.get("content-type", "").startswith("application/http"):
                head, _, body = block.partition(b"\r\n\r\n")
                http = head.decode("latin-1").lower()
            size = len(body)
            if headers.get("warc-type") == "revisit":
                body = None
                size = int(m[1]) if (m := re.search(r"^content-length:\s*(\d+)", http, re.M)) else None
            elif self.verify and digest is not None:
                found = base32_sha1(body)
                if found != digest:
                    raise ValueError(f"payload digest {found} differs from {digest} of record {headers.get('warc-record-id')}")
        return (*(value(headers, c) for c in HEADERS), length, digest, size, body if self.payload else None)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``. Options: payload=false leaves payloads out (and undecoded unless verify=true);
    verify=true recomputes payload digests; partitionBytes is how much of an archive a task reads. Predicates on the header columns are
    pushed down: records that fail them are skipped after their headers. Spark (4.1) keeps the predicates of the first query over
    a loaded DataFrame for all later ones: load it again for each query that has other predicates."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_archive(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records of an archive that ``write_pages`` wrote, of a WARC file, or of a folder of such files, gzipped or plain;
    options are those of ``WarcDataSource``.

    An archive without records gives no rows; a field that a header lacks is null; records that repeat each get a row; a
    payload of any length is one value; bytes that are no record, or a record that is cut short, are an error, as is with
    verify=true a payload that differs from its digest. A task reads a quarter of what a scan's partition may have.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if "partitionBytes" not in options:
        m = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower())
        if m:
            options["partitionBytes"] = str(max(1, (int(m[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[m[2]]) // COMPRESSION))
    return spark.read.format("warc").options(**options).load(path)


def page_number(column: str):
    """The id in a record id that ``write_pages`` made; null if it has none."""
    return F.regexp_extract(F.col(column), f"^{ID_PREFIX}(-?[0-9]+)$", 1).try_cast("long")
