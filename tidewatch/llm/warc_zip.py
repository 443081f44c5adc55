"""WARC records in ZIP packages: a writer, and a reader by byte ranges.

A package holds stored (not deflated) members: ``archive/data-N.warc.gz``, whose
records are gzip members of their own, and ``indexes/index.cdx``, one line per
record with its member, offset and length.  The reader never extracts a member:
it parses the end of the package (the end record, the ZIP64 locator and end
record where sizes need them), the central directory, and the local headers of
the stored members, reads the index, and then reads each record by its range.

Packages are written by tasks straight into a shared folder through Arrow's file
systems (local and HDFS paths, S3, GCS).  Every attempt writes names of its own,
and the list of packages is a table committed by Spark, so a lost or repeated
attempt leaves at most an unlisted file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import dealt_anew, materialise, ready, shuffle_partitions, slices
from tidewatch.session import state_path

#: Bytes of records in a member, and of members in a package, before the next one.
MEMBER_BYTES, PACKAGE_BYTES = 16 << 20, 128 << 20
INDEX = "indexes/index.cdx"
#: Ranges of one package that are read in one task, about.
READ_BYTES = 8 << 20
#: Bytes of neighbouring records that are read at once, and of payloads in a batch
#: of rows (a longer record goes alone); rows of a batch.
READ_TOGETHER, BATCH_ROWS = 4 << 20, 4096
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _block(headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers + [("Content-Length", str(len(body)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, payload_bytes: int, payload_digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the response that ``refers_to`` names."""
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)),
               ("WARC-Date", _DATE), ("WARC-Target-URI", " ".join((url or "").split())),
               ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("X-Payload-Length", str(payload_bytes))]
    if refers_to is not None:
        return _block(headers + [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _urn(refers_to))], b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _block(headers + [("Content-Type", "application/http; msgtype=response")], http + payload)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of one record; raises on a broken one."""
    head, split, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not split or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) != length:
        raise ValueError("a WARC record ends early")
    return headers, block.partition(b"\r\n\r\n")[2] if headers["warc-type"] == "response" else b""


class Package:
    """One package being written: records collect into members, members are
    stored, the index comes last."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member, self.size, self.lines, self.members = io.BytesIO(), 0, [], 0

    def add(self, data: bytes) -> None:
        at = self.member.tell()
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.member.write(packed)
        self.lines.append(f"archive/data-{self.members}.warc.gz {at} {len(packed)}\n")
        if self.member.tell() >= MEMBER_BYTES:
            self._close_member()

    def _close_member(self) -> None:
        if self.member.tell():
            info = zipfile.ZipInfo(f"archive/data-{self.members}.warc.gz")
            with self.zip.open(info, "w", force_zip64=True) as f:
                f.write(self.member.getbuffer())
            self.size += self.member.tell()
            self.member, self.members = io.BytesIO(), self.members + 1

    def close(self) -> None:
        self._close_member()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        part, number = TaskContext.get().partitionId(), 0
        package, out, path, count = None, None, "", 0

        def listed() -> pa.RecordBatch:
            package.close()
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                                              names=["path", "size", "n_records"])

        for whole in batches:
            for batch in slices(whole, "payload"):
                for r in batch.to_pylist():
                    if package is None:
                        path, count = f"part-{part:05d}-{number:03d}-{uuid.uuid4().hex}.zip", 0
                        out = fs.open_output_stream(f"{root}/{path}")
                        package = Package(out)
                        number += 1
                    payload = (r["payload"] or "").encode()
                    package.add(record(r["page_id"], r["url"], payload, r["payload_bytes"], _b32(r["sha1"]), r["refers_to"]))
                    count += 1
                    if package.size >= PACKAGE_BYTES:
                        yield listed()
                        package = None
        if package is not None:
            yield listed()
    return run


def _b32(hexa: str) -> str:
    return base64.b32encode(bytes.fromhex(hexa)).decode()


@dataclass
class Member:
    name: str
    stored: bool
    begin: int          # of its data
    size: int


def _end_of_directory(f, size: int) -> tuple[int, int, int]:
    """(entries, bytes, offset) of the central directory."""
    tail = min(size, 22 + 0xFFFF + 20)
    f.seek(size - tail)
    data = f.read(tail)
    at = data.rfind(b"PK\x05\x06")
    while at >= 0:
        if at + 22 <= len(data) and at + 22 + struct.unpack_from("<H", data, at + 20)[0] <= len(data):
            break
        at = data.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, length, offset = struct.unpack_from("<HII", data, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = at - 20
        if locator < 0 or data[locator:locator + 4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        f.seek(struct.unpack_from("<Q", data, locator + 8)[0])
        record64 = f.read(56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, offset = struct.unpack_from("<QQQ", record64, 32)
    return entries, length, offset


def members(f, size: int) -> list[Member]:
    """The members of a package, located through its central directory."""
    entries, length, offset = _end_of_directory(f, size)
    f.seek(offset)
    data = f.read(length)
    out, at = [], 0
    for _ in range(entries):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("a broken ZIP directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        local = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46:at + 46 + n_name]
        extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
        k = 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:            # ZIP64: only the fields that are all ones stand here, in this order
                p = k + 4
                if plain == 0xFFFFFFFF:
                    plain, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                if packed == 0xFFFFFFFF:
                    packed, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                if local == 0xFFFFFFFF:
                    local = struct.unpack_from("<Q", extra, p)[0]
            k += 4 + n
        f.seek(local)
        head = f.read(30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("a broken ZIP member")
        begin = local + 30 + sum(struct.unpack_from("<HH", head, 26))
        out.append(Member(name.decode("utf-8", "replace"), method == 0, begin, packed))
        at += 46 + n_name + n_extra + n_comment
    return out


def record_ranges(f, size: int) -> list[tuple[int, int]]:
    """(offset, length) in the package of every record that its index lists."""
    found = {m.name: m for m in members(f, size)}
    index = found.get(INDEX)
    if index is None or not index.stored:
        raise ValueError(f"no stored {INDEX}")
    f.seek(index.begin)
    out = []
    for line in f.read(index.size).decode().splitlines():
        name, at, length = line.rsplit(" ", 2)
        m = found[name]
        if not m.stored:
            raise ValueError(f"{name} is not stored")
        if int(at) + int(length) > m.size:
            raise ValueError(f"{name} ends before a record of its index")
        out.append((m.begin + int(at), int(length)))
    return out


def _list_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, name = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(name) as f:
                ranges = record_ranges(f, f.size())
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(ranges), pa.string()), pa.array([b for b, _ in ranges], pa.int64()), pa.array([n for _, n in ranges], pa.int64())],
                names=["path", "begin", "bytes"])


def _stretches(paths: list, begins: list, lengths: list) -> Iterator[tuple[str, int, list[int]]]:
    """Records (sorted by package and place) that lie one behind the other, as
    (package, begin, lengths), up to ``READ_TOGETHER`` bytes each."""
    held: list[int] = []
    path = begin = end = None
    for p, b, n in zip(paths, begins, lengths):
        if held and (p != path or b != end or end + n - begin > READ_TOGETHER):
            yield path, begin, held
            held = []
        if not held:
            path, begin = p, b
        held.append(n)
        end = b + n
    if held:
        yield path, begin, held


def _parsed_record(path: str, data: bytes) -> tuple:
    """(page, url, payload bytes, digest, kind, page referred to, payload)."""
    headers, payload = parse_record(zlib.decompress(data, 31))
    told = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and digest(payload) != told:
        raise ValueError(f"a payload of {path} differs from its digest")
    size = len(payload) if kind == "response" else int(headers["x-payload-length"])
    return (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), size, told, kind, _page(headers.get("warc-refers-to")),
            payload if kind == "response" else None)


def _read_records(keep_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    used = len(names) - (not keep_payload)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names[:used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, f = None, None
        rows, size = [], 0
        for batch in batches:
            for path, begin, lengths in _stretches(*(c.to_pylist() for c in batch.columns)):
                if path != held:
                    if f is not None:
                        f.close()
                    fs, name = pafs.FileSystem.from_uri(path)
                    held, f = path, fs.open_input_file(name)
                data = f.read_at(sum(lengths), begin)
                at = 0
                for n in lengths:
                    row = _parsed_record(path, data[at:at + n])
                    at += n
                    if keep_payload:
                        size += len(row[-1] or b"")
                        row = (*row[:-1], row[-1].decode() if row[-1] is not None else None)
                    rows.append(row[:used])
                    if size >= READ_TOGETHER or len(rows) >= BATCH_ROWS:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)
        if f is not None:
            f.close()
    return run


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record per page into packages below ``folder`` (default: a new one
    below the shared checkpoint folder) and return their list: ``path``,
    ``size``, ``n_records``.

    Of equal payloads of at least ``least_bytes`` bytes, the page with the
    largest id is a response and the others revisit it; all other pages are
    responses.  Defined cases: a null payload is empty; a page without an id is
    a response and never referred to; every row is a record, repeated rows of one
    id and payload too (all of them responses if theirs is the largest id); an
    empty table gives no package.
    """
    spark = ready(pages.sparkSession)
    folder = folder or state_path(spark, "llm", f"packages-{uuid.uuid4().hex}")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    keyed = rows.select("*", F.sha2("html", 256).alias("key"))
    # ids and digests only: the payloads pass one shuffle, by page
    light = keyed.select("page_id", "key", F.sha1("html").alias("sha1"), F.octet_length("html").alias("payload_bytes"))
    last = light.groupBy("key").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    last = dealt_anew(last.where("n > 1").drop("n"))             # payloads of several pages only
    revisit = F.col("page_id").isNotNull() & (F.col("payload_bytes") >= least_bytes) & (F.col("page_id") < F.coalesce("last", "page_id"))
    told = (
        light.join(last, "key", "left")
        .select("page_id", "key", "sha1", "payload_bytes", F.when(revisit, F.col("last")).alias("refers_to"))
        .groupBy("page_id", "key").agg(F.min("sha1").alias("sha1"), F.max("payload_bytes").cast("long").alias("payload_bytes"), F.max("refers_to").alias("refers_to"))
    )
    # ``told`` has one row per (id, payload), so the join keeps every page row once
    body = keyed.select(F.col("page_id").alias("p"), F.col("key").alias("k"), "url", "html")
    joined = body.join(told, (F.col("k") == F.col("key")) & F.col("p").eqNullSafe(F.col("page_id")))
    records = joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("payload"), "payload_bytes", "sha1", "refers_to")
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    return materialise(spark, records.mapInArrow(_write(folder), "path string, size long, n_records long"), "packages")


def read_packages(spark: SparkSession, packages: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Records of the packages listed in ``path``: ``page_id``, ``url``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and,
    on request, ``payload`` (of responses).  Broken packages raise an error."""
    ready(spark)
    ranges = packages.select("path").repartition(shuffle_partitions(spark), "path").mapInArrow(_list_records, "path string, begin long, bytes long")
    spread = ranges.repartition(shuffle_partitions(spark), "path", F.floor(F.col("begin") / READ_BYTES)).sortWithinPartitions("path", "begin")
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInArrow(_read_records(keep_payload), kinds + ", payload string" * keep_payload)
