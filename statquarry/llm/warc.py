"""WARC archives as a PySpark data source.

``WarcSource`` writes records (one gzip member each, with the member's length in its header, so that a reader can step over
it) and reads archives back.  Reading plans one partition for each group of whole files, takes comparisons on the record
type and on header columns from the query (``spark.sql.python.filterPushdown.enabled``), parses a record's headers first,
and steps over the payload of a record that the comparisons reject, or of every record with the option ``payload=false``.
A written archive names its committed files in a manifest: files of failed or repeated task attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, WriterCommitMessage,
)

from statquarry.llm.storage import shared_folder
from statquarry.session import BROADCAST_ROWS, splittable_join

# column of a record, and the header it comes from
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to_id": "WARC-Refers-To", "page_id": "X-Page-Id",
    "refers_to": "X-Refers-To-Page-Id", "payload_bytes": "X-Payload-Bytes",
}
NUMBERS = {"page_id", "refers_to", "payload_bytes"}
READ = ", ".join(f"{c} {'long' if c in NUMBERS else 'string'}" for c in HEADERS) + ", payload binary"
COLUMNS = ["page_id", "target_uri", "payload", "sha1", "refers_to"]  # of a frame to write
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES, BLOCK, PIECE = 256 << 20, 64 << 20, 4 << 20, 1 << 20, 1 << 14


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(content: bytes, level: int = 1) -> bytes:
    """One gzip member with its own length and the content's in the extra field "sl"."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(content) + deflate.flush()
    length = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length & 0xFFFFFFFF, len(content) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value) for name, value in headers if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{payload_digest}')}>"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, date: str):
        self.path, self.date, self.name = path, date, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One partition's records, in files of their own: an attempt never writes into another's file."""
        files, out, size = [], None, 0
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        for row in (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in COLUMNS))):
            if out is None:
                name = f"{uuid.uuid4().hex}.warc.gz"
                out, size = store.open_output_stream(f"{folder}/{name}", compression=None), 0
                about = b"software: statquarry\r\nformat: WARC File Format 1.1\r\n"
                size += out.write(member(record(
                    [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date),
                     ("Content-Type", "application/warc-fields")], about,
                )))
            size += out.write(member(self._record(*row)))
            if size > FILE_BYTES:
                out.close()
                files.append((name, size))
                out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(files)

    def _record(self, page_id, target_uri, payload, sha1, refers_to) -> bytes:
        code = base64.b32encode(bytes.fromhex(sha1)).decode()
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        headers = [
            ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(page_id, code)),
            ("WARC-Date", self.date), ("WARC-Target-URI", target_uri),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{code}"),
            ("X-Page-Id", None if page_id is None else str(page_id)), ("X-Payload-Bytes", str(len(payload))),
        ]
        if refers_to is not None:
            headers += [
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", _id(refers_to, code)), ("X-Refers-To-Page-Id", str(refers_to)),
            ]
        return record(headers, http + payload if refers_to is None else http)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/manifest-{self.name}.json") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _open(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                store.delete_file(f"{folder}/{name}")


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class _Bytes:
    """Forward reading of a file, with steps over what isn't wanted.  ``held[low:]`` is what was read beyond ``at``."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.at, self.held, self.low = file, file.size(), 0, b"", 0

    def peek(self, n: int) -> bytes:
        have = len(self.held) - self.low
        if have < n and self.at + have < self.size:
            self.file.seek(self.at + have)
            self.held, self.low = self.held[self.low :] + self.file.read(max(n - have, BLOCK)), 0
        return self.held[self.low : self.low + n]

    def step(self, n: int) -> None:
        self.seek(self.at + n)

    def seek(self, at: int) -> None:
        self.low, self.at = self.low + at - self.at, at
        if not 0 <= self.low <= len(self.held):
            self.held, self.low = b"", 0


class _Inflated:
    """The same over concatenated gzip members, decoded as far as it is read."""

    def __init__(self, raw: _Bytes):
        self.raw, self.inflate, self.held, self.fed = raw, None, b"", PIECE

    def peek(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n:
            data = self.raw.peek(self.fed)
            if not data and self.inflate is None:
                break
            parts.append(self._more(data, n - have))
            have += len(parts[-1])
            if not data and not parts[-1]:
                break
        self.held = b"".join(parts) if len(parts) > 1 else self.held
        return self.held[:n]

    def _more(self, data: bytes, most: int) -> bytes:
        """Decode no further than ``most`` bytes, within one member."""
        self.inflate = self.inflate or zlib.decompressobj(31)
        out = self.inflate.decompress(data, most)
        left = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.raw.step(len(data) - len(left))
        if self.inflate.eof:
            self.inflate = None
        return out

    def at_member(self) -> bool:
        """Whether the next byte is a member's first; the end of a member that was read whole is taken."""
        if not self.held and self.inflate is not None:
            self.held = self._more(self.raw.peek(PIECE), 1)
        return not self.held and self.inflate is None

    def step(self, n: int) -> None:
        while n:
            m = len(self.peek(min(n, BLOCK)))
            if not m:
                raise ValueError("a record is cut off")
            self.held, n = self.held[m:], n - m


def _length(head: bytes) -> int | None:
    """Length of a gzip member from its extra field."""
    if len(head) >= 24 and head[:3] == b"\x1f\x8b\x08" and head[3] & 4:
        at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
        while at + 4 <= min(end, len(head)):
            name, size = struct.unpack_from("<2sH", head, at)
            if name == b"sl" and size == 8:
                return struct.unpack_from("<I", head, at + 4)[0] or None
            at += 4 + size
    return None


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, verify: bool, partition_bytes: int):
        self.path, self.payload, self.verify, self.partition_bytes = path, payload, verify, partition_bytes
        self.taken: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons on header columns are taken over, the rest is left to Spark."""
        for one in filters:
            column = one.attribute[0] if isinstance(one, (EqualTo, In, IsNull, IsNotNull)) and len(one.attribute) == 1 else None
            if column not in HEADERS:
                yield one
            elif isinstance(one, EqualTo):
                self.taken.append((column, "in", {one.value}))
            elif isinstance(one, In):
                self.taken.append((column, "in", set(one.value)))
            else:
                self.taken.append((column, "null", isinstance(one, IsNull)))

    def partitions(self) -> list[Files]:
        store, folder = _open(self.path)
        info = store.get_file_info(folder)
        if info.type == pafs.FileType.File:
            return [Files([(folder, info.size)])]
        found = store.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        manifests = [f for f in found if re.search(r"/manifest-[0-9a-f]{32}\.json$", f.path)]
        if manifests:
            files = []
            for f in manifests:
                with store.open_input_stream(f.path) as stream:
                    files += [(f"{folder}/{name}", size) for name, size in json.loads(stream.read())]
        else:
            files = [(f.path, f.size) for f in found if re.search(r"\.warc(\.gz)?$", f.path)]
        out, size = [], 0
        for f in sorted(files):
            if not out or size + f[1] > self.partition_bytes:
                out.append(Files([]))
                size = 0
            out[-1].files.append(f)
            size += f[1]
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path, _ in partition.files:
            store, _ = _open(self.path)
            with store.open_input_file(path) as file:
                for row in self._records(file, path):
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {c: pa.int64() if c in NUMBERS else pa.string() for c in HEADERS} | {"payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], names=list(kinds))

    def _wanted(self, row: dict) -> bool:
        return all(
            (row[column] is not None and row[column] in value) if kind == "in" else (row[column] is None) == value
            for column, kind, value in self.taken
        )

    def _records(self, file: pa.NativeFile, path: str) -> Iterator[dict]:
        raw = _Bytes(file)
        packed = raw.peek(2) == b"\x1f\x8b"
        stream = _Inflated(raw) if packed else raw
        while True:
            # a member that tells its length holds one record and can be stepped over
            alone = packed and stream.at_member()
            start = raw.at
            jump = _length(raw.peek(64)) if alone else None
            if packed:
                stream.fed = min(jump, BLOCK) if jump else PIECE  # a member that tells its length is fed at once
            if not stream.peek(1):
                return
            head, n = b"", 4096
            while b"\r\n\r\n" not in head:
                head = stream.peek(n)
                if len(head) < n and b"\r\n\r\n" not in head:
                    if head.strip():
                        raise ValueError(f"{path}: a record at byte {start} has no end of headers")
                    return
                n *= 2
            head = head[: head.index(b"\r\n\r\n")]
            lines = head.decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"{path}: no record at byte {start}")
            headers = {}
            for line in lines[1:]:
                name, _, value = line.partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
            row |= {c: int(row[c]) if (row[c] or "").lstrip("-").isdigit() else None for c in NUMBERS}
            row["payload_digest"] = (row["payload_digest"] or "").partition(":")[2] or None
            row["payload"] = None
            wanted = self._wanted(row)
            if wanted and self.payload and row["record_type"] == "response":
                stream.step(len(head) + 4)
                block = stream.peek(length)
                if len(block) < length:
                    raise ValueError(f"{path}: the record at byte {start} is cut off")
                begin = block.find(b"\r\n\r\n")
                row["payload"] = block[begin + 4 :] if block[:5] == b"HTTP/" and begin >= 0 else block
                if self.verify and row["payload_digest"] and digest(row["payload"]) != row["payload_digest"]:
                    raise ValueError(f"{path}: the payload of {row['record_id']} has another digest")
                stream.step(length + 4)
            elif jump:
                raw.seek(start + jump)
                stream.held, stream.inflate = b"", None
            else:
                stream.step(len(head) + 4 + length + 4)
            if wanted:
                yield row


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (true) and ``verify`` (true: compare digests) for reading; ``date`` for writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def _flag(self, name: str) -> bool:
        return self.options.get(name, "true").lower() == "true"

    def reader(self, schema) -> WarcReader:
        size = int(self.options.get("partitionbytes", PARTITION_BYTES))
        return WarcReader(self.options["path"], self._flag("payload"), self._flag("verify"), size)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"], self.options.get("date", "2020-01-01T00:00:00Z"))


def write_pages(
    pages: DataFrame, path: str, least_bytes: int = 0, id: str = "page_id", url: str = "url", source: str = "html"
) -> None:
    """Append one record for each page to the archive at ``path``.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is a response, the others
    are revisits that refer to it; smaller payloads are all responses.  A null page is an empty payload; a null id is never
    the smallest unless there is no other; rows that repeat the smallest id of their payload are all responses.
    """
    payload = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("target_uri"),
        payload.alias("payload"),
    )
    hashed = rows.withColumn("sha1", F.sha1("payload"))
    again = (
        hashed.where(F.octet_length("payload") >= least_bytes).groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("sha1", "first")
    )
    if again.count() <= BROADCAST_ROWS:
        joined = hashed.join(F.broadcast(again), "sha1", "left")
    else:
        joined = splittable_join(hashed, again, ["sha1"], how="left")
    other = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    out = joined.select("page_id", "target_uri", "payload", "sha1", F.when(other, F.col("first")).alias("refers_to"))
    out.sparkSession.dataSource.register(WarcSource)
    out.write.format("warc").mode("append").save(path)


def read_archive(spark, path: str, **options: str) -> DataFrame:
    """Records of an archive; comparisons of the query on the record type and headers reach the reader.

    Load the archive once for each set of comparisons: Spark keeps one set for a loaded Python source, so two branches of a
    query that compare differently must not share a frame.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages to a new archive in shared storage and read it back: one row for each response and revisit.

    (page_id, payload_bytes, payload_digest, record_type, refers_to).  A response's figures are taken of its payload, whose
    digest the reader compares; revisits are read by their headers alone.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_pages(pages, path, least_bytes)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = read_archive(spark, path).where(F.col("record_type") == "response").withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    revisits = read_archive(spark, path, payload="false").where(F.col("record_type") == "revisit")
    return responses.select(columns).union(revisits.select(columns))
