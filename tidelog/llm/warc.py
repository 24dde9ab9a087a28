"""WARC archives in seekable Zstandard bundles.

Records are gathered into frames that decompress on their own; a bundle ends
with a seek table of its frames (the skippable frame of the seekable format),
and an index maps each record identifier to bundle, frame and the offset
inside the frame. A record whose payload another record has already is a
revisit that names the other.

Bundles are written by the tasks into the shared folder through
``pyarrow.fs``. Names and content follow from the partition alone, and a file
gets its name when it is complete, so a repeated task replaces equal bytes.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import free_prefix, ref, text_of
from tidelog.session import scratch_folder, stored

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Shorter payloads are always written whole.
MIN_REVISIT = 100
#: Pages have no date of their own.
DATE = "1970-01-01T00:00:00Z"
RESPONSE, REVISIT = "response", "revisit"

# Fixed values of the formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = "record_id string, bundle string, frame long, offset long, length long"


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = f"file://{uri[5:]}"
    if "://" not in uri:
        return arrow_fs.LocalFileSystem(), uri
    return arrow_fs.FileSystem.from_uri(uri)


# --- records ------------------------------------------------------------------


def one_line(text: str) -> str:
    """A header value without line ends."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def to_record(identifier: str, url: str, payload: bytes, digest: str, kind: str, refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == RESPONSE else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:x-page:{identifier}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", one_line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == REVISIT:
        fields.insert(3, ("WARC-Profile", REVISIT_PROFILE))
        if refers_to is not None:
            fields.insert(4, ("WARC-Refers-To", f"<urn:x-page:{refers_to}>"))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def identifier(self) -> str:
        return _page(self.headers["WARC-Record-ID"])


def _page(urn: str) -> str:
    return urn.removeprefix("<urn:x-page:").removesuffix(">")


def _fields(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n") if ": " in line)


def parse_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record that begins at ``at`` and where the next one begins."""
    if data[at : at + len(VERSION)] != VERSION:
        raise ValueError(f"no WARC record at {at}")
    head_end = data.index(b"\r\n\r\n", at)
    headers = _fields(data[at + len(VERSION) + 2 : head_end])
    begin = head_end + 4
    end = begin + int(headers["Content-Length"])
    http_end = data.index(b"\r\n\r\n", begin)
    record = Record(headers, _fields(data[begin:http_end]), data[http_end + 4 : end])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} does not end where its length says")
    return record, end + 4


# --- bundles ------------------------------------------------------------------


class BundleWriter:
    """Frames of one partition, in bundles named by partition and number."""

    def __init__(self, folder: str, partition: int):
        self.fs, self.root = open_folder(folder)
        self.folder, self.partition, self.number = folder, partition, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.stream = None
        self.frame = bytearray()
        self.waiting: list[tuple[str, int, int]] = []

    def _name(self) -> str:
        return f"part-{self.partition:06d}-{self.number:04d}.warc.zst"

    def add(self, identifier: str, record: bytes) -> list[tuple]:
        """Index rows of the frame that this record has filled, if any."""
        self.waiting.append((identifier, len(self.frame), len(record)))
        self.frame += record
        return self.end_frame() if len(self.frame) >= FRAME_BYTES else []

    def end_frame(self) -> list[tuple]:
        if not self.waiting:
            return []
        if self.stream is None:
            self.fs.create_dir(self.root, recursive=True)
            self.temporary = f"{self.root}/.{self._name()}.{uuid.uuid4().hex}"
            self.stream, self.frames, self.written = self.fs.open_output_stream(self.temporary), [], 0
        packed = self.packer.compress(bytes(self.frame))
        self.stream.write(packed)
        rows = [(i, self._name(), len(self.frames), at, n) for i, at, n in self.waiting]
        self.frames.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame, self.waiting = bytearray(), []
        if self.written >= BUNDLE_BYTES:
            self.end_bundle()
        return rows

    def end_bundle(self) -> None:
        if self.stream is None:
            return
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.stream.close()
        self.stream = None
        target = f"{self.root}/{self._name()}"
        if self.fs.get_file_info(target).type != arrow_fs.FileType.NotFound:
            self.fs.delete_file(target)
        self.fs.move(self.temporary, target)
        self.number += 1


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_folder(folder)
        self.file = self.fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError(f"{name} has no seek table")
        self.file.seek(size - 9 - 8 * count)
        entries = self.file.read(8 * count)
        self.starts, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", entries, 8 * i)
            self.starts.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.starts[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def record(self, frame: int, offset: int) -> Record:
        return parse_record(self.frame(frame), offset)[0]

    def records(self) -> Iterator[Record]:
        for number in range(len(self.starts)):
            data, at = self.frame(number), 0
            while at < len(data):
                record, at = parse_record(data, at)
                yield record


# --- tables -------------------------------------------------------------------


def typed(pages: DataFrame, id_col: str, url_col: str, payload_col: str, p: str) -> DataFrame:
    """One row per page: identifier, url, payload, digest, kind, refers_to.

    Digests are compared in narrow rows, reduced before they are shuffled;
    payloads move once, by their own identifier, so equal ones never meet.
    """
    payload = text_of(payload_col)
    rows = pages.select(
        F.coalesce(ref(id_col).cast("string"), F.lit("")).alias(f"{p}key"),
        ref(id_col).alias(f"{p}id"),
        text_of(url_col).alias(f"{p}url"),
        payload.alias(f"{p}payload"),
        F.sha2(payload, 256).alias(f"{p}digest"),
        F.octet_length(payload).cast("long").alias(f"{p}bytes"),
    )
    narrow = rows.where(F.col(f"{p}bytes") >= MIN_REVISIT).select(f"{p}key", f"{p}id", f"{p}digest")
    first = narrow.groupBy(f"{p}digest").agg(F.min(f"{p}id").alias(f"{p}least"), F.count(F.lit(1)).alias(f"{p}n"))
    # most payloads are their own response; only those of several rows are joined
    several = first.where(f"{p}n > 1").drop(f"{p}n")
    shared = narrow.join(several, f"{p}digest").select(f"{p}key", f"{p}digest", f"{p}least").distinct()
    shared = shared.withColumn(f"{p}several", F.lit(True))
    again = Window.partitionBy(f"{p}key", f"{p}digest").orderBy(f"{p}url")
    rows = rows.withColumn(f"{p}time", F.row_number().over(again))
    rows = rows.join(shared, [f"{p}key", f"{p}digest"], "left")
    is_first = F.col(f"{p}id").eqNullSafe(F.col(f"{p}least")) & (F.col(f"{p}time") == 1)
    revisit = F.coalesce(F.col(f"{p}several") & ~is_first, F.lit(False))
    return rows.select(
        F.col(f"{p}key").alias("key"),
        F.col(f"{p}time").alias("time"),
        F.col(f"{p}url").alias("url"),
        F.col(f"{p}payload").alias("payload"),
        F.col(f"{p}digest").alias("digest"),
        F.when(revisit, F.lit(REVISIT)).otherwise(F.lit(RESPONSE)).alias("kind"),
        F.when(revisit, F.col(f"{p}least").cast("string")).alias("refers_to"),
    ).sortWithinPartitions("key", "digest", "time")


def write_archive(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; returns the index.

    Null payloads are empty, null URLs are empty, a null id has the empty
    identifier. Repeated rows are records of their own: the second of one id
    and payload has ``:2`` after its identifier and revisits the first. Of
    equal payloads with null ids the first is the response when no other id
    has it. An empty table writes no bundle. Other columns are not read.
    """
    p = free_prefix(pages, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = BundleWriter(folder, TaskContext.get().partitionId())
        names = ["record_id", "bundle", "frame", "offset", "length"]
        for batch in batches:
            rows = []
            for x in batch.itertuples(index=False):
                name = x.key if x.time == 1 else f"{x.key}:{x.time}"
                record = to_record(name, x.url, x.payload.encode(), x.digest, x.kind, x.refers_to)
                rows += writer.add(name, record)
            yield pd.DataFrame(rows, columns=names)
        yield pd.DataFrame(writer.end_frame(), columns=names)
        writer.end_bundle()

    return stored(typed(pages, id_col, url_col, payload_col, p).mapInPandas(write, INDEX_SCHEMA), "warc-index")


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """A row per record in the bundles that the index names, from the records
    alone; payloads of responses are hashed anew. A task takes one bundle."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["bundle"]:
                rows = []
                for r in BundleReader(folder, name).records():
                    kind, named = r.headers["WARC-Type"], r.headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    refers = r.headers.get("WARC-Refers-To")
                    whole = kind == RESPONSE
                    rows.append(
                        (
                            r.identifier,
                            r.headers["WARC-Target-URI"],
                            len(r.payload) if whole else int(r.http["Content-Length"]),
                            hashlib.sha256(r.payload).hexdigest() if whole else named,
                            kind,
                            refers and _page(refers),
                        )
                    )
                    if len(rows) == 5000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    names = ["record_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    bundles = index.select("bundle").distinct()
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, int(bundles.count()))
    return bundles.repartition(tasks, "bundle").mapInPandas(
        read,
        "record_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string",
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    return read_archive(write_archive(pages, folder, id_col, url_col, payload_col), folder)
