"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each with some whole WARC
records, followed by a skippable frame with the seek table of the published
seekable format. An index maps each record to its bundle, frame and offset
inside the frame. Bundles are written and read by tasks, a frame at a time.
Every attempt of a task writes files of its own, and the index names only those
of attempts that succeeded, so a lost executor leaves at worst an unused file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import slices, text_or_empty
from lapwise.session import materialised, shared_dir

# Payloads below this many bytes are always stored whole.
REVISIT_BYTES = 100
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20
# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The tables hold no fetch time.
DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, page_id string, bundle string, frame long, offset long, length long"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, which is Hadoop's default one if the path names none."""
    if "://" in path or path.startswith("file:"):
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


def header_line(name: str, value: str) -> str:
    """A header without control characters in its value."""
    return f"{name}: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value) + "\r\n"


def record_name(page_id, digest: str) -> str:
    """Identifiers are percent-encoded, so that any text can be read back from the name."""
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}:{digest}>"


def write_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit has the headers of its payload, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = "WARC/1.1\r\n" + header_line("WARC-Type", "response" if refers_to is None else "revisit")
    head += header_line("WARC-Record-ID", record_name(page_id, digest))
    head += header_line("WARC-Date", DATE)
    if url:
        head += header_line("WARC-Target-URI", url)
    if refers_to is not None:
        head += header_line("WARC-Profile", REVISIT_PROFILE)
        head += header_line("WARC-Refers-To", record_name(refers_to, digest))
    head += header_line("WARC-Payload-Digest", f"sha256:{digest}")
    head += header_line("Content-Type", "application/http;msgtype=response")
    head += header_line("Content-Length", str(len(block)))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def headers_of(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines) if name}


def read_records(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record in a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at) + 4
        headers = headers_of(frame[at : end - 4])
        size = int(headers["content-length"])
        yield at, end + size + 4 - at, headers, frame[end : end + size]
        at = end + size + 4


class BundleWriter:
    """Writes bundles below a folder and returns the index of each when it is closed."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int) -> None:
        self.fs, self.folder = filesystem(folder)
        self.uri, self.frame_bytes, self.bundle_bytes = folder, frame_bytes, bundle_bytes
        self.fs.create_dir(self.folder, recursive=True)
        self.out = None

    def add(self, record_id: str, page_id: str | None, record: bytes) -> list[tuple]:
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.frames, self.index, self.pending, self.size, self.written = [], [], [], 0, 0
        self.index.append((record_id, page_id, f"{self.uri}/{self.name}", len(self.frames), self.size, len(record)))
        self.pending.append(record)
        self.size += len(record)
        if self.size >= self.frame_bytes:
            self._end_frame()
        return self.close() if self.written >= self.bundle_bytes else []

    def _end_frame(self) -> None:
        data = zstandard.ZstdCompressor().compress(b"".join(self.pending))
        self.out.write(data)
        self.frames.append((len(data), self.size))
        self.written += len(data)
        self.pending, self.size = [], 0

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        if self.pending:
            self._end_frame()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()
        self.out = None
        return self.index


def seek_table(file: pa.NativeFile, size: int) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame, from the footer."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(size - 9 - 8 * count)
    sizes = [a for a, _ in struct.iter_unpack("<II", file.read(8 * count))]
    starts = [0]
    for n in sizes:
        starts.append(starts[-1] + n)
    return list(zip(starts, sizes))


def read_frames(bundle: str, numbers: list[int]) -> Iterator[tuple[int, bytes]]:
    """The wanted frames of a bundle, decompressed one at a time."""
    fs, path = filesystem(bundle)
    size = fs.get_file_info(path).size
    with fs.open_input_file(path) as file:
        table = seek_table(file, size)
        for number in sorted(numbers):
            start, length = table[number]
            file.seek(start)
            yield number, zstandard.ZstdDecompressor().decompress(file.read(length))


def read_record(bundle: str, frame: int, offset: int, length: int) -> bytes:
    """One record by its index entry."""
    for _, data in read_frames(bundle, [frame]):
        return data[offset : offset + length]
    raise KeyError(frame)


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record per row to bundles below `folder`; returns the index.

    A folder without a file system is one of Hadoop's default file system, as for tables.

    Of equal payloads of at least `revisit_bytes` bytes the row with the
    smallest id is a response and rows with other ids revisit it; null ids
    come last. A null html is an empty payload. Repeated rows get a record
    each, of one name. An empty table writes no bundle.
    """
    folder = qualified(pages.sparkSession, folder)
    body = F.encode(text_or_empty(html_col), "UTF-8")
    digest = F.sha2(body, 256)
    light = pages.select(F.col(id_col).alias("id"), digest.alias("digest"), F.octet_length(body).alias("n"))
    light = light.filter(F.col("n") >= revisit_bytes)
    # Copies are combined where they are read; a hot digest joins with one row.
    firsts = light.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    firsts = firsts.select(F.col("digest").alias("f_digest"), "first")
    revisits = light.join(firsts, light["digest"] == firsts["f_digest"]).filter(~F.col("id").eqNullSafe(F.col("first")))
    revisits = revisits.select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "first").distinct()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"), digest.alias("digest"))
    rows = rows.join(revisits, rows["id"].eqNullSafe(revisits["r_id"]) & (rows["digest"] == revisits["r_digest"]), "left")
    rows = rows.select("id", "url", "body", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes)

        def index(entries: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*entries) if entries else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in slices(batches, 2):
            done = []
            for page, url, payload, name, first in zip(*[c.to_pylist() for c in batch.columns]):
                record = write_record(page, url, payload, name, first)
                done += writer.add(record_name(page, name), None if page is None else str(page), record)
            yield index(done)
        yield index(writer.close())

    names = [f.split()[0] for f in INDEX.split(", ")]
    return materialised(rows.mapInArrow(run, INDEX), "warc-index")


def read_bundles(index: DataFrame, id_type: T.DataType | None = None) -> DataFrame:
    """Every record of the indexed bundles: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A task reads single frames. A stored payload must have the digest and
    length of its headers and lie where the index says, or the read fails.
    """
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("at"))
    kind = id_type or T.LongType()
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for _, data in read_frames(row["bundle"], [row["frame"]]):
                    for place, (offset, length, headers, block) in zip(row["at"], read_records(data), strict=True):
                        if (offset, length) != (place["offset"], place["length"]):
                            raise ValueError(f"the index is wrong at {row['bundle']}, frame {row['frame']}, {offset}")
                        cut = block.index(b"\r\n\r\n") + 4
                        size = int(headers_of(block[: cut - 4])["content-length"])
                        name = headers["warc-payload-digest"].removeprefix("sha256:")
                        stored = headers["warc-type"] == "response"
                        if stored and (len(block) - cut != size or hashlib.sha256(block[cut:]).hexdigest() != name):
                            raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
                        ids = [unquote(headers.get(h, "<urn:page::>").split(":")[2]) or None for h in ("warc-record-id", "warc-refers-to")]
                        out.append((ids[0], size, name, headers["warc-type"], ids[1]))
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], names=names)

    # Entries are small and frames are read one by one, so tasks may hold many entries.
    found = frames.repartition("bundle", "frame").mapInArrow(run, schema)
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def archive_round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write all pages to new bundles in the shared folder and read them back."""
    index = write_bundles(pages, shared_dir(spark, "warc"), id_col=id_col)
    return read_bundles(index, pages.schema[id_col].dataType)


SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""
