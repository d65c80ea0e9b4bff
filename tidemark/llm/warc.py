"""WARC archives as seekable Zstandard bundles.

Pages become WARC records. Of records with equal payloads of at least ``LEAST_BYTES`` bytes the one
with the smallest page id is a response, the others are revisits that refer to it. Records are grouped
into independent Zstandard frames; a bundle file ends in a skippable frame with the seek table of the
public seekable format (compressed and plain size and checksum of each frame), so any frame can be
read alone. The index, a table, maps each record to its file, frame and offset within the plain frame.

Tasks write bundles through the file system of the given folder, which all executors must share. A
file's name holds the task attempt, and only the attempt whose rows Spark keeps is in the index, so
a lost executor or a repeated task leaves no wrong record.

Defined cases: a null page body is an empty payload; a null url leaves the header out; rows that share
the smallest page id of a payload are all responses; a null page id is larger than any other; an empty
table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import stored

LEAST_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 27
#: The tables have no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"

# Fixed values of the WARC and seekable Zstandard formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

INDEX = "page_id bigint, path string, frame int, frame_at bigint, frame_bytes bigint, record_at bigint, record_bytes bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, frame int, record_at bigint"


def planned(pages: DataFrame) -> DataFrame:
    """Pages with payload, its size and digest, and ``first``: the page that holds an equal payload.

    Only digests and ids are grouped, folded per task first; payloads that very many pages share are
    joined where they lie, the rest by digest.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.col("size") >= LEAST_BYTES)
    per_digest = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("alike"))
    joined = join_per_key(large, per_digest, "digest", "alike").drop("alike")
    small = rows.filter(F.col("size") < LEAST_BYTES).withColumn("first", F.col("page_id"))
    return joined.unionByName(small)


# ---- writing ---------------------------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    revisit = first is not None and first != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", CAPTURED),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Refers-To", _urn(first)), ("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page", str(first))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder


class _Bundle:
    """One bundle file being written, frame by frame."""

    def __init__(self, folder: str, name: str):
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        self.path = f"{folder}/{name}"
        self.out = files.open_output_stream(f"{path}/{name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int, int]] = []
        self.waiting: list[tuple[int | None, bytes]] = []
        self.plain = self.size = 0

    def add(self, page_id: int | None, record: bytes) -> list[tuple]:
        self.waiting.append((page_id, record))
        self.plain += len(record)
        return self.end_frame() if self.plain >= FRAME_BYTES else []

    def end_frame(self) -> list[tuple]:
        """Write the waiting records as one frame; gives their index rows."""
        if not self.waiting:
            return []
        data = b"".join(r for _, r in self.waiting)
        packed = self.pack.compress(data)
        rows, at = [], 0
        for page_id, record in self.waiting:
            rows.append((page_id, self.path, len(self.frames), self.size, len(packed), at, len(record)))
            at += len(record)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(packed)
        self.waiting, self.plain = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.end_frame()
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()
        return rows


def archive(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as bundles below ``folder``; gives the stored index."""
    schema = pa.schema(
        [(n, pa.string() if n == "path" else pa.int32() if n == "frame" else pa.int64()) for n in _names(INDEX)]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        bundle, n = None, 0
        for batch in batches:
            rows: list[tuple] = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle is None:
                    bundle = _Bundle(folder, f"bundle-{task.partitionId():06d}-{n:04d}-{task.taskAttemptId()}.warc.zst")
                    n += 1
                rows += bundle.add(values[0], _record(*values))
                if bundle.size >= BUNDLE_BYTES:
                    rows += bundle.close()
                    bundle = None
            if rows:
                yield _rows(rows, schema)
        if bundle is not None and (rows := bundle.close()):
            yield _rows(rows, schema)

    plan = planned(pages).select("page_id", "url", "payload", "digest", "first")
    return stored(plan.mapInArrow(write, INDEX), "warc-index")


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(",")]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


# ---- reading ---------------------------------------------------------------------------------


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int, int]]:
    """(offset, compressed size, plain size, checksum) of each frame, from the end of a bundle."""
    end = file.size()
    footer = struct.calcsize("<IBI")
    file.seek(end - footer)
    n, descriptor, magic = struct.unpack("<IBI", file.read(footer))
    if magic != SEEKABLE or descriptor != HAS_CHECKSUMS:
        raise ValueError("not a bundle with a seek table")
    file.seek(end - footer - 12 * n)
    table, at, out = file.read(12 * n), 0, []
    for packed, plain, check in struct.iter_unpack("<III", table):
        out.append((at, packed, plain, check))
        at += packed
    return out


def frame(file: pa.NativeFile, at: int, packed: int, plain: int, check: int) -> bytes:
    file.seek(at)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
    if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("frame does not match its seek table")
    return data


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record at ``at``."""
    blank = data.index(b"\r\n\r\n", at)
    lines = data[at:blank].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = blank + 4
    end = start + int(fields["Content-Length"])
    return fields, data[start:end], end + 4


def _found(fields: dict[str, str], block: bytes, number: int, at: int) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length"))
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != stated:
            raise ValueError("payload does not match its record")
    page, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return (page and int(page), size, stated, fields["WARC-Type"], first and int(first), number, at)


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, checked against digest and seek table."""
    spark = index.sparkSession
    kinds = {"payload_digest": pa.string(), "record_type": pa.string(), "frame": pa.int32()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in _names(RECORDS)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _file_system(path)
                with files.open_input_file(name) as file:
                    for number, entry in enumerate(seek_table(file)):
                        data, at, rows = frame(file, *entry), 0, []
                        while at < len(data):
                            fields, block, end = parse(data, at)
                            rows.append(_found(fields, block, number, at))
                            at = end
                        yield _rows(rows, schema)

    paths = index.select("path").distinct()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(tasks).mapInArrow(read, RECORDS)


def fetch(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """The records of some pages, each read alone by its frame and offset: ``page_id``, ``record``.

    Rows of a frame stay together in a batch only by chance; a frame is 256 KB, so reading it twice
    costs little.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, path, _, at, packed, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                files, name = _file_system(path)
                with files.open_input_file(name) as file:
                    file.seek(at)
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(file.read(packed))
                out.append((page_id, data[start : start + size]))
            yield _rows(out, pa.schema([("page_id", pa.int64()), ("record", pa.binary())]))

    wanted = index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")
    return wanted.select(*_names(INDEX)).mapInArrow(read, "page_id bigint, record binary")
