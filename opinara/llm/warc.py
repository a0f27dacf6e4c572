"""WARC archives as seekable Zstandard bundles.

Writing: every task packs its records into independent Zstandard frames and the
frames into bundle files, each closed by the footer seek table of the seekable
format. A table maps record ids to bundle, frame and offset within the frame.
Reading: the seek tables give the frames, which tasks read and decompress
independently. Bundle names are new for every attempt and only those that the
index names count, so a task can be lost and run again at any time.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import slices, utf8
from opinara.session import saved, scratch_path

#: Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

#: Fixed value of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "record_id string, page_id bigint, bundle string, frame int, frame_start bigint, frame_bytes bigint, "
    "start bigint, length bigint"
)
RECORD_SCHEMA = (
    "record_id string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, verified boolean, bundle string, frame int, start bigint, payload binary"
)


class BundleWriter:
    """One bundle: frames, then the seek table in a skippable frame."""

    def __init__(self, folder: str, level: int):
        self.path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        fs, path = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def add(self, raw: bytes) -> tuple[str, int, int, int]:
        """Write one frame; its bundle, number, start and size."""
        packed = self.packer.compress(raw)
        at = (self.path, len(self.frames), self.size, len(packed))
        self.out.write(packed)
        self.frames.append((len(packed), len(raw)))
        self.size += len(packed)
        return at

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER_BYTES))
        self.out.write(table + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC))
        self.out.close()


def seek_table(bundle: str) -> list[tuple[int, int, int]]:
    """(start, packed bytes, raw bytes) of each frame, from the footer alone."""
    fs, path = pafs.FileSystem.from_uri(bundle)
    with fs.open_input_file(path) as f:
        end = f.size()
        f.seek(end - FOOTER_BYTES)
        count, flags, magic = struct.unpack("<IBI", f.read(FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC or flags & 0x80:
            raise ValueError(f"{bundle} has no seek table of this kind")
        f.seek(end - FOOTER_BYTES - 8 * count)
        sizes = struct.unpack(f"<{2 * count}I", f.read(8 * count))
    out, at = [], 0
    for packed, raw in zip(sizes[::2], sizes[1::2], strict=True):
        out.append((at, packed, raw))
        at += packed
    return out


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{digest}'.encode()).digest())}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool, date: str) -> tuple[str, bytes]:
    name = record_id(page_id, digest)
    clean = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""]
    block = b"\r\n".join(http) + (b"" if is_revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("X-Has-Url: 1")
    if is_revisit:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _parsed(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(start, headers, block) of every record of a frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield at, headers, raw[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, refers_to): refers_to is the page whose equal payload is stored.

    Only digests that occur more than once are joined back; adaptive execution
    broadcasts them or splits a hot one.
    """
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.unhex(F.sha1("html")))
    groups = (
        page.where(F.octet_length("html") >= min_bytes)
        .groupBy("sha1")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("largest"))
        .where("n > 1 and largest is not null")
        .select("sha1", "largest")
    )
    joined = page.join(saved(groups, "payloads"), "sha1", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "sha1", F.when(revisit, F.col("largest")).alias("refers_to"))


def write_bundles(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28,
    level: int = 3, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one WARC record per row of pages (page_id, url, html); return the index table.

    Of the records with equal payloads of at least `min_bytes` bytes, that with the
    largest page_id is the response and the others revisit it; smaller ones are all
    responses. Null html is an empty payload. Repeated rows each get a record: those
    with the largest page_id are all responses, and equal rows share a record id. A
    row without page_id is a record without that header, and a revisit if another row
    of its payload has one. Null url leaves the target as urn:page:<id>. An empty table
    writes nothing. Other columns are ignored. A record larger than `frame_bytes`
    has a frame of its own. `folder` must be reachable by all executors; the default
    is a new one below the shared work folder.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")

    def write(batches):
        bundle: BundleWriter | None = None
        frame: list[tuple] = []
        parts: list[bytes] = []
        held = 0
        for batch in slices(batches):
            columns = [c.to_pylist() for c in batch.columns[:2]]
            for page_id, url, payload, sha1, refers_to in zip(
                *columns, utf8(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True
            ):
                digest = base64.b32encode(sha1).decode()
                name, raw = _record(page_id, url, payload, digest, refers_to, refers_to is not None, date)
                frame.append((name, page_id, held, len(raw)))
                parts.append(raw)
                held += len(raw)
                if held >= frame_bytes:
                    bundle = bundle or BundleWriter(folder, level)
                    yield _index_rows(frame, bundle.add(b"".join(parts)))
                    frame, parts, held = [], [], 0
                    if bundle.size >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if frame:
            bundle = bundle or BundleWriter(folder, level)
            yield _index_rows(frame, bundle.add(b"".join(parts)))
        if bundle:
            bundle.close()

    return saved(with_revisits(pages, min_bytes).mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _index_rows(frame: list[tuple], at: tuple[str, int, int, int]) -> pa.RecordBatch:
    names, ids, starts, lengths = zip(*frame, strict=True)
    n = len(frame)
    columns = [
        pa.array(names, pa.string()), pa.array(ids, pa.int64()), pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int32()),
        pa.array([at[2]] * n, pa.int64()), pa.array([at[3]] * n, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["record_id", "page_id", "bundle", "frame", "frame_start", "frame_bytes", "start", "length"])


def frames_of(spark: SparkSession, bundles: DataFrame) -> DataFrame:
    """(bundle, frame, frame_start, frame_bytes) of all frames, read from the bundles' seek tables."""

    def run(batches):
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                table = seek_table(bundle)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bundle] * len(table), pa.string()), pa.array(range(len(table)), pa.int32()),
                        pa.array([f[0] for f in table], pa.int64()), pa.array([f[1] for f in table], pa.int64()),
                    ],
                    ["bundle", "frame", "frame_start", "frame_bytes"],
                )

    names = bundles.select("bundle").distinct()
    tasks = max(1, -(-names.count() // 64))  # opening a footer takes longer than its row is wide
    return names.repartition(tasks, "bundle").mapInArrow(run, "bundle string, frame int, frame_start bigint, frame_bytes bigint")


def read_frames(frames: DataFrame, payloads: bool = True, task_bytes: int = 32 << 20) -> DataFrame:
    """The records of the given frames (bundle, frame, frame_start, frame_bytes), see RECORD_SCHEMA.

    payload_bytes is of the full payload, also for a revisit, whose own payload is
    empty. `verified` says of a response that its payload has the recorded digest,
    and is null for a revisit. With payloads=False the payload column is null.
    """
    total = frames.agg(F.sum("frame_bytes")).first()[0] or 0
    spread = frames.repartition(max(1, -(-total // task_bytes)), "bundle", "frame")

    def run(batches):
        names = ("record_id", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "verified", "bundle", "frame", "start", "payload")
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int64(), pa.binary())
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(row["bundle"])
                with fs.open_input_file(path) as f:
                    f.seek(row["frame_start"])
                    raw = unpacker.decompress(f.read(row["frame_bytes"]))
                out: list[tuple] = []
                for start, headers, block in _parsed(raw):
                    response = headers["WARC-Type"] == "response"
                    cut = block.index(b"\r\n\r\n") + 4
                    size = int(block[:cut].rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload = block[cut:]
                    out.append((
                        headers["WARC-Record-ID"], _number(headers.get("X-Page-Id")),
                        headers["WARC-Target-URI"] if "X-Has-Url" in headers else None, headers["WARC-Type"],
                        _number(headers.get("X-Refers-To-Page")), size, digest,
                        base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest if response else None,
                        row["bundle"], row["frame"], start, payload if payloads else None,
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], list(names))

    return spread.mapInArrow(run, RECORD_SCHEMA)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the wanted page_ids: only the frames that hold them are read."""
    ids = wanted.select("page_id").distinct()
    hits = index.join(ids, "page_id", "left_semi")
    frames = hits.select("bundle", "frame", "frame_start", "frame_bytes").distinct()
    return read_frames(frames).join(ids, "page_id", "left_semi")
