"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole records up to about
``frame_bytes``, and a last, skippable frame with the seek table: the compressed and
decompressed size and a checksum of every frame. Every record is mapped to (bundle, frame,
offset inside the decompressed frame, length), so one record costs one frame to read.

Of records with equal payloads (same SHA-1 and length) of at least ``min_bytes`` the one with
the smallest id is a response and the others are revisits that name it; revisits carry no payload.

Writers work inside Spark tasks, under a name of their own for each attempt. The record map is
written as a Spark table, so only bundles of tasks that were committed are in it; files left by
lost attempts are never read.

Defined cases: null payload is the empty payload; null url gives a record without a target URI;
control characters in a url are percent-encoded; a record with a null id is a response unless a
non-null id has its payload; rows that repeat id and payload are all what that id is; an empty
table gives an empty map and no bundles.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickgate.llm.common import parted, ready, written
from tickgate.session import arrow_uri, ensure_checkpoint_dir

# Fixed values of the WARC 1.1 and Zstandard seekable formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
ID_URN = "urn:page-id:"

MAP_SCHEMA = "record_id string, bundle string, frame int, frame_at long, frame_size long, offset long, length long"
RECORD_SCHEMA = ("record_id string, record_type string, refers_to string, url string, payload binary, "
                 "payload_bytes long, payload_digest string")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- records

def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def make_record(record_id: str, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """One response, or one revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_URN}{record_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID_URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of one decompressed frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if lines[0] != VERSION:
            raise ValueError("not a WARC record")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError("cut-off WARC record")
        yield fields, block
        at = end + 8 + size


def _urn(value: str | None) -> str | None:
    return None if value is None else value.strip("<>").removeprefix(ID_URN)


def open_record(fields: dict[str, str], block: bytes) -> tuple:
    """A row of RECORD_SCHEMA; a response's payload must have the digest that its header gives."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if kind == "response" and (digest(payload) != stated or len(payload) != length):
        raise ValueError(f"payload of {fields['warc-record-id']} does not fit its digest")
    return (_urn(fields["warc-record-id"]), kind, _urn(fields.get("warc-refers-to")), fields.get("warc-target-uri"),
            payload if kind == "response" else None, length, stated)


# ---------------------------------------------------------------- bundles

def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The skippable frame for (compressed size, decompressed size, checksum) of each frame."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int, int]]:
    """(start, compressed size, decompressed size, checksum) of each frame of an open bundle."""
    f.seek(0, 2)
    end = f.tell()
    f.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
        raise ValueError("no seek table")
    f.seek(end - 9 - 12 * n)
    body, out, at = f.read(12 * n), [], 0
    for i in range(n):
        packed, plain, check = struct.unpack_from("<III", body, 12 * i)
        out.append((at, packed, plain, check))
        at += packed
    return out


def checksum(data: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class BundleWriter:
    """Writes records to one bundle; ``places`` gets a row of MAP_SCHEMA per record."""

    def __init__(self, fs, path: str, name: str, frame_bytes: int, level: int = 3):
        import zstandard
        self.out, self.name, self.frame_bytes = fs.open_output_stream(path, compression=None), name, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.frames, self.places, self.at, self.held, self.parts = [], [], 0, 0, []

    def add(self, record_id: str | None, record: bytes) -> None:
        self.parts.append((record_id, record))
        self.held += len(record)
        if self.held >= self.frame_bytes:
            self.cut()

    def cut(self) -> None:
        if not self.parts:
            return
        plain = b"".join(r for _, r in self.parts)
        packed = self.pack(plain)
        self.out.write(packed)
        offset = 0
        for record_id, r in self.parts:
            self.places.append((record_id, self.name, len(self.frames), self.at, len(packed), offset, len(r)))
            offset += len(r)
        self.frames.append((len(packed), len(plain), checksum(plain)))
        self.at += len(packed)
        self.parts, self.held = [], 0

    def close(self) -> None:
        self.cut()
        self.out.write(seek_table(self.frames))
        self.out.close()


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(uri)


# ---------------------------------------------------------------- Spark

def archive_folder(spark: SparkSession) -> str:
    """A new folder for bundles beside the session's shared checkpoints."""
    return f"{arrow_uri(ensure_checkpoint_dir(spark).rstrip('/'))}/warc-{uuid.uuid4().hex}"


def roles(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """The revisits: id, sha, refers_to. Groups are found on narrow rows, aggregated before the shuffle."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = written(pages.select(F.col(id_col).alias("id"), F.sha1(payload).alias("sha"),
                                F.octet_length(payload).alias("n")))
    first = written(rows.where(F.col("n") >= min_bytes).groupBy("sha", "n")
                    .agg(F.min("id").alias("refers_to"), F.count("*").alias("copies"))
                    .where("copies > 1 AND refers_to IS NOT NULL").drop("copies"))
    return rows.join(first, ["sha", "n"]).where("NOT id <=> refers_to").select("id", "sha", "refers_to").distinct()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write every row of ``pages`` as one record into bundles under ``folder``; return the record map."""
    ready(pages.sparkSession)
    again = written(roles(pages, id_col, payload_col, min_bytes).withColumnsRenamed({"id": "__id", "sha": "__sha"}))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # only payloads that may be revisits shuffle
    alone, hits = parted(rows, "id", again.select("__id").distinct(), "__id")
    met = hits.join(again, hits["id"].eqNullSafe(again["__id"]) & (hits["sha"] == again["__sha"]), "left")
    rows = alone.withColumn("refers_to", F.lit(None)).unionByName(met.select(*alone.columns, "refers_to")).select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("id"), "url", "payload",
        F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        fs, top = _filesystem(folder)
        names = [c.split()[0] for c in MAP_SCHEMA.split(", ")]
        types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in MAP_SCHEMA.split(", ")])
        bundle = None
        flushed = lambda b: pa.RecordBatch.from_arrays(
            [pa.array(col, t.type) for col, t in zip(zip(*b.places), schema)], names=names)
        for batch in batches:
            for i, u, p, r in zip(*(batch.column(k) for k in range(4))):
                if bundle is None:
                    fs.create_dir(top, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(fs, f"{top}/{name}", f"{folder}/{name}", frame_bytes)
                bundle.add(i.as_py(), make_record(i.as_py(), u.as_py(), p.as_py(), r.as_py()))
                if bundle.at >= bundle_bytes:
                    bundle.close()
                    yield flushed(bundle)
                    bundle = None
        if bundle is not None:
            bundle.close()
            yield flushed(bundle)

    return written(rows.mapInArrow(run, MAP_SCHEMA))


def _batches(rows: Iterator[tuple], schema: str, most_rows: int = 512, most_bytes: int = 8 << 20) -> Iterator:
    """Rows of RECORD_SCHEMA as Arrow batches of bounded size."""
    import pyarrow as pa
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}
    fields = [c.split() for c in schema.split(", ")]
    held, size = [], 0
    out = lambda: pa.RecordBatch.from_arrays(
        [pa.array(col, types[t]) for col, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(held) >= most_rows or size >= most_bytes:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def frames_of(record_map: DataFrame) -> DataFrame:
    """The frames of all bundles in the map, from the bundles' own seek tables."""
    ready(record_map.sparkSession)
    schema = "bundle string, frame int, frame_at long, frame_size long, plain_size long, checksum long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for b in batch.column(0):
                fs, path = _filesystem(b.as_py())
                with fs.open_input_file(path) as f:
                    table = read_seek_table(f)
                cols = [[b.as_py()] * len(table), list(range(len(table))), *map(list, zip(*table))]
                if table:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int32(), *[pa.int64()] * 4])],
                        names=[x.split()[0] for x in schema.split(", ")])

    spark = record_map.sparkSession
    bundles = record_map.select("bundle").distinct()
    return written(bundles.repartition(spark.sparkContext.defaultParallelism, "bundle").mapInArrow(run, schema))


def read_all(record_map: DataFrame, payloads: bool = True, task_bytes: int = 32 << 20) -> DataFrame:
    """Every record of the mapped bundles, read back frame by frame; checksums and digests are verified."""
    frames = frames_of(record_map)
    total = frames.agg(F.sum("plain_size")).first()[0] or 0
    # tasks are dealt by number, since the rows that name the frames are tiny and would be merged
    n = max(frames.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))

    def run(batches: Iterator) -> Iterator:
        import zstandard
        unpack = zstandard.ZstdDecompressor()

        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    fs, path = _filesystem(r["bundle"])
                    with fs.open_input_file(path) as f:
                        f.seek(r["frame_at"])
                        plain = unpack.decompress(f.read(r["frame_size"]), max_output_size=r["plain_size"])
                    if len(plain) != r["plain_size"] or checksum(plain) != r["checksum"]:
                        raise ValueError(f"frame {r['frame']} of {r['bundle']} is damaged")
                    for fields, block in parse_records(plain):
                        row = open_record(fields, block)
                        yield row if payloads else (*row[:4], None, *row[5:])
        yield from _batches(rows(), RECORD_SCHEMA)

    return frames.repartition(int(n), "bundle", "frame").mapInArrow(run, RECORD_SCHEMA)


def fetch(record_map: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records named in ``record_ids`` (column record_id): each reads its frame and cuts its bytes."""
    ready(record_map.sparkSession)
    wanted = record_map.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")

    def run(batches: Iterator) -> Iterator:
        import zstandard
        unpack = zstandard.ZstdDecompressor()

        def rows():
            last, plain = None, b""
            for batch in batches:
                for r in batch.to_pylist():
                    if (r["bundle"], r["frame"]) != last:
                        fs, path = _filesystem(r["bundle"])
                        with fs.open_input_file(path) as f:
                            f.seek(r["frame_at"])
                            plain = unpack.decompress(f.read(r["frame_size"]))
                        last = (r["bundle"], r["frame"])
                    for fields, block in parse_records(plain[r["offset"]:r["offset"] + r["length"]]):
                        yield open_record(fields, block)
        yield from _batches(rows(), RECORD_SCHEMA)

    return wanted.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset") \
        .mapInArrow(run, RECORD_SCHEMA)
