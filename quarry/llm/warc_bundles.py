"""WARC archives as seekable Zstandard bundles.

Each archive groups records into independent Zstandard frames of about ``frame_bytes`` and
ends with a seek table (a skippable frame with the compressed and decompressed size of
every frame), so any reader of the seekable format can open it and any plain Zstandard
reader can stream it.  The index maps a record to its archive, frame and the offset inside
the decompressed frame; ``read_records`` fetches and decompresses only the frames it needs.

Of records with equal payloads (SHA-1 and length) the one with the largest page_id is a
response and the others are revisits that refer to it; with ``least_bytes`` above 0, smaller
payloads are always responses.  Equal payloads are found by a pre-aggregated group per
digest, joined back to the rows; a very common payload is split by the skewed-join handling.

Tasks write their archives under new names into the shared folder and return index rows, so
only archives of successful attempts are ever named.

Defined results: null html is an empty payload; a null url leaves its header out; rows that
share the largest page_id of a payload are all responses; among rows without a page_id only,
all are responses, and otherwise such rows are revisits.  Other columns are ignored.  An
empty table gives no archive and an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import shared_path, whole_text

INDEX = ("page_id long, archive string, frame int, frame_start long, frame_bytes long, "
         "record_start long, record_bytes long")
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long")
MOST_TASKS, PART_FRAMES = 100_000, 4
# fixed values of the formats
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


# -- records

def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    block = HTTP + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record in ``data``."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at offset {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, data[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def describe(headers: dict[str, str], block: bytes) -> tuple:
    """The RECORD columns; a response's payload is checked against its headers."""
    digest, size = headers["warc-payload-digest"].partition(":")[2], int(headers["x-payload-length"])
    if headers["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or base32_sha1(payload) != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    return (_page(headers["warc-record-id"]), size, digest, headers["warc-type"], _page(headers.get("warc-refers-to")))


# -- bundles

class BundleWriter:
    """Appends records to one archive; ``add`` returns (frame, offset in the frame)."""

    def __init__(self, path: str, frame_bytes: int):
        import zstandard

        where, name = fs.FileSystem.from_uri(path)
        self.out, self.limit = where.open_output_stream(name, compression=None), frame_bytes
        self.pack = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []  # start, compressed, decompressed
        self.held, self.size, self.end = [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.size and self.size + len(record) > self.limit:
            self.flush()
        place = (len(self.frames), self.size)
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        if self.held:
            packed = self.pack.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((self.end, len(packed), self.size))
            self.end, self.held, self.size = self.end + len(packed), [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", c, d) for _, c, d in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of every frame, from the archive's footer."""
    size = file.size()
    frames, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the archive")
    width = 12 if flags & 0x80 else 8
    raw = file.read_at(frames * width, size - 9 - frames * width)
    out, at = [], 0
    for i in range(frames):
        c, d = struct.unpack_from("<II", raw, i * width)
        out.append((at, c, d))
        at += c
    return out


def read_frames(path: str, first: int = 0, frames: int | None = None) -> Iterator[bytes]:
    """``frames`` frames from number ``first`` on (None: all), found by the seek table."""
    import zstandard

    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as file:
        unpack = zstandard.ZstdDecompressor()
        for start, packed, plain in seek_table(file)[first:None if frames is None else first + frames]:
            yield unpack.decompress(file.read_at(packed, start), max_output_size=plain)


# -- tables

def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to (null for responses)."""
    payload = F.encode(whole_text("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    firsts = (rows.filter(F.col("size") >= least_bytes).groupBy("digest", "size")
              .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(firsts, ["digest", "size"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_bundles(pages: DataFrame, path: str, frame_bytes: int = 1 << 20, archive_bytes: int = 256 << 20,
                  least_bytes: int = 0) -> DataFrame:
    """Writes one record per row under ``path`` and returns the index, read from
    ``path``/index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, name, rows = None, "", []

        def finish() -> pa.RecordBatch:
            bundle.close()
            cols = [list(x) for x in zip(*[(p, name, f, *bundle.frames[f][:2], at, n) for p, f, at, n in rows])]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, INDEX_TYPES)], names=INDEX_NAMES)

        for batch in batches:
            for i in range(batch.num_rows):
                if bundle is None:
                    name, rows = f"{path}/{uuid.uuid4().hex}.warc.zst", []
                    bundle = BundleWriter(name, frame_bytes)
                page, url, payload, refers = (batch.column(k)[i].as_py() for k in range(4))
                record = make_record(page, url, payload, refers)
                rows.append((page, *bundle.add(record), len(record)))
                if bundle.end >= archive_bytes:
                    yield finish()
                    bundle = None
        if bundle is not None:
            yield finish()

    where, name = fs.FileSystem.from_uri(path)
    where.create_dir(name, recursive=True)
    with_roles(pages, least_bytes).mapInArrow(run, INDEX).write.parquet(f"{path}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
INDEX_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
RECORD_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def _described(found: list[tuple]) -> pa.RecordBatch:
    cols = [list(c) for c in zip(*found)] or [[]] * len(RECORD_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, RECORD_TYPES)],
                                      names=[x.split()[0] for x in RECORD.split(", ")])


def read_bundles(index: DataFrame) -> DataFrame:
    """The RECORD columns of every record in the index's archives, read frame by frame; the
    work is dealt in runs of ``PART_FRAMES`` frames, so that a large archive is split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, part in zip(*(batch.column(c).to_pylist() for c in ("archive", "part"))):
                for data in read_frames(path, part * PART_FRAMES, PART_FRAMES):
                    yield _described([describe(*r) for r in parse_records(data)])

    # few rows, but much work per row: dealt by their order, not by hash or bytes
    parts = index.select("archive", F.floor(F.col("frame") / PART_FRAMES).cast("int").alias("part")).distinct()
    tasks = max(1, min(parts.count(), MOST_TASKS))
    return parts.repartitionByRange(tasks, "archive", "part").mapInArrow(run, RECORD)


def read_records(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """page_id, headers and block of the records whose page_id is in ``wanted``; only
    their frames are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                where, name = fs.FileSystem.from_uri(r["archive"])
                with where.open_input_file(name) as file:
                    plain = unpack.decompress(file.read_at(r["frame_bytes"], r["frame_start"]))
                (headers, block), = parse_records(plain[r["record_start"]:r["record_start"] + r["record_bytes"]])
                yield pa.RecordBatch.from_pylist(
                    [{"page_id": r["page_id"], "headers": list(headers.items()), "block": block}],
                    schema=pa.schema([("page_id", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
                                      ("block", pa.binary())]))

    return (index.join(wanted.select("page_id").distinct(), "page_id")
                 .select(*INDEX_NAMES).mapInArrow(run, "page_id long, headers map<string,string>, block binary"))


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the archives of ``pages`` in the shared folder and reads them back."""
    return read_bundles(write_bundles(pages, shared_path(spark, "warc")))
