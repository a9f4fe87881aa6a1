"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some WARC records, and a seek
table in a skippable frame at its end (the layout of the public seekable format). An index maps
record ids to (bundle, frame, offset in the frame, length), so one record costs a footer, a frame
and nothing else.

Payloads that occur more than once are written once: the row with the smallest id is the
response, the others are revisits that name it. Only distinct payloads are shuffled, one per
task and digest at most, however many rows share them.

Bundles are written by the tasks that hold the records, through Arrow's file systems, into the
folder given. A file's name holds its task attempt, and the index names only files of attempts
whose output Spark committed; leftovers of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import small_batches, table
from tarmac.session import scratch, stored

#: Bytes of records in a frame, and of compressed frames in a bundle, before the next begins.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
#: The pages carry no date of their own.
DATE = "1970-01-01T00:00:00Z"

_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER, _HEAD = struct.Struct("<II"), struct.Struct("<IBI"), struct.Struct("<II")

INDEX_TYPE = "page_id long, bundle string, frame int, offset long, length long"
RECORD_TYPE = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1: four letters for each five hex digits."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def plan_records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, digest, n_bytes, payload, refers_to, revisit) for each row of `pages`.

    `pages` has page_id, url and html; other columns are not read. A null html is an empty
    payload. Of rows with equal payloads of at least `revisit_bytes`, the one with the smallest
    page_id, then url, is the response, nulls last; a row repeated as a whole is archived as
    often as it occurs, once as a response at most. Revisits have no payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", "url", payload.alias("payload"),
        base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"),
    )
    place = F.struct(
        F.col("page_id").isNull().alias("no_id"), "page_id",
        F.col("url").isNull().alias("no_url"), "url",
    )
    shared = rows.where(F.col("n_bytes") >= revisit_bytes)
    responses = (
        shared.groupBy("digest", "n_bytes")
        .agg(F.min(place).alias("first"), F.any_value("payload").alias("payload"))
        .select("first.page_id", "first.url", "digest", "n_bytes", "payload",
                F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit"))
    )
    # The others, by their narrow columns alone.
    narrow = shared.groupBy("digest", "n_bytes", "page_id", "url").agg(F.count("*").alias("copies"))
    # Stored, so that the join below can split the rows of a digest that very many share.
    firsts = stored(
        shared.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("rows"))
        .where("rows > 1").select("digest", "first"),
        "firsts",
    )
    extra = F.col("copies") - (place == F.col("first")).cast("long")
    revisits = (
        narrow.join(firsts, "digest").withColumn("extra", extra).where("extra > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("extra").cast("int"))))
        .select("page_id", "url", "digest", "n_bytes", F.lit(None).cast("binary").alias("payload"),
                F.col("first.page_id").alias("refers_to"), F.lit(True).alias("revisit"))
    )
    single = rows.where(F.col("n_bytes") < revisit_bytes).select(
        "page_id", "url", "digest", "n_bytes", "payload",
        F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit"),
    )
    planned = responses.unionByName(revisits)
    return planned.unionByName(single) if revisit_bytes > 0 else planned


def _id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _record(page_id, url, digest, n_bytes, payload, refers_to, revisit) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url)
        lines.insert(3, f"WARC-Target-URI: {safe}")
    if revisit:
        lines.append(f"WARC-Refers-To: {_id(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _Bundle:
    """One file: frames as they fill up, then the seek table."""

    def __init__(self, folder: str, name: str):
        system, path = _open_fs(folder)
        system.create_dir(path, recursive=True)
        self.uri = f"{folder}/{name}"
        self.out = system.open_output_stream(f"{path}/{name}", compression=None)
        self.squeeze = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.buffer: list[bytes] = []
        self.held = self.size = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset and length of the record."""
        if self.held and self.held + len(record) > FRAME_BYTES:
            self.flush()
        at = len(self.frames), self.held, len(record)
        self.buffer.append(record)
        self.held += len(record)
        return at

    def flush(self) -> None:
        if self.buffer:
            frame = self.squeeze.compress(b"".join(self.buffer))
            self.out.write(frame)
            self.frames.append((len(frame), self.held))
            self.size += len(frame)
            self.buffer, self.held = [], 0

    def close(self) -> None:
        self.flush()
        body = b"".join(_ENTRY.pack(*f) for f in self.frames)
        body += _FOOTER.pack(len(self.frames), 0, _SEEKABLE)
        self.out.write(_HEAD.pack(_SKIPPABLE, len(body)) + body)
        self.out.close()


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records below `folder`; the index (INDEX_TYPE) of what was written.

    The index is stored below the folder too, with the writing done once; nothing is archived
    for an empty table.
    """
    small_batches(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        bundle, n = None, 0
        try:
            for batch in batches:
                where = []
                for row in zip(*(batch.column(c) for c in range(batch.num_columns))):
                    row = [x.as_py() for x in row]
                    if bundle is None:
                        bundle = _Bundle(folder, f"{name}-{n:04d}.warc.zst")
                        n += 1
                    where.append((row[0], bundle.uri, *bundle.add(_record(*row))))
                    if bundle.size >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
                if where:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*where), _INDEX_ARROW)],
                        names=[x.split()[0] for x in INDEX_TYPE.split(", ")],
                    )
        finally:
            if bundle is not None:
                bundle.close()

    columns = ["page_id", "url", "digest", "n_bytes", "payload", "refers_to", "revisit"]
    index = records.select(columns).mapInArrow(write, INDEX_TYPE)
    index.write.parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


_INDEX_ARROW = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]


def seek_table(source) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the end of an open bundle."""
    size = source.size()
    tail = source.read_at(_FOOTER.size, size - _FOOTER.size)
    count, _, magic = _FOOTER.unpack(tail)
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    body = source.read_at(count * _ENTRY.size, size - _FOOTER.size - count * _ENTRY.size)
    out, at = [], 0
    for packed, full in _ENTRY.iter_unpack(body):
        out.append((at, packed, full))
        at += packed
    return out


def read_frame(source, frame: tuple[int, int, int]) -> bytes:
    start, packed, full = frame
    return zstandard.ZstdDecompressor().decompress(source.read_at(packed, start), full)


def _number(text: str | None) -> int | None:
    found = re.search(r"x-page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Headers (with `http-length`), payload and end of the record at a place of a frame."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin, length = end + 4, int(headers["Content-Length"])
    cut = data.index(b"\r\n\r\n", begin, begin + length) + 4
    headers["http-length"] = re.search(rb"Content-Length: (\d+)", data[begin:cut])[1].decode()
    return headers, data[cut : begin + length], begin + length + 4


def _told(headers: dict, payload: bytes) -> tuple:
    revisit = headers["WARC-Type"] == "revisit"
    if revisit:
        n_bytes, digest = int(headers["http-length"]), headers["WARC-Payload-Digest"].split(":")[1]
    else:
        n_bytes = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (
        _number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), n_bytes, digest,
        headers["WARC-Type"], _number(headers.get("WARC-Refers-To")),
    )


_RECORD_ARROW = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def read_bundles(index: DataFrame) -> DataFrame:
    """All records (RECORD_TYPE) of the bundles that an index names, frame by frame.

    Sizes and digests of responses come from the payloads read; a revisit's from its headers.
    """
    bundles = index.select("bundle").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD_TYPE.split(", ")]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open_fs(uri)
                with system.open_input_file(path) as source:
                    for frame in seek_table(source):
                        data, at, rows = read_frame(source, frame), 0, []
                        while at < len(data):
                            headers, payload, at = parse_record(data, at)
                            rows.append(_told(headers, payload))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_ARROW)], names=names
                        )

    return bundles.mapInArrow(read, RECORD_TYPE)


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, payload) of the records that an index (or a part of one) names.

    Each costs a read of its frame; frames named more than once in a row are read once.
    Revisits have an empty payload.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, data = None, b""
            for page_id, uri, frame, offset, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if (uri, frame) != last:
                    system, path = _open_fs(uri)
                    with system.open_input_file(path) as source:
                        data = read_frame(source, seek_table(source)[frame])
                    last = (uri, frame)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([page_id], pa.int64()), pa.array([parse_record(data, offset)[1]])],
                    names=["page_id", "payload"],
                )

    columns = [x.split()[0] for x in INDEX_TYPE.split(", ")]
    return index.select(columns).mapInArrow(read, "page_id long, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = plan_records(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    index = write_bundles(records, scratch(spark, "warc"))
    return read_bundles(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_GROUPS = " || ".join(
    f"substr(a, ((n{i} >> 15) & 31) + 1, 1) || substr(a, ((n{i} >> 10) & 31) + 1, 1)"
    f" || substr(a, ((n{i} >> 5) & 31) + 1, 1) || substr(a, (n{i} & 31) + 1, 1)" for i in range(8)
)
SQL = f"""
WITH hashed AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
        sha1(coalesce(html, '')) AS h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a FROM pages
), numbers AS (
    SELECT *, {", ".join(f"('0x' || substr(h, {5 * i + 1}, 5))::BIGINT AS n{i}" for i in range(8))} FROM hashed
), told AS (
    SELECT page_id, payload_bytes, {_GROUPS} AS payload_digest,
        row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST) AS r,
        first_value(page_id) OVER (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST) AS first
    FROM numbers
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN r > 1 THEN first END AS refers_to
FROM told
"""
