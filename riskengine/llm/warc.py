"""WARC writing with revisit records, and a salvage reader.

Writer: one gzip member per record, archives of bounded size written by the tasks straight to the shared
folder. Of the records with equal payloads of ``REVISIT_BYTES`` or more, that with the largest ``page_id``
is a response and the others revisit it; smaller ones are responses. A manifest lists the archives of
the attempts that succeeded; files left by lost attempts are in no manifest.

Reader: members and records are checked (gzip CRC, version line, length, block and payload digest). After
a failed check it searches for the next member or version line whose record is valid, goes on from there, and reports the bytes
between as a quarantined gap with the reason.

A member may hold many records (an archive compressed as a whole). It is inflated in a stream and its bytes
are walked like a file's: after a failed record they are searched for the next version line. Such
records and gaps carry ``inner_offset``, their place in the inflated bytes; ``offset`` is then the member's and
``length`` counts inflated bytes. Where such a member breaks off, the records before the damage are kept, but for the last
one, which only the member's end confirms; the gap then starts at most ``BACK`` bytes before the first byte not known to be sound.

Defined results: a null html is an empty payload. A null ``page_id`` comes back as null; where all ids of
equal payloads are null, each is a response. Repeated rows with the largest id are all responses. URLs lose line
breaks. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm.store import materialise
from riskengine.session import scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
READ_BYTES = 1 << 20
CHUNK_BYTES = 1 << 16
BACK = 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
STARTS = re.compile(re.escape(MAGIC) + rb"|WARC/1\.")


def filesystem(uri: str):
    """pyarrow file system and path of a folder or file that all executors share."""
    from pyarrow import fs

    if uri.startswith("s3a://"):
        uri = "s3://" + uri[6:]
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One uncompressed record; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + re.sub(r"[\r\n]+", "", url or ""),
        f"WARC-Payload-Digest: {_sha1(payload)}",
        f"WARC-Block-Digest: {_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = filesystem(folder)
        held, size, count = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, count
            name = f"{where}/{uuid.uuid4().hex}.warc.gz"
            with fs.open_output_stream(name, compression=None) as out:
                for part in held:
                    out.write(part)
            row = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name.rsplit('/', 1)[1]}"]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["path", "bytes", "records"])
            held, size, count = [], 0, 0
            return row

        for batch in batches:
            ids, urls, refers = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
            payloads = batch.column("payload")
            for i in range(len(ids)):
                packed = member(record_bytes(ids[i], urls[i], payloads[i].as_py(), refers[i]))
                held.append(packed)
                size += len(packed)
                count += 1
                if size >= limit:
                    yield flush()
        if held:
            yield flush()

    return run


def with_roles(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least, F.sha1("payload")))
    tops = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 and top is not null").select("digest", "top")
    refers = F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return rows.join(tops, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as archives in ``folder`` (default: a new one in the shared scratch folder);
    returns the stored manifest (path, bytes, records)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    hadoop = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hadoop.mkdirs(path)
    hadoop.deleteOnExit(path)
    return materialise(with_roles(pages).mapInArrow(_writer(folder, archive_bytes), "path string, bytes long, records long"), "warc-manifest")


class _Input:
    """A file read forward in pieces, of which a stretch is held."""

    def __init__(self, handle):
        self.handle, self.data, self.start, self.done = handle, b"", 0, False

    def fill(self, upto: int) -> bool:
        """Hold bytes up to position ``upto``; False if the file ends before."""
        parts, have = [self.data], self.start + len(self.data)
        while have < upto and not self.done:
            got = self.handle.read(max(READ_BYTES, upto - have))
            if not got:
                self.done = True
            parts.append(got)
            have += len(got)
        if len(parts) > 1:
            self.data = b"".join(parts)
        return have >= upto

    def drop(self, before: int) -> None:
        """Forget bytes before a position, some time."""
        if before - self.start > READ_BYTES // 4:
            self.data = self.data[before - self.start :]
            self.start = before

    def find(self, at: int) -> int:
        """Position from ``at`` on where a member or a version line may begin, or -1; forgets what lies before."""
        while True:
            hit = STARTS.search(self.data, max(0, at - self.start))
            if hit:
                return self.start + hit.start()
            end = self.start + len(self.data)
            if not self.fill(end + 1):
                return -1
            at = max(at, end - 8)
            self.drop(at)


class Damaged(Exception):
    """A record or member that fails its checks; ``sound``: where its sound bytes end, if any records came of it."""

    def __init__(self, reason: str, sound: int | None = None):
        super().__init__(reason)
        self.sound = sound


class _Inflated:
    """The inflated bytes of the gzip member at ``at``, read forward; ``broken`` tells why they ended early."""

    def __init__(self, source: _Input, at: int):
        self.source, self.at, self.end = source, at, at
        self.unpack, self.tail, self.total, self.step = zlib.decompressobj(31), b"", 0, CHUNK_BYTES
        self.broken: str | None = None
        self.reached: deque[tuple[int, int]] = deque()  # inflated bytes, and the packed bytes that gave them

    def read(self, most: int) -> bytes:
        while not self.unpack.eof and not self.broken:
            if not self.tail:
                if not self.source.fill(self.end + 1):
                    self.broken = "member is cut off"
                    break
                self.tail = self.source.data[self.end - self.source.start :][:CHUNK_BYTES]
            before, piece = self.unpack.copy(), self.tail[: self.step]
            try:
                out = self.unpack.decompress(piece, most)
            except zlib.error:
                # a failed call loses what it has inflated so far: go up to the damage in smaller steps
                if len(piece) == 1:
                    self.broken = "member does not inflate"
                    break
                self.unpack, self.step = before, max(1, len(piece) // 8)
                continue
            left = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            self.end += len(piece) - len(left)
            self.tail = left + self.tail[self.step :]
            self.total += len(out)
            self.reached.append((self.total, self.end))
            if out:
                return out
        return b""

    def sound(self, upto: int) -> int:
        """A position in the file before which all bytes are known to have given the first ``upto`` inflated ones."""
        while len(self.reached) > 1 and self.reached[1][0] <= upto:
            self.reached.popleft()
        known = self.reached[0][1] if self.reached and self.reached[0][0] <= upto else 0
        return max(self.at + 1, known - BACK)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record at the start of ``data``."""
    if not VERSION.match(data):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise Damaged("header does not end")
    headers = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        raise Damaged("no length")
    stop = end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("record does not end where it says")
    block = data[end + 4 : stop]
    told = headers.get("warc-block-digest")
    if told and told.startswith("sha1:") and told != _sha1(block):
        raise Damaged("block digest differs")
    return headers, block, stop + 4


def _described(headers: dict[str, str], block: bytes) -> dict:
    """Fields of a checked record."""
    page = re.fullmatch(r"<urn:x-page:(-?\d+)>", headers.get("warc-record-id", ""))
    to = re.fullmatch(r"<urn:x-page:(-?\d+)>", headers.get("warc-refers-to", ""))
    kind = headers.get("warc-type", "")
    http, gap, payload = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
    told = headers.get("warc-payload-digest", "")
    if kind == "revisit":
        length = re.search(rb"(?i)^content-length:\s*(\d+)\s*$", http, re.M)
        size, payload = (int(length[1]) if length else None), None
        digest = base64.b32decode(told[5:]).hex() if told.startswith("sha1:") else None
    else:
        if told.startswith("sha1:") and told != _sha1(payload):
            raise Damaged("payload digest differs")
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {
        "page_id": int(page[1]) if page else None,
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": int(to[1]) if to else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def _plain(source: _Input, at: int) -> tuple[dict, int]:
    """The uncompressed record at ``at`` and its end."""
    source.fill(at + READ_BYTES)
    head = source.data[at - source.start : at - source.start + READ_BYTES]
    if not VERSION.match(head):
        raise Damaged("no version line")
    end = head.find(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)\r\n", head[: end + 2]) if end >= 0 else None
    if size is None:
        raise Damaged("no length")
    if not source.fill(at + end + 8 + int(size[1])):
        raise Damaged("record is cut off")
    headers, block, length = parse_record(source.data[at - source.start : at - source.start + end + 8 + int(size[1])])
    return _described(headers, block), at + length


def _packed(source: _Input, at: int) -> Iterator[dict]:
    """Records and inner gaps of the member at ``at``; returns its end. A member without a valid record, or that
    breaks off, is damaged."""
    unpacked = _Inflated(source, at)
    inner, here = _Input(unpacked), 0
    held: list[dict] = []  # the last record found, after the gap before it
    gap, why, sound = 0, None, None
    while inner.fill(here + 1):
        inner.drop(here)
        try:
            found, stop = _plain(inner, here)
        except Damaged as bad:
            why = why or str(bad)
            here = inner.find(here + 1)
            if here < 0:
                break
            continue
        if held:
            yield from held
            sound = unpacked.sound(gap)
            source.drop(sound)
        held = [{"offset": at, "inner_offset": gap, "length": here - gap, "reason": why}] if gap < here else []
        held.append(found | {"offset": at, "inner_offset": here, "length": stop - here, "reason": None})
        gap, here, why = stop, stop, None
    if unpacked.broken:
        raise Damaged(unpacked.broken, sound)
    if not held:
        raise Damaged(why or "no version line")
    if held[-1]["length"] == unpacked.total:
        held[-1] |= {"inner_offset": None, "length": unpacked.end - at}
    yield from held
    if gap < unpacked.total:
        yield {"offset": at, "inner_offset": gap, "length": unpacked.total - gap, "reason": why}
    return unpacked.end


def _single(source: _Input, at: int) -> Iterator[dict]:
    """The uncompressed record at ``at``; returns its end."""
    found, stop = _plain(source, at)
    yield found | {"offset": at, "inner_offset": None, "length": stop - at, "reason": None}
    return stop


def _rows(source: _Input, at: int) -> Iterator[dict]:
    if source.fill(at + 3) and source.data[at - source.start :][:3] == MAGIC:
        return _packed(source, at)
    if source.fill(at + 10) and VERSION.match(source.data[at - source.start :][:16]):
        return _single(source, at)
    raise Damaged("neither a member nor a version line")


def salvage(handle) -> Iterator[dict]:
    """Records and gaps of an open archive, in order: dicts with ``offset``, ``length``, ``inner_offset`` (null
    outside shared members), ``reason`` (null for records) and a record's fields."""
    source, at = _Input(handle), 0
    gap, why = None, None
    while source.fill(at + 1):
        source.drop(at)
        try:
            rows, stop = _rows(source, at), None
            while stop is None:
                try:
                    row = next(rows)
                except StopIteration as done:
                    stop = done.value
                    break
                if gap is not None:
                    yield {"offset": gap, "inner_offset": None, "length": at - gap, "reason": why}
                    gap = None
                yield row
            at = stop
        except Damaged as bad:
            if gap is None:
                gap, why = bad.sound or at, str(bad)
            at = source.find(max(at + 1, bad.sound or 0))
            if at < 0:
                at = source.start + len(source.data)
                break
    if gap is not None:
        yield {"offset": gap, "inner_offset": None, "length": at - gap, "reason": why}


FIELDS = [
    ("path", pa.string()),
    ("offset", pa.int64()),
    ("inner_offset", pa.int64()),
    ("length", pa.int64()),
    ("reason", pa.string()),
    ("page_id", pa.int64()),
    ("url", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("payload", pa.binary()),
]
SCHEMA = "path string, offset long, inner_offset long, length long, reason string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in FIELDS], names=[n for n, _k in FIELDS])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, where = filesystem(path)
                held, size = [], 0
                with fs.open_input_stream(where, compression=None) as handle:
                    for row in salvage(handle):
                        size += len(row.get("payload") or b"")
                        held.append(row | {"path": path} | ({} if with_payload else {"payload": None}))
                        if size > 4 << 20 or len(held) >= 5000:
                            yield pack(held)
                            held, size = [], 0
                if held:
                    yield pack(held)

    return run


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records, and gaps (``reason`` not null), of the archives named in ``manifest.path``; one archive is
    one piece of work, read in a stream."""
    # several archives a partition at most where they are many; each is bounded by the writer
    paths = manifest.select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")
    return paths.mapInArrow(_reader(with_payload), SCHEMA)


def records(found: DataFrame) -> DataFrame:
    return found.where("reason is null").drop("reason")


def quarantined(found: DataFrame) -> DataFrame:
    """(path, offset, inner_offset, length, reason) of the byte stretches that hold no valid record."""
    return found.where("reason is not null").select("path", "offset", "inner_offset", "length", "reason")
