"""WARC archives: write whole-file gzip streams, normalise them to one member a record, index, read back.

``write_streams`` writes each partition as archives that are one gzip stream each, as some crawlers leave
them. ``normalise`` inflates each stream once, from start to end, writes every record as a gzip member of its
own and a sidecar index of (record, offset, length), and turns records that a table names as copies into revisit
records. ``read_archives`` seeks by the index and checks every digest.

Files go to a folder that all executors share, under a name given by their content's place, first as a temporary file and
then renamed, so a task that runs twice leaves one file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm.bytesops import text_batches
from thalweg.session import shared_path, stage_table

#: Bytes of payload after which a partition begins its next archive.
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
CHUNK = 1 << 18
_HEAD = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Stands for the target of a page without a url, which every record must have.
NO_URI = "about:blank"
_DATE = "1970-01-01T00:00:00Z"


#: Tasks that rewrite or read archives, unless there are fewer archives.
MOST_TASKS = 20_000


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, seq: int) -> str:
    """The URN of a record, by its place."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{seq}')}>"


def http_head(size: int) -> bytes:
    """The head of an HTTP response with a payload of so many bytes."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def http_parts(block: bytes) -> tuple[int, bytes]:
    """The payload's length that the head of an HTTP response states, and the bytes behind the head."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/1.1 "):
        raise ValueError("a block without an HTTP head")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value), body
    raise ValueError("an HTTP head without a length")


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "\r\n".join([_HEAD, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(stream: io.BufferedIOBase) -> tuple[dict[str, str], bytes] | None:
    """The next record of a plain stream, None at its end."""
    line = stream.readline()
    if not line:
        return None
    if line.rstrip(b"\r\n") != _HEAD.encode():
        raise ValueError(f"not a record: {line[:60]!r}")
    headers = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        k, _, v = line.decode().rstrip("\r\n").partition(": ")
        headers[k] = v
    block = _exactly(stream, int(headers["Content-Length"]))
    if _exactly(stream, 4) != b"\r\n\r\n":
        raise ValueError("a record does not end with two line ends")
    return headers, block


def _exactly(stream: io.BufferedIOBase, n: int) -> bytes:
    got = stream.read(n)
    if len(got) != n:
        raise ValueError(f"{n} bytes expected, {len(got)} left")
    return got


class Inflated(io.RawIOBase):
    """A gzip file of any number of members as one plain stream, read once from the start."""

    def __init__(self, source):
        self.source, self.engine, self.rest, self.fresh = source, zlib.decompressobj(31), b"", True

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            raw = self.rest or self.source.read(CHUNK)
            self.rest = b""
            if not raw:
                if not self.fresh:
                    raise ValueError("a gzip stream ends early")
                return 0
            self.fresh = False
            out = self.engine.decompress(raw, len(into))
            self.rest = self.engine.unconsumed_tail
            if self.engine.eof:
                self.rest = self.engine.unused_data
                self.engine, self.fresh = zlib.decompressobj(31), True
            if out:
                into[: len(out)] = out
                return len(out)


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class _Sink:
    """A file written under a temporary name and renamed when whole."""

    def __init__(self, uri: str):
        self.fs, self.path = _fs(uri)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.size = self.fs.open_output_stream(self.tmp), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, sink, engine, seq, filled = TaskContext.get().partitionId(), 0, None, None, 0, 0
        for batch in batches:
            rows = []
            payloads = batch.column(1).cast(pa.binary())
            for page, url, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), payloads, strict=True):
                payload = payload.as_py() or b""
                if sink is None or filled >= archive_bytes:
                    if sink is not None:
                        sink.write(engine.flush())
                        sink.commit()
                    name = f"part-{part:06d}-{count:04d}"
                    sink, engine, seq, filled, count = _Sink(f"{folder}/{name}.warc.gz"), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0, count + 1
                digest = payload_digest(payload)
                headers = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", record_id(name, seq)),
                    ("WARC-Date", _DATE),
                    ("WARC-Target-URI", " ".join((url or "").split()) or NO_URI),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("X-Page-Id", "" if page is None else str(page)),
                ]
                sink.write(engine.compress(record_bytes(headers, http_head(len(payload)) + payload)))
                rows.append((name, seq, page, len(payload), digest))
                seq, filled = seq + 1, filled + len(payload) + 256
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["archive", "seq", "page_id", "payload_bytes", "payload_digest"])
        if sink is not None:
            sink.write(engine.flush())
            sink.commit()

    return run


def write_streams(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, html) as whole-file gzip archives; return the manifest (archive, seq, page_id, payload_bytes, payload_digest)."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"), F.col("url").cast("string").alias("url"))
    return stage_table(source.mapInArrow(_write(folder, archive_bytes), "archive string, seq long, page_id long, payload_bytes long, payload_digest string"), "warc-manifest")


def mark_copies(manifest: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``record_type``, ``refers_to`` and ``response`` (archive, seq; null for a response): of equal payloads of ``least_bytes`` or more the smallest page_id is the response.

    Ties (a repeated page_id) go by archive and place; a record without page_id comes after all others. The smallest is found by
    a partial aggregation and joined back, so a payload that very many pages share is not gathered anywhere.
    """
    order = F.struct(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("page"), "archive", "seq")
    first = manifest.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min(order).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    joined = manifest.join(first.select("payload_digest", "first"), "payload_digest", "left")
    copy = F.col("first").isNotNull() & (F.col("payload_bytes") >= least_bytes) & ~((F.col("first.archive") == F.col("archive")) & (F.col("first.seq") == F.col("seq")))
    return joined.select(
        *[c for c in manifest.columns],
        F.when(copy, "revisit").otherwise("response").alias("record_type"),
        F.when(copy & ~F.col("first.none"), F.col("first.page")).alias("refers_to"),
        F.when(copy, F.struct("first.archive", "first.seq")).alias("response"),
    )


def _normalise(source: str, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = sink = index = None
        current, rows = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            if sink is None:
                return
            if parse_record(reader) is not None:
                raise ValueError(f"{current} holds more records than its manifest")
            sink.commit()
            index.write("".join(f"{seq} {offset} {length}\n" for seq, offset, length in rows).encode())
            index.commit()
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([len(rows)], pa.int64()), pa.array([sink.size], pa.int64())], names=["archive", "records", "bytes"])

        for batch in batches:
            for name, seq, kind, refers, response in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if name != current:
                    yield from finish()
                    current, rows = name, []
                    fs, path = _fs(f"{source}/{name}.warc.gz")
                    reader = io.BufferedReader(Inflated(fs.open_input_stream(path, compression=None)), CHUNK)
                    sink, index = _Sink(f"{target}/{name}.warc.gz"), _Sink(f"{target}/{name}.idx")
                headers, block = parse_record(reader)
                if headers["WARC-Record-ID"] != record_id(name, seq):
                    raise ValueError(f"record {seq} of {name} is out of place")
                if kind == "revisit":
                    # the HTTP head stays, and with it the payload's length; page_id is none of the format's headers
                    headers |= {"WARC-Type": "revisit", "WARC-Profile": _PROFILE, "WARC-Refers-To": record_id(response["archive"], response["seq"])}
                    if refers is not None:
                        headers["X-Refers-To-Page-Id"] = str(refers)
                    block = block[: len(block) - len(http_parts(block)[1])]
                headers.pop("Content-Length")
                engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = engine.compress(record_bytes(list(headers.items()), block)) + engine.flush()
                rows.append((seq, sink.size, len(member)))
                sink.write(member)
        yield from finish()

    return run


def normalise(decided: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives of ``decided`` (archive, seq, record_type, refers_to), one task an archive; return (archive, records, bytes)."""
    tasks = max(1, min(MOST_TASKS, decided.agg(F.count_distinct("archive")).first()[0]))
    # a count of partitions that is given is not coalesced: rows of the list are small, but the archives behind them are not
    rows = decided.select("archive", "seq", "record_type", "refers_to", "response").repartition(tasks, "archive").sortWithinPartitions("archive", "seq")
    return stage_table(rows.mapInArrow(_normalise(source, target), "archive string, records long, bytes long"), "warc-archives")


def _read(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = _fs(f"{target}/{name}.idx")
                with fs.open_input_stream(path, compression=None) as f:
                    places = [tuple(map(int, x.split())) for x in f.read().decode().splitlines()]
                fs, path = _fs(f"{target}/{name}.warc.gz")
                out = []
                with fs.open_input_file(path) as f:
                    for _, offset, length in places:
                        headers, block = parse_record(io.BytesIO(zlib.decompress(f.read_at(length, offset), 31)))
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        size, payload = http_parts(block)
                        if headers["WARC-Type"] != "revisit" and (len(payload) != size or payload_digest(payload) != digest):
                            raise ValueError(f"a payload of {name} differs from its digest or length")
                        page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
                        out.append((int(page) if page else None, size, digest, headers["WARC-Type"], int(refers) if refers else None, headers["WARC-Record-ID"], headers.get("WARC-Refers-To")))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=[x.split()[0] for x in _RECORDS.split(", ")])

    return run


_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, response_id string"


def read_archives(archives: DataFrame, target: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of ``archives``, by the sidecar indexes.

    Payloads are held against their digests, and what revisits say of length and digest against the response that each refers to; a
    difference or a missing response is an error.
    """
    tasks = max(1, min(MOST_TASKS, archives.count()))
    records = stage_table(archives.select("archive").repartition(tasks, "archive").mapInArrow(_read(target), _RECORDS), "warc-records")
    # revisits of one response agree but for errors, so that few rows of a response are joined however many its revisits
    told = records.filter("record_type = 'revisit'").groupBy(F.col("response_id").alias("id"), "payload_bytes", "payload_digest").count()
    held = records.filter("record_type = 'response'").select(F.col("record_id").alias("id"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    wrong = told.join(held, "id", "left").filter(~(F.col("payload_bytes").eqNullSafe(F.col("b")) & F.col("payload_digest").eqNullSafe(F.col("d"))))
    wrong = wrong.limit(1).collect()
    if wrong:
        raise ValueError(f"a revisit differs from the response {wrong[0]['id']}")
    return records.drop("record_id", "response_id")


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html, any more columns) as archives, normalise them and read them back, a row a record.

    A null html is an empty payload; equal payloads of ``least_bytes`` or more have one response, the smallest page_id, and revisits
    that refer to it. Rows that repeat a page_id are records of their own, those without page_id come last and their
    page_id stays null. An empty table writes no archive and gives no rows. The archives stay in ``folder``.
    """
    spark: SparkSession = pages.sparkSession
    text_batches(spark)
    folder = folder or shared_path(spark, "warc")
    manifest = write_streams(pages, f"{folder}/streams", archive_bytes)
    archives = normalise(mark_copies(manifest, least_bytes), f"{folder}/streams", f"{folder}/members")
    return read_archives(archives, f"{folder}/members")
