"""WARC archives: a writer with revisit records, and a reader whose tasks scan byte ranges."""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.files import file_system, qualified
from tideline.llm.shared import written
from tideline.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of an archive that one reading task owns, and bytes it reads at once.
SPLIT_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20
MOST_TASKS = 100_000
# Compression effort, and the date that records without one carry.
LEVEL, DATE = 4, "1970-01-01T00:00:00Z"
CONTROL = re.compile(r"[\x00-\x20\x7f]")
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header_value(value: str) -> str:
    """A value that fits one header line: white space and control characters become percent signs with hex."""
    return CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One gzip member that holds a response record, or a revisit record where `refers_to` is given.

    A revisit has the HTTP headers alone; their Content-Length still tells the size of the payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_header_value(record_id)}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_header_value(refers_to)}>"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write (record_id, url, payload binary, payload_digest, refers_to) as archives; a row per file: file, bytes, records.

    Each task writes one archive under a name of its own and reports it. A task that ran twice leaves a file
    that no row names, so read the files of the returned (materialised) table and no others. A folder without
    a scheme is one of Spark's default file system.
    """
    folder = qualified(records.sparkSession, folder)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, path = file_system(folder)
        name, sink, size, count = f"{path}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    target.create_dir(path, recursive=True)
                    sink = target.open_output_stream(name, compression=None)
                member = record(row[0], row[1], row[2], row[3], row[4])
                sink.write(member)
                size, count = size + len(member), count + 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name.rpartition('/')[2]}"], "bytes": [size], "records": [count]})

    columns = records.select("record_id", "url", "payload", "payload_digest", "refers_to")
    return written(columns.mapInArrow(archive, "file string, bytes long, records long"), "archives")


class Ranged:
    """A window on a remote file that grows to the right, one block at a time."""

    def __init__(self, source, start: int):
        self.source, self.start, self.data, self.whole = source, start, bytearray(), False

    def need(self, end: int) -> bool:
        """Load up to absolute position `end`; false if the file is shorter."""
        while self.start + len(self.data) < end and not self.whole:
            some = self.source.read_at(BLOCK_BYTES, self.start + len(self.data))
            self.data += some
            self.whole = len(some) < BLOCK_BYTES
        return self.start + len(self.data) >= end

    def find(self, what: bytes, at: int, end: int) -> int:
        """First position from `at` and below `end` where `what` begins, or -1."""
        while at < end:
            self.need(min(end, at + BLOCK_BYTES) + len(what) - 1)
            stop = min(end, self.start + len(self.data) - len(what) + 1)
            found = self.data.find(what, at - self.start, max(0, stop - self.start) + len(what) - 1)
            if found >= 0:
                return found + self.start
            if stop <= at:
                return -1
            at = stop
        return -1

    def drop(self, before: int) -> None:
        """Forget what lies before a position, once it is worth the copy."""
        if before - self.start > BLOCK_BYTES:
            del self.data[: before - self.start]
            self.start = before

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The decoded gzip member at `at` and its end, or None if none that starts a WARC record is there.

        Its first bytes are decoded first, which refuses nearly all false magic; then the whole member with its
        checksum, and the next member, or the end of the file, must follow, perhaps after zero bytes of padding."""
        packer, out, end = zlib.decompressobj(31), [], at
        try:
            while not packer.eof:
                if not self.need(end + 1):
                    return None
                some = bytes(self.data[end - self.start : end - self.start + (1 << 16)])
                out.append(packer.decompress(some))
                end += len(some) - len(packer.unused_data)
                if len(out) == 1 and not out[0].startswith(b"WARC/"[: len(out[0])]):
                    return None
        except zlib.error:
            return None
        body = b"".join(out)
        return (body, end) if body.startswith(b"WARC/") and self.begins(self.padded(end)) else None

    def padded(self, at: int) -> int:
        """The first position from `at` that holds no zero byte, or the end of the file."""
        while self.need(at + 1):
            some = bytes(self.data[at - self.start :])
            at += len(some) - len(some.lstrip(b"\0"))
            if some.strip(b"\0"):
                break
        return at

    def begins(self, at: int) -> bool:
        """Whether gzip magic or the end of the file is at a position."""
        return not self.need(at + 1) or (self.need(at + 3) and bytes(self.data[at - self.start : at - self.start + 3]) == MAGIC)


def parse(body: bytes) -> Iterator[dict]:
    """The response and revisit records of a decoded member, one after another; other types are passed over."""
    at = 0
    while body.startswith(b"WARC/", at):
        top = body.find(b"\r\n\r\n", at)
        if top < 0:
            return
        lines = body[at:top].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers.get("content-length", "0"))
        block = body[top + 4 : top + 4 + size]
        at = top + 8 + size
        kind = headers.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
        whole = kind == "response"
        yield {
            "record_id": headers.get("warc-record-id", "").strip("<>"),
            "record_type": kind,
            "url": headers.get("warc-target-uri"),
            "payload_digest": base32(hashlib.sha1(payload).digest()) if whole else headers.get("warc-payload-digest", "").removeprefix("sha1:"),
            "payload_bytes": len(payload) if whole else int(length[1]) if length else None,
            "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
            "payload": payload if whole else None,
        }


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, most_tasks: int = MOST_TASKS) -> DataFrame:
    """Records of the archives named by the columns `file` and `bytes`, columns as in RECORD.

    Every file is cut into byte ranges that are dealt out to tasks. A task looks for gzip magic in its range,
    decodes the candidate member, and owns the records of each true member that starts inside the range, also
    if it ends beyond. Digest and size of a response are those of the payload read; those of a revisit come
    from its headers. Empty files and an empty table give no rows. There are as many tasks as ranges, up to
    `most_tasks`, which take several ranges each.
    """
    cuts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = files.select("file", cuts.alias("first"))
    count = files.agg(F.sum(F.greatest(F.ceil(F.col("bytes") / split_bytes), F.lit(1)))).first()[0]
    # A number of partitions keeps adaptive execution from joining ranges whose rows are small.
    ranges = ranges.repartition(max(1, min(int(count or 0), most_tasks)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, path = file_system(name)
                with source.open_input_file(path) as opened:
                    window, at, end = Ranged(opened, first), first, first + split_bytes
                    rows, held = [], 0
                    while (at := window.find(MAGIC, at, end)) >= 0:
                        found = window.member(at)
                        if found is None:
                            at += 1
                            continue
                        body, after = found
                        rows += [{"file": name, "position": at, **r} for r in parse(body)]
                        held, at = held + len(body), after
                        window.drop(at)
                        if held > BLOCK_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_RECORD)

    return ranges.mapInArrow(scan, RECORD)


ARROW_RECORD = pa.schema(
    [(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in RECORD.fields]
)


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column."""
    digest = F.sha1(payload)

    def letters(group: Column) -> Column:
        value = F.conv(F.substr(digest, group * 5 + 1, F.lit(5)), 16, 10).cast("int")
        at = [F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1 for s in (15, 10, 5, 0)]
        return F.concat(*[F.substr(F.lit(BASE32), k, F.lit(1)) for k in at])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def with_revisits(pages: DataFrame, page_id: str, url: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """Records for `write` from pages: of rows with equal payloads of at least `least_bytes` the largest id is a
    response and the others revisit it. Rows that share that largest id are all responses; null ids come last.

    Digests are grouped before the pages move, so a payload that many pages share costs one group row.
    """
    own = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    own = own.withColumn("payload_digest", sha1_base32(F.col("payload")))
    shared = F.octet_length("payload") >= least_bytes
    latest = own.filter(shared).groupBy("payload_digest").agg(F.max("id").alias("latest"), F.count("*").alias("n"))
    joined = own.join(latest.filter("n > 1").drop("n"), "payload_digest", "left")
    revisit = shared & F.col("latest").isNotNull() & ~F.col("id").eqNullSafe(F.col("latest"))
    return joined.select(
        record_id(F.col("id")).alias("record_id"),
        "url",
        "payload",
        "payload_digest",
        F.when(revisit, record_id(F.col("latest"))).alias("refers_to"),
    )


def record_id(page: Column) -> Column:
    """Record name of a page; pages without an id share the name `urn:page:`."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")))


def page_of(name: Column) -> Column:
    """The page id in a record name, null for a page without one."""
    return F.nullif(F.substring(name, len("urn:page:") + 1, 1 << 20), F.lit("")).cast("long")


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write every page as a record and read the archives back; columns as in RECORD.

    The payload is the html in UTF-8, null empty. Repeated rows give a record each. Columns besides the three
    are not read. An empty table gives no rows.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    return read(write(with_revisits(pages, page_id, url, payload), folder))
