"""WARC archives of gzip members: a writer with revisit records and a splittable reader."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, open_folder, pieces

#: Compressed bytes after which a task begins a new archive, and bytes of a reader's range.
ARCHIVE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 23
#: Bytes read and decoded at a time, and bytes of a candidate that tell whether it is a record.
READ_BYTES, UNPACK_BYTES, PROBE_BYTES = 1 << 20, 1 << 13, 1 << 10
MARK = b"WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]")
_KEPT = "".join(map(chr, range(33, 127)))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """One WARC record; a revisit if it refers to another page. Spaces, control and other than
    ASCII characters of the URL are percent-encoded."""
    digest = base32_sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_KEPT)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    level: int = 4,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record for every row (payload: the html, null: empty); a row ``path``, ``bytes``
    for each archive.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest
    page_id is a response and the others revisit it. Rows that repeat its page_id are responses
    too, and so are all rows of a payload without any page_id; a null page_id among others is a
    revisit. Other columns are ignored. Archives are renamed when whole, under names of the attempt's
    own: a task that runs twice writes archives apart, and the rows name those of the attempt that
    counts, with their sizes.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    sha = F.sha1(F.col("html").cast("binary"))
    keys = cut(rows.where(F.octet_length("html") >= least_bytes).select("page_id", sha.alias("sha")))
    last = keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    repeated = keys.distinct().join(last.where("n > 1 and refers_to is not null"), "sha")
    revisits = repeated.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "refers_to"
    )
    marked = rows.withColumn("sha", sha)
    joined = marked.join(
        revisits,
        marked["page_id"].eqNullSafe(revisits["_page"]) & (marked["sha"] == revisits["_sha"]),
        "left",
    ).select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        part, number, out, unfinished, size = TaskContext.get().partitionId(), 0, None, "", 0
        attempt = uuid.uuid4().hex

        def finish() -> pa.RecordBatch:
            out.close()
            name = f"part-{part:06d}-{number:06d}-{attempt}.warc.gz"
            store.move(unfinished, f"{root}/{name}")
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "bytes": size}])

        for piece in pieces(batches, "html"):
            columns = [piece.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns):
                if out is None:
                    unfinished, size = f"{root}/.{uuid.uuid4().hex}", 0
                    out = store.open_output_stream(unfinished)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url, html.encode(), refers_to, date))
                data += packer.flush()
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    yield finish()
                    out, number = None, number + 1
        if out is not None:
            yield finish()

    return cut(joined.mapInArrow(run, "path string, bytes long"))


class Members:
    """The gzip members of WARC records that start in a byte range of an open archive."""

    def __init__(self, source: pa.NativeFile, size: int):
        self._source, self._size = source, size
        #: Places where a record began that could not be read to its end.
        self.broken: list[int] = []
        self._at, self._held = 0, memoryview(b"")

    def _read(self, at: int, n: int) -> memoryview:
        """Up to ``n`` bytes from ``at``; the archive is read ahead in large pieces."""
        stop = min(at + n, self._size)
        if at < self._at or stop > self._at + len(self._held):
            ahead = max(0, min(max(n, READ_BYTES), self._size - at))
            self._at, self._held = at, memoryview(self._source.read_at(ahead, at))
        return self._held[at - self._at : stop - self._at]

    def is_record(self, at: int) -> bool:
        """Whether what starts here decodes to the header of a record."""
        try:
            return zlib.decompressobj(31).decompress(self._read(at, PROBE_BYTES), 16)[:7] == MARK
        except zlib.error:
            return False

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The whole record that starts here and the place after it; None if none does."""
        unpack, out, place = zlib.decompressobj(31), [], at
        while not unpack.eof:
            data = self._read(place, UNPACK_BYTES)
            if not data:
                return None
            place += len(data)
            try:
                out.append(unpack.decompress(data))
            except zlib.error:
                return None
        whole = b"".join(out)
        return (whole, place - len(unpack.unused_data)) if whole.startswith(MARK) else None

    def next_record(self, at: int, stop: int) -> int | None:
        """The first place of [at, stop) where a record starts."""
        while at < stop:
            data = self._read(at, min(READ_BYTES, stop - at + 3))
            for found in _MAGIC.finditer(data):
                place = at + found.start()
                if place < stop and self.is_record(place):
                    return place
            at += max(1, len(data) - 3)
        return None

    def within(self, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
        """(place, bytes) of the records that start in the range, wherever they end."""
        stop = min(stop, self._size)
        at = self.next_record(start, stop)
        while at is not None and at < stop:
            found = self.member(at)
            if found is None:
                self.broken.append(at)
                at = self.next_record(at + 1, stop)
                continue
            yield at, found[0]
            after = found[1]
            at = after if _MAGIC.match(self._read(after, 4)) else self.next_record(after, stop)


def headers(raw: bytes) -> dict[str, str]:
    """Fields by lower-case name; the first line is left out."""
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if _}


def parsed(data: bytes) -> dict:
    """The columns of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    block = rest[: int(warc.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = warc.get("warc-type", "")
    number = lambda name: int(warc[name]) if name in warc else None
    full = kind != "revisit"
    declared = warc.get("warc-payload-digest", "").removeprefix("sha1:")
    return {
        "page_id": number("x-page-id"),
        "record_type": kind,
        "url": warc.get("warc-target-uri"),
        "payload": payload if full else None,
        "payload_bytes": len(payload) if full else int(headers(http).get("content-length", 0)),
        "payload_digest": base32_sha1(payload) if full else declared,
        "refers_to": number("x-refers-to-page-id"),
    }


_READ = (
    "page_id long, record_type string, url string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def read_warc(
    archives: DataFrame, split_bytes: int = SPLIT_BYTES, broken_rows: bool = False
) -> DataFrame:
    """A row for each record of the archives (``path``, ``bytes``), read in ranges of bytes.

    A task looks for gzip magic from the start of its range, takes a candidate for a record only
    if it decodes to a record's header, and reads the records that start in its range to their
    ends. Every record starts in one range, so none is lost or read twice. A revisit's payload is
    null; its size and digest are those of the full payload. Members that begin as a record and
    break off are passed over; with ``broken_rows`` each has a row of type ``broken``, whose url is the
    archive's path and, after a #, the place.
    """
    starts = f"explode(sequence(0L, bytes - 1, {int(split_bytes)}L)) AS start"
    ranges = archives.where("bytes > 0").selectExpr("path", "bytes", starts)
    kinds = pa.schema(
        [
            ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
            ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_folder(row["path"])
                with store.open_input_file(path) as source:
                    rows, held = [], 0
                    members = Members(source, row["bytes"])
                    for _, data in members.within(row["start"], row["start"] + split_bytes):
                        rows.append(parsed(data))
                        held += len(data)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                    if broken_rows:
                        rows += [
                            {"record_type": "broken", "url": f"{row['path']}#{at}"} for at in members.broken
                        ]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kinds)

    partitions = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = max(1, min(ranges.count(), 4 * partitions))
    return ranges.repartition(many).mapInArrow(run, _READ)
