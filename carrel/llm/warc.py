"""WARC archives with an index of their records, and coalesced range reads through it.

Writing: payload digests decide which records hold their payload and which are revisits of an equal
one; each task writes its records into archives, each a gzip member of its own, and returns the
index row of each record: archive, offset and length of the member, URL and digest. An archive begins
with a warcinfo record. Record ids are unique; the page of a record, and that which a revisit repeats, have fields of their own. Reading takes any selection of index rows, brings those of an
archive together sorted by offset, joins neighbouring ranges into one read, and parses the records.

Cases: a null html is an empty payload; payloads under 100 bytes are never revisits; rows that
repeat the page_id of the response with an equal payload are responses too; a null page_id comes
after all others; a null url has no WARC-Target-URI; control characters of a URL are
percent-encoded; an empty table gives no archive; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.llm.files import read_range, write_whole
from carrel.sources.staging import fresh_dir, stage

LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 32 << 20
READ_BYTES = 4 << 20
READ_GAP = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "archive string, offset long, length long, url string, digest string, page_id long"
_READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


_PAGE, _REFERS = "Carrel-Page-ID", "Carrel-Refers-To-Page-ID"


def _named(archive: uuid.UUID, at: int) -> str:
    """The id of the record at a place of an archive; no two records share one, whatever their pages are."""
    return f"<urn:uuid:{uuid.uuid5(archive, str(at))}>"


def _page_id(value: str | None) -> int | None:
    return int(value) if value and value != "none" else None


def _plain(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None, date: str = DATE) -> bytes:
    """One WARC record; with refers_to a revisit, which has the payload's HTTP header only.

    Pages stand in fields of our own, as several records may be of one page.
    """
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", f"{_PAGE}: {'none' if page_id is None else page_id}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_plain(url)}")
    if revisit:
        head += [f"{_REFERS}: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def information(record_id: str, date: str = DATE) -> bytes:
    """The warcinfo record that every archive begins with; the index has no row for it."""
    block = b"software: carrel\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record; a false length or digest raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    n = int(fields["Content-Length"])
    if not head.startswith(b"WARC/1.") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record of the indexed length")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    inner = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "response":
        if len(payload) != int(inner["Content-Length"]) or f"sha256:{hashlib.sha256(payload).hexdigest()}" != fields["WARC-Payload-Digest"]:
            raise ValueError("the payload differs from its length or digest")
    return fields, inner, payload


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the records that repeat a payload."""
    keys = pages.filter(F.octet_length("payload") >= least).select("page_id", "digest")
    keys = stage(keys, "warc-keys")
    first = stage(keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n"), "warc-first")
    return keys.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()).distinct()


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives and returns their index, a row for each record."""
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    revisits = _revisits(rows, least).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    typed = rows.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def begun() -> tuple[uuid.UUID, list[bytes], list[tuple], int]:
            # a name of its own for every attempt: an index row always fits the archive it names
            name = uuid.uuid4()
            first = gzip.compress(information(_named(name, 0)), 6, mtime=0)
            return name, [first], [], len(first)

        name, parts, index, at = begun()

        def flush() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{name.hex}.warc.gz"
            write_whole(path, b"".join(parts))
            columns = list(zip(*index, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([path] * len(index)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3]), pa.array(columns[4], pa.int64())], names=["archive", "offset", "length", "url", "digest", "page_id"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, text, digest, refers_to = row
                data = gzip.compress(record(_named(name, at), page_id, url, text.encode(), digest, refers_to), 6, mtime=0)
                index.append((at, len(data), url, digest, page_id))
                parts.append(data)
                at += len(data)
                if at >= archive_bytes:
                    yield flush()
                    name, parts, index, at = begun()
        if index:
            yield flush()

    return stage(typed.mapInArrow(run, _INDEX), "warc-index")


def read(index: DataFrame, payloads: bool = True, read_bytes: int = READ_BYTES, gap: int = READ_GAP) -> DataFrame:
    """The records that the index rows name: page_id, url, payload, its size and digest, type, refers_to.

    A revisit's payload is null, its size and digest those of the full payload. Ranges of an archive
    at most ``gap`` bytes apart are read together, up to ``read_bytes`` in one read.
    """

    def fetch(archive: str, wanted: list[tuple[int, int]]) -> Iterator[tuple]:
        lo, hi = wanted[0][0], max(a + n for a, n in wanted)
        data = read_range(archive, lo, hi - lo)
        for a, n in wanted:
            fields, http, payload = parse(gzip.decompress(data[a - lo : a - lo + n]))
            revisit = fields["WARC-Type"] == "revisit"
            yield (_page_id(fields[_PAGE]), fields.get("WARC-Target-URI"), payload if payloads and not revisit else None, int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"], _page_id(fields.get(_REFERS)))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        archive, wanted, hi = None, [], 0
        for batch in batches:
            for name, a, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if wanted and (name != archive or a - hi > gap or a + n - wanted[0][0] > read_bytes):
                    yield archive, wanted
                    wanted = []
                archive = name
                wanted.append((a, n))
                hi = a + n
        if wanted:
            yield archive, wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for archive, wanted in ranges(batches):
            columns = zip(*fetch(archive, wanted), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = index.select("archive", "offset", "length").repartition(tasks, "archive").sortWithinPartitions("archive", "offset")
    return chosen.mapInArrow(run, _READ)
