"""Web archives: records written by Spark tasks, an index of every record, and range reads through the index.

Writing makes the index: a task appends gzip members to an archive file and returns, per record, archive, offset,
length, URL and digest. The index is a table that Spark commits, so the records of a lost or repeated task attempt are
simply not in it: archive names are unique to an attempt. Reading sorts the selected index rows by archive and offset,
merges neighbouring ranges into one read while the gap is small, and parses the members.

Defined results: a null or empty html is a record with an empty payload, a null url an empty target; of equal payloads
the smallest page_id is the response and the others revisit it (payloads below `min_bytes` are all responses); rows that
repeat a page_id with the same payload are responses alike; null ids revisit, or are responses if no copy has an id;
line breaks in a URL are percent-encoded in the header; an empty table writes no archive and gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import saved, small_batches
from auditmill.plans.storage import new_path

ARCHIVE_BYTES = 64 << 20
#: Ranges closer than this are read together, up to READ_BYTES at once.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
DATE = "2000-01-01T00:00:00Z"

_INDEX = pa.schema(
    [("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
     ("digest", pa.string()), ("record_type", pa.string())]
)
_INDEX_SQL = "page_id bigint, archive string, offset bigint, length bigint, url string, digest string, record_type string"
_RECORD = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()),
     ("payload", pa.binary())]
)
_RECORD_SQL = "page_id bigint, url string, record_type string, digest string, refers_to bigint, payload binary"


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store behind a path or URI; Hadoop's names of S3 are understood."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    for alias in ("s3a://", "s3n://"):
        path = path.replace(alias, "s3://") if path.startswith(alias) else path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _id_of(urn: str | None) -> int | None:
    number = (urn or "none>").rpartition(":")[2].rstrip(">")
    return None if number == "none" else int(number)


def record_bytes(page_id: int | None, url: str, kind: str, digest: str, refers_to: int | None, payload: bytes) -> bytes:
    block = payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Target-URI: {url.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_urn(refers_to)}",
        ]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """(page_id, url, record_type, digest, refers_to, payload) of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    payload = rest[: int(fields["Content-Length"])]
    url = fields["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return _id_of(fields["WARC-Record-ID"]), url, kind, digest, _id_of(refers), payload


def _write_worker(folder: str):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (html or "").encode()
                    digest = base32_digest(payload)
                    member = gzip.compress(record_bytes(page_id, url or "", kind, digest, refers_to, payload), 4, mtime=0)
                    out.write(member)
                    rows.append((page_id, name, at, len(member), url, digest, kind))
                    at += len(member)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)
        finally:
            if out is not None:
                out.close()

    return work


def roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, record_type, refers_to); only payloads that repeat take part in the join."""
    key = F.sha2(F.coalesce("html", F.lit("")), 256)
    size = F.octet_length(F.coalesce("html", F.lit("")))
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", key.alias("key"), size.alias("size"))
    # The digests are counted from a narrow table; partial counts make a hot payload a row per task.
    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), key.alias("key"), size.alias("size"))
    copies = (
        narrow.where(F.col("size") >= min_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("key", "first")
    )
    response = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return keyed.join(copies, "key", "left").select(
        "page_id", "url", "html",
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes one record per row below `folder`; returns the stored index of the records that count."""
    small_batches(pages.sparkSession)
    return saved(roles(pages, min_bytes).mapInArrow(_write_worker(folder), _INDEX_SQL), "warc_index")


def _read_worker(folder: str):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        name, file = None, None
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns)))
            for archive, ranges in _coalesced(wanted):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, store.open_input_file(f"{root}/{archive}")
                first = ranges[0][0]
                data = file.read_at(ranges[-1][0] + ranges[-1][1] - first, first)
                records = [parse_record(gzip.decompress(data[o - first : o - first + n])) for o, n in ranges]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), _RECORD)], schema=_RECORD)
        if file is not None:
            file.close()

    return work


def _coalesced(rows: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of sorted (archive, offset, length) that one read serves."""
    run: list[tuple[int, int]] = []
    current, end = None, 0
    for archive, offset, length in rows:
        if run and (archive != current or offset - end > GAP_BYTES or offset + length - run[0][0] > READ_BYTES):
            yield current, run
            run = []
        current, end = archive, offset + length
        run.append((offset, length))
    if run:
        yield current, run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the given index rows name, by range reads; a task's rows are neighbours in its archives."""
    small_batches(index.sparkSession)
    ranges = index.select("archive", "offset", "length").repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return ranges.mapInArrow(_read_worker(folder), _RECORD_SQL)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the archives, reads every record back, and gives each page the figures of its full payload."""
    folder = new_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, min_bytes)
    records = saved(
        read_records(index, folder).select(
            "page_id", "record_type", "digest", "refers_to", F.octet_length("payload").cast("bigint").alias("bytes"),
            F.sha1("payload").alias("sha1"),
        ),
        "warc_records",
    )
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'")
    # A revisit's payload is that of the record it refers to; both say so by their digest.
    origin = responses.where("page_id IS NOT NULL").groupBy("page_id", "digest").agg(F.max("bytes").alias("bytes"), F.max("sha1").alias("sha1"))
    origin = origin.select(F.col("page_id").alias("refers_to"), "digest", "bytes", "sha1")
    resolved = revisits.drop("bytes", "sha1").join(origin, ["refers_to", "digest"], "left")
    return responses.unionByName(resolved).select(
        "page_id", F.col("bytes").alias("payload_bytes"), base32_of_sha1(F.col("sha1")).alias("payload_digest"), "record_type", "refers_to"
    )


def base32_of_sha1(hex_digits):
    """Base32 of 40 hexadecimal digits: their 160 bits in groups of five."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    nibbles = lambda i: F.conv(F.substring(hex_digits, i, 1), 16, 10).cast("int")
    out = []
    for group in range(0, 40, 5):  # five digits are four letters
        n = sum((nibbles(group + 1 + i) * (16 ** (4 - i)) for i in range(5)), F.lit(0))
        out += [F.substring(F.lit(letters), F.shiftright(n, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*out)
