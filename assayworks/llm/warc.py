"""WARC archives whose repeated payloads are revisit records.

Headers (digest, size, id, address), never payloads, are shuffled by digest to find
the original of each payload; the decision then joins the pages by their id, which
no hot payload can skew.  Archives are WARC/1.1 files of one gzip member a record (or
several, from 16 MB on), so any record can be read by its offset; each file begins with a
``warcinfo`` record, and all records carry the time of this run.  Many records make a
file, about ``file_bytes`` of payload.  Reading takes whole files, so a file
bounds a task's memory, and goes by Content-Length, so a payload may hold
anything.

Every record has a UUID of its own.  The page's id is in ``X-Page-ID``; a revisit names
its original by ``WARC-Refers-To-Target-URI``, ``WARC-Refers-To-Date`` and
``X-Refers-To-Page-ID``.

Defined cases: a null html is an empty payload.  Of equal payloads of at least
``least_bytes`` the largest page id is the response and the others revisit it;
rows that repeat that id are responses too.  Null ids
lose against any id (-1 is an id like any other); a payload that only rows without
an id hold stays response.  A null url is the
empty string; control characters and blanks in it are percent-encoded.  An empty
table writes no record and reads back empty.  Extra columns are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import time
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.llm.shared import as_text, forget, fresh_path, reading, release, settings, tidy, written

#: Level of compression; higher ones cost twice the time for a twentieth of the size.
LEVEL = 4
#: The digits of numbers to base 32 and base32's alphabet, the profile of a revisit.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: Column) -> Column:
    """Base32 of SHA-1: 60, 60 and 40 bits of it as numbers to base 32, in base32's alphabet."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def with_decisions(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, body, payload_bytes, payload_digest, refers_to, refers_url`` of ``pages(page_id, url, html)``.

    The pages are dealt once, by the keys of the join.  Its other side is a plain table: rows that
    share an id (or have none) and a payload are a skewed join that AQE splits.
    """
    body = F.encode(as_text(F.col("html")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), as_text(F.col("url").cast("string")).alias("url"), body.alias("body")).select(
        "*", F.octet_length("body").cast("long").alias("payload_bytes"), payload_digest(F.col("body")).alias("payload_digest")
    )
    # a null id is a key of its own
    rows = rows.select("*", F.col("page_id").isNull().alias("nameless"), F.coalesce("page_id", F.lit(0)).alias("id"))
    same = ["payload_digest", "payload_bytes"]
    on = ["id", "nameless", *same]
    heads = written(rows.select("page_id", "url", *on).where(F.col("payload_bytes") >= least_bytes), "heads")
    first = heads.where("not nameless").groupBy(*same).agg(F.max(F.struct("page_id", "url")).alias("original"))
    n = heads.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = written(first.join(n, same).select(*same, "original"), "repeated")
    later = (
        heads.join(repeated, same)
        .where(~F.col("page_id").eqNullSafe(F.col("original.page_id")))
        .select(*on, F.col("original.page_id").alias("refers_to"), F.col("original.url").alias("refers_url"))
        .distinct()
    )
    later = written(later, "later")
    forget(heads, repeated)
    out = rows.join(later, on, "left").drop("id", "nameless")
    return reading(out, later)


def _clean_url(url: str) -> str:
    if url.isprintable() and " " not in url:
        return url
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def _record(kind: str, block: bytes, heads: list[tuple[str, str]], date: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), *heads, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _page_record(page: int | None, url: str, body: bytes | None, size: int, digest: str, refers: int | None, refers_url: str | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    heads = [("X-Page-ID", "none" if page is None else str(page)), ("WARC-Target-URI", _clean_url(url)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers is not None:
        heads += [("WARC-Profile", _PROFILE), ("WARC-Refers-To-Target-URI", _clean_url(refers_url)), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-ID", str(refers))]
    heads.append(("Content-Type", "application/http; msgtype=response"))
    return _record("response" if refers is None else "revisit", http + (body or b""), heads, date)


def _members(record: bytes) -> bytes:
    """A record as gzip members, but for the last byte.

    A member ends with its size, lowest byte first; members of under 16 MB end with a
    zero byte, which the writer of lines adds.
    """
    most = (1 << 24) - 1
    return b"".join(gzip.compress(record[at : at + most], LEVEL, mtime=0) for at in range(0, len(record), most))[:-1]


def records(decided: DataFrame, date: str) -> DataFrame:
    """One column ``record``: the gzip members of each record without their last (zero) byte; a ``warcinfo`` record first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, some, size = True, [], 0
        for batch in batches:
            if fresh and batch.num_rows:
                fields = b"software: assayworks\r\nformat: WARC File Format 1.1\r\n"
                some.append(_members(_record("warcinfo", fields, [("Content-Type", "application/warc-fields")], date)))
                fresh = False
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                some.append(_members(_page_record(*row, date)))
                size += len(some[-1])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["record"])
                    some, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["record"])
        tidy()

    body = F.when(F.col("refers_to").isNull(), F.col("body"))
    slim = decided.select("page_id", "url", body.alias("body"), "payload_bytes", "payload_digest", "refers_to", "refers_url")
    return slim.mapInArrow(run, "record binary")


def write_archives(pages: DataFrame, path: str | None = None, least_bytes: int = 0, file_bytes: int = 8 << 20, date: str | None = None) -> str:
    """Write ``pages(page_id, url, html)`` as WARC files below a folder, and return the folder.

    Spark's committer renames files into place, so a lost executor leaves none half-written.
    The line writer ends each row with a zero byte, the last one of its gzip member.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    date = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    decided = with_decisions(pages, least_bytes)
    # a shuffled partition of about that size is a file
    dealt = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes), "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    }
    with settings(spark, dealt):
        records(decided, date).select(F.col("record").cast("string")).write.option("lineSep", "\0").text(path)
    release(decided)
    return path


def _inflated(data: bytes) -> bytes:
    """All members of a gzip file, a window at a time: what follows a member is not copied for each of them."""
    view, out, at = memoryview(data), [], 0
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            part = view[at : at + (1 << 15)]
            if not part:
                raise ValueError("the last gzip member is cut off")
            out.append(member.decompress(part))
            at += len(part)
        at -= len(member.unused_data)
    return b"".join(out)


def _parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], int, int]]:
    """Headers and the place of the block of each record."""
    at, n = 0, len(data)
    while at < n:
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].split(b"\r\n")
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {at}")
        heads = {k.strip().lower(): v.strip() for k, v in (x.split(b":", 1) for x in lines)}
        begin = end + 4
        stop = begin + int(heads[b"content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        yield heads, begin, stop
        at = stop + 4


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _page(name: bytes | None) -> int | None:
    return None if name in (None, b"none") else int(name)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the WARC files below a folder; digests of responses are taken anew and must agree."""
    schema = _READ if with_payload else _READ.remove(6)
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                data = value.as_py()
                data = _inflated(data) if data[:2] == b"\x1f\x8b" else data
                rows: list[tuple] = []
                for heads, begin, stop in _parse(data):
                    if heads[b"warc-type"] == b"warcinfo":
                        continue
                    block = data.index(b"\r\n\r\n", begin, stop) + 4
                    told = heads[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
                    kind = heads[b"warc-type"].decode()
                    if kind == "response":
                        size = stop - block
                        if b32encode(hashlib.sha1(memoryview(data)[block:stop]).digest()).decode() != told:
                            raise ValueError(f"record {heads[b'warc-record-id']!r} has another digest")
                    else:
                        http = dict(x.split(b": ", 1) for x in data[begin : block - 4].split(b"\r\n")[1:])
                        size = int(http[b"Content-Length"])
                    row = (_page(heads[b"x-page-id"]), heads[b"warc-target-uri"].decode(), size, told, kind, _page(heads.get(b"x-refers-to-page-id")))
                    rows.append((*row, data[block:stop] if kind == "response" else None) if with_payload else row)
                columns = list(zip(*rows, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
        tidy()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, kinds + ", payload binary" * with_payload)
