"""WARC archives: writing pages as records, and a reader that salvages damaged archives.

Each record is a gzip member of its own. Spark's text writer puts the members into files: it
writes strings byte for byte and ends each with a separator, here the zero byte that every
member ends with (its size field; an empty member follows one of 16 MB or more). So archives
go wherever Spark can write, under Spark's commit protocol, and a lost executor or a second
attempt leaves no half-written archive.

The reader walks members (or plain records) and checks version line, headers, lengths and
digest. After a failed check it searches for the next member or version line that begins a
valid record, goes on there, and logs the bytes between as a quarantined gap.

Of pages with equal payloads of MIN_REVISIT bytes or more, the one with the largest page_id is
a response and the others refer to it. Null html is an empty payload; pages without a page_id
are responses, unless an equal page with one exists. Repeated rows are separate records, and
rows that share the largest page_id are all responses.
"""

import base64
import binascii
import hashlib
import re
import zlib

from pyspark.sql import functions as F

from repotide.llm.common import map_rows
from repotide.scratch import scratch_path

MIN_REVISIT = 1000
#: Records in one archive file, so that a reader holds a bounded number of records.
RECORDS_PER_FILE = 1000
LEVEL = 2
VERSION, CRLF = b"WARC/1.0", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
MEMBERS_DDL = "member binary"
RECORDS_DDL = (
    "archive string, at long, size long, problem string, page_id long, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def packed(data):
    """Bytes as gzip member(s) that end with a zero byte."""
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    member = pack.compress(data) + pack.flush()
    if member[-1]:
        empty = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member += empty.flush()
    return member


def record(page_id, url, payload, size, digest, refers_to):
    """The bytes of one uncompressed record."""
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", "<urn:page:%s>" % ("" if page_id is None else page_id)),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url) if url else None),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("X-Payload-Length", str(size)),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("Content-Length", str(len(payload))),
    ]
    head = CRLF.join([VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None)])
    return head + CRLF * 2 + payload + CRLF * 2


def _number(field):
    digits = re.fullmatch(r"<urn:page:(-?\d*)>", field or "")
    if not digits:
        raise ValueError("bad record id")
    return int(digits[1]) if digits[1] else None


def parse(data, at=0):
    """(record as a tuple from page_id on, end) of the plain record at `at`; ValueError if bad."""
    if data[at : at + 7] != b"WARC/1.":
        raise ValueError("no version line")
    stop = data.find(CRLF * 2, at)
    if stop < 0:
        raise ValueError("headers do not end")
    lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = fields.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", length):
        raise ValueError("bad length")
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != CRLF * 2:
        raise ValueError("block does not end")
    payload, kind = bytes(data[begin:end]), fields.get("warc-type")
    if kind not in ("response", "revisit"):
        raise ValueError("unknown record type")
    try:
        digest = base64.b32decode(fields.get("warc-payload-digest", "").removeprefix("sha1:")).hex()
    except binascii.Error:
        raise ValueError("bad digest") from None
    size = fields.get("x-payload-length", length)
    if not re.fullmatch(r"\d{1,18}", size):
        raise ValueError("bad length")
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or int(size) != len(payload)):
        raise ValueError("digest does not match")
    refers_to = _number(fields.get("warc-refers-to")) if kind == "revisit" else None
    return (_number(fields.get("warc-record-id")), kind, refers_to, int(size), digest, payload), end + 4


def unpacked(data, at):
    """(record, end) of the gzip member at `at`, together with empty members after it."""
    try:
        unpack = zlib.decompressobj(31)
        plain = unpack.decompress(memoryview(data)[at:])
    except zlib.error as error:
        raise ValueError(f"bad member: {error}") from None
    if not unpack.eof:
        raise ValueError("member does not end")
    end = len(data) - len(unpack.unused_data)
    row, stop = parse(plain)
    if stop != len(plain):
        raise ValueError("bytes after the record")
    empty = packed(b"")
    while data[end : end + len(empty)] == empty:
        end += len(empty)
    return row, end


def read_at(data, at):
    return unpacked(data, at) if data[at : at + 3] == MAGIC else parse(data, at)


def next_start(data, at):
    """The next place from `at` on where a valid record begins, or the end."""
    places = re.compile(re.escape(MAGIC) + rb"|WARC/1\.")
    for m in places.finditer(data, at):
        try:
            read_at(data, m.start())
        except ValueError:
            continue
        return m.start()
    return len(data)


def salvage(data):
    """(at, size, problem, record or None): records, and gaps with the check that failed."""
    at = 0
    while at < len(data):
        try:
            row, end = read_at(data, at)
        except ValueError as error:
            end = next_start(data, at + 1)
            yield at, end - at, str(error), None
        else:
            yield at, end - at, None, row
        at = end


def planned(pages):
    """Pages with payload, size, digest and the page they refer to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest"))
    heads = (
        rows.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("head"))
    return rows.join(heads, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "size", "digest", F.when(other, F.col("head")).alias("refers_to")
    )


def write_archives(pages, path):
    """Write one record per page into archives below `path`."""

    def make():
        def each(page_id, url, payload, size, digest, refers_to):
            body = b"" if refers_to is not None else bytes(payload)
            yield (packed(record(page_id, url, body, size, digest, refers_to))[:-1],)

        return each

    members = map_rows(planned(pages), make, MEMBERS_DDL)
    writer = members.select(F.col("member").cast("string").alias("value")).write
    writer.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_archives(spark, path):
    """RECORDS_DDL rows of all archives below `path`; gaps have a `problem` and no record."""

    def make():
        def each(archive, content):
            for at, size, problem, row in salvage(bytes(content)):
                yield (archive, at, size, problem, *(row or (None,) * 6))

        return each

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_rows(files, make, RECORDS_DDL)


def records(found):
    return found.where(F.col("problem").isNull()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def gaps(found):
    """Where bytes were quarantined: archive, at, size, problem."""
    return found.where(F.col("problem").isNotNull()).select("archive", "at", "size", "problem")


def round_trip(pages):
    """Write archives into the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)


ORACLE = """
SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 1000 AND page_id <> head THEN head END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head FROM pages)
"""
