"""WARC archives of web pages: writer, and a reader that salvages damaged files.

Every record is one gzip member, as the format advises, and carries the digest of its block.
The reader checks each member (gzip's own checksum, version line, lengths, block digest). After
a failed check it searches for the next place where a gzip member or a version line starts a
record that passes all checks, goes on from there, and logs the bytes in between as a gap.
Of a member that is damaged, cut short or fails its checksum, every record that can be inflated and
passes its own checks is kept, but for a member of one record alone that is cut; version lines are searched in the inflated bytes too. A gap between
such records has the offsets of their member, and those in the inflated bytes in its reason.

Pages with equal payloads of at least ``least`` bytes are stored once: the page with the largest
id is the response, the others are revisits that refer to it.

Edge cases: a null html is the empty payload; a null url gives a record without target; a page
without id is written as ``null`` and read as null, and is never what others refer to unless the
whole group has no id (then all its records are responses); rows that repeat an id with the same
payload are all responses if it is the group's largest; an empty table gives no file and no rows.
Other columns of the input are not read.
"""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, fresh_path, in_slices, read_file, rows_of, stored, write_file

# Fixed values of the format.
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_START = b"\x1f\x8b\x08"

LEAST = 1000  # bytes from which equal payloads are stored once
FILE_BYTES = 32 << 20  # an archive file is closed once it has so many bytes
CAPTURED = "2024-01-01T00:00:00Z"

MANIFEST = "path string, size long, records long"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, gap_path string, gap_start long, gap_end long, gap_reason string"
)
_MANIFEST = pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())])
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("gap_path", pa.string()),
        ("gap_start", pa.int64()),
        ("gap_end", pa.int64()),
        ("gap_reason", pa.string()),
    ]
)


# --- records as bytes -----------------------------------------------------------------


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", uri or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; with ``refers_to`` it is a revisit without payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _page_uri(page_id)),
        ("WARC-Date", CAPTURED),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(1, ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _page_uri(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode("utf-8", "replace")
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


class Damaged(Exception):
    """A record that fails a check."""


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; raises ``Damaged`` unless all checks pass."""
    if data[at : at + len(VERSION)] not in VERSIONS or data[at + 8 : at + 10] != b"\r\n":
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("headers without end")
    headers = {}
    for line in data[at + 10 : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        raise Damaged("no content length")
    first = end + 4
    last = first + int(size)
    block = data[first:last]
    if len(block) < int(size) or data[last : last + 4] != b"\r\n\r\n":
        raise Damaged("block shorter or longer than its length")
    if headers.get("warc-block-digest", "") != _digest(block):
        raise Damaged("block digest differs")
    return headers, block, last + 4


CUT = "member cut short"
PIECE = 1 << 16  # compressed bytes that are inflated at a time


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """Content and end of the member at ``at``; with an error, what could be inflated before it."""
    unpack = zlib.decompressobj(31)
    parts = []
    here = at
    try:
        while not unpack.eof:
            piece = data[here : here + PIECE]
            if not piece:
                return b"".join(parts), here, CUT
            parts.append(unpack.decompress(piece))
            here += len(piece)
    except zlib.error as error:
        return *_inflate_slowly(data, at), f"gzip: {error}"
    return b"".join(parts), here - len(unpack.unused_data), None


def _inflate_slowly(data: memoryview, at: int, most: int | None = None) -> tuple[bytes, int]:
    """Content up to an error or to ``most`` bytes, and the place in ``data`` where that was reached.

    The piece in which it happens is inflated byte by byte.
    """
    unpack = zlib.decompressobj(31)
    parts, size, here = [], 0, at
    while here < len(data) and not unpack.eof:
        piece, before = data[here : here + PIECE], unpack.copy()
        try:
            out = unpack.decompress(piece)
        except zlib.error:
            out = None
        if out is not None and (most is None or size + len(out) < most):
            parts.append(out)
            size += len(out)
            here += len(piece)
            continue
        unpack = before
        for i in range(len(piece)):
            try:
                parts.append(unpack.decompress(piece[i : i + 1]))
            except zlib.error:
                return b"".join(parts), here + i
            size += len(parts[-1])
            if most is not None and size >= most:
                return b"".join(parts), here + i + 1
        break
    return b"".join(parts), here


_VERSION_LINE = re.compile(rb"(?:(?<=\n)|\A)WARC/1\.[01]\r\n")
_CANDIDATE = re.compile(rb"\x1f\x8b\x08|" + _VERSION_LINE.pattern)


def _records_in(content: bytes) -> tuple[list[tuple[dict, bytes]], list[tuple[int, int, str]], int]:
    """Records in inflated bytes, gaps before and between them, and the end of the last one."""
    found, gaps, here, last, why = [], [], 0, 0, ""
    while here < len(content):
        try:
            headers, block, end = parse_record(content, here)
        except Damaged as error:
            if here == last:
                why = str(error)
            following = _VERSION_LINE.search(content, here + 1)
            here = following.start() if following else len(content)
            continue
        if here > last:
            gaps.append((last, here, why))
        found.append((headers, block))
        here = last = end
    if last < len(content):
        gaps.append((last, len(content), why))
    return found, gaps, last


def _records_at(data: bytes, view: memoryview, at: int) -> tuple[list[tuple], int, str | None]:
    """Records and inner gaps of the gzip member, or the one plain record, that starts at ``at``.

    With an error, the end is where the last record of the member ends. A member without any
    record that passes its checks raises ``Damaged``.
    """
    if not data.startswith(GZIP_START, at):
        headers, block, end = parse_record(data, at)
        return [(headers, block)], end, None
    content, end, error = _inflate(view, at)
    found, gaps, last = _records_in(content)
    if not found and (error or gaps):
        raise Damaged(error or gaps[0][2])
    if error:
        gaps = [gap for gap in gaps if gap[0] < last]
        _, end = _inflate_slowly(view, at, last)
    return [*found, *((at, end, f"inflated bytes {a} to {b}: {why}") for a, b, why in gaps)], end, error


def salvage(data: bytes) -> Iterator[tuple[dict, bytes] | tuple[int, int, str]]:
    """All records that pass every check as (headers, block), and gaps as (start, end, reason)."""
    view, at, bad, why = memoryview(data), 0, None, ""
    while at < len(data):
        try:
            found, end, error = _records_at(data, view, at)
        except Damaged as damage:
            if bad is None:
                bad, why = at, str(damage)
            following = _CANDIDATE.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad is not None:
            yield bad, at, why
            bad = None
        yield from found
        at = end
        if error:
            bad, why = end, error
            following = _CANDIDATE.search(data, end)
            at = following.start() if following else len(data)
    if bad is not None:
        yield bad, len(data), why


# --- Spark jobs -----------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload and refers_to of every page.

    Only digests that occur more than once are joined, from a written table, so a digest
    that many pages share is a skewed join that Spark can split.
    """
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digest = F.when(F.octet_length("payload") >= least, F.sha1("payload"))
    shared = stored(
        named.select("page_id", digest.alias("shared_digest"))
        .where("shared_digest is not null")
        .groupBy("shared_digest")
        .agg(F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("shared_digest", "kept_id"),
        "shared-payloads",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id"))
    return (
        named.withColumn("digest", digest)
        .join(shared, F.col("digest") == F.col("shared_digest"), "left")
        .select("page_id", "url", "payload", refers.alias("refers_to"))
    )


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as .warc.gz files in ``folder``; returns the manifest."""

    def write(batches):
        held, size = [], 0
        written = []
        for page_id, url, payload, refers_to in rows_of(batches, "page_id", "url", "payload", "refers_to"):
            held.append(member(record_bytes(page_id, url, payload, refers_to)))
            size += len(held[-1])
            if size >= file_bytes:
                written.append((write_file(folder, "part.warc.gz", held), size, len(held)))
                held, size = [], 0
        if held:
            written.append((write_file(folder, "part.warc.gz", held), size, len(held)))
        yield from batches_of(written, _MANIFEST)

    return stored(with_revisits(pages, least).mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of the files that ``manifest`` (path) names, and one row for each quarantined gap.

    A file is one unit of work and bounded in size by its writer.
    """

    def read(batches):
        def rows():
            for (path,) in rows_of(batches, "path"):
                for found in salvage(read_file(path)):
                    if len(found) == 3:
                        yield None, None, None, "gap", None, None, path, *found
                        continue
                    headers, block = found
                    kind = headers.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    if kind == "response":
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    else:
                        length = re.search(rb"(?i)\ncontent-length:\s*([0-9]+)", http)
                        size = int(length[1]) if length else None
                        code = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        digest = base64.b32decode(code).hex()
                    yield (
                        _page_of(headers.get("warc-record-id")),
                        size,
                        digest,
                        kind,
                        _page_of(headers.get("warc-refers-to")),
                        headers.get("warc-target-uri"),
                        None,
                        None,
                        None,
                        None,
                    )

        yield from batches_of(rows(), _RECORDS)

    files = manifest.select("path").repartition(in_slices(manifest), "path")
    return files.mapInArrow(read, RECORDS)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archive round trip of every page."""
    archives = fresh_path(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{folder}/pages.parquet"), archives)
    return (
        read_archives(manifest)
        .where("record_type <> 'gap'")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


# The same rows in DuckDB, without any archive.
ORACLE = f"""
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN last IS NULL OR last = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  nullif(last, page_id) AS refers_to
FROM (SELECT page_id, payload,
        CASE WHEN strlen(payload) >= {LEAST} THEN max(page_id) OVER (PARTITION BY payload) END AS last
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""
