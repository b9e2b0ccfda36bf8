"""WARC archives: written by Spark, read back by a reader that salvages what follows damage."""

from __future__ import annotations

import base64
import hashlib
import logging
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches, durable, shared_folder

LEAST_BYTES = 1000  # payloads below are never revisits
DATE = "2024-01-01T00:00:00Z"  # fixed, so that equal input gives equal archives
ROWS_A_FILE = 2000  # records of pages up to SMALL bytes in one file
SMALL = 32 << 10
FILE_BYTES = 64 << 20  # of larger pages in one file; a page over it has a file of its own
CHUNK = 4096  # bytes unpacked at first; doubled as a member goes on
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n(?=[A-Za-z-]+:)")  # with a header after it
#: An empty gzip member. Spark's text writer must put something after each row; readers of joined members pass over it.
EMPTY_MEMBER = zlib.compressobj(3, zlib.DEFLATED, 31).flush()
RECORD = "file string, record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, payload binary, refers_to string, gap_start long, gap_end long, reason string"
PAGE_ID = r"^urn:page:(-?[0-9]{1,19})$"

log = logging.getLogger(__name__)


def gzip_member(data: bytes, level: int = 3) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def digest32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(kind: str, number: str, url: str, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record as bytes; a revisit has no payload but the digest of the whole one."""
    block = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{number}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest32(sha1)}",
        f"WARC-Block-Digest: sha1:{digest32(hashlib.sha1(block).hexdigest())}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, first): `first` is the largest page_id among equal payloads of some size that come
    more than once. Only digests are grouped; the list of repeated ones joins back."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    repeated = rows.where(F.length("payload") >= LEAST_BYTES).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    return rows.join(durable(repeated, "repeated"), "digest", "left")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write a record per row to folder: text files (.txt) of one gzip member per record, with empty members between.

    A null html is an empty payload. Files are bounded by rows and by bytes: pages over SMALL bytes go to files of their
    own kind, of at most FILE_BYTES or one page. Spark's text writer makes them, so any file system that Spark reaches
    will do.
    """
    spark = pages.sparkSession
    bound_batches(spark)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = 1, 0
        for batch in batches:
            members, parts = [], []
            for page, url, payload, sha1, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = first is not None and page != first
                clean = re.sub(r"[\r\n]+", " ", url)
                members.append(gzip_member(record("revisit" if revisit else "response", "null" if page is None else str(page), clean, payload, sha1, str(first))))
                if revisit or len(payload) <= SMALL:
                    parts.append(0)
                    continue
                held += len(payload)
                if held > FILE_BYTES:
                    part, held = part + 1, len(payload)
                parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(parts, pa.int32())], ["value", "part"])

    rows = with_types(pages, id_col, url_col, html_col).select("page_id", "url", "payload", "digest", "first")
    members = rows.mapInArrow(build, "value binary, part int").select(F.col("value").cast("string").alias("value"), "part")
    writer = members.write.partitionBy("part").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", ROWS_A_FILE)
    writer.text(folder)
    return folder


@dataclass
class Found:
    kind: str
    record_id: str
    uri: str
    payload: bytes
    sha1: str
    refers_to: str | None
    checked: bool  # against a digest in its own header


@dataclass
class Gap:
    start: int
    end: int
    reason: str


def bare(urn: str) -> str:
    return urn.removeprefix("<").removesuffix(">")


def parse_record(data: bytes, at: int) -> tuple[Found | None, int]:
    """The record at `at` (None if it is of a kind without payloads of pages) and where the next begins. Raises ValueError
    if a check fails. The payload of an HTTP message is what follows its header; ids may have any form."""
    head_end = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/", at) or head_end < 0:
        raise ValueError("no version line or no end of the header")
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line without a colon")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    if not (size := fields.get(b"content-length", "")).isdecimal() or len(size) > 18:
        raise ValueError("no length")
    begin = head_end + 4
    end = begin + int(size)
    if end > len(data) or data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("cut off, or no end where the length says")
    block = data[begin:end]
    sha1 = hashlib.sha1(block).hexdigest()
    checked = bool(told := hex_of(fields.get(b"warc-block-digest", "")))
    if checked and told != sha1:
        raise ValueError("the block's digest differs")
    kind = fields.get(b"warc-type", "")
    if kind not in ("response", "revisit"):
        return None, end + 4
    if not (record_id := bare(fields.get(b"warc-record-id", ""))):
        raise ValueError("no record id")
    http = fields.get(b"content-type", "").startswith("application/http")
    if http:
        block = block.partition(b"\r\n\r\n")[2]
        sha1 = hashlib.sha1(block).hexdigest()
    if told := hex_of(fields.get(b"warc-payload-digest", "")):
        # an HTTP body may be coded for transfer, which its digest leaves aside
        if kind == "response" and not http and told != sha1:
            raise ValueError("the payload's digest differs")
        sha1 = told
    refers = fields.get(b"warc-refers-to")
    return Found(kind, record_id, fields.get(b"warc-target-uri", ""), block, sha1, bare(refers) if refers else None, checked), end + 4


def hex_of(digest: str) -> str:
    """The hex form of a labelled SHA-1 in base 32 or 16; empty for others."""
    value = digest.removeprefix("sha1:")
    if value == digest:
        return ""
    return value.lower() if len(value) == 40 else base64.b32decode(value).hex()


def plain_records(data: bytes) -> Iterator[Found | Gap]:
    """Records of uncompressed data. After a failed check, the search goes on at the next version line."""
    at = 0
    while at < len(data):
        try:
            found, after = parse_record(data, at)
        except ValueError as e:
            following = VERSION.search(data, at + 1)
            after = following.start() if following else len(data)
            yield Gap(at, after, str(e))
        else:
            if found:
                yield found
        at = after


def unpack(data: memoryview, at: int) -> tuple[bytes, int, bool]:
    """The content of the gzip member at `at`, where it ends, and whether it is whole; of a damaged one what comes before
    the damage. It is fed in pieces that grow with it, so the cost follows the member, not the file."""
    unpacker, out, size = zlib.decompressobj(31), [], CHUNK
    position = at
    while position < len(data) and not unpacker.eof:
        piece = data[position : position + size]
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error:
            return b"".join(out), position, False
        position += len(piece)
        size = min(2 * size, 1 << 20)
    return b"".join(out), position - len(unpacker.unused_data), unpacker.eof


def starts_member(data: memoryview, at: int) -> bool:
    """Whether a member that could hold a record begins here."""
    unpacker = zlib.decompressobj(31)
    try:
        content = unpacker.decompress(data[at : at + CHUNK], 64)
    except zlib.error:
        return False
    return content.startswith(b"WARC/") or (not content and unpacker.eof)


class Starts:
    """Where the next member or version line begins; each kind is searched for once per stretch of the file."""

    def __init__(self, data: bytes, view: memoryview):
        self.data, self.view = data, view
        self.member = self.line = -1

    def after(self, at: int, line_from: int) -> int:
        if self.member < at:
            place = self.data.find(MEMBER, at)
            while place >= 0 and not starts_member(self.view, place):
                place = self.data.find(MEMBER, place + 1)
            self.member = place if place >= 0 else len(self.data)
        if self.line < line_from:
            line = VERSION.search(self.data, line_from)
            self.line = line.start() if line else len(self.data)
        return min(self.member, self.line)


def salvage(data: bytes) -> Iterator[Found | Gap]:
    """All records of an archive, plain, of gzip members, or mixed, and the gaps between them, whatever it begins with.

    After a failed check the search goes on at the next member or version line. Of a damaged member those records are
    kept that are whole before the damage and fit their digest; a gap inside a member is given as the member's place in the file.
    """
    view = memoryview(data)
    starts = Starts(data, view)
    at = 0
    while at < len(data):
        if data.startswith(EMPTY_MEMBER, at):
            at += len(EMPTY_MEMBER)
            continue
        reason, line_from = "neither a member nor a version line", at + 1
        if data.startswith(MEMBER, at):
            content, after, whole = unpack(view, at)
            found = list(plain_records(content)) if content else []
            yield from (x for x in found if isinstance(x, Found) and (whole or x.checked))
            if whole:
                yield from (Gap(at, after, x.reason) for x in found if isinstance(x, Gap))
                at = after
                continue
            # lines before `after` are of the member's own content, as far as it is not packed
            reason, line_from = "a member that can't be unpacked", max(at + 1, after)
        elif data.startswith(b"WARC/", at):
            try:
                record_, after = parse_record(data, at)
            except ValueError as e:
                reason = str(e)
            else:
                if record_:
                    yield record_
                at = after
                continue
        after = starts.after(at + 1, line_from)
        yield Gap(at, after, reason)
        at = after


def read_archives(spark: SparkSession, folder: str, files: str = "*") -> DataFrame:
    """Rows of all records and gaps under folder (names that fit `files`): file, record_id, record_type (response, revisit
    or gap), target_uri, payload_bytes, payload_digest, payload, refers_to (a record_id), gap_start, gap_end, reason.
    One task reads a file whole; the writer bounds its size."""
    bound_batches(spark)
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for x in salvage(content.as_py()):
                    if isinstance(x, Gap):
                        rows.append((file, None, "gap", None, None, None, None, None, x.start, x.end, x.reason))
                    else:
                        rows.append((file, x.record_id, x.kind, x.uri, len(x.payload) if x.kind == "response" else None, x.sha1, x.payload, x.refers_to, None, None, None))
                        size += len(x.payload)
                    if size > 4 << 20 or len(rows) > 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(folder)
    return found.select("path", "content").mapInArrow(parse, RECORD)


def quarantine(rows: DataFrame) -> DataFrame:
    """The gaps (file, gap_start, gap_end, reason) of what was read, written to the shared folder and told in the log."""
    gaps = durable(rows.where("record_type = 'gap'").select("file", "gap_start", "gap_end", "reason"), "quarantine")
    told = gaps.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("gap_end") - F.col("gap_start")), F.lit(0)).alias("bytes")).first()
    if told["n"]:
        log.warning("%d byte gaps (%d bytes) of archives are in quarantine: %s", told["n"], told["bytes"], gaps.inputFiles()[0].rpartition("/")[0])
    return gaps


def page_of(record_id: str) -> Column:
    """The page_id in one of our record ids; null for other ids."""
    number = F.regexp_extract(F.coalesce(record_id, F.lit("")), PAGE_ID, 1)
    return F.when(number != "", number).try_cast("long")


def read_pages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """What can be read of the pages archived in folder (page_id, payload_bytes, payload_digest, record_type, refers_to),
    and the quarantined gaps. A revisit has the length of a response of equal digest; null where none could be read."""
    kept = read_archives(spark, folder).select("file", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "gap_start", "gap_end", "reason")
    found = durable(kept, "records")
    gaps = quarantine(found)
    rows = found.where("record_type <> 'gap'").select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to")
    )
    revisits = rows.where("record_type = 'revisit'").drop("payload_bytes")
    wanted = revisits.select("payload_digest").distinct()
    sizes = rows.where("record_type = 'response'").join(wanted, "payload_digest", "left_semi").groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    whole = revisits.join(sizes, "payload_digest", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return rows.where("record_type = 'response'").union(whole), gaps


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write pages to archives in the shared folder, read those back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Byte gaps, should a file be damaged meanwhile, go to quarantine (`quarantine`), and what follows them is read on.
    Null html: empty payload, always a response. Null page_ids: their record has no number; they never are the response
    of others with a number. Equal rows with the largest page_id all are responses. An empty table gives no rows; other
    columns are not looked at.
    """
    spark = pages.sparkSession
    if pages.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    folder = write_archives(pages, f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}", id_col, url_col, html_col)
    return read_pages(spark, folder)[0]
