"""Conversion of legacy ARC archives to WARC, and reading WARC back.

ARC: a version block names the fields of the header lines to come (five in
version 1, ten in version 2); each record is a header line and as many bytes
as its last field declares. The converter keeps the bytes of a record as the
block, and derives what WARC asks for besides: an identifier from the
archive's name and the record's offset, a date, a type, and digests.

Each WARC record is a gzip member of its own. Spark's text writer puts them
out with an empty gzip member as the line separator, so archives go through
the commit protocol to any file system that Spark writes, and a lost task
leaves nothing behind.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field lists of the version blocks (fixed by the ARC format).
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
_SEPARATOR = gzip.compress(b"", mtime=0)
_IDS = uuid.UUID("5f0c6d1e-6a3b-4c55-9b1f-2f0d9c1f7a11")


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ---------------------------------------------------------------------


@dataclass(frozen=True)
class ArcRecord:
    offset: int
    version: int
    fields: dict[str, str]
    body: bytes
    truncated: bool


def arc_archive(name: str, records: Sequence[tuple[str, str, str, str, bytes]], version: int = 1, date: str = "20200101000000") -> bytes:
    """An ARC archive of (url, ip, date, content type, bytes) records."""
    names = FIELDS[version]
    block = f"{version} 0 legacy\n{' '.join(names)}\n\n".encode()
    out = bytearray()

    def header(url: str, ip: str, when: str, kind: str, size: int, check: str) -> None:
        known = {"URL": re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url), "IP-address": ip, "Archive-date": when, "Content-type": kind, "Result-code": "200", "Checksum": check, "Location": "-", "Offset": str(len(out)), "Filename": name, "Archive-length": str(size)}
        out.extend((" ".join(known[n] for n in names) + "\n").encode("utf-8", "surrogatepass"))

    header(f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(block), "-")
    out.extend(block)
    for url, ip, when, kind, body in records:
        header(url, ip, when, kind, len(body), hashlib.md5(body).hexdigest() if version == 2 else "-")
        out.extend(body)
        out.extend(b"\n")
    return bytes(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an archive by their declared lengths, the version block first.

    Blank lines between records are skipped, and so are lines that are no
    header of the archive's version. A record that ends before its declared
    length is marked as truncated.
    """
    at, version = 0, 1
    while at < len(data):
        end = data.find(b"\n", at)
        line_end = len(data) if end < 0 else end
        parts = data[at:line_end].decode("utf-8", "replace").rstrip("\r").split(" ")
        start, offset = line_end + 1, at
        at = start
        names = FIELDS[1] if parts[0].startswith("filedesc://") and len(parts) == 5 else FIELDS[version]
        if parts[0].startswith("filedesc://") and len(parts) == len(FIELDS[2]):
            names = FIELDS[2]
        if len(parts) != len(names) or not parts[-1].isdecimal():
            continue
        size = int(parts[-1])
        body = data[start : start + size]
        if parts[0].startswith("filedesc://"):
            version = 2 if body[:2] == b"2 " else 1
        yield ArcRecord(offset, version, dict(zip(names, parts, strict=True)), body, len(body) < size)
        at = start + len(body)


# --- WARC --------------------------------------------------------------------


def warc_date(stamp: str) -> str:
    """ISO date of an ARC stamp of 8 to 14 digits; other stamps give the epoch."""
    digits = stamp[:14].ljust(14, "0")
    if not stamp[:8].isdecimal() or len(stamp) < 8 or not digits.isdecimal():
        digits = "19700101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def convert(name: str, record: ArcRecord) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers, HTTP head and payload of an ARC record."""
    url, body = record.fields["URL"], record.body
    headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_IDS, f'{name}:{record.offset}')}>", "WARC-Date": warc_date(record.fields["Archive-date"])}
    head, payload = split_http(body)
    if url.startswith("filedesc://"):
        headers |= {"WARC-Type": "warcinfo", "WARC-Filename": url.removeprefix("filedesc://"), "Content-Type": "text/plain"}
    else:
        kind = "application/http; msgtype=response" if head else record.fields["Content-type"]
        headers |= {"WARC-Type": "response" if head else "resource", "WARC-Target-URI": url, "WARC-IP-Address": record.fields["IP-address"], "Content-Type": kind, "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if record.truncated:
        headers["WARC-Truncated"] = "length"
    return headers | {"WARC-Block-Digest": f"sha1:{digest(body)}"}, head, payload


RECORDS = "record_id string, warc_type string, target_uri string, warc_date string, ip string, head binary, payload_digest string, payload_bytes long, member binary"


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def arc_to_warc(archives: DataFrame) -> DataFrame:
    """A row for each record of ARC archives (name, content): its WARC fields and the whole record as a gzip member.

    A null or empty archive has no records, an empty table gives no rows, and
    other columns are not read. Repeated records all come, with their full
    payload; ``with_revisits`` turns them into revisit records. Record ids
    follow from an archive's name and the record's offset, so archives that
    repeat a name and hold the same give equal ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for record in parse_arc(content.as_py() or b""):
                    h, head, payload = convert(name or "", record)
                    rows.append((h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Target-URI"), h["WARC-Date"], h.get("WARC-IP-Address"), head, h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, len(payload), _member(warc_record(h, record.body))))
                yield _batch(rows, RECORDS)

    return archives.select("name", "content").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def with_revisits(records: DataFrame, order: str, least_bytes: int = 0) -> DataFrame:
    """(member): of records with equal payloads of at least ``least_bytes`` bytes all but one become revisits of it.

    order: column of records; the largest value keeps its payload, of equal
    ones the largest record id, and null counts as the smallest. Only
    responses are merged. The digest join moves compressed records; one
    digest's rows may be dealt over many tasks. records is evaluated twice,
    for the digests and for the join, so what it is read from must be a table
    that gives the same rows in the same tasks each time, as files do; write
    other inputs first. An empty table gives no rows.
    """
    merged = F.col("warc_type") == "response"
    first = records.filter(merged & (F.col("payload_bytes") >= least_bytes)).groupBy("payload_digest").agg(F.max(F.struct(F.col(order).alias("o"), "record_id", "target_uri", "warc_date")).alias("first"))
    first = first.select(F.col("payload_digest").alias("first_digest"), F.col("first.record_id").alias("first_id"), F.col("first.target_uri").alias("first_uri"), F.col("first.warc_date").alias("first_date"))
    key = F.when(merged & (F.col("payload_bytes") >= least_bytes), F.col("payload_digest"))
    joined = records.join(first, key == F.col("first_digest"), "left").withColumn("repeat", F.coalesce(F.col("first_id") != F.col("record_id"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("member").to_pylist()
            for i in [i for i, r in enumerate(batch.column("repeat").to_pylist()) if r]:
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "member"}
                headers = {"WARC-Type": "revisit", "WARC-Record-ID": row["record_id"], "WARC-Date": row["warc_date"], "WARC-Target-URI": row["target_uri"], "WARC-IP-Address": row["ip"], "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": row["first_id"], "WARC-Refers-To-Target-URI": row["first_uri"], "WARC-Refers-To-Date": row["first_date"], "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{row['payload_digest']}", "WARC-Block-Digest": f"sha1:{digest(row['head'])}"}
                members[i] = _member(warc_record(headers, row["head"]))
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    return joined.mapInArrow(run, "member binary")


def write_warc(members: DataFrame, path: str, archive_bytes: int = 1 << 26) -> None:
    """Archives of (member) rows under path, in folders by number; each task begins another when one has so many bytes.

    An archive is larger than that by less than its last record. Null members
    are left out, repeated ones are written again, and an empty table makes an
    empty folder.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = number = 0
        for batch in batches:
            at = []
            for length in pc.binary_length(batch.column(0)).to_pylist():
                number, size = (number + 1, 0) if size >= archive_bytes else (number, size)
                size += length
                at.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0)], ["archive", "member"])

    rows = members.filter("member is not null").select("member").mapInArrow(numbered, "archive int, member binary")
    text = rows.select("archive", F.col("member").cast("string").alias("value"))
    text.write.partitionBy("archive").option("lineSep", _SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an uncompressed stream, by their declared lengths; header names are lower-cased."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        yield headers, stream.read(int(headers["content-length"]))


WARC = "record_id string, warc_type string, target_uri string, warc_date string, refers_to string, declared_digest string, payload_digest string, head binary, payload binary"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives under path; in a revisit payload and payload_digest are null.

    Archives are read one at a time and put out record by record, in batches of
    a few MB. Repeated records all come; a folder without archives gives no
    rows. What is no WARC record raises an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for h, block in parse_warc(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))):
                    head, payload = split_http(block)
                    kind = h["warc-type"]
                    rows.append((h["warc-record-id"], kind, h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, *((None, head, None) if kind == "revisit" else (digest(payload), head, payload))))
                    size += len(block)
                    if size >= 1 << 22:
                        yield _batch(rows, WARC)
                        rows, size = [], 0
                yield _batch(rows, WARC)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, WARC)


# --- pages -------------------------------------------------------------------


def pages_to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20200101000000", archive_bytes: int = 1 << 22) -> DataFrame:
    """Legacy archives (name, content) of a page table, versions 1 and 2 in turn, of a few MB each.

    Each record is an HTTP response with the html in UTF-8 as payload (null:
    empty) and the page's id in X-Page-Id (none for a null id). A null url
    becomes urn:page:unknown.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{made:06d}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_archive(name, held, 1 + made % 2, date)], pa.binary())], ["name", "content"])

        for batch in batches:
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                named = "" if page is None else f"X-Page-Id: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n".encode()
                held.append((url or "urn:page:unknown", "0.0.0.0", date, "text/html", head + payload))
                size += len(payload)
                if size >= archive_bytes:
                    yield archive()
                    made, held, size = made + 1, [], 0
        if held:
            yield archive()

    return pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col)).mapInArrow(run, "name string, content binary")


def http_number(name: str, head: str = "head") -> Column:
    """A whole-number header field of an HTTP head, or null."""
    return F.expr(f"try_cast(nullif(regexp_extract(decode({head}, 'ISO-8859-1'), '(?im)^{name}: *(-?[0-9]+)', 1), '') as bigint)")
