"""Legacy ARC archives to WARC: parse, convert, write, and read back.

An ARC file declares its own version and field list; each record has one header line and a declared
length. Conversion gives WARC records with synthesised ids, timestamps, types and digests. Records
whose payload another record already holds become revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import salt_of, salted, sent_whole, table
from siltstone.session import work_path

sent_whole(__name__)

CRLF = b"\r\n"
#: The end of an HTTP head; old archives hold bare line feeds.
HEAD_END = re.compile(rb"\r?\n\r?\n")
#: Field lists of the two ARC versions (fixed by the format).
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Records in one ARC container of the query, and rows per archive file.
ARC_RECORDS, FILE_ROWS = 64, 2000
#: Bytes of blocks after which a batch of read records is handed over.
BATCH_BYTES = 16 << 20
#: Payloads from this size on are stored once.
LEAST_SHARED = 1000


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    offset: int
    block: bytes
    #: Why the header line could not be read; such a record has no fields.
    error: str | None = None

    @property
    def url(self) -> str:
        return self.fields["URL"]


def arc_file(records: list[tuple[str, bytes]], version: int, date: str, name: str) -> bytes:
    """An ARC container of (url, http message) records in either version of the format."""
    names = ARC_FIELDS[version]
    about = f"{version} 0 archive\n{' '.join(names)}\n\n".encode()

    def line(url: str, kind: str, length: int, offset: int) -> bytes:
        value = {
            "URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": "200",
            "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(length),
        }
        return " ".join(value[n] for n in names).encode() + b"\n"

    out = io.BytesIO()
    out.write(line(f"filedesc://{name}", "text/plain", len(about), 0) + about + b"\n")
    for url, block in records:
        out.write(line(url, "text/html", len(block), out.tell()) + block + b"\n")
    return out.getvalue()


def arc_records(data: bytes, lenient: bool = False) -> Iterator[ArcRecord]:
    """Records of an ARC file, by the field list that its first record declares.

    Header lines are read from the right, so that blanks in a url are part of it. Too few fields, a date that
    is no number, unreadable or overlong lengths raise ValueError: a wrong length would turn the rest of
    the file into noise. If ``lenient``, a line whose length alone can be read gives a record with
    ``error``, and the next follows after its block. Blank lines between records are skipped.
    """
    at, version, names = 0, 0, ARC_FIELDS[1]
    while at < len(data):
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"header line at {at} has no end")
        line = data[at:stop].rstrip(b"\r").decode("utf-8", "replace")
        if not line:
            at = stop + 1
            continue
        parts, head = line.rsplit(" ", len(names) - 1), names
        if version == 0:
            parts = line.split(" ")
            if not line.startswith("filedesc://") or len(parts) not in map(len, ARC_FIELDS.values()):
                raise ValueError("not an ARC file: no version block")
            head = next(n for n in ARC_FIELDS.values() if len(n) == len(parts))
        told = dict(zip(head, parts, strict=False))
        wrong = None
        if len(parts) != len(head) or not told["Archive-date"].isdigit():
            wrong = f"header line at {at} does not fit its {len(head)} fields: {line[:200]}"
        if not parts[-1].isdigit() or (wrong and not (lenient and version)):
            raise ValueError(wrong or f"header line at {at} has no length: {line[:200]}")
        start, length = stop + 1, int(parts[-1])
        if start + length > len(data):
            raise ValueError(f"record at {at} declares {length} bytes, {len(data) - start} are left")
        block = data[start : start + length]
        if version == 0:
            lines = block.decode("utf-8", "replace").splitlines()
            version = int(lines[0].split(" ")[0])
            names = tuple(lines[1].split(" "))
        yield ArcRecord(version, {} if wrong else told, at, block, wrong)
        at = start + length


def sha1_name(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(key: str) -> str:
    """The same key gives the same id, whatever task makes it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def warc_date(date: str) -> str:
    """A 14-digit ARC date (shorter ones are padded to their first moment) as a W3C timestamp."""
    full = date[:14] + "00000101000000"[len(date[:14]) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (lower-case names), the head as it stands, and the body of an HTTP message."""
    ends = HEAD_END.search(block)
    head, body = (block[: ends.end()], block[ends.end() :]) if ends else (block, b"")
    named = {}
    for line in head.decode("utf-8", "replace").split("\n")[1:]:
        name, _, value = line.partition(":")
        if name.strip():
            named[name.strip().lower()] = value.strip()
    return named, head, body


def warc_record(record: ArcRecord, key: str, refers_key: str | None = None, refers_to: str | None = None) -> bytes:
    """One ARC record as a WARC record, without the two line ends that close it.

    filedesc becomes warcinfo, an HTTP message a response (or a revisit that keeps the HTTP head
    only), a dns: url and anything else a resource. Digests are of the whole block and payload.
    """
    block, url = record.block, record.url
    lines = {"WARC-Date": warc_date(record.fields["Archive-date"]), "WARC-Record-ID": record_id(key)}
    if url.startswith("filedesc://"):
        kind, content, payload = "warcinfo", "application/warc-fields", None
        lines["WARC-Filename"] = url.removeprefix("filedesc://")
        block = f"software: arc conversion\r\nconverted-from: ARC/{record.version}\r\n".encode()
    else:
        lines["WARC-Target-URI"] = url
        lines["WARC-IP-Address"] = record.fields["IP-address"]
        if block.startswith(b"HTTP/"):
            kind, content = "response", "application/http; msgtype=response"
            _, head, payload = http_parts(block)
            if refers_key is not None:
                kind, block = "revisit", head
                content = "application/http; msgtype=response"
                lines |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_key), "X-Refers-To-Key": str(refers_to), "WARC-Truncated": "length"}
        else:
            kind, content, payload = "resource", record.fields["Content-type"], block
    if payload is not None:
        lines["WARC-Payload-Digest"] = sha1_name(hashlib.sha1(payload).digest())
    lines |= {"WARC-Block-Digest": sha1_name(hashlib.sha1(block).digest()), "Content-Type": content, "Content-Length": str(len(block))}
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in ({"WARC-Type": kind} | lines).items())
    return head.encode() + CRLF + block


@dataclass
class WarcRecord:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def warc_records(stream) -> Iterator[WarcRecord]:
    """Records of an uncompressed WARC stream, by declared lengths; a wrong block digest raises ValueError."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:80]!r}")
        headers = {}
        while (line := stream.readline()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        length = int(headers["Content-Length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record declares {length} bytes, {len(block)} are left")
        if (named := headers.get("WARC-Block-Digest")) and named != sha1_name(hashlib.sha1(block).digest()):
            raise ValueError(f"block digest of {headers.get('WARC-Record-ID')} differs")
        yield WarcRecord(headers, block)


def mark_repeats(df: DataFrame, key: str, payload: Column, least: int = LEAST_SHARED) -> DataFrame:
    """``df`` with ``refers_to``: the largest key with the same payload of ``least`` bytes or more, for all others.

    Counted inside the map tasks first; only payloads with several keys take part in the join, over
    salts, so that thousands of copies of one payload are spread.
    """
    sized = df.withColumns({"_digest": F.sha1(payload), "_big": F.octet_length(payload) >= least})
    firsts = salted(
        sized.filter("_big").groupBy("_digest").agg(F.max(key).alias("_largest"), F.min(key).alias("_smallest"))
        .filter("_largest <> _smallest or _largest is null").drop("_smallest")
    ).withColumnRenamed("salt", "_salt")
    joined = sized.withColumn("_salt", salt_of(F.col(key), F.lit(7))).join(firsts, ["_digest", "_salt"], "left")
    shared = F.col("_big") & F.col("_largest").isNotNull() & ~F.col(key).eqNullSafe(F.col("_largest"))
    return joined.withColumn("refers_to", F.when(shared, F.col("_largest"))).drop("_digest", "_big", "_largest", "_salt")


def _safe_url(url: str | None) -> str:
    """A url without blanks and control characters, as header lines need it."""
    return quote(url or "about:blank", safe="".join(map(chr, range(33, 127))))


def to_warc(pages: DataFrame, date: str = "20240101000000") -> DataFrame:
    """(page_id, url, html, refers_to) rows as WARC records (column ``value``), by way of ARC containers."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ARC_RECORDS):
                part = batch.slice(at, ARC_RECORDS)
                keys, urls, htmls, refers = (part.column(i).to_pylist() for i in range(4))
                messages = []
                for key, url, html in zip(keys, urls, htmls, strict=True):
                    body = (html or "").encode()
                    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\nX-Key: {'' if key is None else key}\r\n\r\n"
                    messages.append((_safe_url(url), head.encode() + body))
                data = arc_file(messages, 1 + count % 2, date, f"part-{count}.arc")
                count += 1
                out = []
                for number, record in enumerate(arc_records(data)):
                    if number == 0:
                        out.append(warc_record(record, f"{record.url}#{keys[0]}"))
                        continue
                    refer = refers[number - 1]
                    out.append(warc_record(record, f"page:{keys[number - 1]}", None if refer is None else f"page:{refer}", refer))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(convert, "value binary")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, version, url, ip, date, content_type, block, error) of the records of delivered ``.arc`` and ``.arc.gz`` files.

    Gzip files may hold one member for each record. One file is one row of a task and is held whole there
    (a file may have up to 2 GB, Spark's limit of one value). What cannot be read does not end the job: a
    header line that does not fit, or the place where the rest of a file is lost, is a row with ``error``.
    A folder without such files gives no rows.
    """
    names = ["file", "offset", "version", "url", "ip", "date", "content_type", "block", "error"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held, after = [], 0, 0
                try:
                    data = content.as_py()
                    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                    for r in arc_records(data, lenient=True):
                        told = [r.fields.get(n) for n in ("URL", "IP-address", "Archive-date", "Content-type")]
                        rows.append([file, r.offset, r.version, *told, r.block, r.error])
                        held, after = held + len(r.block), r.offset + 1
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)
                            rows, held = [], 0
                except (ValueError, IndexError, EOFError, OSError, zlib.error) as broken:
                    rows.append([file, after, None, None, None, None, None, None, str(broken)])
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arc{,.gz}").load(path).select("path", "content")
    return files.mapInArrow(
        parse,
        "file string, offset bigint, version int, url string, ip string, date string, content_type string, block binary, error string",
    )


def arc_to_warc(records: DataFrame) -> DataFrame:
    """Rows of ``read_arc`` as WARC records (column ``value``); ids come from file and offset. Rows with ``error`` are left out."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, offset, version, url, ip, date, kind, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                told = {"URL": _safe_url(url), "IP-address": ip, "Archive-date": date, "Content-type": kind}
                out.append(warc_record(ArcRecord(version, told, offset, block), f"{file}#{offset}"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    good = records.filter("error is null").select("file", "offset", "version", "url", "ip", "date", "content_type", "block")
    return good.mapInArrow(convert, "value binary")


def write_warc(records: DataFrame, path: str, rows_per_file: int = FILE_ROWS) -> None:
    """Write records as gzip WARC files: every record ends in two line ends, which is Spark's separator here."""
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", rows_per_file
    ).text(path, compression="gzip")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(key, record_type, refers_to, payload_bytes, payload_digest, target_uri, warc_date) of all records but warcinfo.

    One file is one row of a task, and its records are read as a stream. A response's payload is hashed
    anew and has to agree with its header; a revisit tells size and digest of the payload it refers to.
    """
    schema = "key string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, target_uri string, warc_date string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for record in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    told = record.headers
                    if told["WARC-Type"] == "warcinfo":
                        continue
                    http, _, body = ({}, b"", record.block) if told["WARC-Type"] == "resource" else http_parts(record.block)
                    digest = base64.b32decode(told["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if told["WARC-Type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload digest of {told['WARC-Record-ID']} differs")
                    rows.append({
                        "key": http.get("x-key") or None, "record_type": told["WARC-Type"], "refers_to": told.get("X-Refers-To-Key"),
                        "payload_bytes": len(body) if told["WARC-Type"] != "revisit" else int(http["content-length"]) if http.get("content-length", "").isdigit() else None,
                        "payload_digest": digest,
                        "target_uri": told["WARC-Target-URI"], "warc_date": told["WARC-Date"],
                    })
                kinds = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in (x.split()[0] for x in schema.split(", "))])
                yield pa.RecordBatch.from_pylist(rows, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, schema)


def op2_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record by way of ARC, then read from the archives.

    Null htmls are empty payloads. Rows that repeat the largest page_id of a payload are responses
    like it. A null page_id counts as smallest; where all are null, all are responses.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = work_path(spark, "warc")
    write_warc(to_warc(mark_repeats(pages, "page_id", F.coalesce("html", F.lit("")))), path)
    read = read_warc(spark, path)
    return read.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "target_uri", "warc_date",
    )


OP2_SQL = f"""
with sized as (
    select page_id, url, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes,
        sha1(coalesce(html, '')) as payload_digest
    from pages
), marked as (
    select *, case when payload_bytes >= {LEAST_SHARED} then max(page_id) over (partition by payload_digest, payload_bytes >= {LEAST_SHARED}) end as largest
    from sized
)
select page_id, payload_bytes, payload_digest,
    case when largest is null or largest is not distinct from page_id then 'response' else 'revisit' end as record_type,
    case when largest is null or largest is not distinct from page_id then null else largest end as refers_to,
    url as target_uri, '2024-01-01T00:00:00Z' as warc_date
from marked
"""
