"""Legacy ARC archives to WARC.

``write_arc`` stores pages as version 1 or 2 ARC archives; ``read_arc`` parses
archives of any origin by their version block (which names the fields of every
header line) and the declared lengths; ``arc_to_warc`` turns the records into
WARC/1.1 with synthesised record ids, ISO timestamps, types and SHA-256
digests, storing a payload once and its copies as revisits; ``read_warc`` reads
those archives.

A record that holds an HTTP response keeps its own HTTP head, whatever its
status and type, and becomes a response; any other (``dns:``, ``ftp:``) becomes a
resource whose payload is its whole block, under the declared content type. The
declared IP address is carried over. Payloads are bytes throughout.

Archives are made inside tasks, of about ``archive_bytes`` each (a longer
record makes a longer archive), and stored by Spark's own writer, one gzip
file per archive, so they land wherever the path points. Reading takes one
archive at a time. Payloads do not move by key: digests decide which record
of which archive is a revisit, and these few rows meet the packed archives.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.graph import stored
from ledgerloom.llm.workers import ready
from ledgerloom.session import scratch_path

ARCHIVE_BYTES = 16 * 1024 * 1024
MIN_PAYLOAD = 100
CRAWLED = "20200101000000"  # pages carry no time of their own
# Field names of ARC header lines by version; profile of revisits.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = 0x6C6F6F6D_7761_8000 << 64
ARC_RECORDS = ("file string, no long, page_id long, url string, ip string, content_type string, http binary, payload binary, "
               "payload_digest string, n long, archived string")
STORED = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary, warc_date string, record_id string")


def _escaped(url: str | None) -> str:
    """A URL fit for a header line; ``-`` stands for null."""
    return "-" if url is None else quote(url, safe="".join(map(chr, range(33, 127)))) or "%"


def _store(df: DataFrame, path: str) -> None:
    # a binary value cast to text keeps its bytes, and the writer writes them as they are
    (df.select(F.col("value").cast("string")).write.option("compression", "gzip").option("maxRecordsPerFile", 1)
     .option("lineSep", "\n").text(path))


def _archives(records: Iterator[bytes], head: bytes, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    def batch(parts):
        # the writer ends the file with a line feed of its own
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["value"])

    parts, size = [head], 0
    for r in records:
        if size and size + len(r) > archive_bytes:
            yield batch(parts)
            parts, size = [head], 0
        parts.append(r)
        size += len(r)
    if size:
        yield batch(parts)


def write_arc(pages: DataFrame, path: str, version: int = 1, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Store ``page_id, url, html`` rows as ARC archives below ``path``. The
    body of a record is an HTTP response that names its page."""
    fields = ARC_FIELDS[version]
    version_block = f"{version} 0 ledgerloom\n{fields}\n".encode()
    rest = " 200 - - 0 -" if version == 2 else ""
    head = (f"filedesc://ledgerloom.arc 0.0.0.0 {CRAWLED} text/plain{rest} {len(version_block)}\n").encode() + version_block + b"\n"

    def records(batches):
        for b in batches:
            for page, url, text in zip(*(c.to_pylist() for c in b.columns)):
                body = (text or "").encode("utf-8")
                http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        + (b"" if page is None else b"X-Page-Id: %d\r\n" % page)
                        + b"Content-Length: %d\r\n\r\n" % len(body))
                more = f" 200 {hashlib.md5(body).hexdigest()} - 0 -" if version == 2 else ""
                line = f"{_escaped(url)} 0.0.0.0 {CRAWLED} text/html{more} {len(http) + len(body)}\n"
                yield b"".join((line.encode(), http, body, b"\n"))

    _store(ready(pages).select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        lambda it: _archives(records(it), head, archive_bytes), "value binary"), path)


def split_http(block: bytes) -> tuple[bytes | None, bytes]:
    """The head of an HTTP response, with the empty line that ends it, and the
    body. A block that is no HTTP response has no head and is all body."""
    if not block.startswith(b"HTTP/"):
        return None, block
    ends = [(at, len(sep)) for sep in (b"\r\n\r\n", b"\n\n") if (at := block.find(sep)) >= 0]
    if not ends:  # a head alone
        return block, b""
    at, size = min(ends)
    return block[:at + size], block[at + size:]


def http_fields(head: bytes | None) -> dict[str, str]:
    """The header fields of an HTTP head, names in lower case."""
    fields = {}
    for line in (head or b"").splitlines()[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    return fields


def _page(head: bytes | None) -> int | None:
    page = http_fields(head).get("x-page-id")
    return int(page) if page is not None and page.removeprefix("-").isdigit() else None


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC archive: the fields of its version, read as Latin-1,
    and ``block``."""
    at, names = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        if end == at:  # an empty line between records
            at += 1
            continue
        values = data[at:end].decode("latin-1").rstrip("\r").split(" ")
        length, start = int(values[-1]), end + 1
        block = data[start:start + length]
        if len(block) != length:
            raise ValueError("the archive ends inside a record")
        if names is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an ARC archive starts with its version block")
            head, fields = (x.rstrip("\r") for x in block.decode("latin-1").split("\n")[:2])
            version = int(head.split(" ")[0])
            if version not in ARC_FIELDS or fields != ARC_FIELDS[version]:
                raise ValueError(f"unknown ARC version block: {head} / {fields}")
            names = fields.split(" ")
        else:
            if len(values) < len(names):
                raise ValueError(f"a header line has {len(values)} fields, not {len(names)}")
            # old crawlers left spaces in URLs: the other fields have none
            spare = len(values) - len(names)
            values = [" ".join(values[:spare + 1]), *values[spare + 1:]]
            yield dict(zip(names, values)) | {"block": block}
        at = start + length


def _files(spark: SparkSession, path: str) -> DataFrame:
    return ready(spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content"))


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType],
             most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    got, size = [], 0
    for r in rows:
        got.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes | str))
        if size > most or len(got) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], names=names)
            got, size = [], 0
    if got:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got), kinds)], names=names)


def _url(written: str) -> str | None:
    """The URL as archived: white space and non-ASCII stay percent-encoded."""
    return {"-": None, "%": ""}.get(written, written)


def _arc_rows(file: str, content: bytes, with_payload: bool) -> Iterator[tuple]:
    for no, r in enumerate(parse_arc(gzip.decompress(content))):
        head, body = split_http(r["block"])
        yield (file, no, _page(head), _url(r["URL"]), r["IP-address"], r["Content-type"], head, body if with_payload else None,
               hashlib.sha256(body).hexdigest(), len(body), r["Archive-date"])


_ARC_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(),
              pa.int64(), pa.string()]
_ARC_NAMES = [x.split(" ")[0] for x in ARC_RECORDS.split(", ")]


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """``(file, no, page_id, url, ip, content_type, http, payload,
    payload_digest, n, archived)`` of ARC archives of either version below
    ``path``. http is the head of an HTTP response (null: the record is none),
    page_id the number in its X-Page-Id field, if any."""
    def rows(batches):
        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                yield from _arc_rows(file.as_py(), content.as_py(), with_payload)

    return _files(spark, path).mapInArrow(lambda it: _batches(rows(it), _ARC_NAMES, _ARC_KINDS), ARC_RECORDS)


def record_id(page: int | None, other: str = "") -> str:
    """A WARC record id; that of a page holds the page's id."""
    n = (_NAMESPACE | (page % (1 << 64))) if page is not None else uuid.uuid5(uuid.NAMESPACE_URL, other).int
    return f"<urn:uuid:{uuid.UUID(int=n)}>"


def _page_of(rid: str | None) -> int | None:
    if rid is None:
        return None
    n = uuid.UUID(rid[10:-1]).int & ((1 << 64) - 1)
    return n - (1 << 64) if n >> 63 else n


def _warc_date(archived: str) -> str:
    """An ARC date (14 digits, or fewer) as ISO; the start of what it leaves open."""
    d = archived + "00000101000000"[len(archived):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: dict, refers_to: int | None) -> bytes:
    """One WARC record from a record of :func:`read_arc`; with ``refers_to`` a
    revisit of that page's response."""
    head, body, digest = r["http"], r["payload"], r["payload_digest"]
    kind = "revisit" if refers_to is not None else "resource" if head is None else "response"
    block = (head or b"") + (b"" if kind == "revisit" else body)
    rid = record_id(r["page_id"], f"{r['url']} {r['archived']} {digest}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", f"WARC-Date: {_warc_date(r['archived'])}",
             f"WARC-Target-URI: {_escaped(r['url'])}", f"WARC-Payload-Digest: sha256:{digest}",
             f"Payload-Length: {r['n']}",
             f"Content-Type: {r['content_type'] if head is None else 'application/http; msgtype=response'}"]
    if r["ip"] not in ("-", "0.0.0.0"):
        lines.append(f"WARC-IP-Address: {r['ip']}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    else:
        lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}")
    lines.append(f"Content-Length: {len(block)}")
    return b"".join(("\r\n".join(lines).encode(), b"\r\n\r\n", block, b"\r\n\r\n"))


def _warc_head() -> bytes:
    info = b"software: ledgerloom\r\nformat: WARC File Format 1.1\r\n"
    return (b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: %s\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
            b"Content-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
            % (record_id(None, "warcinfo").encode(), len(info), info))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("a record starts with its WARC version")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError("a record's length differs from its header")
        yield fields, data[start:stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per response, resource or revisit record of the archives below
    ``path``; digests of stored payloads are checked."""
    def rows(batches):
        for b in batches:
            for content in b.column(0):
                for fields, block in parse_warc(gzip.decompress(content.as_py())):
                    kind = fields["warc-type"]
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    head, body = (None, block) if kind == "resource" else split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind != "revisit" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
                    yield (_page(head), _url(fields["warc-target-uri"]), kind,
                           _page_of(fields.get("warc-refers-to")), int(fields["payload-length"]), digest,
                           body if with_payload and kind != "revisit" else None, fields["warc-date"],
                           fields["warc-record-id"])

    names = [x.split(" ")[0] for x in STORED.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string()]
    return _files(spark, path).select("content").mapInArrow(lambda it: _batches(rows(it), names, kinds), STORED)


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, min_payload: int = MIN_PAYLOAD,
                archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Convert the ARC archives below ``arc_path``.

    Of records with equal payloads of at least ``min_payload`` bytes, the one
    with the smallest page id is a response (all rows with that id, if it is
    repeated, and all, if every id is null); the others become revisits."""
    small = read_arc(spark, arc_path, with_payload=False).select("file", "no", "page_id", "payload_digest", "n")
    # digests and ids alone, written: they are read twice
    small = stored(spark, small.where(F.col("n") >= min_payload), "digests")
    copies = (small.groupBy("payload_digest").agg(F.min("page_id").alias("least"), F.count("*").alias("c"))
              .where("c > 1 and least is not null").select("payload_digest", "least"))
    revisits = (small.join(copies, "payload_digest").where("page_id is null or page_id > least")
                .groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("no", "least"))).alias("revisits")))
    # whole archives, packed, meet the list of their own revisits
    files = _files(spark, arc_path).join(revisits, "file", "left").select("file", "content", "revisits")

    def made(batches):
        for b in batches:
            for file, content, found in zip(b.column(0), b.column(1), b.column(2)):
                later = dict(found.as_py() or ())
                for row in _arc_rows(file.as_py(), content.as_py(), True):
                    r = dict(zip(_ARC_NAMES, row))
                    yield warc_record(r, later.get(r["no"]))

    _store(files.mapInArrow(lambda it: _archives(made(it), _warc_head(), archive_bytes), "value binary"), warc_path)


def convert_pages(spark: SparkSession, pages: DataFrame, arc_version: int = 1,
                  archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, str]:
    """Paths of the ARC and WARC archives made from ``page_id, url, html``
    rows. A null page is an empty payload; null urls and ids survive (in urls, white
    space and non-ASCII letters come back percent-encoded); an empty
    table leaves folders without archives."""
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, arc_version, archive_bytes)
    arc_to_warc(spark, arc, warc, archive_bytes=archive_bytes)
    return arc, warc
