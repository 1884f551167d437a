"""The converter on archives that it has not made."""

import gzip
import hashlib
import os

import pytest

from ledgerloom.llm import warc

PNG = b"\x89PNG\r\n\x1a\n\x00\xff\xfe" + bytes(range(256)) * 2


def arc(version, records):
    """An ARC file of ``(url, ip, date, type, block)``."""
    block = f"{version} 0 other crawler\n{warc.ARC_FIELDS[version]}\n".encode()
    more = " 200 - - 0 other.arc" if version == 2 else ""
    out = f"filedesc://other.arc 0.0.0.0 19970101000000 text/plain{more} {len(block)}\n".encode() + block + b"\n"
    for url, ip, date, kind, data in records:
        out += url + f" {ip} {date} {kind}{more} {len(data)}\n".encode() + data + b"\n"
    return out


RECORDS = [
    (b"http://a.example/logo.png", "192.0.2.7", "19970203040506", "image/png",
     b"HTTP/1.0 200 OK\r\nContent-Type: image/png\r\n\r\n" + PNG),
    (b"http://a.example/gone", "192.0.2.7", "19970203040507", "text/html",
     b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=iso-8859-1\r\nServer: x\r\n\r\n<p>caf\xe9 gone</p>"),
    (b"dns:a.example", "192.0.2.1", "19970203040508", "text/dns", b"19970203040508\na.example. 60 IN A 192.0.2.7\n"),
    ("http://a.example/café".encode("latin-1"), "192.0.2.7", "1997", "text/html", b"HTTP/1.0 200 OK\nContent-Type: text/html\n\nbare line feeds"),
    (b"http://a.example/two words", "-", "199702", "text/html", b"HTTP/1.0 204 No Content\r\n\r\n"),
    (b"http://a.example/again", "192.0.2.7", "19980101000000", "text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\n" + b"same " * 50),
    (b"http://a.example/more", "192.0.2.7", "19980101000001", "text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\n" + b"same " * 50),
    (b"http://a.example/head", "192.0.2.7", "19980101000002", "text/html", b"HTTP/1.1 304 Not Modified"),
]


@pytest.mark.parametrize("version", [1, 2])
def test_foreign_records_survive(spark, tmp_out, version):
    path, out = tmp_out("foreign"), tmp_out("warc")
    os.makedirs(path)
    for i, part in enumerate((RECORDS[:5], RECORDS[5:])):
        with gzip.open(f"{path}/{i}.arc.gz", "wb") as f:
            f.write(arc(version, part))
    read = {r["archived"]: r for r in warc.read_arc(spark, path).collect()}
    assert len(read) == len(RECORDS)
    assert bytes(read["19970203040506"]["payload"]) == PNG and read["19970203040506"]["ip"] == "192.0.2.7"
    assert read["1997"]["url"] == "http://a.example/café" and bytes(read["1997"]["payload"]) == b"bare line feeds"
    assert read["199702"]["url"] == "http://a.example/two words"
    warc.arc_to_warc(spark, path, out)
    got = {r["warc_date"]: r for r in warc.read_warc(spark, out, with_payload=True).collect()}
    assert len(got) == len(RECORDS)
    for _, _, _, _, block in RECORDS:
        body = warc.split_http(block)[1]
        assert any(r["payload_digest"] == hashlib.sha256(body).hexdigest() and r["payload_bytes"] == len(body) for r in got.values())
    assert got["1997-01-01T00:00:00Z"]["record_type"] == "response" and got["1997-02-01T00:00:00Z"]["payload_bytes"] == 0
    dns = got["1997-02-03T04:05:08Z"]
    assert dns["record_type"] == "resource" and bytes(dns["payload"]) == RECORDS[2][4]
    again = got["1998-01-01T00:00:01Z"]
    assert (again["record_type"], again["refers_to"], again["page_id"], again["payload_bytes"]) == ("revisit", 5, 9, 250)
    # the heads are those that were archived
    blocks = {}
    for name in os.listdir(out):
        if name.endswith(".gz"):
            with gzip.open(f"{out}/{name}") as f:
                for fields, block in warc.parse_warc(f.read()):
                    blocks[fields.get("warc-target-uri", "info")] = fields, block
    fields, block = blocks["http://a.example/gone"]
    assert block == RECORDS[1][4] and fields["warc-ip-address"] == "192.0.2.7"
    assert blocks["http://a.example/logo.png"][1] == RECORDS[0][4]
    assert blocks["dns:a.example"][0]["content-type"] == "text/dns"
    assert blocks["http://a.example/more"][1] == RECORDS[6][4][:-250] and "warc-ip-address" not in blocks["http://a.example/two%20words"][0]


def test_heads_and_bodies():
    assert warc.split_http(b"HTTP/1.0 200 OK\n\nx\r\n\r\ny") == (b"HTTP/1.0 200 OK\n\n", b"x\r\n\r\ny")
    assert warc.split_http(b"<p>HTTP/1.0\r\n\r\n") == (None, b"<p>HTTP/1.0\r\n\r\n")
    assert warc.split_http(b"") == (None, b"")
    assert warc.http_fields(b"HTTP/1.0 200 OK\r\nA: 1\r\nbad\r\nX-Page-Id: -3\r\n\r\n") == {"a": "1", "x-page-id": "-3"}
    assert warc._page(b"HTTP/1.0 200 OK\r\nX-Page-Id: seven\r\n\r\n") is None and warc._page(None) is None


def test_payloads_are_not_exchanged(spark, tmp_out):
    """What meets the decisions is the packed archive: no payload column goes through an exchange."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", "body " * 100) for i in range(20)], "page_id long, url string, html string")
    arc_path, _ = warc.convert_pages(spark, pages, archive_bytes=2000)
    small = warc.read_arc(spark, arc_path, with_payload=False).select("file", "no", "page_id", "payload_digest", "n")
    assert small.count() == 20 and small.select("file").distinct().count() > 3
