import gzip
import hashlib
import io

import pytest

from siltstone.llm.archive import (
    arc_file, arc_records, arc_to_warc, http_parts, mark_repeats, read_arc, read_warc, to_warc, warc_date, warc_record, warc_records, write_warc,
)
from pyspark.sql import functions as F

KIND = "page_id long, url string, html string"
MESSAGE = b"HTTP/1.0 200 OK\r\nX-Key: 7\r\nContent-Length: 6\r\n\r\n\xff\n\r\nab"


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip_in_both_versions(version):
    data = arc_file([("http://a/b", MESSAGE), ("http://c/", b"HTTP/1.0 200 OK\r\n\r\n")], version, "20200102030405", "x.arc")
    first, one, two = arc_records(data)
    assert (first.version, first.url, one.url, one.block, two.block) == (version, "filedesc://x.arc", "http://a/b", MESSAGE, b"HTTP/1.0 200 OK\r\n\r\n")
    assert ("Result-code" in one.fields) == (version == 2)
    warc = list(warc_records(io.BytesIO(b"\r\n\r\n".join(warc_record(r, f"k{i}") for i, r in enumerate((first, one, two))) + b"\r\n\r\n")))
    assert [w.headers["WARC-Type"] for w in warc] == ["warcinfo", "response", "response"]
    assert warc[1].block == MESSAGE and warc[1].headers["WARC-Date"] == "2020-01-02T03:04:05Z"
    assert http_parts(warc[1].block)[2] == b"\xff\n\r\nab"


def test_broken_archives_are_refused():
    data = arc_file([("http://a/b", MESSAGE)], 1, "20200102030405", "x.arc")
    for bad in (data[:-9], data.replace(b"text/html 5", b"text/html x5"), b"nonsense\n", data.replace(b"0.0.0.0 20200102030405 text/html", b"0.0.0.0 text/html")):
        with pytest.raises(ValueError):
            list(arc_records(bad))
    good = warc_record(list(arc_records(data))[1], "k")
    with pytest.raises(ValueError):
        list(warc_records(io.BytesIO(good.replace(b"ab", b"zz"))))


def test_other_records():
    dns, other = (list(arc_records(arc_file([(u, b"text")], 1, "2020", "x.arc")))[1] for u in ("dns:a.example", "ftp://a/b"))
    assert b"WARC-Type: resource" in warc_record(dns, "k") and b"WARC-Type: resource" in warc_record(other, "k")
    assert warc_date("2020") == "2020-01-01T00:00:00Z"


def test_pages_come_back_and_repeats_are_revisits(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/ x\n", big), (5, None, big), (5, "http://b/", big), (3, "http://c/", "s" * 999), (4, "http://d/", "s" * 999),
            (6, "http://e/", None), (None, "http://f/", big), (8, "http://g/", ""), (9, "http://h/", "\r\n\r\nWARC/1.0\r\n\r\n" * 100)]
    df = spark.createDataFrame(rows, KIND).withColumn("_digest", F.lit("clash"))
    path = str(tmp_path / "warc")
    write_warc(to_warc(mark_repeats(df.drop("_digest"), "page_id", F.coalesce("html", F.lit("")))), path)
    got = sorted(((r["key"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in read_warc(spark, path).collect()), key=repr)
    want = []
    for key, _, html in rows:
        data = (html or "").encode()
        again = html == big and key != 5
        want.append((None if key is None else str(key), "revisit" if again else "response", "5" if again else None, len(data), hashlib.sha1(data).hexdigest()))
    assert got == sorted(want, key=repr)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "warc")
    write_warc(to_warc(mark_repeats(spark.createDataFrame([], KIND), "page_id", F.col("html"))), path)
    assert read_warc(spark, path).count() == 0


def test_heads_with_bare_line_feeds():
    for head in (b"HTTP/1.0 200 OK\nX-Key: 7\nContent-Length: 3\n\n", b"HTTP/1.0 200 OK\r\nX-Key: 7\r\n\r\n", b"HTTP/1.0 200 OK\nX-Key: 7\r\n\n"):
        named, kept, body = http_parts(head + b"a\n\nb")
        assert (named["x-key"], kept, body) == ("7", head, b"a\n\nb")
    assert http_parts(b"HTTP/1.0 200 OK\r\nA: b")[1:] == (b"HTTP/1.0 200 OK\r\nA: b", b"")
    assert http_parts(b"")[1:] == (b"", b"")


@pytest.mark.parametrize("version", [1, 2])
def test_blanks_in_urls_and_lines_set_aside(version):
    data = arc_file([("http://a/b c  d", MESSAGE), ("http://a/z", b"ten  bytes"), ("http://e/", MESSAGE)], version, "20200102030405", "x.arc")
    assert [r.url for r in arc_records(data)][1:] == ["http://a/b c  d", "http://a/z", "http://e/"]
    broken = data.replace(b"http://a/z 0.0.0.0 20200102030405 ", b"http://a/z 0.0.0.0 never ")
    with pytest.raises(ValueError):
        list(arc_records(broken))
    got = list(arc_records(broken, lenient=True))
    assert [bool(r.error) for r in got] == [False, False, True, False] and got[3].url == "http://e/"


def test_delivered_files_become_warc(spark, tmp_path):
    """Plain files, gzip of the whole and gzip of each record; a file that breaks off and one that is none lose only themselves."""
    folder, out = tmp_path / "arc", str(tmp_path / "warc")
    folder.mkdir()
    said = {f"http://a/{i}": b"HTTP/1.1 200 OK\nServer: x\n\n" + bytes([255, i]) * i for i in range(40)}
    items = list(said.items())
    (folder / "one.arc").write_bytes(arc_file(items[:15], 1, "20010203040506", "one.arc"))
    (folder / "two.arc.gz").write_bytes(gzip.compress(arc_file(items[15:30], 2, "2002", "two.arc")))
    whole = arc_file(items[30:], 1, "20030203040506", "three.arc")
    ends = [r.offset for r in arc_records(whole)][1:] + [len(whole)]
    (folder / "three.arc.gz").write_bytes(b"".join(gzip.compress(whole[a:b]) for a, b in zip([0, *ends], ends)))
    (folder / "four.arc").write_bytes(arc_file([("http://b/", MESSAGE), ("http://c/", MESSAGE)], 1, "2004", "four.arc")[:-9])
    (folder / "five.arc.gz").write_bytes(gzip.compress(whole)[:-20])
    (folder / "six.arc").write_bytes(b"")
    (folder / "seven.arc").write_bytes(b"nonsense\n")
    (folder / "note.txt").write_bytes(b"not read")
    records = read_arc(spark, str(folder)).cache()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in records.filter("error is not null").collect()) == ["five.arc.gz", "four.arc", "seven.arc"]
    write_warc(arc_to_warc(records), out)
    got = {r["target_uri"]: (r["record_type"], r["payload_bytes"], r["payload_digest"], r["warc_date"][:4]) for r in read_warc(spark, out).collect()}
    want = {}
    for i, (url, block) in enumerate(items):
        body = block.partition(b"\n\n")[2]
        want[url] = ("response", len(body), hashlib.sha1(body).hexdigest(), "2001" if i < 15 else "2002" if i < 30 else "2003")
    body = MESSAGE.partition(b"\r\n\r\n")[2]
    want["http://b/"] = ("response", len(body), hashlib.sha1(body).hexdigest(), "2004")
    assert got == want
    records.unpersist()
