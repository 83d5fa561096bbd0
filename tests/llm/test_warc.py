import gzip
import hashlib

import pytest

from leadpipe.llm import warc

V1 = "1 0 origin\nURL IP-address Archive-date Content-type Archive-length\n"
V2 = (
    "2 0 origin\n"
    "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
)
HTTP = b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\n"


def block(version):
    text = {1: V1, 2: V2}[version]
    more = {1: "", 2: " 200 - - 0 f.arc"}[version]
    return f"filedesc://f.arc 0.0.0.0 20040102030405 text/plain{more} {len(text)}\n{text}\n".encode()


def record(version, url, document, date="20040102030405"):
    more = {1: "", 2: " 200 sum - 17 f.arc"}[version]
    return f"{url} 1.2.3.4 {date} text/html{more} {len(document)}\n".encode() + document + b"\n"


@pytest.mark.parametrize("version", [1, 2])
def test_records_are_cut_by_their_declared_lengths(version):
    documents = [HTTP + b"a\n\nWARC/1.0\r\n\r\nhttp://x 1 2 3 4\n", b"", b"\x00\xff\n" * 9, HTTP]
    content = block(version) + b"".join(record(version, f"http://h/{i}", d) for i, d in enumerate(documents))
    for data in (content, gzip.compress(content), gzip.compress(content[:50]) + gzip.compress(content[50:])):
        found = list(warc.arc_records(data))
        assert [d for _, d in found][1:] == documents
        assert found[1][0]["URL"] == "http://h/0" and found[1][0]["IP-address"] == "1.2.3.4"
    if version == 2:
        assert found[1][0]["Checksum"] == "sum"


def test_dates():
    assert warc.timestamp("20040102030405") == "2004-01-02T03:04:05Z"
    assert warc.timestamp("200411") == "2004-11-01T00:00:00Z"
    assert warc.timestamp("then") == "1970-01-01T00:00:00Z"


def files(spark, frame, contents):
    return frame([(f"{i}.arc", bytearray(c)) for i, c in enumerate(contents)], "archive string, content binary")


def test_what_is_no_record_ends_its_file_with_an_error(spark, frame):
    good = block(1) + record(1, "http://h/", HTTP + b"x")
    broken = [good + b"no header\n", good[:-4], b"junk\n", good + b"u 1.2.3.4 2004 t 99\nshort", b"", b"\x1f\x8bnot gzip"]
    rows = warc.index(files(spark, frame, [good, *broken])).collect()
    errors = {r.archive for r in rows if r.error}
    assert errors == {"1.arc", "2.arc", "3.arc", "4.arc", "6.arc"}
    assert sum(r.error is None for r in rows) == 3
    assert [len(list(warc._converted("a", c, None))) for c in [good, *broken]] == [2, 2, 1, 0, 2, 0, 0]


def test_conversion_of_foreign_archives(spark, tmp_path):
    body = b"y" * 150
    first = [("http://a/", HTTP + body), ("dns:a", b"a 1.2.3.4"), ("http://b/", b"HTTP/1.0 200 OK\r\n\r\n" + body)]
    second = [("http://c/x y", HTTP.replace(b"5", b"-3") + body), ("ftp://d", b"\xff\xfe" * 80), ("ftp://e", b"\xff\xfe" * 80)]
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.arc").write_bytes(block(1) + b"".join(record(1, u, d) for u, d in first))
    (source / "two.arc.gz").write_bytes(gzip.compress(block(2) + b"".join(record(2, u, d, "2005") for u, d in second)))
    target = f"{tmp_path}/out"
    listed = warc.convert(spark, str(source), target).collect()
    assert len(listed) == 6 and not any(r.error for r in listed)
    rows = {r.url: r for r in warc.resolve(warc.read_warc(spark, target)).collect()}
    kinds = {u: r.record_type for u, r in rows.items()}
    assert kinds == {
        "http://a/": "revisit", "dns:a": "resource", "http://b/": "revisit", "http://c/x y": "response",
        "ftp://d": "resource", "ftp://e": "revisit",
    }
    assert {r.digest for u, r in rows.items() if u.startswith("http")} == {hashlib.sha256(body).hexdigest()}
    assert rows["http://a/"].refers_to == rows["http://c/x y"].record_id
    assert rows["http://c/x y"].date == "2005-01-01T00:00:00Z"
    assert rows["ftp://e"].payload_bytes == 160 and rows["ftp://e"].stated_digest == rows["ftp://d"].digest
    assert len({r.record_id for r in rows.values()}) == 6
    again = f"{tmp_path}/again"
    warc.convert(spark, str(source), again)
    assert {r.record_id for r in warc.read_warc(spark, again).collect()} == {r.record_id for r in rows.values()}


def test_warc_blocks_and_digests(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "f.arc").write_bytes(block(1) + record(1, "http://a/", HTTP + b"body"))
    warc.convert(spark, str(source), f"{tmp_path}/out")
    (part,) = [p for p in (tmp_path / "out").glob("part-*") if warc.opened(p.read_bytes()).read(1)]
    data = warc.opened(part.read_bytes()).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"body\r\n\r\n")
    (_, (header, found)) = warc.warc_records(part.read_bytes())
    assert found == HTTP + b"body"
    assert header["warc-block-digest"] == "sha256:" + hashlib.sha256(found).hexdigest()
    assert header["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"body").hexdigest()
    assert header["warc-ip-address"] == "1.2.3.4"


def by_hand(pages):
    bodies = {i: (h or "").encode() for i, h in pages}
    least = {}
    for i, b in bodies.items():
        least[b] = min(i, least.get(b, i))
    return {
        i: (len(b), hashlib.sha256(b).hexdigest(), *(("response", None) if len(b) < 100 or least[b] == i else ("revisit", least[b])))
        for i, b in bodies.items()
    }


def test_pages_round_trip(frame, monkeypatch):
    monkeypatch.setattr(warc.write_arc, "__defaults__", ("20170331000000", 7))  # many small files of both versions
    big, long = "é" * 50, "<p>\r\n\r\nWARC/1.0\n\n</p>" * 20_000
    bodies = [None, "", "short", "short", big, big, big[:-1], long, long, "\n\r\n\x00é\U0001f600" * 30]
    pages = [(i * 3 % 50, bodies[i % len(bodies)]) for i in range(50)]
    rows = warc.pages_as_warc(frame([(i, f"http://h/{i} x", h, 1) for i, h in pages], "page_id long, url string, html string, digest int")).collect()
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows}
    assert len(rows) == 50 and found == by_hand(pages)


def test_nulls_repeated_rows_and_no_rows(frame):
    body = "z" * 120
    pages = frame([(None, None, body), (4, None, body), (4, None, body), (None, "u", None)], "page_id long, url string, html string")
    rows = warc.pages_as_warc(pages).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes) == [
        (0, "revisit", 4), (4, "response", None), (4, "revisit", 4),
    ]
    assert [r.payload_bytes for r in rows].count(0) == 1
    assert warc.pages_as_warc(pages.limit(0)).count() == 0


def test_a_large_group_of_equal_pages(frame):
    pages = [(i, "<html>" + "same " * 40 if i % 3 else f"own {i} " * 30) for i in range(900)]
    rows = warc.pages_as_warc(frame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows} == by_hand(pages)


