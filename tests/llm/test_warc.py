import base64
import hashlib

from gleanframe.llm import warc
from gleanframe.llm.tables import stored

PAGES = "page_id bigint, url string, html string, id string, payload string"
LONG = "é<p>" * 5000


def rows():
    return [(4, "http://a/4", "same", "", ""), (2, "http://a/2", "same", "", ""), (3, "http://a/\r\nX: 1", "", "", ""),
            (5, None, None, "", ""), (6, "http://a/6", LONG, "", ""), (1, "http://a/1", LONG, "", ""),
            (None, "http://a/n", "same", "", ""), (7, "http://a/7", "\r\n\r\nWARC/1.1\r\n\r\n", "", "")]


def test_round_trip(table):
    archive = stored(warc.write(warc.records(table(rows(), PAGES, 3)), chunk_bytes=700), "archive")
    assert archive.filter("length(data) > 1200").count() == 0
    got = {r.page_id: r for r in warc.read(archive).collect()}
    assert len(got) == 8 and all(r.intact for r in got.values())
    for page_id, url, html, *_ in rows():
        payload = (html or "").encode()
        assert got[page_id].payload_bytes == len(payload)
        assert got[page_id].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert {n: r.refers_to for n, r in got.items()} == {
        4: 2, 2: None, 3: None, 5: 3, 6: 1, 1: None, None: 2, 7: None}
    assert {n for n, r in got.items() if r.record_type == "revisit"} == {4, 5, 6, None}


def test_short_payloads_are_no_revisits_above_a_length(table):
    out = warc.read(stored(warc.write(warc.records(table(rows(), PAGES), revisit_from=5)), "archive"))
    assert {r.page_id for r in out.collect() if r.record_type == "revisit"} == {6}


def test_damage_shows(table, spark):
    archive = warc.write(warc.records(table(rows()[:1], PAGES)))
    bad = stored(archive.selectExpr(
        "record_id", "chunk_no", "last", "cast(replace(decode(data, 'UTF-8'), 'same', 'some') as binary) as data",
        "running"), "archive")
    assert [r.intact for r in warc.read(bad).collect()] == [False]


def test_exported_files_hold_whole_records(table, tmp_path):
    archive = stored(warc.write(warc.records(table(rows(), PAGES)), chunk_bytes=700), "archive")
    files = warc.export(archive, str(tmp_path), 2).collect()
    found = 0
    for f in files:
        rest = open(f.file, "rb").read()
        assert len(rest) == f.bytes
        while rest:
            head, rest = rest.split(b"\r\n\r\n", 1)
            length = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length:length + 4] == b"\r\n\r\n"
            rest, found = rest[length + 4:], found + 1
    assert found == 8


def test_no_rows(table):
    assert warc.read(stored(warc.write(warc.records(table([], PAGES))), "archive")).collect() == []


def test_long_pages_that_share_an_id(table, tmp_path):
    other, third = "ü<p>" * 6000, "x" * 9000
    pages = [(1, "u", LONG, "", ""), (1, "u", LONG, "", ""), (None, "v", LONG, "", ""), (None, "w", other, "", ""),
             (2, "x", other, "", ""), (2, "y", third, "", ""), (None, "z", "short", "", ""), (None, "z", "short", "", "")]
    archive = stored(warc.write(warc.records(table(pages, PAGES, 3)), chunk_bytes=700), "archive")
    got = warc.read(archive).collect()
    assert all(r.intact for r in got)
    want = [(i, u, len(h.encode()), {"v": 1, "w": 2}.get(u)) for i, u, h, *_ in pages]
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    text = b"".join(open(f.file, "rb").read() for f in warc.export(archive, str(tmp_path), 2).collect())
    assert text.count(LONG.encode()) == 2 and text.count(third.encode()) == 1 and text.count(other.encode()) == 1
