import base64
import hashlib
import zlib

import pytest

from tickerloom.llm import warc
from tickerloom.llm.common import open_file

SCHEMA = "page_id long, url string, html string, key string, first string, path string"

PAGES = [
    (3, "https://www.Example.com/a/b?x=1#top", "<p>one</p>"), (1, "http://example.com:80/", "<p>one</p>"),
    (2, "http://example.com:8080/", "<p>two</p>"), (4, None, None), (5, "not a url", ""),
    (6, "http://[broken", "é漢字\r\n\r\nWARC/1.1"), (7, "http://a.example.com/\nx: y%0A", "x" * 100_000),
    (8, "https://user:pw@b.example.com/p", "<p>one</p>"), (None, "http://example.com/", "<p>one</p>"),
    (2, "http://example.com:8080/", "<p>two</p>"), (9, "http://example.com/", "<p>two</p>"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "f", "p") for r in rows], SCHEMA)


def expected(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        if page_id is not None and len(raw) >= least:
            first[raw] = min(page_id, first.get(raw, page_id))
    for page_id, url, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        to = first.get(raw)
        again = page_id is not None and to is not None and to < page_id
        yield (page_id, url, len(raw), digest, "revisit" if again else "response",
               to if again else None, None if again else raw)


KEY = lambda r: str(r)


@pytest.mark.parametrize("least", [0, 9, 11])
@pytest.mark.parametrize("sizes", [(1 << 27, 3000), (200, 2)])
def test_records_come_back_through_the_index(spark, least, sizes):
    captures = warc.write_archives(
        pages(spark, PAGES).repartition(3), min_revisit=least, file_bytes=sizes[0]
    )
    directory = warc.write_index(captures, block_lines=sizes[1])
    listed = warc.read_captures(directory)
    assert sorted(map(KEY, listed.collect())) == sorted(map(KEY, captures.collect()))
    found = [
        (*r[:6], None if r[6] is None else bytes(r[6])) for r in warc.read_records(listed).collect()
    ]
    assert sorted(found, key=KEY) == sorted(expected(PAGES, least), key=KEY)


def test_blocks_are_sorted_and_looked_up(spark):
    rows = [(i, f"http://h{i % 7}.example.org/p{i % 50}", f"page {i}") for i in range(300)]
    directory = warc.write_index(warc.write_archives(pages(spark, rows).repartition(4)), block_lines=9)
    blocks = directory.orderBy("part", "seq").collect()
    lines = [line for b in blocks for line in warc.read_block(b["path"], b["offset"], b["length"])]
    assert [line[0] for line in lines] == sorted(line[0] for line in lines) and len(lines) == 300
    for b in blocks:
        own = warc.read_block(b["path"], b["offset"], b["length"])
        assert (own[0][0], own[-1][0], len(own)) == (b["first_key"], b["last_key"], b["n_lines"])
    urls = ["http://h3.example.org/p3", "http://h1.example.org/p8", "http://nowhere.org/"]
    found = warc.look_up(directory, urls)
    assert sorted(r["page_id"] for r in found.collect()) == [
        i for i, u, _ in rows if u in urls
    ]
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read_records(found).collect()}
    assert payloads and all(raw == f"page {i}".encode() for i, raw in payloads.items())
    assert warc.look_up(directory, []).count() == 0


def test_archives_are_plain_warc_files(spark):
    captures = warc.write_archives(pages(spark, PAGES[:3]).coalesce(1)).collect()
    with open_file(captures[0]["path"]) as source:
        data = source.read()
    members = []
    while data:
        undo = zlib.decompressobj(47)
        members.append(undo.decompress(data))
        data = undo.unused_data
    assert len(members) == 3 and all(m.startswith(b"WARC/1.1\r\n") for m in members)
    assert all(m.endswith(b"\r\n\r\n") for m in members)


def test_damage_is_noticed():
    record = warc.warc_record(1, "http://a/", b"payload", warc.base32_sha1(b"payload"), None)
    assert warc.parse_record(warc._gzip(record))["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(warc._gzip(record.replace(b"payload\r\n", b"pAyload\r\n")))


@pytest.mark.parametrize(("url", "key"), [
    ("https://www.Example.com/a/B?x=1#top", "com,example,www)/a/B?x=1"),
    ("http://example.com:80", "com,example)/"), ("http://example.com:8080/", "com,example:8080)/"),
    ("https://u:p@example.com/x", "com,example)/x"), (None, ""), ("", ""), ("no url", "no url"),
    ("http://[broken", "http://[broken"), ("http://x:99999/", "http://x:99999/"),
])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_an_empty_table_writes_nothing(spark):
    captures = warc.write_archives(pages(spark, []))
    directory = warc.write_index(captures)
    assert captures.count() == directory.count() == 0
    assert warc.read_records(warc.read_captures(directory)).count() == 0
    assert warc.look_up(directory, ["http://a/"]).count() == 0
