"""Archives: exact round trip, revisits, a global order."""

import gzip
import hashlib
import random
from collections import Counter

import pytest

from meteora.llm import warc

LONG = "x" * 60 + "é" * 30
PAGES = [(5, "http://www.b.example.com/x?q=1", LONG), (2, "http://b.example.com/x?q=1", LONG), (9, None, LONG),
         (3, "https://a.example.org:8080", "y" * 99), (4, "https://a.example.org:8080", "y" * 99),
         (6, "http://[bad", None), (7, "line\r\nend\nWARC/1.1", ""), (8, "mailto:x", "WARC/1.1\r\n\r\n" * 20),
         (None, "http://c.example/", LONG), (2, "http://b.example.com/x?q=1", LONG), (-1, "", "\r\n\r\n" * 40),
         (1 << 62, "http://日本.example/ü", "z" * 5000), (10, "http://c.example/", "z" * 5000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS row", "2 AS digest", "3 AS bytes", "'x' AS date", "4 AS payload", "5 AS lead_row")


def expected(rows):
    out, groups = [], {}
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        if len(data) >= 100:
            groups.setdefault(data, []).append((page is None, page or 0, i))
    for i, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        lead = min(groups.get(data, [(page is None, page or 0, i)]))[2]
        same = lead == i
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if same else "revisit",
                    None if same else rows[lead][0]))
    return Counter(out)


@pytest.mark.parametrize("archive,each", [(1 << 26, 1 << 18), (1, 3), (2000, 1)])
def test_archives_round_trip(spark, archive, each):
    index = warc.archive_and_read(frame(spark, PAGES), None, archive, each)
    got = Counter(tuple(r) for r in warc.digest(index).collect())
    assert got == expected(PAGES)
    rows = index.orderBy("range", "nth").collect()
    keys = [(r.urlkey, r.ts, r.page_id is None, r.page_id or 0, r.row) for r in rows]
    assert keys == sorted(keys) and Counter(k[0] for k in keys) == Counter(warc.url_key(
        u and u.replace("\r", "%0D").replace("\n", "%0A")) for _, u, _ in PAGES)


def test_empty_table_and_named_dates(spark):
    assert warc.archive_and_read(frame(spark, [])).count() == 0
    index = warc.archive_and_read(frame(spark, PAGES[:3]).selectExpr("*", "'2001-02-03T04:05:06Z' AS day"), "day")
    assert {r.ts for r in index.collect()} == {"20010203040506"}


def test_a_copied_payload_of_a_third_of_the_rows(spark):
    rows = [(i, f"http://h{i % 5}.example/", "same " * 40 if i % 3 else f"{i} " * 60) for i in range(600)]
    got = warc.digest(warc.archive_and_read(frame(spark, rows), None, 20_000, 50)).collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_url_keys():
    assert warc.url_key("https://u@WWW.Site.example.com:443/A?b=1#c") == "com,example,site)/A?b=1"
    assert warc.url_key("http://site.example:81") == "example,site:81)/"
    assert [warc.url_key(x) for x in (None, "", "No Address", "http://[x")] == ["", "", "no address", "http://[x"]


def test_damaged_archives_are_refused():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:capture:1:0>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
            f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'abc').hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n")
    whole = head.encode() + block + b"\r\n\r\n"
    (record,) = warc.read_records(gzip.compress(whole))
    assert warc.capture(*record)[4:7] == ("response", 3, hashlib.sha256(b"abc").hexdigest())
    for bad in (whole[:-6], whole[1:], whole[:60]):
        with pytest.raises(ValueError):
            list(warc.read_records(gzip.compress(bad)))
    with pytest.raises(ValueError):
        warc.capture(record[0], block[:-1] + b"x")


def test_loser_tree_merges_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted((rng.randrange(50), r, i) for i in range(rng.choice([0, 1, 30]))) for r in range(k)]
        assert warc.merge(runs, key=lambda x: x) == sorted(x for run in runs for x in run)
    equal = [[(1,)] * 5, [(1,)] * 3, [(0,), (1,)]]
    assert warc.merge(equal, key=lambda x: x) == [(0,)] + [(1,)] * 9
