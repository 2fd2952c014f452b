"""WARC archives: write pages with de-duplicated payloads, read them back
into a globally ordered capture index.

Writing. A capture is a page row. Captures with equal payloads of at least
``LEAST`` bytes meet by digest; the one with the smallest page_id becomes a
``response`` record, the others are ``revisit`` records that refer to it and
hold the response's HTTP header alone (whose Content-Length tells the
payload's size). Records are lines of Spark's text writer with CR LF CR LF as
the line end, which is how WARC ends a record, so archives can lie in any
store Spark writes; every archive is one gzip stream of about
``ARCHIVE_BYTES`` of text.

Reading. An archive is parsed record by record by Content-Length; payloads
are hashed again and compared with the declared digest. The captures of an
archive, sorted by URL key, time, page_id and row, are a run. The runs of a
task are merged by a loser tree and written (external runs); range
partitions of about ``RANGE_ROWS`` captures then take their share of every
run and merge the k shares by a loser tree again. ``range`` and ``nth`` order
all captures, hence each URL key's history. The bounds lie between single
captures, so a URL key that many captures bear is spread over ranges.

Cases: null html is an empty payload; a null url has no WARC-Target-URI and
the empty URL key; a null page_id comes after all others; of rows that share
the smallest page_id of a payload one is the response; line ends in a url are
written as %0D and %0A; an empty table gives no rows; other columns are not
read. WARC-Date is page_id seconds after ``EPOCH`` (modulo 10^9) unless a
column with date texts is named.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import _LEFT, checkpoint_dir, drop, join_spread, scratch

LEAST = 100
ARCHIVE_BYTES = 64 << 20
RANGE_ROWS = 1 << 18
EPOCH = "2020-01-01"
#: Fixed by the WARC format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"

CAPTURE = ("urlkey string, ts string, page_id long, row long, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long")


# -------------------------------------------------------------------- writing

def _date(page_id: Column) -> Column:
    s = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(s / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(F.floor(s % 86400 / 3600)), F.lit(":"), two(F.floor(s % 3600 / 60)), F.lit(":"),
                    two(s % 60), F.lit("Z"))


def _urn(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:capture:"), F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(":"),
                    row.cast("string"), F.lit(">"))


def captures(pages: DataFrame, date: str | None = None) -> DataFrame:
    """row, page_id, url, date, payload, bytes, digest; a scratch table, so
    that a row keeps its number."""
    payload = F.coalesce("html", F.lit(""))
    return scratch(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), "url",
        (F.col(date) if date else _date(F.col("page_id"))).alias("date"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha2(payload, 256).alias("digest")), "captures", "zstd")


def revisits(found: DataFrame, least: int = LEAST) -> DataFrame:
    """row, lead_page, lead_row of the captures that revisit another one; a
    scratch table."""
    rows = found.where(F.col("bytes") >= least).select("row", "digest")
    lead = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("lead")
    groups = scratch(found.where(F.col("bytes") >= least).groupBy("digest").agg(lead, F.count(F.lit(1)).alias("copies"))
                     .where("copies > 1"), "copies")
    out = scratch(join_spread(rows, groups, "digest", "copies").where("row <> lead.row").select(
        "row", F.col("lead.page_id").alias("lead_page"), F.col("lead.row").alias("lead_row")), "revisits")
    drop(groups)
    return out


def records(found: DataFrame, again: DataFrame) -> DataFrame:
    """``value``: the text of a record without its closing line ends."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    head = text(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: ",
                F.col("bytes").cast("string"), END + END)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    is_again = F.col("lead_row").isNotNull()
    block = F.when(is_again, head).otherwise(F.concat(head, F.col("payload")))
    both = found.join(again.hint("shuffle_hash"), "row", "left").withColumn("block", block)
    return both.select(text(
        f"{VERSION}{END}WARC-Type: ", F.when(is_again, "revisit").otherwise("response"),
        f"{END}WARC-Record-ID: ", _urn(F.col("page_id"), F.col("row")), f"{END}WARC-Date: ", F.col("date"),
        F.coalesce(text(f"{END}WARC-Target-URI: ", url), F.lit("")),
        f"{END}WARC-Payload-Digest: sha256:", F.col("digest"),
        F.when(is_again, text(f"{END}WARC-Refers-To: ", _urn(F.col("lead_page"), F.col("lead_row")),
                              f"{END}WARC-Profile: {PROFILE}")).otherwise(""),
        f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: ",
        F.octet_length("block").cast("string"), END + END, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of all rows of ``pages`` in the folder ``path``."""
    found = captures(pages, date)
    again = revisits(found)
    n, size = found.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    each = max(1, archive_bytes // (max(size or 0, 1) // max(n, 1) + 600))
    (records(found, again).write.option("lineSep", END + END).option("compression", "gzip")
     .option("maxRecordsPerFile", int(each)).text(path))
    drop(found, again)


# -------------------------------------------------------------------- reading

def url_key(url: str | None) -> str:
    """Host labels turned round, then path and query: captures of a site and
    of a page are neighbours."""
    if not url:
        return ""
    from urllib.parse import urlsplit
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    at = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{at}){parts.path or '/'}{query}"


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        while not line.endswith(b"\r\n"):  # a bare line feed is part of a value
            line += (more := stream.readline())
            if not more:
                raise ValueError("archive ends inside a header")
        name, _, value = line[:-2].decode().partition(": ")
        found[name] = value
    return found


def _page(urn: str) -> tuple[int | None, int]:
    page, row = urn.removeprefix("<urn:capture:").removesuffix(">").split(":")
    return (None if page == "-" else int(page)), int(row)


def read_records(content: bytes):
    """(headers, block) of each record of a gzip archive."""
    with io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20) as stream:
        while line := stream.readline():
            if line != f"{VERSION}{END}".encode():
                raise ValueError(f"not the start of a record: {line[:40]!r}")
            head = _headers(stream)
            size = int(head["Content-Length"])
            block = stream.read(size)
            if len(block) != size or stream.read(4) != b"\r\n\r\n":
                raise ValueError("archive ends inside a record")
            yield head, block


def capture(head: dict[str, str], block: bytes) -> tuple:
    """A row of the capture index."""
    at = block.index(b"\r\n\r\n") + 4
    http = _headers(io.BytesIO(block[block.index(b"\r\n") + 2:at]))
    kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
    if kind == "response" and (len(block) - at != size or hashlib.sha256(block[at:]).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    page, row = _page(head["WARC-Record-ID"])
    refers = _page(head["WARC-Refers-To"])[0] if kind == "revisit" else None
    ts = "".join(c for c in head["WARC-Date"] if c.isdigit())
    return url_key(head.get("WARC-Target-URI")), ts, page, row, kind, size, digest, refers


def order_key(row) -> tuple:
    return row[0], row[1], row[2] is None, row[2] or 0, row[3]


class LoserTree:
    """Merges sorted runs: a node keeps the loser of its match, so when the
    winner's run moves on, only the path to the root is played again."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(self.k, 1)
        self.winner = self._build(1) if self.k else -1

    def _head(self, r: int):
        run, i = self.runs[r], self.at[r]
        return (0, run[i], r) if i < len(run) else (1, (), r)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self._head(b) < self._head(a):
            a, b = b, a
        self.losers[node] = b
        return a

    def blocks(self):
        """(run, from, to) in merged order: as much of the winner's run as
        comes before the best of the losers on its path."""
        while self.k and self._head(self.winner)[0] == 0:
            w = self.winner
            node, rest = (w + self.k) // 2, []
            while node:
                rest.append(self._head(self.losers[node]))
                node //= 2
            run, lo = self.runs[w], self.at[w]
            _, bar, other = min(rest, default=(1, (), w))
            hi = len(run) if not bar else max(lo + 1, bisect_left(run, bar, lo))
            self.at[w] = hi
            yield w, lo, hi
            node, best = (w + self.k) // 2, w
            while node:
                if self._head(self.losers[node]) < self._head(best):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def merge(runs: list[list], key=order_key) -> list:
    """The rows of sorted runs in one order."""
    keys = [[key(r) for r in run] for run in runs]
    return [row for r, lo, hi in LoserTree(keys).blocks() for row in runs[r][lo:hi]]


def _batches(rows, extra=()):
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [f.split()[0] for f in CAPTURE.split(", ")]
    for lo in range(0, len(rows), 10_000):
        part = rows[lo:lo + 10_000]
        cols = [pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)]
        more = [pa.array(f(range(lo, lo + len(part))), t) for _, t, f in extra]
        yield pa.record_batch(cols + more, names + [n for n, _, _ in extra])


def _run_pass(batches):
    """The captures of a task's archives, merged to one sorted run."""
    from pyspark import TaskContext
    runs = []
    for batch in batches:
        for content in batch.column(0):
            runs.append(sorted((capture(*r) for r in read_records(content.as_py())), key=order_key))
    run = TaskContext.get().partitionId()
    yield from _batches(merge(runs), [("run", pa.int64(), lambda at: [run] * len(at)), ("seq", pa.int64(), list)])


def _merge_pass(batches):
    """The shares of all runs that fell into a range, merged."""
    from pyspark import TaskContext
    runs = {}
    for batch in batches:
        *cols, run, seq = (c.to_pylist() for c in batch.columns)
        for r, s, row in zip(run, seq, zip(*cols, strict=True), strict=True):
            runs.setdefault(r, []).append((s, row))
    shares = []
    for share in runs.values():
        if any(a[0] > b[0] for a, b in zip(share, share[1:], strict=False)):
            share.sort()  # a shuffle keeps a run's order, but doesn't promise it
        shares.append([row for _, row in share])
    at = TaskContext.get().partitionId()
    yield from _batches(merge(shares), [("range", pa.int32(), lambda x: [at] * len(x)), ("nth", pa.int64(), list)])


def capture_index(spark, path: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of the archives in ``path``: the columns of ``CAPTURE``
    with range and nth, which order them by URL key and time."""
    content = spark.read.format("binaryFile").load(path).select("content")
    runs = scratch(content.mapInArrow(_run_pass, f"{CAPTURE}, run long, seq long"), "runs")
    n = max(1, -(-runs.count() // range_rows))
    spread = runs.repartitionByRange(n, "urlkey", "ts", F.col("page_id").asc_nulls_last(), "row")
    out = scratch(spread.mapInArrow(_merge_pass, f"{CAPTURE}, range int, nth long"), "histories")
    drop(runs)
    return out


def archive_and_read(pages: DataFrame, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
                     range_rows: int = RANGE_ROWS) -> DataFrame:
    """The capture index of archives written from ``pages``."""
    spark = pages.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"
    _LEFT.append(path)
    write_archives(pages, path, date, archive_bytes)
    out = capture_index(spark, path, range_rows)
    archives = spark.range(0)
    archives._scratch_path = path
    drop(archives)
    return out


def digest(index: DataFrame) -> DataFrame:
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha256(t) AS payload_digest FROM p),
r AS (SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS lead FROM d
  WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST} AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND nth > 1 THEN lead END AS refers_to
FROM r
"""
