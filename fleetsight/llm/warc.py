"""WARC archives of pages, and a capture index merged from locally sorted runs.

Writing: each page becomes a record. Of records with equal payloads of a least size the one with
the smallest id is a ``response``; the others are ``revisit`` records without payload that name it.
Records are WARC/1.1 text, so Spark's text sink writes them (a blank line ends each record) to any
file system, with its commit protocol, as gzip files of bounded size.

Reading: files are read whole, and records are taken by their Content-Length, so payloads may hold
anything, blank lines and header lines included.

Index: each archive file gives one run of captures, sorted by URL key and timestamp. Ranges of the
key order are cut evenly over (key, timestamp, id), so a URL with very many captures spreads over
ranges. Each range merges its slices of all runs with a loser tree; ranges in order are the global order.

Defined cases: null html is an empty payload; a null url gives an empty URL key; a null id is kept
(it never is the smallest); repeated rows are records of their own, so rows that repeat the original
are responses as it is; an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import gzip
import itertools
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.llm.common import staged

MIN_PAYLOAD = 100
FILE_BYTES = 16 << 20
RANGE_CAPTURES = 20_000  # captures that one merge task holds
CRLF = "\r\n"


def capture_time(id_col: str) -> Column:
    """Pages carry no time of capture: one second for each id from 2020 on (null: the start)."""
    return F.timestamp_seconds(F.lit(1_577_836_800) + F.coalesce(F.col(id_col).cast("long"), F.lit(0)))


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", captured: Column | None = None
) -> DataFrame:
    """A WARC record for each page: page_id, payload_bytes, record (headers and payload).

    Digests decide the originals: one small row for each page goes through the count by digest,
    and only digests that occur more than once come back to the pages.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("body"),
        F.date_format(captured if captured is not None else capture_time(id_col), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    large = F.col("payload_bytes") >= MIN_PAYLOAD
    seen = source.filter(large).groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
    shared = seen.filter("n > 1").select(F.col("digest").alias("d"), "original")
    joined = source.join(shared, source["digest"] == shared["d"], "left")
    # a null id among copies refers to the original; the original itself is the row with the smallest id
    copy = large & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    # white space and control characters would break the header line
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    body = F.when(copy, F.lit("")).otherwise(F.col("body"))
    refers = F.when(copy, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("original").cast("string"), F.lit(">"))))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(copy, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.coalesce(refers, F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF),
    )
    return joined.select("page_id", "payload_bytes", F.concat(header, body).alias("record"))


def write_archive(pages: DataFrame, path: str, **columns) -> None:
    """Write the records as gzip files whose records have about FILE_BYTES of payload, by the mean page."""
    body = F.octet_length(F.col(columns.get("html_col", "html")).cast("string"))
    total = pages.agg(F.count("*").alias("n"), F.sum(body).alias("bytes")).first()
    rows = max(1, int(FILE_BYTES * total.n / max(total.bytes or 0, 1)))
    made = records(pages, **columns).select("record")
    made.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", rows).text(path)


_CAPTURE = "file string, offset long, url_key string, timestamp string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
_NAMES = [c.split()[0] for c in _CAPTURE.split(", ")]
_TYPES = [{"string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in _CAPTURE.split(", ")]


def url_key(url: str) -> str:
    """Host labels in reverse order, then path and query, so that a site's captures are neighbours."""
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return f"){url.lower()}"
    labels = ",".join(reversed(host.lower().removeprefix("www.").split(".")))
    return f"{labels}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def parse_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, payload) of each record; a damaged archive raises."""
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        head = content[at:end].decode().split(CRLF)
        if end < 0 or not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in head[1:])}
        begin = end + 4
        stop = begin + int(headers["content-length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut short")
        yield at, headers, content[begin:stop]
        at = stop + 4


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Read the archive back: one row for each record, by file; payloads are checked against their digests."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                content = gzip.decompress(row["content"]) if row["path"].endswith(".gz") else row["content"]
                found = []
                for offset, head, payload in parse_records(content):
                    digest = head["warc-payload-digest"].removeprefix("sha256:")
                    size = int(head["x-payload-length"])
                    if head["warc-type"] == "response":
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{row['path']}: the payload at {offset} doesn't match its digest")
                    stamp = re.sub(r"\D", "", head["warc-date"])
                    found.append((row["path"], offset, url_key(head["warc-target-uri"]), stamp, _number(head["warc-record-id"]),
                                  head["warc-type"], _number(head.get("warc-refers-to")), size, digest))
                if found:
                    found.sort(key=_order)  # the file's run
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, _CAPTURE)


def _order(row: tuple) -> tuple:
    return row[2], row[3], row[4] is not None, row[4] or 0, row[0], row[1]


def merge_runs(runs: list[list[tuple]], key=_order) -> Iterator[tuple]:
    """Merge sorted runs by a loser tree: each inner node holds the run that lost there.

    Taking the winner's next row replays one path from its leaf to the root, log2(k) comparisons.
    """
    k = len(runs)
    if k == 0:
        return
    cursors = [iter(r) for r in runs]
    heads = [next(c, None) for c in cursors]
    keys = [None if h is None else key(h) for h in heads]

    def beats(a: int, b: int) -> bool:  # an exhausted run loses; ties go to the lower run
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    losers = [-1] * k
    winner = [0] * (2 * k)
    winner[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winner[1] if k > 1 else 0
    while keys[best] is not None:
        yield heads[best]
        heads[best] = next(cursors[best], None)
        keys[best] = None if heads[best] is None else key(heads[best])
        node = (best + k) // 2
        while node >= 1:
            if beats(losers[node], best):
                losers[node], best = best, losers[node]
            node //= 2


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The archive's captures as runs in the shared folder, one for each file."""
    return staged(captures(spark, path), "runs")


def merged_index(runs: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """Captures in global order of (url_key, timestamp, page_id): ``range``, then ``rank`` in it.

    A range holds about ``range_captures`` captures; it takes its slices of the runs, sorted by
    run, and merges them.
    """
    ranges = max(1, -(-runs.count() // range_captures))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [tuple(r.values()) for b in batches for r in b.select(_NAMES).to_pylist()]
        slices = [list(g) for _, g in itertools.groupby(rows, key=lambda r: r[0])]
        merged = list(merge_runs(slices))
        if merged:
            columns = [pa.array(c, t) for c, t in zip(zip(*merged, strict=True), _TYPES, strict=True)]
            part = pa.array([TaskContext.get().partitionId()] * len(merged), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, part, pa.array(range(len(merged)), pa.int64())], [*_NAMES, "range", "rank"])

    ordered = runs.repartitionByRange(ranges, "url_key", "timestamp", F.col("page_id").asc_nulls_first(), "file", "offset")
    # by file: each run's slice is whole and in its own order
    sliced = ordered.sortWithinPartitions("file", "url_key", "timestamp", F.col("page_id").asc_nulls_first(), "offset")
    return sliced.mapInArrow(run, _CAPTURE + ", range long, rank long")


def timestamp_of(capture: str) -> datetime:
    """The time of a 14-digit timestamp of the index."""
    return datetime.strptime(capture, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
