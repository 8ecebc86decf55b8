"""WARC archives and their index, merged from sorted runs.

Writing: every page becomes one WARC record. Of pages with equal payloads the one with the largest id is the
response, the others are revisits that point to it. A record ends with two line breaks, which is the line separator
under which Spark's text writer sets record behind record; files are compressed as a whole.

Reading: each archive is parsed record by record, payloads are digested again and held against what the record
declares. The captures of an archive, sorted by URL key, time and id, are a run.

Index: runs are dealt to ranges of the same order, and each range merges its part of all runs with a loser tree.
Ranges in order are one globally ordered index, in which the captures of a URL stand together by time. A URL with very
many captures spans ranges, as the order goes on with time and id.

Defined results: a NULL html is an empty payload, a NULL url an empty key. Pages without an id keep none; a revisit
of such pages points nowhere if no page of the group has an id. Repeated rows are captures of their own, of one type.
Times come from a column if there is one, else from the page id: its remainder modulo `SPAN` in seconds from `EPOCH`, so
that ids of any size and sign give times with a year of four digits, which sort as text.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

EPOCH = "2024-01-01T00:00:00Z"
SPAN = 1 << 37
RECORDS_PER_FILE = 1000
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The digits of base 32 as SQL's conv writes them, and as RFC 4648 does.
CONV32, RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURE = "page_id bigint, url string, url_key string, captured string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, file string, offset bigint"
ORDER = ("url_key", "captured", "page_id")


def base32_sha1(binary: Column) -> Column:
    """Upper-case base 32 of the SHA-1: five hex digits are four digits to base 32."""
    digits = F.sha1(binary)
    parts = [F.lpad(F.upper(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32)), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, RFC32)


def url_key(url: Column) -> Column:
    """Host from its last label to its first, then path and query, in lower case, without fragment."""
    plain = F.lower(F.coalesce(url.cast("string"), F.lit("")))
    host = F.regexp_replace(F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), r"^www\d*\.", "")
    rest = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))


def typed(pages: DataFrame, scratch: common.Scratch) -> DataFrame:
    """Pages with digest, size, record type and the page that a revisit refers to."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    named = named.withColumns({"digest": base32_sha1(F.col("body")), "payload_bytes": F.octet_length("body").cast("bigint")})
    groups = named.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only payloads that repeat; Spark sees the size of the stored table and moves no page if it is small.
    groups = scratch.store(groups.select(F.col("digest").alias("again"), "first"), "groups")
    joined = named.join(groups, F.col("digest") == F.col("again"), "left")
    revisit = F.col("again").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumns({"revisit": revisit, "refers_to": F.when(revisit, F.col("first"))}).drop("again", "first")


def record(typed_pages: DataFrame, time: Column | None = None) -> DataFrame:
    """The text of each record, without the line breaks at its end."""
    seconds = F.unix_timestamp(F.to_timestamp(F.lit(EPOCH))) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(SPAN))
    at = time if time is not None else F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    uri = F.replace(F.replace(text("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), text("payload_bytes"), F.lit(END))
    block = F.when(F.col("revisit"), F.lit("")).otherwise(F.concat(http, F.col("body").cast("string")))
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    refers = F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), text("refers_to"), F.lit(">"))))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), text("page_id"), F.lit(">"))),
        line("WARC-Target-URI", uri),
        line("WARC-Date", at),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", text("payload_bytes")),
        line("X-URL-Key", F.regexp_replace(url_key(F.col("url")), r"[\r\n]", "")),
        F.when(F.col("revisit"), refers).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return typed_pages.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, scratch: common.Scratch) -> None:
    writer = record(typed(pages, scratch)).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _id(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parsed(name: str, content: bytes) -> Iterator[tuple]:
    """CAPTURE tuples of an archive, in its order; raises ValueError where a payload is not what its record says."""
    offset = 0
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as f:
        while first := f.readline():
            if first != b"WARC/1.1\r\n":
                raise ValueError(f"{name}: no record at {offset}")
            size, fields = len(first), {}
            while (line := f.readline()) != b"\r\n":
                size += len(line)
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                fields[key] = value
            block = f.read(int(fields["Content-Length"]))
            if f.read(4) != END.encode():
                raise ValueError(f"{name}: record at {offset} has no end")
            declared, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
            if fields["WARC-Type"] == "response":
                payload = block[block.index(END.encode()) + 4 :]
                if len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != declared:
                    raise ValueError(f"{name}: payload of record at {offset} was changed")
            refers = fields.get("WARC-Refers-To")
            yield (
                _id(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["X-URL-Key"], fields["WARC-Date"], fields["WARC-Type"],
                _id(refers) if refers else None, length, declared, name, offset,
            )
            offset += size + 2 + len(block) + 4


def _key(row: tuple) -> tuple:
    """URL key, time, id; captures without an id come first."""
    return row[2], row[3], row[0] is not None, row[0] or 0, row[8], row[9]


SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("url_key", pa.string()), ("captured", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
])


def _batch(rows: list[tuple], extra: pa.Array | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(SCHEMA)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, extra] if extra is not None else arrays, names=[*SCHEMA.names, *(["place"] if extra is not None else [])])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):  # one archive at a time
            rows = sorted(parsed(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()), key=_key)
            yield _batch(rows, pa.array(range(len(rows)), pa.int64()))


def sorted_runs(spark: SparkSession, path: str) -> DataFrame:
    """CAPTURE rows of all archives, with the place in the run of their archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_runs, CAPTURE + ", place bigint")


class LoserTree:
    """Merges sorted iterators: inner nodes keep the loser of their match, so a step replays one path to the root."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _next(self, i: int) -> tuple | None:
        row = next(self.runs[i], None)
        return None if row is None else (_key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        if a == -1 or b == -1:  # a place not yet filled wins, so that every first entry settles somewhere
            return a == -1
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[0] < y[0])

    def _replay(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node:
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (i := self.losers[0]) >= 0 and self.heads[i] is not None:
            yield self.heads[i][1]
            self.heads[i] = self._next(i)
            self._replay(i)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: its rows come run by run, each in the order of its run."""
    runs: dict[str, list[pa.RecordBatch]] = {}
    for batch in batches:
        files = batch.column(8).to_pylist()
        start = 0
        for end in range(1, len(files) + 1):
            if end == len(files) or files[end] != files[start]:
                runs.setdefault(files[start], []).append(batch.slice(start, end - start))
                start = end

    def rows(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for s in range(0, len(part), 512):
                yield from zip(*(c.to_pylist() for c in part.slice(s, 512).columns[: len(SCHEMA)]), strict=True)

    out: list[tuple] = []
    for row in LoserTree([rows(p) for p in runs.values()]):
        out.append(row)
        if len(out) == 4096:
            yield _batch(out)
            out = []
    yield _batch(out)


def merge_runs(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The index: CAPTURE rows, ordered by URL key, time and id within each partition and from one to the next.

    `runs` is read twice, for the bounds of the ranges and for the rows, so it should be a stored table.
    """
    dealt = runs.repartitionByRange(ranges or common.slices(runs.sparkSession), *ORDER)
    return dealt.sortWithinPartitions("file", "place").mapInArrow(_merged, CAPTURE)


def archive(pages: DataFrame) -> DataFrame:
    """Write, read back and index the pages."""
    scratch = common.Scratch(pages.sparkSession, "capture-index")
    write_archives(pages, scratch.path("warc"), scratch)
    runs = scratch.store(sorted_runs(pages.sparkSession, scratch.path("warc")), "runs")
    return merge_runs(runs)


def op9_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive(common.table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


SQL = r"""
WITH p AS (SELECT page_id, lower(coalesce(url, '')) AS u, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
  d AS (SELECT *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda k:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, 5 * i + 1, 5) AS INTEGER) >> (15 - 5 * k)::INTEGER) & 31) + 1, 1)), '')), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h) AS first_,
    regexp_replace(regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^www\d*\.', '') AS host, regexp_extract(u, '^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS rest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_ THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_ THEN first_ END AS refers_to,
  array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END AS url_key,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM d
"""
