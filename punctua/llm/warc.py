"""Web archives: WARC records written and read back, and a merged capture index.

Writing is column expressions and the text writer: a record is one string, and
the writer's line end is the last byte of the blank lines that close a record.
Of records with equal payloads one is a response, the others refer to it.

Reading goes file by file through the records' own lengths.  The captures of a
file, sorted by URL key and time, are a run.  Range partitions take their part of
every run, and a loser tree merges the runs of a partition; with the counts of
the partitions before it every capture knows its place in the whole index.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.llm.common import stored
from punctua.session import scratch_path

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_BYTES = 0
#: Records and bytes per file and index rows per merging task: both are read into memory.
FILE_RECORDS, FILE_BYTES, MERGE_ROWS = 2_000, 128 << 20, 50_000
_CRLF = "\r\n"

INDEX = "url_key string, captured_at string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string, offset bigint, length bigint"


def base32_sha1(value: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8: four letters from every five hex digits."""
    digest = F.sha1(value)
    letters = []
    for k in range(8):
        n = F.conv(F.substr(digest, F.lit(5 * k + 1), F.lit(5)), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(n, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*letters)


def _record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.concat(F.lit("none:"), digest)), F.lit(">"))


def _date(page_id: Column) -> Column:
    """Capture time: the page's number in seconds after a fixed day, free of the session's zone."""
    seconds = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))
    at = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.regexp_replace(F.substr(at.cast("string"), F.lit(1), F.lit(19)), " ", "T")


def _uri(url: Column) -> Column:
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return F.coalesce(url, F.lit("about:blank"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """(value): one WARC record per page, without its last line feed."""
    return _records(pages, id_col, url_col, html_col, least).select("value")


def _room(url: Column, html: Column) -> Column:
    """Records of at most this page's size that fit into a file, as a power of eight; headers are counted generously."""
    size = F.coalesce(F.octet_length(html.cast("string")), F.lit(0)).cast("bigint") + 8 * F.coalesce(F.octet_length(url.cast("string")), F.lit(0)) + 2048
    fit = F.greatest(F.floor(F.lit(FILE_BYTES) / size), F.lit(1))
    return F.when(fit >= FILE_RECORDS, FILE_RECORDS).otherwise(F.pow(F.lit(8), F.floor(F.log2(fit) / 3)).cast("int"))


def _records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """:func:`records` with ``room``, as of :func:`_room`."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), _room(F.col(url_col), F.col(html_col)).alias("room"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload").cast("bigint")})
    # Payloads that occur again; the smallest id (and its url) is referred to.
    firsts = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first")
    )
    firsts = stored(firsts.filter("n > 1 AND first IS NOT NULL").select("digest", F.col("first.page_id").alias("to_id"), F.col("first.url").alias("to_url")), "payloads")
    rows = rows.join(firsts, "digest", "left").withColumn("again", F.coalesce(~F.col("page_id").eqNullSafe(F.col("to_id")) & F.col("to_id").isNotNull(), F.lit(False)))
    again = F.col("again")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))

    def field(name: str, value: Column, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
        return line if when is None else F.when(when, line).otherwise(F.lit(""))

    head = F.concat(
        F.lit(VERSION + _CRLF), field("WARC-Type", F.when(again, "revisit").otherwise("response")), field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.concat(_date(F.col("page_id")), F.lit("Z"))), field("WARC-Target-URI", _uri(F.col("url"))), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Profile", F.lit(PROFILE), again), field("WARC-Refers-To", _record_id(F.col("to_id"), F.col("digest")), again),
        field("WARC-Refers-To-Target-URI", _uri(F.col("to_url")), again), field("WARC-Refers-To-Date", F.concat(_date(F.col("to_id")), F.lit("Z")), again),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", length.cast("string")), F.lit(_CRLF),
    )
    return rows.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"), "room")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> None:
    """WARC files of at most ``FILE_RECORDS`` records in the folder ``path``.

    A file also stays below about ``FILE_BYTES`` (more only with one record
    larger than that): pages are written by size class, the large ones with fewer
    to a file.  An empty table writes one empty file.
    """
    rows = _records(pages, id_col, url_col, html_col, least)
    present = pages.select(_room(F.col(url_col), F.col(html_col)).alias("room")).distinct().collect()  # at most one row per power of eight
    for room in sorted((r["room"] for r in present), reverse=True) or [FILE_RECORDS]:
        rows.filter(F.col("room") == room).select("value").write.mode("append").option("lineSep", "\n").option("maxRecordsPerFile", room).text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and query; without
    scheme, user, ``www.``, default port and fragment."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*:(//)?", "", url.strip(), count=1, flags=re.I).split("#")[0]
    host, slash, path = rest.partition("/")
    if "?" in host:
        host, _, query = host.partition("?")
        slash, path = "/", f"?{query}"
    host = re.sub(r":(80|443)?$", "", re.sub(r"^www\d*\.", "", host.rpartition("@")[2].lower()))
    return ",".join(reversed(host.split("."))) + ")/" + path


def parse(content: bytes) -> Iterator[tuple]:
    """(url_key, captured_at, page_id, payload_bytes, payload_digest, record_type,
    refers_to, offset, length) of every record in a file."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        lines = content[at:head].decode().split(_CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        begin = head + 4
        end = begin + int(fields["content-length"])
        body = content.index(b"\r\n\r\n", begin, end) + 4
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response":
            payload = content[body:end]
            size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if found != digest:
                raise ValueError(f"payload digest differs at byte {at}")
        else:
            size = int(re.search(rb"Content-Length: (\d+)", content[begin:body])[1])
        yield (
            url_key(fields["warc-target-uri"]), fields["warc-date"], _page(fields["warc-record-id"]), size, digest, kind,
            _page(fields.get("warc-refers-to", "")), at, end + 4 - at,
        )
        at = end + 4


def _page(record_id: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", record_id)
    return int(found[1]) if found else None


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives below ``path``, each file's in index order."""
    def read(file: tuple[str, bytes]) -> list[tuple]:
        name = file[0].rpartition("/")[2]
        return sorted((row[:7] + (name,) + row[7:] for row in parse(bytes(file[1]))), key=_order)

    files = spark.sparkContext.binaryFiles(path, spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(files.flatMap(read), INDEX)


class LoserTree:
    """Merge of sorted lists: inner nodes keep the loser of their match, so the
    next smallest takes one match per level.  An exhausted list loses to all."""

    def __init__(self, lists: list[list[tuple]], key):
        self.lists, self.key, self.k = lists, key, max(1, len(lists))
        self.at = [0] * len(lists)
        self.heads = [self._head(i) for i in range(len(lists))] or [(1,)]
        self.losers = [0] * self.k
        # Play all matches once, from the leaves (k .. 2k - 1) to the root.
        winner = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.losers[node] = (a, b) if self.heads[a] <= self.heads[b] else (b, a)
        self.champion = winner[1] if self.k > 1 else 0

    def _head(self, i: int) -> tuple:
        return (0, self.key(self.lists[i][self.at[i]]), i) if self.at[i] < len(self.lists[i]) else (1,)

    def __iter__(self) -> Iterator[tuple]:
        while self.heads[self.champion][0] == 0:
            best = self.champion
            yield self.lists[best][self.at[best]]
            self.at[best] += 1
            self.heads[best] = self._head(best)
            node = (best + self.k) // 2
            while node:
                if self.heads[self.losers[node]] < self.heads[best]:
                    self.losers[node], best = best, self.losers[node]
                node //= 2
            self.champion = best


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[str, list[tuple]] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            parts.setdefault(row[7], []).append(row)
    if schema is None:
        return
    for run in parts.values():
        run.sort(key=_order)  # in order already, unless the shuffle mixed its blocks
    rows, at = [], 0
    def out() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        places = pa.array(range(at - len(rows), at), pa.int64())
        return pa.RecordBatch.from_arrays([*arrays, places], names=[*schema.names, "place"])

    for row in LoserTree([parts[name] for name in sorted(parts)], _order):
        rows.append(row)
        at += 1
        if len(rows) == 10_000:
            yield out()
            rows = []
    if rows:
        yield out()


def merged_index(captures: DataFrame) -> DataFrame:
    """``captures`` (as of :func:`runs`) with ``position``, their place by URL key and time.

    A URL with very many captures spreads over partitions, as time and page
    divide it further.
    """
    n = captures.count()
    parts = max(1, math.ceil(n / MERGE_ROWS))
    ranges = captures.repartitionByRange(parts, "url_key", "captured_at", "page_id", "file", "offset")
    merged = stored(ranges.mapInArrow(_merged, INDEX + ", place bigint").withColumn("part", F.spark_partition_id()), "index")
    sizes = {r["part"]: r["n"] for r in merged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per merging task
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    offset = merged.sparkSession.createDataFrame(list(before.items()), "part int, before bigint")
    return merged.join(F.broadcast(offset), "part").withColumn("position", F.col("before") + F.col("place")).drop("part", "place", "before")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` to archives in the shared folder, reads them back, and
    returns one row per record, as read: the index with ``position``.

    A NULL html is an empty payload, a NULL url ``about:blank``.  Rows with the
    referred-to id are all responses, should the id repeat; a NULL id refers to
    the smallest id with its payload, or is a response if there is none.  Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, id_col=id_col, url_col=url_col, html_col=html_col)
    captures = stored(runs(spark, f"{path}/part-*") if _any(spark, path) else spark.createDataFrame([], INDEX), "runs")
    return merged_index(captures)


def _any(spark: SparkSession, path: str) -> bool:
    return bool(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").take(1))
