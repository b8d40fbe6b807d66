"""WARC archives of pages, and capture histories by an external merge of index runs.

Pages become WARC/1.1 records in gzip-compressed archives, written by Spark's own writer, so a lost task leaves no
half archive. Of pages with equal payloads one is kept whole and the others revisit it. Reading an
archive back gives its records and a local run of index entries, sorted by URL key and time. The
runs' entries are dealt to key ranges, and each range merges its runs with a loser tree, so the
ranges in order are one globally sorted capture history.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.session import scratch_path

#: Payloads below this size are always written whole.
REVISIT_BYTES = 1000
#: Times of capture, for pages that have none: this many seconds after 1970, plus the id.
FIRST_CAPTURE = 1_700_000_000
_SALTS = 16
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = (
    "page_id long, url string, url_key string, captured_at string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, record_offset long, record_bytes long"
)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _url_text(url: Column) -> Column:
    """The URL as a header value: control characters and spaces are percent-coded, null is empty."""
    url = F.coalesce(url, F.lit(""))
    for c in ("\r", "\n", "\t", " "):
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return url


def with_record_types(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, payload, at) with digest, bytes and, for revisits, refers_to.

    Digests that several pages share are few; each is spread over fixed salts before it meets the
    pages, so the pages of one very common payload are dealt to many tasks.
    """
    p = pages.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    p = p.withColumn("salt", F.when(F.col("bytes") >= revisit_bytes, F.pmod(F.xxhash64("page_id"), F.lit(_SALTS))))
    shared = (
        p.where(F.col("bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id", F.explode(F.array(*(F.lit(i).cast("long") for i in range(_SALTS)))).alias("salt"))
    )
    p = p.join(shared, ["digest", "salt"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id", "salt")


def warc_records(pages: DataFrame) -> DataFrame:
    """One column ``value``: the WARC/1.1 record of each page, without the closing blank lines.

    A revisit keeps the HTTP header of its page, and with it the payload's length, but no payload.
    """
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    # A missing id is written as an empty one.
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\n"),
        _header("WARC-Record-ID", page("page_id")),
        _header("WARC-Date", F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", _url_text(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_header("WARC-Refers-To", page("refers_to")), _header("WARC-Profile", F.lit(_REVISIT_PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    return pages.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_archive: int = 20_000) -> None:
    """Write pages (page_id, url, payload, at) as archives under ``path``; a record ends in two blank lines."""
    records = warc_records(with_record_types(pages))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_archive).text(path)


def url_key(url: str) -> str:
    """Sort-friendly form of a URL: the host's labels from the last to the first, then the path."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?(.*)", url, re.S)
    if not m:
        return url.lower()
    host = m[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (m[2].lower() or "/")


class RecordReader:
    """Records of one gzip-compressed archive, by their stated lengths, holding one record at a time."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.step, self.fed = memoryview(data), step, 0
        self.unzip = zlib.decompressobj(31)
        self.buffer = bytearray()
        self.offset = 0

    def _more(self) -> bool:
        if self.unzip.eof and self.unzip.unused_data:  # the next gzip member
            rest, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
            self.buffer += self.unzip.decompress(rest)
            return True
        if self.fed >= len(self.data):
            return False
        self.buffer += self.unzip.decompress(self.data[self.fed : self.fed + self.step])
        self.fed += self.step
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
        """(headers, block, offset in the uncompressed archive, record bytes)."""
        while True:
            while (end := self.buffer.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    if self.buffer.strip():
                        raise ValueError("the archive ends within a record")
                    return
            head = bytes(self.buffer[:end]).decode("utf-8").split("\r\n")
            if not head[0].startswith("WARC/"):
                raise ValueError(f"no record at offset {self.offset}")
            fields = dict(line.split(": ", 1) for line in head[1:])
            size = int(fields["Content-Length"])
            while len(self.buffer) < end + 8 + size and self._more():
                pass
            block = bytes(self.buffer[end + 4 : end + 4 + size])
            if len(block) < size or self.buffer[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
                raise ValueError(f"the record at offset {self.offset} is cut short")
            total = end + 8 + size
            yield fields, block, self.offset, total
            del self.buffer[:total]
            self.offset += total


def _page_number(urn: str | None) -> int | None:
    digits = (urn or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def _index_entries(batches: Iterator) -> Iterator:
    """Archives to index entries, each archive's sorted by URL key, time and id: its local run."""
    import hashlib

    import pyarrow as pa

    types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _ENTRY.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            archive = batch["path"][i].as_py().rsplit("/", 1)[-1]
            run = []
            for fields, block, offset, total in RecordReader(batch["content"][i].as_buffer()):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{archive}: the payload at offset {offset} does not match its digest")
                url = fields["WARC-Target-URI"]
                run.append(
                    (
                        _page_number(fields["WARC-Record-ID"]), url, url_key(url), fields["WARC-Date"], fields["WARC-Type"],
                        _page_number(fields.get("WARC-Refers-To")), size, digest, archive, offset, total,
                    )
                )
            run.sort(key=_capture_order)
            cols = list(zip(*run)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _capture_order(entry: tuple) -> tuple:
    page = entry[0]
    return entry[2], entry[3], page is not None, page or 0, entry[8], entry[9]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(_index_entries, _ENTRY)


class LoserTree:
    """Merge of sorted runs: each inner node keeps the loser of its match, the top the next entry."""

    def __init__(self, runs: list[Iterator], key):
        self.key, self.runs, self.k = key, runs, len(runs)
        self.head = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.head]
        self.loser = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i, building=True)

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and self.keys[a] is not None
        return self.keys[a] <= self.keys[b]

    def _play(self, winner: int, building: bool = False) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.loser[node]
            if building and other < 0:
                self.loser[node] = winner  # waits for its opponent
                return
            if other >= 0 and self._before(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            top = self.loser[0]
            if self.head[top] is None:
                return
            yield self.head[top]
            self.head[top] = next(self.runs[top], None)
            self.keys[top] = None if self.head[top] is None else self.key(self.head[top])
            self._play(top)


def _merge_runs(batches: Iterator) -> Iterator:
    """A key range's entries, run by run and sorted within each, to one sorted sequence."""
    import pyarrow as pa

    names, runs, schema = [c.split()[0] for c in _ENTRY.split(", ")], {}, None
    for batch in batches:
        schema = batch.schema
        for row in zip(*(batch[c].to_pylist() for c in names)):
            runs.setdefault(row[8], []).append(row)
    merged: list[tuple] = []
    for entry in LoserTree([iter(r) for r in runs.values()], _capture_order):
        merged.append(entry)
        if len(merged) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*merged), schema)], schema=schema)
            merged = []
    if merged:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*merged), schema)], schema=schema)


def merge_index(entries: DataFrame, ranges: int | None = None) -> DataFrame:
    """Globally ordered capture history: the partitions in order, each merged from its runs' slices.

    Ranges are cut on (URL key, time, id), so the captures of one very common URL fill several.
    ``ranges`` is the number of key ranges, Spark's number of shuffle partitions if not given; a
    range's entries are held by one task.
    """
    by = ["url_key", "captured_at", "page_id"]
    dealt = entries.repartitionByRange(ranges, *by) if ranges else entries.repartitionByRange(*by)
    runs = dealt.sortWithinPartitions("archive", *by, "record_offset")
    return runs.mapInArrow(_merge_runs, _ENTRY)


def archive_pages(
    pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None
) -> DataFrame:
    """Write pages as archives, read them back and return the merged index, one row per page.

    The payload is the HTML in UTF-8, empty for null. Among equal payloads (by SHA-1) of at least
    ``REVISIT_BYTES`` bytes the page with the largest id is kept whole and the others revisit it;
    rows that repeat that id are all kept whole, as are rows with null ids where no id is known.
    Null URLs are written empty; control characters in URLs are percent-coded. ``time_col`` holds
    seconds since 1970; without one the id gives a stand-in time. An empty table gives no rows.
    Extra columns are ignored.
    """
    spark = pages.sparkSession
    path = path or f"{scratch_path(spark, 'warc')}/archives"
    at = F.col(time_col).cast("long") if time_col else F.lit(FIRST_CAPTURE) + F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
        F.coalesce(at, F.lit(FIRST_CAPTURE)).alias("at"),
    )
    write_archives(slim, path)
    return merge_index(read_archives(spark, path))
