"""WARC archives and the external merge of their capture index.

Pages are written as WARC/1.1 records by Spark's own text writer, with the
record separator CR LF CR LF as its line separator, so archives can be in any
store that Spark writes to and survive lost executors. Each archive is a run
sorted by (URL key, time). They are read through Spark's text reader, whatever
their store, as a stream of which one record is held at a time: records are
framed by Content-Length, every payload is checked against its digest and each
capture gives an index row. The index is dealt by key ranges; each range keeps
its sorted runs in a temporary file and merges them with a loser tree of which
every leaf holds a chunk of its run, which gives globally ordered histories.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import materialize, new_path, small_batches, table

MIN_REVISIT_BYTES = 1000
CRLF = "\r\n"
#: Rows in an archive at most; its bytes are at most those of one partition of the pages.
ARCHIVE_ROWS = 2048
#: Index rows in a key range, about; rows of a run that are held at a time.
RANGE_ROWS, CHUNK_ROWS = 500_000, 512
CAPTURE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, capture_s long, archive string, record_offset long"


def url_key(url: F.Column) -> F.Column:
    """Sort-friendly key: host labels reversed, then path and query."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, r"^[^/?#]*", ""))


def resolve(pages: DataFrame, least: int) -> DataFrame:
    """Which captures are responses and which revisit another page.

    The digests alone are aggregated (map-side combined); the join back is an
    equi-join whose hot digests adaptive execution splits.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html.cast("binary")).alias("payload_digest"))
    large = base.filter(F.col("payload_bytes") >= least)
    owners = large.groupBy(F.col("payload_digest").alias("d")).agg(F.max("page_id").alias("owner"))
    owned = large.join(owners, F.col("payload_digest") == F.col("d"), "left").drop("d")
    small = base.filter(F.col("payload_bytes") < least).withColumn("owner", F.lit(None).cast("long"))
    refers = F.when(F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner"))
    return owned.unionByName(small).withColumn("refers_to", refers).drop("owner")


def record(revisit: bool) -> F.Column:
    """The text of one WARC record without its closing CR LF CR LF."""
    http = [F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")]
    block = F.concat(*http) if revisit else F.concat(*http, F.col("html"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: revisit" if revisit else "WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.replace(F.expr("CAST(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, capture_s) AS STRING)"), F.lit(" "), F.lit("T")), F.lit("Z")),  # UTC whatever the session's time zone
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("X-Url-Key: "), F.regexp_replace("url_key", r"[\x00-\x20\x7F]", "%20")),
        F.concat(F.lit("X-Capture-Seconds: "), F.col("capture_s").cast("string")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
    ]
    if revisit:
        lines += [F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))]
    lines += [F.lit("Content-Type: application/http; msgtype=response"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)  # concat_ws leaves null lines out


def write_archives(pages: DataFrame, path: str, least: int = MIN_REVISIT_BYTES) -> None:
    """One record per row, revisits without payload; runs sorted by (URL key, capture time, page)."""
    rows = resolve(pages, least).withColumn("url_key", url_key(F.col("url"))).withColumn("capture_s", F.lit(1577836800) + F.coalesce(F.col("page_id"), F.lit(0)))
    text = F.when(F.col("refers_to").isNull(), record(False)).otherwise(record(True))
    rows = rows.sortWithinPartitions("url_key", "capture_s", "page_id").select(text.alias("value"))
    rows.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_ROWS).text(path)


class Records:
    """Records of one archive, from its bytes as they come."""

    def __init__(self, name: str):
        self.name, self.held, self.at = name, bytearray(), 0

    def feed(self, data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
        """(offset, headers, block) of the records that are complete now."""
        held = self.held
        held += data
        while (end := held.find(b"\r\n\r\n")) >= 0:
            first, *lines = held[:end].decode("utf-8").split(CRLF)
            if not first.startswith("WARC/"):
                raise ValueError(f"no WARC record at {self.at} of {self.name}")
            headers = dict(x.split(": ", 1) for x in lines)
            stop = end + 4 + int(headers["Content-Length"])
            if len(held) < stop + 4:
                return
            if held[stop : stop + 4] != b"\r\n\r\n":
                raise ValueError(f"record at {self.at} of {self.name} isn't closed")
            yield self.at, headers, bytes(held[end + 4 : stop])
            del held[: stop + 4]
            self.at += stop + 4

    def close(self) -> None:
        if self.held:
            raise ValueError(f"{self.name} ends within a record")


def page_of(urn: str | None) -> int | None:
    return int(urn.removeprefix("<urn:page:").rstrip(">")) if urn else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under a path, payloads checked against their digests."""

    def row(name: str, at: int, h: dict[str, str], block: bytes) -> tuple:
        size, digest, revisit = int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"] == "revisit"
        if not revisit:
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                raise ValueError(f"payload of {h.get('WARC-Record-ID')} doesn't match its digest")
        return page_of(h.get("WARC-Record-ID")), size, digest, h["WARC-Type"], page_of(h.get("WARC-Refers-To")), h["X-Url-Key"], int(h["X-Capture-Seconds"]), name, at

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Records | None = None
        for batch in batches:
            out = []
            for name, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.name != name:
                    if now is not None:
                        now.close()
                    now = Records(name)
                out += [row(name, *x) for x in now.feed(piece + b"\r\n\r\n")]
            if out:
                yield captures(out)
        if now is not None:
            now.close()

    def captures(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in CAPTURE.split(", ")])

    # a compressed archive is read by one task, from its beginning to its end
    pieces = spark.read.option("lineSep", CRLF + CRLF).text(path).select(F.col("_metadata.file_name").alias("name"), F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(run, CAPTURE)


class LoserTree:
    """k-way merge of sorted runs: each inner node keeps the loser of its match, the winner climbs."""

    END = object()

    def __init__(self, runs: list[Iterable[Any]], key: Callable[[Any], Any]):
        self.iters, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads: list[Any] = [next(i, self.END) for i in self.iters]
        self.keys = [None if h is self.END else key(h) for h in self.heads]
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self.replay(leaf)

    def beats(self, a: int, b: int) -> bool:
        """Ended runs lose; ties go to the earlier run, which keeps the merge stable."""
        if self.heads[a] is self.END or self.heads[b] is self.END:
            return self.heads[a] is not self.END
        return (self.keys[a], a) < (self.keys[b], b)

    def replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node:
            if self.tree[node] == -1:
                self.tree[node] = winner
                return
            if self.beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[Any]:
        while self.k and self.heads[w := self.tree[0]] is not self.END:
            yield self.heads[w]
            self.heads[w] = head = next(self.iters[w], self.END)
            self.keys[w] = None if head is self.END else self.key(head)
            self.replay(w)


def merge_index(captures: DataFrame) -> DataFrame:
    """Captures in the global order of (URL key, time, page), numbered from 0 in ``capture_no``.

    Key ranges are cut on all three columns, so that one URL with a third of
    the captures spans many of them; their number follows that of the captures,
    and a range holds a chunk of each of its runs at a time. Repeated rows are
    captures of their own, null ids come before others, and an empty index
    gives no rows.
    """
    names = [x.split()[0] for x in CAPTURE.split(", ")]
    out = f"{CAPTURE}, pid int, pos long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        order = lambda r: (r[5].encode(), r[6], r[0] is not None, r[0] or 0)  # noqa: E731  nulls first, as Spark has them
        with tempfile.TemporaryFile() as store:
            runs: list[list[int]] = []  # where the chunks of each run are
            held: list[tuple] = []

            def put() -> None:
                if held:
                    runs[-1].append(store.tell())
                    pickle.dump(held, store)
                    held.clear()

            def read(places: list[int]) -> Iterator[tuple]:
                for at in places:
                    store.seek(at)
                    yield from pickle.load(store)

            last: tuple | None = None
            for batch in batches:
                for row in zip(*(batch.column(n).to_pylist() for n in names)):
                    if last is None or row[7] != last[7] or order(row) < order(last):  # an archive written by others may be several runs
                        put()
                        runs.append([])
                    held.append(row)
                    last = row
                    if len(held) == CHUNK_ROWS:
                        put()
            put()
            merged = zip(LoserTree([read(x) for x in runs], order), count())
            while some := list(islice(merged, 4096)):
                rows = [(*r, TaskContext.get().partitionId(), i) for r, i in some]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[*names, "pid", "pos"])

    spark = captures.sparkSession
    captures = materialize(captures, "index")  # the archives are read once, the ranges are cut on index rows
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    dealt = captures.repartitionByRange(ranges, "url_key", "capture_s", "page_id").sortWithinPartitions("archive", "record_offset")
    made = materialize(dealt.mapInArrow(run, out), "captures")
    starts = made.groupBy("pid").agg(F.count("*").alias("n"))  # a row for each range
    starts = starts.select("pid", F.coalesce(F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return made.join(starts, "pid").withColumn("capture_no", F.col("before") + F.col("pos")).drop("pid", "pos", "before")


def op3_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null html is an empty payload, null URLs and page ids are kept; of repeated rows with the largest page_id all are responses."""
    small_batches(spark)
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    small = merge_index(read_archives(spark, path))
    return small.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "capture_no")


OP3_SQL = r"""
WITH base AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
keyed AS (
  SELECT *, regexp_replace(array_to_string(list_reverse(string_split(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '.')), ',') || ')' || regexp_replace(rest, '^[^/?#]*', ''), '[\x00-\x20\x7F]', '%20', 'g') AS url_key,
         CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS owner
  FROM base)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN owner IS NOT NULL AND owner IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner IS DISTINCT FROM page_id THEN owner END AS refers_to,
       row_number() OVER (ORDER BY url_key, 1577836800 + coalesce(page_id, 0), page_id NULLS FIRST) - 1 AS capture_no
FROM keyed
"""
