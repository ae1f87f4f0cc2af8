"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over hashed word unigrams and bigrams are counted over whole
texts: one over every document, one over the trusted ones. Each task sums its
own counts and sends a row per bucket it met, Spark adds them up, and the
bounded table of log ratios goes back to the tasks. A document's score is the
mean log ratio of its n-grams (so long texts aren't favoured) and it is kept
if that isn't below a fixed threshold and the base rules hold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, table, whole_texts

BUCKETS = 1 << 16
#: Counts added to either side of a ratio, the raw one scaled to the target's size: rare n-grams say little.
PRIOR = 5.0
#: Mean nats per n-gram below which a document goes.
THRESHOLD = -0.2
#: Trusted ids are broadcast up to so many (8 MB); beyond, the join is shuffled.
BROADCAST_IDS = 1_000_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")
_SPACES, _SYMBOLS = " \t\n\r\x0b\x0c", "#*$%&|<>"
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double"


def grams(data: bytes) -> np.ndarray:
    """Buckets of the uni- and bigrams of a text, case kept, marks apart from words."""
    found = _TOKEN.findall(data)
    h = np.fromiter(map(zlib.crc32, found), np.uint64, len(found))
    both = np.concatenate([h, h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]])
    return (both * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.int64)


def rules(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8").split()  # bytes.split knows ASCII white space alone
    chars = len(text) - sum(map(text.count, _SPACES))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeated = 0
    if len(words) > 2:
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
        _, pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
        _, triple, counts = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
        again = counts[triple] > 1
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[k : k + len(again)] |= again
        repeated = int(covered.sum())
    return len(words), chars, sum(map(text.count, _SYMBOLS)), dup, repeated


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that no label row calls bad or toxic and some calls good."""
    per = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
    return per.agg(F.min("quality").alias("q"), F.max(F.coalesce(F.col("toxic"), F.lit(0))).alias("t")).filter("q = 1 AND t = 0").select(F.col("doc_id").alias("trusted_id"))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> np.ndarray:
    """The log ratio of each bucket; all zero where nothing is trusted."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                g = grams(text.encode("utf-8"))
                np.add.at(raw, g, 1) if len(g) < 4096 else np.add(raw, np.bincount(g, minlength=buckets), out=raw)
                if good:
                    np.add.at(target, g, 1)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    ids = trusted_ids(labels)
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    marked = whole_texts(docs).join(ids, F.col("doc_id") == F.col("trusted_id"), "left").select("text", F.col("trusted_id").isNotNull().alias("good"))
    rows = marked.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in rows.collect():  # a row per bucket
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(buckets)
    return np.log(target + prior) - np.log(raw * (target.sum() / raw.sum()) + prior)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep_columns: bool = False) -> DataFrame:
    """Base rules and verdict of each document.

    A null or empty text has no words and fails the base rules; its ratio is 0.
    Repeated rows and null ids give a row each, an empty table none; without
    labels only the base rules decide. With ``keep_columns`` the documents that
    are kept come back whole, their own columns alone.
    """
    small_batches(docs.sparkSession)
    ratios = log_ratios(docs, labels)

    def verdict(text: str) -> tuple:
        n, chars, symbols, dup, again = rules(text)
        g = grams(text.encode("utf-8"))
        llr = float(ratios[g].mean()) if len(g) else 0.0
        failed = n < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * n
        return n, chars, symbols, dup, again, failed, not failed and llr >= threshold, llr

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        for batch in batches:
            if batch.num_rows:
                cols = zip(*map(verdict, batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([verdict(x or "")[6] for x in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema) if keep_columns else whole_texts(docs).mapInArrow(run, RESULT)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
