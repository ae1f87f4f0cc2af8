"""Best-fit packing by large-item matching.

Tokens are counted once, without a shuffle: every piece gets its length, the
partition it was made in and its rank among that partition's pieces of the
same length. The packing itself is solved on the *histogram of lengths*, which
has at most ``capacity`` entries whatever the corpus: items above a third of
the capacity go at most two to a bin, each with the largest partner that still
fits; smaller items, longest first, go to the bins with the tightest gap. Bins
of one kind are kept as an interval of bin numbers, so the plan is a short
list of (length, first rank, first bin, items per bin, offset) and each piece
finds its place from its global rank among its length by a binary search.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, small_batches, table, whole_texts
from .tokenizer import encoding_of, public_path

CAPACITY, EOS = 1024, 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, local_rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first."""
    first = n - (max(1, -(-n // capacity)) - 1) * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, eos: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding, pid, seen = encoding_of(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoding.encode(text, allowed_special="all")
                ids.append(eos)
                raw = np.array(ids, dtype="<u4").tobytes()
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), pid, int(seen[length])))
                    seen[length] += 1
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = [x.split()[0] for x in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return docs.mapInArrow(run, PIECES)


class Plan:
    """Places for all items of a histogram of lengths.

    ``events[length]`` lists (first rank, first bin, items per bin, offset in
    the bin), by rising first rank.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.events: dict[int, list[tuple[int, int, int, int]]] = {}
        self.used: dict[int, int] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> intervals of bins (first, how many)
        left = {n: c for n, c in counts.items() if c}
        self.large({n: left[n] for n in left if 3 * n > capacity})
        for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
            self.small(n, left[n])

    def put(self, n: int, first: int, bins: int, each: int, offset: int) -> None:
        rank = self.used.get(n, 0)
        self.events.setdefault(n, []).append((rank, first, each, offset))
        self.used[n] = rank + bins * each

    def open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def leave(self, gap: int, first: int, bins: int) -> None:
        if gap and bins:
            self.gaps.setdefault(gap, []).append((first, bins))

    def large(self, left: dict[int, int]) -> None:
        sizes: list[int] = sorted(left)
        while sizes:
            a = sizes[-1]
            b = next((n for n in reversed(sizes) if n + a <= self.capacity and (n != a or left[a] > 1)), None)
            m = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            first = self.open(m)
            self.put(a, first, m, 2 if b == a else 1, 0)
            left[a] -= m * (2 if b == a else 1)
            if b not in (None, a):
                self.put(b, first, m, 1, a)
                left[b] -= m
            self.leave(self.capacity - a - (b or 0), first, m)
            sizes = [n for n in sizes if left[n]]

    def small(self, n: int, count: int) -> None:
        for gap in sorted(g for g in self.gaps if g >= n):
            each, kept = gap // n, []
            for first, bins in self.gaps.pop(gap):
                full = min(bins, count // each)
                if full:
                    self.put(n, first, full, each, self.capacity - gap)
                    self.leave(gap - each * n, first, full)
                    count -= full * each
                if full < bins and count and count < each:
                    self.put(n, first + full, 1, count, self.capacity - gap)
                    self.leave(gap - count * n, first + full, 1)
                    count, full = 0, full + 1
                if full < bins:
                    kept.append((first + full, bins - full))
            if kept:
                self.gaps.setdefault(gap, [])[:0] = kept
            if not count:
                return
        each = self.capacity // n
        full, rest = divmod(count, each)
        if full:
            first = self.open(full)
            self.put(n, first, full, each, 0)
            self.leave(self.capacity - each * n, first, full)
        if rest:
            first = self.open(1)
            self.put(n, first, 1, rest, 0)
            self.leave(self.capacity - rest * n, first, 1)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """Sequences of at most ``capacity`` tokens for (doc_id, text) rows.

    A null or empty text is the end token alone. Repeated rows are packed as
    often as they occur, a null doc_id stays null, and an empty table gives no
    rows. Only documents longer than the capacity are cut.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = materialize(pieces(whole_texts(docs), tokenizer or public_path("byte_bpe_50k.json"), capacity, eos), "pieces")
    per = made.groupBy("pid", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length
    plan = Plan(counts, capacity)
    events = {n: np.array(e, np.int64).T for n, e in plan.events.items()}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("local_rank").to_numpy() + batch.column("rank0").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first_rank, first_bin, each, offset = events[int(n)]
                e = np.searchsorted(first_rank, rank[at], side="right") - 1
                seq[at] = first_bin[e] + (rank[at] - first_rank[e]) // each[e]
                off[at] = offset[e] + (rank[at] - first_rank[e]) % each[e] * n
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)], names=[x.split()[0] for x in PLACED.split(", ")])

    return made.join(starts, ["pid", "length"]).mapInArrow(place, PLACED)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
