"""Exact substring dedup: every byte of a 200-byte string that also starts elsewhere goes.

Every 200-byte window has an anchor, the 32-gram with the least hash in it
(rightmost of equals). Equal windows have equal anchors at equal places, so
only windows whose anchors hash alike need comparing. Windows that follow each
other and share an anchor are a run; its bytes are its neighbourhood.

1. Anchors, dealt by hash and streamed in order: runs whose whole neighbourhood
   occurs again are settled; a run whose anchor has another neighbourhood too is
   sent on, one for each different neighbourhood.
2. Their bytes meet by anchor and their windows are sorted as suffixes: a
   mergesort whose comparisons find the common extension of two suffixes by
   binary search on prefix polynomial hashes, so a comparison takes log(200)
   steps. Neighbours that agree on 200 bytes are compared byte by byte before
   they count, against collisions.
3. An anchor with a crowd of neighbourhoods isn't compared in one task: blocks
   of its windows, then the windows of those blocks that aren't settled by it,
   are dealt by their own digests and counted, map-side first.

Texts are known by a 128-bit key: copies of a text are one text here, and all
of a copied text of 200 bytes or more goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from struct import unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, small_batches, table

LENGTH, GRAM = 200, 32
#: Window starts looked at in one go: places in it fit 20 bits, and memory stays bounded for any text.
BLOCK = 1 << 19
#: Bytes of neighbourhoods whose suffixes are sorted together.
SORT_BYTES = 1 << 21
U = np.uint64
BASE = 0x9E3779B97F4A7C15
#: Different neighbourhoods of one anchor in one range from which on they are a crowd.
CROWD = 4096
#: Distances from the anchor in a block of a crowded anchor's windows.
STEP = 8
DUP, SHIP, HOT = 1, 2, 4


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for p in (BASE, pow(BASE, -1, 1 << 64)):
        a = np.full(n + 1, p, U)
        a[0] = 1
        out.append(np.cumprod(a))
    return out[0], out[1]


class PrefixHash:
    """Polynomial hashes modulo 2 ** 64 of all substrings of a buffer, from sums of its prefixes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        size = 1 << max(21, (n + 1).bit_length())
        self.up, self.down = powers(size)
        self.sums = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * self.up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def runs(data: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, neighbourhood hash, first window, windows less one, anchor less first window) of a text's runs."""
    width = LENGTH - GRAM + 1
    for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        part = np.frombuffer(data[at : at + BLOCK + LENGTH - 1], np.uint8)
        h = PrefixHash(part)
        grams = mix(h.of(np.arange(len(part) - GRAM + 1), GRAM))
        low = U((1 << 20) - 1)
        least, step = (grams & ~low) | (low - np.arange(len(grams), dtype=U)), 1
        while step * 2 <= width:
            least, step = np.minimum(least[:-step], least[step:]), step * 2
        if width > step:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        more = np.diff(np.concatenate([first, [len(least)]])) - 1
        anchor = (low - (least[first] & low)).astype(np.int64)
        yield grams[anchor].view(np.int64), mix(h.of(first, more + LENGTH)).view(np.int64), at + first, more, anchor - first


def keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def anchors(texts: DataFrame) -> DataFrame:
    """All runs; ``run`` packs (first window, windows less one, anchor less first window)."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, text in enumerate(batch.column(2).to_pylist()):
                for kh, nh, first, more, place in runs(text.encode("utf-8")):
                    for c, a in zip(out, (kh, nh, np.full(len(kh), k1[i]), np.full(len(kh), k2[i]), first << 16 | more << 8 | place)):
                        c.append(a)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["kh", "nh", "k1", "k2", "run"])

    return texts.mapInArrow(find, "kh long, nh long, k1 long, k2 long, run long")


def settle(found: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Verdicts on runs (k1, k2, run, kh, flag), from anchors sorted by (kh, nh, k1, k2, run).

    One pass that keeps a row: whatever the size of a group, memory is bounded.
    The anchors are dealt by ranges of all five columns, so one that a third of
    the texts hold spans many tasks. What stands at either end of a range may
    go on in the next one; it is sent on, and the comparison of bytes settles it.
    """
    names = ["kh", "nh", "k1", "k2", "run"]

    def verdicts(a: np.ndarray, before: np.ndarray | None, first_nh: int, rank: int, ahead: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int, int]:
        """For distinct sorted rows between one row before and one ahead; ``rank`` counts the neighbourhoods of the anchor so far."""
        kh, nh = a[0], a[1]
        prev_kh = np.concatenate([[0 if before is None else before[0]], kh[:-1]]) == kh
        prev_nh = np.concatenate([[0 if before is None else before[1]], nh[:-1]]) == nh
        if before is None:
            prev_kh[0] = False
        next_kh = np.concatenate([kh[1:], [0 if ahead is None else ahead[0]]]) == kh
        next_nh = np.concatenate([nh[1:], [0 if ahead is None else ahead[1]]]) == nh
        if ahead is None:
            next_kh[-1] = False
        same_before, same_ahead = prev_kh & prev_nh, next_kh & next_nh
        start = np.maximum.accumulate(np.where(~prev_kh, np.arange(len(kh)), -1))
        firsts = np.where(start < 0, first_nh, nh[np.maximum(start, 0)])
        ship = ~same_ahead & ((nh != firsts) | next_kh)
        met = np.cumsum(~same_before)
        ranks = np.where(start < 0, rank + met, met - met[np.maximum(start, 0)] + 1)
        return (same_before | same_ahead) * DUP, ship * SHIP + (ship & (ranks > crowd)) * HOT, int(firsts[-1]), int(ranks[-1])

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows without a verdict: the last one's next isn't known
        before, first_nh, rank = None, 0, 0
        opening: tuple | None = None  # the first neighbourhood of the range

        def out(a: np.ndarray, dup: np.ndarray, ship: np.ndarray) -> pa.RecordBatch:
            flag = dup | ship
            at = np.flatnonzero(flag)
            return pa.RecordBatch.from_arrays([pa.array(a[2][at]), pa.array(a[3][at]), pa.array(a[4][at]), pa.array(a[0][at]), pa.array(flag[at].astype(np.int32))], names=["k1", "k2", "run", "kh", "flag"])

        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.stack([batch.column(n).to_numpy() for n in names])
            if held is not None:
                a = np.concatenate([held, a], axis=1)
            a = a[:, np.concatenate([[True], (a[:, 1:] != a[:, :-1]).any(axis=0)])]  # copies of a text
            if opening is None:
                opening = (a[0, 0], a[1, 0])
            if a.shape[1] > 1:
                done, held = a[:, :-1], a[:, -1:]
                dup, ship, first_nh, rank = verdicts(done, before, first_nh, rank, held[:, 0])
                ship |= edge(done, opening, held[:, 0]) * SHIP
                before = done[:, -1]
                yield out(done, dup, ship)
            else:
                held = a
        if held is not None:
            dup, ship, _, _ = verdicts(held, before, first_nh, rank, None)
            yield out(held, dup, ship | SHIP)

    def edge(a: np.ndarray, opening: tuple, ahead: np.ndarray) -> np.ndarray:
        """The last run of the range's first neighbourhood."""
        first = (a[0] == opening[0]) & (a[1] == opening[1])
        return first & ~np.append(first[1:], (ahead[0], ahead[1]) == opening)

    return found.repartitionByRange(*names).sortWithinPartitions(*names).mapInArrow(stream, "k1 long, k2 long, run long, kh long, flag int")


class Suffixes:
    """Suffixes of a buffer, compared by the hashes of their beginnings up to ``limit`` bytes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit, self.hash = data, limit, PrefixHash(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension: binary search for the longest equal beginning."""
        low = np.where(self.hash.of(a, self.limit) == self.hash.of(b, self.limit), self.limit, 0)
        at = np.flatnonzero(low == 0)
        lo, hi, x, y = np.zeros(len(at), np.int64), np.full(len(at), self.limit), a[at], b[at]
        while len(at) and (hi - lo > 1).any():
            mid = (lo + hi) >> 1
            same = self.hash.of(x, mid) == self.hash.of(y, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid)
        low[at] = lo
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """a before b, and whether they agree up to the limit."""
        n = self.common(a, b)
        equal = n >= self.limit
        k = np.where(equal, 0, n)
        return ~equal & (self.data[a + k] < self.data[b + k]), equal

    def sort(self, starts: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Stable order by (segment, suffix): bottom-up merges of all segments at once."""
        order = np.argsort(segment, kind="stable")
        seg = segment[order]
        head = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        size = np.diff(np.concatenate([head, [len(seg)]]))
        base, count = np.repeat(head, size), np.repeat(size, size)
        local = np.arange(len(seg)) - base
        width = 1
        while True:
            busy = np.flatnonzero(count > width)
            if not len(busy):
                return order
            at, b, c = local[busy], base[busy], count[busy]
            run = at // width
            left = run % 2 == 0
            other = np.minimum((run + 1 - 2 * ~left) * width, c)
            lo, hi = other.copy(), np.minimum(other + width, c)
            mine = starts[order[busy]]
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) >> 1
                theirs = starts[order[b[open_] + mid]]
                below, equal = self.less(theirs, mine[open_])
                below |= equal & ~left[open_]  # equals of the left run stay first
                lo[open_] = np.where(below, mid + 1, lo[open_])
                hi[open_] = np.where(below, hi[open_], mid)
            merged = np.where(left, at, at - width) + lo - np.where(left, other, other)
            moved = order.copy()
            moved[b + merged] = order[busy]
            order = moved
            width *= 2


def repeated(data: np.ndarray, starts: np.ndarray, segment: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Which of the suffixes share their first ``limit`` bytes with another of their segment."""
    s = Suffixes(data, limit)
    order = s.sort(starts, segment)
    a, b = starts[order[:-1]], starts[order[1:]]
    near = np.flatnonzero((segment[order[:-1]] == segment[order[1:]]) & (s.hash.of(a, limit) == s.hash.of(b, limit)))
    out = np.zeros(len(starts), bool)
    for k in range(0, len(near), 20_000):  # byte by byte: a collision of hashes doesn't count
        n = near[k : k + 20_000]
        span = np.arange(limit)
        true = n[(data[a[n][:, None] + span] == data[b[n][:, None] + span]).all(axis=1)]
        out[order[true]] = out[order[true + 1]] = True
    return out


def compare(rows: list[tuple[int, int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """(k1, k2, start, end) of the repeated windows of runs that share anchor hashes."""
    lens = np.array([len(r[4]) for r in rows])
    data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    offset = np.concatenate([[0], np.cumsum(lens)[:-1]])
    windows = lens - LENGTH + 1
    row = np.repeat(np.arange(len(rows)), windows)
    k = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    place = np.array([r[3] & 255 for r in rows])[row] - k  # anchor less window start: equal windows have equal ones
    _, group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
    hit = repeated(data, offset[row] + k, group[row] * 1024 + place + 512)
    edge = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (row[1:] != row[:-1])]))
    last = np.flatnonzero(hit & np.concatenate([~hit[1:] | (row[1:] != row[:-1]), [True]]))
    return [(rows[i][1], rows[i][2], (rows[i][3] >> 16) + a, (rows[i][3] >> 16) + z + LENGTH) for i, a, z in zip(row[edge].tolist(), k[edge].tolist(), k[last].tolist())]


def place() -> Column:
    return F.xxhash64("k1", "k2", "start")


def again(df: DataFrame, *by: str) -> DataFrame:
    """The keys that two places or more have, and one of these, as a table: a join with it can be split where a key is hot."""
    return materialize(df.groupBy(*by).agg(F.min(place()).alias("one"), F.max(place()).alias("z")).filter("one <> z").drop("z"), "again")


def crowded(runs_: DataFrame) -> DataFrame:
    """(k1, k2, start, stop) of the repeated windows of crowded anchors' runs (k1, k2, run, bytes).

    The windows of a run go by blocks of STEP distances from the anchor. A
    block whose whole extent occurs again is repeated; one whose core, the bytes
    that all its windows have, doesn't occur again is not. What is between the
    two, the blocks at the ends of a shared passage, is counted by windows,
    with one block of each extent that occurs again.
    """

    def batched(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
        while some := list(islice(rows, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some)], names=names)

    def digest_of(data: bytes) -> tuple[int, int]:
        return unpack("<qq", hashlib.blake2b(data, digest_size=16).digest())

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for k1, k2, run, data in zip(*(c.to_pylist() for c in batch.columns)):
                    first, anchor, end, w = run >> 16, run & 255, (run >> 8 & 255) + 1, 0
                    while w < end:
                        last = anchor - (anchor - w) // STEP * STEP  # where the aligned block's last window begins
                        stop = min(end, last + 1)
                        yield digest_of(data[last : last - STEP + 1 + LENGTH])[0], *digest_of(data[w : stop - 1 + LENGTH]), k1, k2, run, first + w, stop - w
                        w = stop

        return batched(rows(), ["core", "w1", "w2", "k1", "k2", "run", "start", "n"])

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for k1, k2, run, data, open_ in zip(*(c.to_pylist() for c in batch.columns)):
                    for w in (w for b in open_ for w in range(b["start"], b["start"] + b["n"])):
                        at = w - (run >> 16)
                        yield *digest_of(data[at : at + LENGTH]), k1, k2, w

        return batched(rows(), ["w1", "w2", "k1", "k2", "start"])

    runs_ = runs_.select("k1", "k2", "run", "bytes")
    made = runs_.mapInArrow(blocks, "core long, w1 long, w2 long, k1 long, k2 long, run long, start long, n long")
    made = materialize(made, "blocks")
    near = made.join(again(made, "core").drop("one"), "core").join(again(made, "w1", "w2"), ["w1", "w2"], "left")
    settled = near.filter("one IS NOT NULL").select("k1", "k2", "start", (F.col("start") + F.col("n") - 1 + LENGTH).alias("stop"))
    wanted = near.filter(F.col("one").isNull() | (F.col("one") == place())).groupBy("k1", "k2", "run").agg(F.collect_set(F.struct("start", "n")).alias("blocks"))
    single = runs_.join(wanted, ["k1", "k2", "run"]).mapInArrow(windows, "w1 long, w2 long, k1 long, k2 long, start long")
    single = materialize(single, "windows")
    found = single.join(again(single, "w1", "w2").drop("one"), ["w1", "w2"])
    return settled.unionByName(found.select("k1", "k2", "start", (F.col("start") + LENGTH).alias("stop")))


def spans(texts: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(k1, k2, spans): the byte ranges to remove from each distinct text; overlaps aren't merged yet."""
    found = materialize(settle(anchors(texts), crowd), "runs")
    hot = found.filter(F.col("flag").bitwiseAND(HOT) != 0).select(F.col("kh").alias("hot")).distinct()
    to_ship = found.filter(F.col("flag").bitwiseAND(SHIP) != 0)
    crowds = hot.limit(1).count() > 0
    to_ship = to_ship.join(hot, F.col("kh") == F.col("hot"), "left").withColumn("crowd", F.col("hot").isNotNull()) if crowds else to_ship.withColumn("crowd", F.lit(False))
    wanted = to_ship.groupBy("k1", "k2").agg(F.collect_list(F.struct("run", "kh", "crowd")).alias("runs"))

    def ship(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for k1, k2, text, runs_ in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != last:
                    data = text.encode("utf-8")
                    out += [(r["kh"], k1, k2, r["run"], data[r["run"] >> 16 : (r["run"] >> 16) + (r["run"] >> 8 & 255) + LENGTH], r["crowd"]) for r in runs_]
                last = (k1, k2)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.binary(), pa.bool_()])], names=["kh", "k1", "k2", "run", "bytes", "crowd"])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush(now: list[tuple]) -> pa.RecordBatch | None:
            out = compare(now) if now else []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["k1", "k2", "start", "stop"]) if out else None

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and r[:4] == rows[-1][:4]:
                    continue
                if size >= SORT_BYTES and r[0] != rows[-1][0]:
                    if (b := flush(rows)) is not None:
                        yield b
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
        if (b := flush(rows)) is not None:
            yield b

    shipped = texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "runs").mapInArrow(ship, "kh long, k1 long, k2 long, run long, bytes binary, crowd boolean")
    shipped = materialize(shipped, "shipped")  # the texts are shuffled for it once, whatever reads it
    compared = shipped.filter("NOT crowd").drop("crowd").repartition("kh").sortWithinPartitions("kh", "k1", "k2", "run").mapInArrow(sort, "k1 long, k2 long, start long, stop long")
    start = F.shiftright("run", 16)
    settled = found.filter(F.col("flag").bitwiseAND(DUP) != 0).select("k1", "k2", start.alias("start"), (start + F.shiftright("run", 8).bitwiseAND(F.lit(255).cast("long")) + LENGTH).alias("stop"))
    copied = texts.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2", F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop"))
    if crowds:
        compared = compared.unionByName(crowded(shipped.filter("crowd")))
    return settled.unionByName(compared).unionByName(copied).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def cut(data: bytes, found: list[dict] | None) -> tuple[int, int, bytes]:
    """Bytes and maximal runs removed, and what is left."""
    n = len(data)
    if not found or n < LENGTH:
        return 0, 0, data
    out, removed, count, end = [], 0, 0, 0
    start = None
    for a, z in sorted((s["start"], n if s["stop"] < 0 else s["stop"]) for s in found):
        if start is None:
            start, stop = a, z
        elif a <= stop:
            stop = max(stop, z)
        else:
            out.append(data[end:start])
            removed, count, end, start, stop = removed + stop - start, count + 1, stop, a, z
    out += [data[end:start], data[stop:]]
    return removed + stop - start, count + 1, b"".join(out)


def with_keys(docs: DataFrame, *extra: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*keys(text), text.alias("text"), *extra)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digest(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """What goes from each document and the digest of what stays.

    Null and empty texts and texts under 200 bytes stay as they are; repeated
    rows are copies of each other, so their texts go from 200 bytes on; null
    ids give a row each and an empty table none.
    """
    small_batches(docs.sparkSession)
    found = spans(with_keys(docs), crowd)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8")
                removed, count, kept = cut(data, ranges)
                out.append((doc_id, len(data), removed, count, hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.string()])], names=[x.split()[0] for x in RESULT.split(", ")])

    joined = with_keys(docs, "doc_id").join(found, ["k1", "k2"], "left")
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans").mapInArrow(run, RESULT)


def remove(docs: DataFrame) -> DataFrame:
    """The documents less their repeated passages; characters cut in half go too, ``n_chars`` follows."""
    small_batches(docs.sparkSession)
    found = spans(with_keys(docs)).withColumnsRenamed({"k1": "_f1", "k2": "_f2", "spans": "_spans"})
    text = F.coalesce(F.col("text"), F.lit(""))
    k1, k2 = keys(text)
    keyed = docs.withColumns({"_k1": k1, "_k2": k2})
    joined = keyed.join(found, (F.col("_k1") == F.col("_f1")) & (F.col("_k2") == F.col("_f2")), "left").select(*docs.columns, "_spans")
    schema, names = docs.schema, docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            texts = cols["text"].to_pylist()
            kept = [t if not s or not t else cut(t.encode("utf-8"), s)[2].decode("utf-8", "ignore") for t, s in zip(texts, batch.column(len(names)).to_pylist())]
            changed = [k != t for k, t in zip(kept, texts)]
            cols["text"] = pa.array(kept, cols["text"].type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(k) if c else n for k, c, n in zip(kept, changed, cols["n_chars"].to_pylist())], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return joined.mapInArrow(run, schema)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
