"""Near duplicates by Order MinHash.

Texts are lower-cased words; their k-mers are of five words. A k-mer is
labelled with its occurrence number, each of several sketches takes the two
labelled k-mers with the least seeded hashes and keeps them in the order of
the text, so equal sketches speak for few edits and not just for common
k-mers. Texts that share a sketch are candidates: each with the least of its
group and with its neighbour in it first. A group is sorted by its texts' next
sketch, so that in a crowd that shares no more than one passage, texts that are
alike beyond it stand side by side. Where that leaves the texts of a group in
more than one class, all its pairs are verified, in blocks of a bounded size.

Every candidate is verified by a banded alignment of the words of both texts:
the words that a longest common subsequence pairs, as a share of the longer
text's, must be 0.8 or more. Such an alignment can't leave the diagonals that
are 0.2 of the longer text apart from the main one, so the band loses nothing.
Classes are the connected components of the verified links.

A pair whose five-word shingles have a likeness of J shares a sketch with
probability J * J. With a share e of words replaced one by one J is about
q / (2 - q), q = (1 - e) ** 5: all of 32 sketches miss it with probability
1e-9 at 4 % of the words, 6e-4 at 9 %, 0.07 at 15 %, 0.29 at the threshold of
20 % (measured on 1500 pairs each: 0, 0, 0.07, 0.31); edits that stand together
break fewer shingles and are missed less.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from .common import bloom_filtered, forget, materialize, small_batches, table
from .components import components

K, SIMILAR, SKETCHES, MINIMA = 5, 0.8, 32, 2
#: Texts and words of a block of an open group, about.
BLOCK_TEXTS, BLOCK_WORDS = 256, 200_000
#: Bands whose open groups are settled together; what the first ones link is no longer open in the next.
ROUNDS = ((0, 2), (2, SKETCHES))
#: Parts that the nodes of a class are dealt into where class figures are joined back.
SALTS = 32
U = np.uint64
_WORD = re.compile(r"\w+").findall
_SEEDS = np.random.default_rng(20240607).integers(1, 1 << 63, SKETCHES, dtype=np.int64).astype(U) | U(1)
_MIX = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0xFF51AFD7ED558CCD)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, in order."""
    words = _WORD(text.lower())
    return np.fromiter(map(xxh3_64_intdigest, words), U, len(words))


def unpacked(words: bytes) -> np.ndarray:
    """Word hashes as they are shipped, of 32 bits: less than the text, and two words of a pair of texts seldom share one."""
    return np.frombuffer(words, np.uint32).astype(U)


def kmers(h: np.ndarray) -> np.ndarray:
    """Hashes of all five-word shingles of a text's words; a shorter text is one shingle, a text without words has none."""
    n = len(h) - K + 1
    if n < 1:
        return mix(np.add.reduce(h * np.arange(1, len(h) + 1, dtype=U), keepdims=True)) if len(h) else h
    total = np.zeros(n, U)
    for k in range(K):
        total = mix(total + h[k : k + n] * _MIX[k])
    return total


def occurrences(hashes: np.ndarray) -> np.ndarray:
    """How often each came before."""
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], s[1:] != s[:-1]]), np.arange(len(s)), 0))
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(len(s)) - start
    return out


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes with their occurrence number, all different in a text."""
    return mix(hashes + occurrences(hashes).astype(U) * U(0x9E3779B97F4A7C15)) if len(hashes) else hashes


def sketches(shingles: np.ndarray) -> np.ndarray:
    """A number for each sketch, of its minima of the labelled k-mers in the order of the text."""
    marks = labelled(shingles)
    v = marks[None, :] * _SEEDS[:, None]  # marks are mixed and seeds odd: another order of them for each
    at = np.empty((SKETCHES, min(MINIMA, len(marks))), np.int64)
    for k in range(at.shape[1]):
        at[:, k] = v.argmin(axis=1)
        v[np.arange(SKETCHES), at[:, k]] = ~U(0)
    out = _SEEDS.copy()
    for m in marks[np.sort(at, axis=1)].T:
        out = out * U(0x9E3779B97F4A7C15) + m
    return out


def aligned(a: np.ndarray, b: np.ndarray, band: int, rows: int = 2048) -> int:
    """Words that the best alignment pairs inside the band of diagonals, for two arrays of word hashes.

    A row of the table is one integer, whose zero bits are the columns at which
    the alignment gains a word; a row follows from the one before by an addition
    (the bit-parallel form of the longest common subsequence). Rows go by
    chunks, each over the columns that the band gives it and no others.
    """
    gained, row, low, wide = 0, 0, 0, 0
    of: dict[int, int]
    words_a, words_b = a.tolist(), b.tolist()
    for first in range(0, len(words_b), rows):
        chunk = words_b[first : first + rows]
        start, stop = max(low, min(first - band, len(words_a))), min(len(words_a), first + len(chunk) + band)
        if start >= stop:
            break
        gone = start - low  # columns that the band has left for good
        gained += gone - (row & (1 << gone) - 1).bit_count()
        row >>= gone
        wide -= gone
        low = start
        row |= (1 << stop - low) - (1 << wide)
        wide = stop - low
        of, bit, full = {}, 1, (1 << wide) - 1
        for w in words_a[low:stop]:
            of[w] = of.get(w, 0) | bit
            bit <<= 1
        for w in chunk:
            m = of.get(w)
            if m is not None:
                x = row & m
                row = (row + x | row - x) & full
    return gained + wide - row.bit_count()


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common, repeats counted: no alignment pairs more."""
    return len(np.intersect1d(a, b, assume_unique=True))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether a banded alignment of two texts' words pairs 0.8 of the longer one's."""
    n = max(len(a), len(b))
    least = -(-n * 4 // 5)
    if not n or min(len(a), len(b)) < least:
        return False
    head = np.flatnonzero(a[: len(b)] != b[: len(a)])
    if not len(head):
        return True
    start, both = int(head[0]), min(len(a), len(b))
    tail = np.flatnonzero(a[len(a) - both + start :][::-1] != b[len(b) - both + start :][::-1])
    same = int(tail[0]) if len(tail) else both - start  # equal words at the ends are paired in some best alignment
    return start + same + aligned(a[start : len(a) - same], b[start : len(b) - same], n - least) >= least


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketched(docs: DataFrame) -> DataFrame:
    """(node, n, sketches, words) of each text with words, nodes being 128-bit digests; copies repeat."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            out: tuple[list, ...] = ([], [], [], [])
            room = 1 << 22
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node not in seen and len(h := word_hashes(text)):
                    seen.add(node)
                    for c, x in zip(out, (node, len(h), sketches(kmers(h)).view(np.int64), h.astype(np.uint32).tobytes())):
                        c.append(x)
                    room -= len(h)
                    if room < 0:
                        yield made(out)
                        out, room = ([], [], [], []), 1 << 22
            if out[0]:
                yield made(out)

    def made(out: tuple[list, ...]) -> pa.RecordBatch:
        values = pa.array(np.concatenate(out[2]))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out[0]) + 1, dtype=np.int32) * SKETCHES), values)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), lists, pa.array(out[3], pa.binary())], names=["node", "n", "sketches", "words"])

    texts = docs.select(node_of(F.col("text")).alias("node"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return materialize(texts.mapInArrow(run, "node binary, n int, sketches array<long>, words binary"), "texts")


def grouped(texts: DataFrame) -> DataFrame:
    """(band, sketch, after, node, n, least) of the texts that share a sketch with another one."""
    once = texts.groupBy("node").agg(F.first("n").alias("n"), F.first("sketches").alias("s"))
    rows = once.select("node", "n", "s", F.posexplode("s").alias("band", "sketch"))
    rows = rows.select("band", "sketch", F.get("s", F.pmod(F.col("band") + 1, F.lit(SKETCHES))).alias("after"), "node", "n")
    rows = materialize(rows, "sketches")
    groups = rows.groupBy("band", "sketch").agg(F.min("node").alias("least"), F.count("*").alias("size")).filter("size > 1")
    groups = materialize(groups, "groups")
    with bloom_filtered(texts.sparkSession):  # sketches are of 64 bits and seeded by their band, so they are a key without it
        out = materialize(rows.join(groups.filter("size > 1").select("sketch", "least"), "sketch").select("band", "sketch", "after", "node", "n", "least"), "shared")
    forget(rows, groups)
    return out


def candidates(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of different texts that share a sketch: each text with the least of its group and with its neighbour."""
    star = shared.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if last and last[:2] == row[:2]:
                    out.append((last[3], row[3]))
                last = row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])

    # neighbours in a group: a range sort may cut a group anywhere, so a hot one spans tasks
    order = ["band", "sketch", "after", "node"]
    near = shared.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chain, "a binary, b binary")
    return star.union(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Links (u, v) among the pairs. ``words`` has a row for each node; both joins are of plain exchanges, which adaptive execution splits where a text has many partners."""
    left = pairs.join(words.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("words").alias("wb")), "b")
    both = left.join(words.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("words").alias("wa")), "a")
    both = both.filter(F.least("na", "nb") >= F.lit(SIMILAR) * F.greatest("na", "nb")).select("a", "b", "wa", "wb")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: bytes | None = None
        for batch in batches:
            out = []
            for a, b, wa, wb in zip(*(c.to_pylist() for c in batch.columns)):
                if a != last:
                    ha, last = unpacked(wa), a
                    la = labelled(ha)
                hb = unpacked(wb)
                if 5 * common_words(la, labelled(hb)) >= 4 * max(len(ha), len(hb)) and alike(ha, hb):
                    out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["u", "v"])

    return both.mapInArrow(run, "u binary, v binary")


def opened(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(band, sketch, node, n, label, size, total) of the groups whose texts are in more than one class; of groups of the same texts, one."""
    named = shared.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    same = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    sizes = [F.count("*").alias("size"), F.sum("n").alias("total"), F.min("label").alias("lo"), F.max("label").alias("hi")]
    groups = named.groupBy("band", "sketch").agg(*sizes, *same).filter("size > 2 AND lo <> hi")
    once = groups.groupBy("size", "x", "y").agg(F.min(F.struct("band", "sketch", "total")).alias("g")).select("g.*", "size")
    return named.join(once, ["band", "sketch"]).select("band", "sketch", "node", "n", "label", "size", "total")


def common(rows: list[np.ndarray], cols: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many hashes each of ``rows`` has in common with each of ``cols``; all have distinct hashes."""
    out = np.zeros((len(rows), len(cols)), np.float32)
    (r, a), (c, b) = ((np.repeat(np.arange(len(x)), [len(h) for h in x]), np.concatenate(x)) for x in (rows, cols))
    both = np.intersect1d(a, b)
    sides = []
    for own, hashes in ((r, a), (c, b)):
        at = np.searchsorted(both, hashes)
        at[at == len(both)] = 0
        hit = both[at] == hashes if len(both) else np.zeros(len(hashes), bool)
        own, at = own[hit], at[hit]
        order = np.argsort(at, kind="stable")
        sides.append((own[order], at[order]))
    for first in range(0, len(both), width):
        dense = []
        for (own, at), n in zip(sides, out.shape):
            lo, hi = np.searchsorted(at, [first, first + width])
            m = np.zeros((n, min(width, len(both) - first)), np.float32)
            m[own[lo:hi], at[lo:hi] - first] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def linked(left: list[tuple], right: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
    """Labels whose classes are linked by two blocks of (node, label, words): all pairs of different classes are verified, links that change no class are left out."""
    one = left is right
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    names_a, names_b = (np.unique(np.array([row[1].hex() for row in left + right]), return_inverse=True)[1][part] for part in (slice(0, len(left)), slice(len(left), None)))
    other = names_a[:, None] != names_b[None, :]
    if one:
        other = np.triu(other)
    if not other.any():
        return
    la = [labelled(r[2]) for r in left]
    lb = la if one else [labelled(r[2]) for r in right]
    longer = np.maximum(np.array([len(x) for x in la])[:, None], np.array([len(x) for x in lb])[None, :])
    maybe = other & (5 * common(la, lb).astype(np.int64) >= 4 * longer)  # no alignment pairs more words than both texts have
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(maybe))):
        x, y = root(left[i][1]), root(right[j][1])
        if x != y and alike(left[i][2], right[j][2]):
            parent[x] = y
            yield left[i][1], right[j][1]


def settled(members: DataFrame, words: DataFrame) -> DataFrame:
    """Linked labels (u, v) of open groups, whose texts are dealt into blocks; each pair of blocks meets once."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_TEXTS), F.ceil(F.col("total") / BLOCK_WORDS)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", "sketch"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["band", "sketch", "i", "j"]
    met = met.select("band", "sketch", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "node", "label")
    rows = met.join(words.select("node", "words"), "node").select(*key, "own", "node", "label", "words")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last: tuple | None = None

        def links() -> Iterator[pa.RecordBatch]:
            i, j = last[2:]
            left = [r[1:] for r in held if r[0] == i]
            right = left if i == j else [r[1:] for r in held if r[0] == j]
            if left and right and (out := list(linked(left, right))):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["u", "v"])

        for batch in batches:
            for *row, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(row[:4]) != last:
                    if held:
                        yield from links()
                    held, last = [], tuple(row[:4])
                held.append((*row[4:], unpacked(raw)))
        if held:
            yield from links()

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "u binary, v binary")


def labels(docs: DataFrame) -> DataFrame:
    """(node, label) of every text that is like another one."""
    small_batches(docs.sparkSession)
    texts = sketched(docs)
    shared = grouped(texts)
    sharing = materialize(shared.groupBy("node").agg(F.count("*").alias("times")), "sharing")
    with bloom_filtered(docs.sparkSession):  # few texts share a sketch, and words are most of what could be shipped
        met = texts.join(sharing.filter("times > 0").select("node"), "node")
        words = materialize(met.groupBy("node").agg(F.first("n").alias("n"), F.first("words").alias("words")), "words")
    forget(texts)
    found = materialize(components(verified(candidates(shared), words)), "labels")
    left = materialize(opened(shared, found).select("band", "sketch", "node", "n"), "open")
    forget(shared, sharing)
    if left.isEmpty():
        return found
    for first, end in ROUNDS:
        members = materialize(opened(left.filter(F.col("band").between(first, end - 1)), found), "members")
        if members.isEmpty():
            continue
        links = materialize(settled(members, words), "class-links")
        forget(members)
        if links.isEmpty():
            continue
        moved = materialize(components(links), "moved")
        kept = found.join(moved.select(F.col("node").alias("label"), F.col("label").alias("least")), "label", "left").select("node", F.coalesce("least", "label").alias("label"))
        before, found = found, materialize(kept.union(moved.join(found, "node", "left_anti").select("node", "label")), "labels")
        forget(before, moved, links)
    forget(left, words)
    return found


def class_figures(docs: DataFrame) -> DataFrame:
    """(node, label, own_least, class_id, class_size) of each different text.

    Documents are summed by text before anything is joined, and the texts of a
    class are dealt into parts where the class's figures are joined back, so
    neither copies nor near copies by the million meet in one task.
    """
    found = labels(docs)
    per = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(F.col("text")).alias("node"))
    per = materialize(per.groupBy("node").agg(F.min("doc_id").alias("own_least"), F.count("*").alias("copies")), "copies")
    members = per.join(found, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    members = materialize(members.select("node", "label", "salt", "own_least", "copies"), "classed")
    sums = members.groupBy("label", "salt").agg(F.min("own_least").alias("m"), F.sum("copies").alias("c"))
    sums = sums.groupBy("label").agg(F.min("m").alias("class_id"), F.sum("c").alias("class_size"))
    dealt = materialize(sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "sums")
    named = members.join(dealt, ["label", "salt"]).select("node", "label", "class_id", "class_size")
    alone = F.col("label").isNull()
    out = per.join(named, "node", "left").select(
        "node",
        "own_least",
        F.when(alone, F.col("own_least")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("copies")).otherwise(F.col("class_size")).alias("class_size"),
        F.coalesce("label", "node").alias("label"),
    )
    out = materialize(out, "figures")
    forget(found, per, members, dealt)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """Class and class size of each document, copies included; the class is named by its least doc_id.

    Null and empty texts are copies of each other, as are other texts without
    words that are the same; repeated rows share a class. A class of null ids
    alone has a null name. An empty table gives no rows.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(F.col("text")).alias("node"))
    return named.join(class_figures(docs).select("node", "class_id", "class_size"), "node").select("doc_id", "class_id", "class_size")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the least doc_id; its columns are untouched.

    Null texts count as empty ones and stay null; a class of null ids alone
    keeps one of them, and of repeated rows one stays. An empty table gives no
    rows.
    """
    key = lambda c: [F.col(c).isNull().alias("_none"), F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias("_id")]
    order = F.struct(F.col("own_least").isNull(), "own_least", "node")
    first = class_figures(docs).groupBy("label").agg(F.min_by(F.struct("node", "own_least"), order).alias("f")).select(F.col("f.node").alias("_node"), F.col("f.own_least").alias("_least"))
    first = first.select("_node", *key("_least"))
    named = docs.select(node_of(F.col("text")).alias("_node"), *key("doc_id"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)])
    # dealt by text and id, so copies of a text are spread; of rows that are still the same one stays
    kept = named.join(first, ["_node", "_none", "_id"]).dropDuplicates(["_node", "_none", "_id"])
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op7_order_minhash(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
