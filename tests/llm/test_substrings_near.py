import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import near_dedup, substrings
from corpusloom.llm.components import components

from . import brute
from .conftest import texts_of


def compare(docs, **how):
    rows = texts_of(docs)
    data = [(t or "").encode("utf-8") for _, t in rows]
    want = Counter((d, *brute.removal(t, gone)) for (d, _), t, gone in zip(rows, data, brute.repeated_bytes(data)))
    got = substrings.digest(docs, **how).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_substrings(request, name):
    compare(request.getfixturevalue(name))


@pytest.mark.parametrize("seed", range(3))
def test_substrings_of_patchworks(spark, seed):
    """Texts cut from few passages at any place, so that repeats of 190 to 260 bytes abound."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab é" if seed == 2 else "abcdefgh ") for _ in range(900)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p, a = rng.choice(pool), rng.randrange(700)
            parts.append(p[a : a + rng.choice([150, 199, 200, 201, 230, 260, 700])] + rng.choice(["", "#", str(i)]))
        rows.append((i, "".join(parts)))
    rows.append((60, "z" * 1000 + pool[0] + "yz" * 300))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    compare(docs)
    compare(docs, crowd=1)


def test_crowded_anchors(spark):
    """A passage in the midst of texts that differ around it, with few and with many neighbourhoods to an anchor."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = word(210)
    rows = [(i, word(300) + passage[rng.randrange(8) :] + word(300)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for crowd in (3, 4096):
        compare(docs, crowd=crowd)


def test_long_text(spark, monkeypatch):
    """A text of several blocks that repeats a passage across their edges."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefghijklm ") for _ in range(300))
    for block in (400, 1000):
        monkeypatch.setattr(substrings, "BLOCK", block)
        parts = list(substrings.runs(("".join(rng.choice("nopqrst") for _ in range(700)) + passage + "x" * 30 + passage).encode()))
        starts = [s for _, _, first, more, _ in parts for f, m in zip(first, more) for s in range(f, f + m + 1)]
        assert sorted(starts) == list(range(700 + 630 - 199))


def test_suffix_sort():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 600).astype(np.uint8)
    segment = rng.integers(0, 4, 500)
    order = substrings.Suffixes(data, 50).sort(np.arange(500), segment)
    assert order.tolist() == sorted(range(500), key=lambda i: (segment[i], data[i : i + 50].tobytes(), i))


def test_none(empty):
    assert substrings.digest(empty).count() == 0 and substrings.remove(empty).count() == 0 and near_dedup.classes(empty).count() == 0 and near_dedup.representatives(empty).count() == 0


@pytest.mark.parametrize("name", ["odd", "twice"])
def test_removal_keeps_columns(request, name):
    docs = request.getfixturevalue(name)
    rows = texts_of(docs)
    data = [(t or "").encode("utf-8") for _, t in rows]
    want = Counter()
    for (d, t), b, gone in zip(rows, data, brute.repeated_bytes(data)):
        want[(d, t if t is None else bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))] += 1
    got = substrings.remove(docs)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want


def partition(pairs):
    of = defaultdict(set)
    for member, c in pairs:
        of[c].add(member)
    return {frozenset(x) for x in of.values()}


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_near_classes(request, name):
    docs = request.getfixturevalue(name)
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    want = partition((rows[i][0], c) for i, c in enumerate(brute.near_classes([t for _, t in rows])))
    got = near_dedup.classes(docs).collect()
    assert partition((r["doc_id"], r["class_id"]) for r in got) == want
    sizes = {d: len(c) for c in want for d in c}
    assert all(r["class_size"] == sizes[r["doc_id"]] for r in got)
    assert all(r["class_id"] == min([d for d in c if d is not None], default=None) for c in want for r in got if r["doc_id"] in c)
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(min([d for d in c if d is not None], default=None) for c in want)


def test_near_copies_of_many_edits(spark):
    """Words replaced, added, dropped and moved at both ends, up to a tenth: found; half of them: not."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(120):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(60, 400))]
        share = rng.choice([0.02, 0.05, 0.1, 0.5])
        copy = []
        for w in base:
            x = rng.random()
            copy += [] if x < share / 3 else [w, "added"] if x < share / 3 * 2 else [f"x{rng.randrange(4000)}"] if x < share else [w]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
        want[2 * i + 1] = brute.alike(rows[-1][1], rows[-2][1])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[d] in (d, d - 1) for d in want) and not any(got[d] == d - 1 and not w for d, w in want.items())
    assert sum(got[d] == d - 1 for d, w in want.items() if w) >= 0.95 * sum(want.values())
    assert sum(want.values()) >= 60


@pytest.mark.parametrize("rows", [3, 7, 2048])
def test_banded_alignment(rows):
    """The banded table gives the longest common subsequence wherever that has 0.8 of the longer text."""
    rng, seen = random.Random(8), Counter()
    for _ in range(300):
        a = [rng.randrange(rng.choice([3, 500])) for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(0, 1 + len(a) // 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice([0, 1])] = [rng.randrange(500)] * rng.choice([0, 1, 2])
        want = brute.alike(" ".join(map(str, a)), " ".join(map(str, b)))
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        n = max(len(a), len(b))
        assert near_dedup.alike(x, y) == want and (near_dedup.aligned(x, y, n // 5, rows) >= -(-4 * n // 5)) == want
        seen[want] += 1
    assert min(seen.values()) > 30


def test_moved_halves_are_no_copies(spark):
    """Order counts: the same shingles in another order aren't aligned."""
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join(words[100:] + words[:100])), (2, " ".join(words * 10)), (3, " ".join(words[:95] + words[96:]))]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 0}


def test_near_copies_of_a_long_text(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(30_000)}" for _ in range(120_000)]
    copy = [w if rng.random() > 0.04 else "changed" for w in words]
    rows = [(0, " ".join(words)), (1, " ".join(copy)), (2, " ".join(words[:80_000]))]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_near_repeated_rows(twice, odd):
    assert near_dedup.classes(twice).count() == twice.count()
    assert near_dedup.representatives(twice).count() == near_dedup.representatives(odd).count()


def test_near_links_in_a_crowd(spark):
    """Pairs of near copies among many texts that share their most telling passage."""
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = [f"o{i}v{rng.randrange(9999)}" for _ in range(90)]
        rows.append((2 * i, " ".join(own[:45] + shared + own[45:])))
        rows.append((2 * i + 1, " ".join(own[:45] + shared + own[45:-3] + ["other", "end"])))
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(d, d - d % 2) for d in range(300)}


def test_components(spark):
    chain = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 40)] + [("900", "901"), ("902", "901"), ("950", "950")]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "u string, v string")).collect()}
    assert got == {f"{i:03}": "000" for i in range(41)} | {"900": "900", "901": "900", "902": "900"}
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


@pytest.mark.parametrize("block", [256, 40])
def test_near_hub_and_spokes(spark, monkeypatch, block):
    """Copies that are alike to their base and not to each other are in its class, wherever the base stands in their groups."""
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
    rng = random.Random(21)
    base = [f"b{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 301):
        copy = list(base)
        for k, at in enumerate(rng.sample(range(5, 295), 32)):
            copy[at] = f"c{i}x{k}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join([*base[:60], *(f"d{i}w{k}" for k in range(60))])) for i in range(50)]
    want = {d: 0 if d < 1000 else d for d, _ in rows}
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_blocks_verify_as_pairs_do():
    """The links of all pairs of two blocks are those of each pair, with repeats and moved passages."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(60):
        t = rng.choice(texts).split(" ") if texts and rng.random() < 0.7 else [rng.choice(words[: rng.choice([6, 40])]) for _ in range(rng.randrange(1, 90))]
        if rng.random() < 0.3:
            t = t * rng.randrange(1, 4)
        for _ in range(rng.randrange(3)):
            t = t[:-1] + [rng.choice(words)] if rng.random() < 0.5 else t[len(t) // 2 :] + t[: len(t) // 2]
        texts.append(" ".join(t))
    rows = [(bytes([i]), bytes([i]), near_dedup.word_hashes(t)) for i, t in enumerate(dict.fromkeys(texts))]
    texts = list(dict.fromkeys(texts))
    link = [(i, j) for i in range(len(rows)) for j in range(i) if brute.alike(texts[i], texts[j])]
    assert len(link) > 10

    def parts(pairs):
        of = list(range(len(rows)))
        for a, b in pairs:
            of = [of[a] if x == of[b] else x for x in of]
        return [of.index(x) for x in of]

    half = len(rows) // 2
    a, b = rows[:half], rows[half:]
    assert parts((x[0], y[0]) for x, y in near_dedup.linked(rows, rows)) == parts(link)
    assert parts((x[0], y[0]) for x, y in near_dedup.linked(a, b)) == parts((i, j) for i, j in link if (i < half) != (j < half))
