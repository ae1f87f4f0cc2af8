import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import bpe, packing
from corpusloom.llm.tokenizer import encoding_of, public_path, ranks_of, split_pattern

from . import brute
from .conftest import texts_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def reference_encoder():
    import tiktoken

    path = public_path("byte_bpe_50k.tiktoken")
    return tiktoken.Encoding("t", pat_str=split_pattern(), mergeable_ranks=ranks_of(path), special_tokens={})


def fuzz(n: int) -> list[str]:
    rng = random.Random(7)
    alphabet = [*"abcdeé ß\n\t\r '’.,!?0129ſ", " ", " ", "\x85", "\x0b", "日本", "😀", "👩‍👩‍👧", "á", "​", "'ll", "'S", "  ", " \n ", "the ", "<|endoftext|>", "﻿", "ัก", "א", "ع"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_packing(request, library, name):
    docs = request.getfixturevalue(name)
    rows = packing.pack(docs).collect()
    want = Counter()
    for doc_id, text in texts_of(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if k == 0 else start + 1024]
            want[(doc_id, k, start, len(part), brute.crc32_ids(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(3 * n > 1024 for places in bins.values() for _, n in places) == sum(3 * r["length"] > 1024 for r in rows)
    assert all(sum(3 * n > 1024 for _, n in places) <= 2 for places in bins.values())
    total = sum(r["length"] for r in rows)
    assert len(bins) <= 1.1 * -(-total // 1024) + 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((fit or capacity) - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 101), rng.randrange(1, 30), rng.randrange(34, 70)]) for _ in range(800)]
    plan = packing.Plan(Counter(lengths), 100)
    used = np.zeros(plan.bins, int)
    for n, c in Counter(lengths).items():
        e = plan.events[n]
        for rank in range(c):
            first_rank, first_bin, each, offset = max(x for x in e if x[0] <= rank)
            used[first_bin + (rank - first_rank) // each] += n
    assert used.max() <= 100 and used.sum() == sum(lengths)
    assert plan.bins <= 1.02 * best_fit_decreasing(lengths, 100) + 1


def test_packing_none(empty):
    assert packing.pack(empty).count() == 0


def test_tokenizers_and_tiktoken_agree(library):
    fast = encoding_of(public_path("byte_bpe_50k.json"))
    for text in fuzz(3000):
        assert fast.encode_ordinary(text) == library.encode(text, add_special_tokens=False).ids, json.dumps(text)


def test_transducer(reference_encoder):
    encoder, stream = bpe.machines(public_path("byte_bpe_50k.tiktoken"))
    for text in fuzz(4000):
        ids = encoder.encode(text)
        assert ids == reference_encoder.encode_ordinary(text), json.dumps(text)
        assert stream.text(np.array(ids, np.int64)) == text and "".join(stream.decode(ids)) == text


def test_transducer_bytes(reference_encoder):
    """Single pieces of any bytes, among them long runs and half characters."""
    machine, rng = bpe.machines(public_path("byte_bpe_50k.tiktoken"))[0].machine, random.Random(3)
    for _ in range(3000):
        data = bytes(rng.choice(rng.choice([b"abcdefghij", b"etaoinshr", b" -=_*", bytes(range(256))])) for _ in range(rng.randrange(1, 40)))
        assert machine.encode(data) == reference_encoder._encode_single_piece(data)


def test_bounded_lookahead():
    """Tokens come out before the end: what is pending stays short however long the piece."""
    machine = bpe.machines(public_path("byte_bpe_50k.tiktoken"))[0].machine
    machine.encode(b"internationalization" * 200)
    s, longest, emitted = 0, 0, 0
    for byte in b"internationalization" * 200:
        move = machine.table[s, machine.classes[byte]]
        s, emitted = machine.to[move], emitted + machine.count[move]
        longest = max(longest, len(machine.known[s][1]))
    assert longest <= 2 * max(map(len, machine.ranks)) and emitted


def test_transducer_starts_anew(reference_encoder):
    """Texts cut into groups, a memo of few words and a table of few states give the same ids."""
    encoder = bpe.Encoder(public_path("byte_bpe_50k.tiktoken"), memo=20)
    encoder.machine.max_states, encoder.GROUP, encoder.PIECES = 50, 60, 7
    texts = [*fuzz(1000), " ".join(fuzz(300)), "word " * 2000, "a" * 3000 + " " + "b c" * 900]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.packed(texts)] == [reference_encoder.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("data", [b"\xe2\x82", b"\xf0\x9f\x98", b"a\xc3(", b"\xff\xfe", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe2\x82\xacx"])
def test_streaming_utf8(data):
    stream = bpe.Utf8Stream({i: bytes((i,)) for i in range(256)})
    assert "".join(stream.decode(data)) == stream.text(np.frombuffer(data, np.uint8)) == data.decode("utf-8", "replace")


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_round_trip(request, reference_encoder, name):
    docs = request.getfixturevalue(name)
    want = Counter()
    for doc_id, text in texts_of(docs):
        ids = reference_encoder.encode_ordinary(text or "")
        want[(doc_id, len(ids), brute.sha256(np.array(ids, "<u4").tobytes()), brute.sha256(text or ""))] += 1
    got = bpe.round_trip(docs).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_round_trip_none(empty):
    assert bpe.round_trip(empty).count() == 0


def test_added_tokens_inside_texts(spark):
    """The library's defaults take an added token's literal for its id."""
    from tokenizers import Tokenizer

    path = public_path("byte_bpe_50k.json")
    default, fast = Tokenizer.from_file(path), encoding_of(path)
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "a<|endoftext|", "x <|endoftext|>\n y", *fuzz(3000)]
    for text in texts:
        assert fast.encode(text, allowed_special="all") == default.encode(text, add_special_tokens=False).ids, json.dumps(text)
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")).collect()
    want = {d: [*default.encode(t, add_special_tokens=False).ids, 2] for d, t in enumerate(texts[:40])}
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {d: (len(x), brute.crc32_ids(x)) for d, x in want.items()}
