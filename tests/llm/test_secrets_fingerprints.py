from collections import Counter

import pytest

from corpusloom.llm import fingerprints, secrets

from . import brute
from .conftest import texts_of


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_base_secrets(request, name):
    docs = request.getfixturevalue(name)
    want = Counter()
    for doc_id, text in texts_of(docs):
        counts, shown = brute.base_secrets(text)
        want[(doc_id, *counts, brute.sha256(shown))] += 1
    got = secrets.scan(docs).collect()
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    base = {d: set(filter(None, brute.base_secrets(t)[1].split(","))) for d, t in texts_of(docs)}
    assert all(base[r["doc_id"]] <= set(r["spans"].split(",")) | {""} for r in got)


def test_no_secrets(empty):
    assert secrets.scan(empty).count() == 0 and secrets.redact(empty).count() == 0


def test_ownership(spark):
    live, copied = "ghp_" + "aB3" * 8, "ghp_" + "cD4" * 8
    rows = [(1, f"use {live}", "a", "en"), (2, f"again {live}", "a", "fr")] + [(i, f"an example {copied} here", f"o{i}", "en") for i in range(3, 7)] + [(9, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert got[1]["spans"] == f"owned:4:{4 + len(live)}" and got[1]["n_live"] == 1
    assert got[3]["spans"] == "" and got[9]["spans"] == ""
    found = secrets.candidates(docs, ["source"], ["source", "lang"]).withColumn("hash", secrets.value_hash())
    assert {(r["n_owners"], r["n_repos"]) for r in secrets.ownership(found).collect()} == {(1, 2), (4, 4)}


def test_redaction(odd, odd_rows):
    got = {r["doc_id"]: r for r in secrets.redact(odd).collect()}
    for doc_id, text, *_ in odd_rows:
        if not brute.base_secrets(text)[1]:
            assert got[doc_id]["text"] == text
    text = next(t for _, t, *_ in odd_rows if t and t.startswith("password = hunter2"))
    masked = next(r for r in got.values() if r["text"] and r["text"].endswith(" <SECRET>"))
    assert masked["text"].startswith("<SECRET> and API_KEY: 'abc' <SECRET>") and masked["n_chars"] == len(masked["text"]) < len(text)
    assert secrets.redact(odd).columns == odd.columns


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_winnowing(request, name):
    rows = sorted(texts_of(request.getfixturevalue(name)), key=lambda r: (r[0] is not None, r[0] or 0))
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(request.getfixturevalue(name)).collect()}
    assert len(got) == len(rows)
    shown = lambda f: ",".join(f"{h:x}@{p}" for h, p in f)
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        new = brute.edited(text, following)
        own, other, nxt = brute.winnow(text), brute.winnow(new), brute.winnow(following)
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha256(new))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own), shown(other))
        a, b, c = ({h for h, _ in f} for f in (own, other, nxt))
        assert r["near_edited"] == pytest.approx(brute.jaccard(a, b)) and r["near_next"] == pytest.approx(brute.jaccard(a, c))


def test_winnowing_repeats_and_none(twice, empty, odd_rows):
    got = fingerprints.fingerprint(twice)
    assert got.count() == len(odd_rows) + 10
    assert fingerprints.fingerprint(empty).count() == 0


def test_winnowing_guarantee(spark):
    """A shared passage of k + w - 1 words gives a common fingerprint."""
    shared = " ".join(f"s{i}" for i in range(fingerprints.K + fingerprints.WINDOW - 1))
    rows = [(1, " ".join(f"a{i}" for i in range(90)) + " " + shared), (2, shared + " " + " ".join(f"b{i}" for i in range(70)))]
    got = fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["near_next"] > 0 for r in got)
