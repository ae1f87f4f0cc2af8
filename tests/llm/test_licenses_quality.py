import math
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import licenses, quality

from . import brute
from .conftest import texts_of


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_base_licenses(request, name):
    docs = request.getfixturevalue(name)
    want = Counter((d, *brute.base_licenses(t)) for d, t in texts_of(docs))
    got = licenses.scan(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    for r in got:
        assert 0 <= r["score"] <= 1
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert r["labels"].split(",") == sorted(set(r["labels"].split(",")))
        assert (r["score"] > 0) == (r["labels"] != "")


def cover(words: list[str], template: list[str]) -> float:
    """Best cover of a template's words by the grams of one diagonal."""
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    diagonals = defaultdict(set)
    for p in range(len(template) - 4):
        for i in at[tuple(template[p : p + 5])]:
            diagonals[i - p] |= set(range(p, p + 5))
    return max(map(len, diagonals.values()), default=0) / len(template)


@pytest.mark.parametrize("name", ["odd", "documents"])
def test_diagonals_cover_the_single_ones(request, name):
    """Labels of the method hold every template that one diagonal covers to 0.8."""
    docs = request.getfixturevalue(name)
    got = {r["doc_id"]: set(r["labels"].split(",")) - {""} for r in licenses.scan(docs).collect()}
    for d, text in texts_of(docs):
        words = brute.license_words(text)
        want = {label for label, t in licenses.TEMPLATES if len(brute.license_words(t)) >= 5 and cover(words, brute.license_words(t)) >= 0.8}
        base = set(brute.base_licenses(text)[4].split(",")) - {""}
        assert want | base <= got[d]
        if not want | base:
            assert not got[d]


def test_neighbouring_diagonals_merge(spark):
    t = dict(licenses.TEMPLATES)["bsd"].split(" ")
    rows = [(1, " ".join(["intro"] * 9 + t[:10] + ["really"] + t[10:])), (2, " ".join(t[:8])), (3, " ".join(t[:8] + ["x"] * 50 + t[8:])), (4, " ".join(t[:11] + t[12:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()} == {1: "bsd", 2: "", 3: "", 4: "bsd"}
    span = licenses.spans(docs.filter("doc_id = 1")).collect()[0]
    assert (span["first_word"], span["end_word"]) == (9, 9 + len(t) + 1)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.mark.parametrize("name", ["odd", "twice", "documents"])
def test_rules(request, labels, name):
    docs = request.getfixturevalue(name)
    want = Counter((d, *brute.quality(t)) for d, t in texts_of(docs))
    got = quality.judge(docs, labels).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_verdicts(documents, labels):
    """Ratios and verdicts counted anew, one text after the other."""
    rows = texts_of(documents)
    marks = defaultdict(list)
    for r in labels.collect():
        marks[r["doc_id"]].append((r["quality"], r["toxic"]))
    trusted = {d for d, m in marks.items() if min(q for q, _ in m) == 1 and max(t for _, t in m) == 0}
    raw, target = Counter(), Counter()
    for d, text in rows:
        g = quality.grams((text or "").encode()).tolist()
        raw.update(g)
        if d in trusted:
            target.update(g)
    share = sum(target.values()) / sum(raw.values())
    got = {r["doc_id"]: r for r in quality.judge(documents, labels).collect()}
    for d, text in rows:
        g = quality.grams((text or "").encode()).tolist()
        llr = sum(math.log(target[x] + quality.PRIOR) - math.log(raw[x] * share + quality.PRIOR) for x in g) / len(g) if g else 0.0
        assert got[d]["llr"] == pytest.approx(llr, abs=1e-9)
        assert got[d]["kept"] == (not brute.quality(text)[5] and llr >= quality.THRESHOLD)


def test_verdicts_follow_the_labels(documents, labels):
    got = {r["doc_id"]: r["kept"] for r in quality.judge(documents, labels).collect()}
    good = [r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]]
    assert sum(got[d] for d in good if d in got) >= 0.9 * sum(d in got for d in good)


def test_keep_columns(twice, empty, labels):
    kept = quality.judge(twice, labels, keep_columns=True)
    assert kept.columns == twice.columns and kept.schema == twice.schema
    want = Counter(r["doc_id"] for r in quality.judge(twice, labels).collect() if r["kept"])
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    assert quality.judge(empty, labels).count() == 0


def test_odd_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in quality.judge(odd, none).collect())
    rows = [(1, 1, 0), (1, 0, 0), (4, 1, None), (7, 1, 1), (None, 1, 0), (10, None, 0), (13, 1, 0), (13, 1, 0)]
    assert {r["trusted_id"] for r in quality.trusted_ids(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()} == {4, 13}
