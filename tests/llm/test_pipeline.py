from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from corpusloom.llm import packing, quality, registry
from corpusloom.llm.tokenizer import encoding_of, public_path

from . import brute
from .conftest import texts_of


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Every stage's input and result, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, f in corpus_pipeline.STAGES:
        out[name] = (docs, corpus_pipeline.materialize(f(spark, docs, sf_dir), f"test-{name}"))
        docs = out[name][1]
    return out


def test_columns(stages, documents):
    for name, (_, got) in stages.items():
        if name != "best_fit_packing":
            assert got.columns == documents.columns and got.count()


def test_quality_stage(spark, sf_dir, stages):
    docs, got = stages["quality_rules"]
    judged = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert Counter(texts_of(got)) == Counter((d, t) for d, t in texts_of(docs) if d in {r["doc_id"] for r in judged if r["kept"]})


def test_near_stage(stages):
    docs, got = stages["near_duplicates"]
    rows = sorted(texts_of(docs))
    first = brute.near_classes([t for _, t in rows])
    assert Counter(texts_of(got)) == Counter(r for i, r in enumerate(rows) if first[i] == i)


def test_substring_stage(stages):
    docs, got = stages["repeated_passages"]
    rows = texts_of(docs)
    data = [t.encode() for _, t in rows]
    want = {d: bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for (d, _), b, gone in zip(rows, data, brute.repeated_bytes(data))}
    assert dict(texts_of(got)) == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect() if r["text"] != dict(rows)[r["doc_id"]])


def test_secret_stage(stages):
    docs, got = stages["secret_masking"]
    before, after = dict(texts_of(docs)), dict(texts_of(got))
    assert before.keys() == after.keys()
    for d, text in after.items():
        if before[d] == text:
            assert not brute.base_secrets(text)[1]
        else:
            assert "<SECRET>" in text or "<EXAMPLE>" in text


def test_packing_stage(stages):
    docs, got = stages["best_fit_packing"]
    encode = encoding_of(public_path("byte_bpe_50k.json")).encode_ordinary
    want = {d: len(encode(t)) + 1 for d, t in texts_of(docs)}
    total, bins = Counter(), defaultdict(int)
    for r in got.collect():
        total[r["doc_id"]] += r["length"]
        bins[r["sequence_id"]] += r["length"]
    assert dict(total) == want and max(bins.values()) <= packing.CAPACITY


def test_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    want = stages["best_fit_packing"][1]
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[c] for c in key) for r in got.collect()) == Counter(tuple(r[c] for c in key) for r in want.collect())


def test_registered():
    import __spark_entry__ as e

    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
    assert set(registry.queries()) | {"pipeline"} <= set(e.queries())
    assert set(registry.oracle_sql()) <= set(e.oracle_sql())
