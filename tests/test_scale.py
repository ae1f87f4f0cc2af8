"""Findings of reviews at larger tables: each test fails on the form before."""

from collections import Counter

import duckdb
import pytest

from corpusloom import plans


@pytest.fixture(scope="module")
def keys_dir(spark, tmp_path_factory):
    """Documents with tokens that hold runs of digits and single ones, in three sources."""
    at = tmp_path_factory.mktemp("keys")
    rows = [(i, f"a1 e3b3ed33cc44d6 word{i % 2} x9y 3 12 zz3e44", "en", f"src{i % 3}", 30) for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"file://{at}/documents.parquet")
    return str(at)


def against_sql(spark, sf_dir, name):
    """The query's rows and those of its SQL."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet/*.parquet'")
    cur = con.execute(plans.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    return Counter(map(tuple, plans.queries()[name](spark, sf_dir).select(*names).collect())), Counter(cur.fetchall())


def test_merge_freqs_smashes_digits_as_its_sql(spark, keys_dir):
    got, want = against_sql(spark, keys_dir, "merge_freqs")
    assert got == want
    assert "e0b0ed00cc00d0" in {word for _, word, _ in got}


def test_cb_tiers_smashes_digits_as_its_sql(spark, keys_dir):
    """The first word of a tier was another one."""
    got, want = against_sql(spark, keys_dir, "cb_tiers")
    assert got == want


def test_jieba_rows_smashes_digits_as_its_sql(spark, keys_dir):
    got, want = against_sql(spark, keys_dir, "jieba_rows")
    assert got == want


def shuffled(spark):
    """Bytes that all stages so far wrote for shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_word_alignment_ships_no_pairs(spark):
    """Lines of 300 words have 90,000 pairs each; what is shipped is of the order of the lines."""
    from corpusloom.operators.alignment import align

    side = lambda k, c: [f"{c}{(7 * k + i * i) % 997}" for i in range(300)]
    rows = spark.createDataFrame([(k, side(k, "s"), side(k, "t")) for k in range(30)], "line long, src array<string>, tgt array<string>")
    before = shuffled(spark)
    got = align(rows, rounds=2).collect()
    assert len(got) == 30 and all(len(r["links"].split()) == 300 for r in got)
    assert shuffled(spark) - before < 5_000_000


def test_word_alignment_in_chunks(monkeypatch):
    """A target word with too many pairs for one chunk gets the same counts."""
    import numpy as np
    import pyarrow as pa

    from corpusloom.operators import alignment as A

    rows = [{"line": k, "src": A._JOIN.join(f"s{(k * i) % 11}" for i in range(5 + k % 3)), "m": 4, "j": [0, 1, 3], "t": ["the", f"t{k % 4}", "the"], "s": None, "round": None, "total": None} for k in range(60)]
    kinds = [("line", pa.int64()), ("src", pa.string()), ("m", pa.int32()), ("j", pa.list_(pa.int32())), ("t", pa.list_(pa.string())), ("s", pa.string()), ("round", pa.int32()), ("total", pa.float64())]
    found = []
    for pairs in (1 << 20, 16):
        monkeypatch.setattr(A, "PAIRS", pairs)
        totals = {}
        for done in range(3):
            task = A._Task(2, 4.0)
            task.add(pa.RecordBatch.from_pylist(rows, pa.schema(kinds)))
            if done:
                task.add(pa.RecordBatch.from_pylist([{"s": s, "round": k, "total": x} for k, of in totals.items() for s, x in of.items()], pa.schema(kinds)))
            task.ready()
            sums, best = task.run(done)
            totals[done] = dict(zip(task.words, sums))
        found.append((list(totals[0].values()) + list(totals[1].values()), best.tolist()))
    assert np.allclose(found[0][0], found[1][0]) and found[0][1] == found[1][1]


def test_full_tokens_holds_one_text_at_a_time(spark):
    """Rows go to Python in small batches and come back as text, not as lists of tokens."""
    from corpusloom.operators import tokenizing as K

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    rows = spark.createDataFrame([("en", "One, two."), ("fr", None), ("fr", "l'eau")], "lang string, text string")
    got = K.tokenize_by_language(rows, ["en", "fr"])
    assert [r["text"] for r in got.collect()] == ["one , two .", None, "l eau"]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 4096
    assert "array_join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_detection_over_arrays(spark, sf_dir):
    """Models and languages as the plain form has them, text by text; a filter on the language doesn't detect again."""
    from collections import Counter as Count

    from pyspark.sql import functions as F

    from corpusloom.functions import langid

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    models = langid.train(docs)
    low = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))
    counts = {}
    for r in docs.select("lang", low.alias("t")).filter("t is not null").collect():
        counts.setdefault(r["lang"], Count()).update(r["t"][i : i + n] for n in (2, 3) for i in range(len(r["t"]) - n + 1))
    for lang, found in counts.items():
        top = sorted(found.items(), key=lambda x: (-x[1], x[0]))[: langid.FEATURES]
        assert [g for g in models.logs[lang]] == [g for g, _ in top]
        assert models.ranks[lang] == {g: i for i, g in enumerate([g for g, _ in top if len(g) == 3][: langid.PROFILE])}
    texts = [r["text"] or "" for r in docs.collect()][:150] + ["", " ", "a", "1 2 3", "Ünï \U00010400x", "ΑΣ ΟΔΟΣ. İç"]
    assert models.detect_all(texts) == [models.checked(t)[0] if t else "und" for t in texts]
    assert langid.Models().detect_all(["x"]) == ["und"]
    plan = docs.withColumn("x", langid.detect(F.col("text"), models)).filter("x <> 'und'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def once(spark, df):
    """Python functions that the plan runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_twitter_cleans_and_detects_once(spark):
    from corpusloom.functions import langid
    from corpusloom.operators import social as S

    lines = spark.createDataFrame([("a &amp; b\r\nc",), ("@x",)], "text string")
    plan = S.preprocess_twitter(lines, lambda c: langid.detect(c, langid.Models({"en": {"abc": 0}}, {"en": {"abc": -1.0}}, {"en": -9.0})))
    assert once(spark, plan) == 2
    assert [tuple(r) for r in plan.collect()] == [("en", "a & b\nc")]


def test_reddit_cleans_and_detects_once(spark):
    from corpusloom.functions import langid, murmur
    from corpusloom.operators import social as S

    models = langid.Models({"en": {"abc": 0}}, {"en": {"abc": -1.0}}, {"en": -9.0})
    rows = spark.createDataFrame([(5, "some *marked* __text__ &gt; ~here~", "a"), (5, "x", "bad"), (5, "y", None)], "score long, body string, subreddit string")
    denied = spark.createDataFrame([(murmur.murmur3(b"bad"),)], "hash int")
    got = S.preprocess_reddit(rows, denied, lambda c: langid.detect(c, models))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 4  # names hashed, also for a filter on the hash; texts cleaned, languages detected
    assert plan.count("BroadcastHashJoin") >= 1 and "LeftAnti, BuildRight" in plan
    assert sorted(tuple(r) for r in got.collect()) == [("en", "some marked text > here"), ("en", "y")]
