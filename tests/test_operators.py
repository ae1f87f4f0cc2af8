import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import alignment, assoc as A, counts as C, embedding, freqs as Q, parallel as P
from corpusloom.plans import parallel as PP
from corpusloom.sources import readers as R, writers as O
from corpusloom.streaming import counts as ST


def test_counts(spark):
    rows = [("en", 0, ["a", "b", "a", "'", "__x", "", "¶", "."]), ("en", 1, ["b", "‘b’", ".", "♪", "♪"])]
    df = spark.createDataFrame(rows, "lang string, pos long, tokens array<string>")
    got = C.count_tokens(df, ["lang"]).orderBy(F.desc("count"), "first_seen").collect()
    assert [(r["token"], r["count"]) for r in got] == [("b", 3), ("a", 2), ("♪", 2)]
    assert C.count_totals(df, ["lang"]).collect()[0]["total"] == 10  # singletons, the stripped apostrophe and full stops included


def test_recount(spark):
    df = spark.createDataFrame([("__total__", 99), ("Two Words", 3), ("words", 2), ("20", 4), ("1.5", 1), ("!", 7)], "term string, count long")
    assert {r["token"]: r["count"] for r in C.recount(df, []).collect()} == {"two": 3, "words": 5, "00": 4, "0.0": 1}
    assert C.recount_totals(df, []).collect()[0]["total"] == 13


def test_ngram_floor(spark):
    df = spark.createDataFrame([(1, "a b", 60), (1, "a b", 50), (2, "a b", 99), (2, "c d", 100)], "shard int, term string, count long")
    assert {r["term"]: r["count"] for r in C.ngram_floor(df).collect()} == {"a b": 110, "c d": 100}


@pytest.mark.parametrize("n", [3, 4, 5])
def test_trimmed_mean(spark, n):
    lists = [{"a": 0.5, "b": 0.1}, {"a": 0.4, "c": 0.2}, {"a": 0.3, "b": 0.2}, {}, {"b": 0.3}][:n]
    rows = [("en", i, w, f) for i, x in enumerate(lists) for w, f in x.items()]
    df = spark.createDataFrame(rows, "lang string, source int, word string, freq double")
    means = {}
    for w in "abc":
        v = sorted(x.get(w, 0.0) for x in lists)[1:-1]
        means[w] = sum(v) / len(v)
    total = sum(means.values())
    want = {w: m / total * 0.99 for w, m in means.items() if m}
    got = {r["word"]: r["freq"] for r in Q.merge_freqs(df, spark.createDataFrame([("en", n)], "lang string, n long")).collect()}
    assert got == pytest.approx(want)


def test_merge_needs_three(spark):
    df = spark.createDataFrame([("en", "a", 0.5)], "lang string, word string, freq double")
    with pytest.raises(Exception, match="three lists"):
        Q.merge_freqs(df, spark.createDataFrame([("en", 2)], "lang string, n long")).collect()


def test_frequencies(spark):
    counts = spark.createDataFrame([("x", "“Hi”", 2), ("x", "Hi", 3), ("x", "'", 1), ("x", "rare", 1)], "source string, token string, count long")
    totals = spark.createDataFrame([("x", 10)], "source string, total long")
    assert {r["word"]: round(r["freq"], 9) for r in Q.frequencies(counts, totals, ["source"]).collect()} == {'"Hi"': 0.2, "Hi": 0.3, "rare": 0.1}
    big = totals.withColumn("total", F.lit(2 * 10**9))
    assert {r["word"] for r in Q.frequencies(counts, big, ["source"], merge=False).collect()} == {"“Hi”", "Hi"}


def test_tiers_and_jieba(spark):
    df = spark.createDataFrame([("en", "a", 0.1), ("en", "b", 0.1), ("en", "c", 0.0098), ("en", "d", 1e-8), ("en", " ", 0.5)], "lang string, word string, freq double")
    tiers = {r["neg_cb"]: r["words"] for r in Q.cb_tiers(df, 600).collect()}
    assert tiers[100] == ["a", "b"] and tiers[201] == ["c"] and tiers[5] == [] and len(tiers) == 202
    assert {r["word"]: r["ppb"] for r in Q.jieba_rows(df, 600).collect()} == {"a": 100_000_000, "b": 100_000_000, "c": 9_800_000}
    with pytest.raises(Exception, match="count file"):
        Q.cb_tiers(df.union(spark.createDataFrame([("en", "__total__", 1.0)])), 600).collect()


def test_cooccurrences(spark):
    vocab = spark.createDataFrame([(0, "en/a"), (1, "en/b"), (2, "fr/x")], "idx int, uri string")
    pairs = spark.createDataFrame([(1, "en", ["a", "a", "b", "z"], "fr", ["x"])], "line long, lang1 string, tokens1 array<string>, lang2 string, tokens2 array<string>")
    words, want = [0, 0, 1, 2], {}
    for i in words:
        for j in words:
            want[i, j] = want.get((i, j), 0) + 1
    assert {(r["idx1"], r["idx2"]): r["n"] for r in A.cooccurrences(pairs, vocab).collect()} == want


def test_parallel(spark):
    a = spark.createDataFrame([(0, "one two"), (1, "♪ song"), (2, "x" * 9), (3, "priv"), (4, "left")], "pos long, text string")
    b = spark.createDataFrame([(0, "un deux"), (1, "chanson"), (2, "y"), (3, "prive")], "pos long, text string")
    assert P.zip_lines(a, b).filter("pos = 4").collect()[0]["text2"] == ""
    got = PP.prepare(a, b, "en", "fr", test=1, valid=0).collect()
    assert [(r["part"], r["text1"], r["text2"]) for r in got] == [("test", "one two", "un deux")]
    lines = PP.aligner_input(spark.createDataFrame([("a", "b"), ("", "c")], "text1 string, text2 string")).collect()
    assert {tuple(r) for r in lines} == {("forward", "a ||| b"), ("backward", "b ||| a")}


def test_numbered_and_splits(spark):
    df = spark.range(1000).repartition(7)
    got = sorted((r["pos"], r["id"]) for r in P.numbered(df, "id").collect())
    assert got == [(i, i) for i in range(1000)]
    parts = P.split_sets(df, "id", 100, 50).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"test": 100, "valid": 50, "train": 850}
    assert sorted(r["id"] for r in P.every_nth(df, "id", 100, 1).collect()) == list(range(0, 1000, 100))


def test_alignment(spark):
    rows = [(1, ["a", "b"], ["x", "y"]), (2, ["a"], ["x"]), (3, ["b"], ["y"])]
    got = alignment.align(spark.createDataFrame(rows, "line long, src array<string>, tgt array<string>"))
    assert {r["line"]: r["links"] for r in got.collect()} == {1: "0-0 1-1", 2: "0-0", 3: "0-0"}


def test_skipgrams(spark):
    lines = spark.createDataFrame([(["a", "b", "c"] * 5,)], "tokens array<string>")
    assert embedding.skipgrams(lines, size=4, epochs=1, least=1).getVectors().count() == 3


def test_readers(spark, tmp_path):
    def file(name, data):
        p = tmp_path / name
        p.write_bytes(data if isinstance(data, bytes) else data.encode("utf-8"))
        return f"file://{p}"

    import bz2
    import lzma

    import zstandard

    for name, pack in (("a.bz2", bz2.compress), ("a.xz", lzma.compress), ("a.zst", zstandard.compress)):
        assert [r["text"] for r in R.compressed_lines(spark, file(name, pack("é 1\n\nb".encode()))).collect()] == ["é 1", "", "b"]
    with pytest.raises(Exception, match="unknown compression"):
        R.compressed_lines(spark, file("a.rar", b"x")).collect()
    assert [r["text"] for r in R.text_lines(spark, file("t.txt.gz", gzip.compress(b"x\ny\n"))).collect()] == ["x", "y"]
    assert [r["text"] for r in R.strict_text_lines(spark, file("bad.txt", b"a\xffb\nc\n")).collect()] == ["ab", "c"]
    assert [(r["line"], r["text"]) for r in R.numbered_lines(spark, file("n.txt", "x\ny\n")).collect()] == [(0, "x"), (1, "y")]
    assert [r["text"] for r in R.tweets(spark, file("t.jsonl", json.dumps({"text": "a\nb", "geo": {"x": 1}}))).collect()] == ["a", "b"]
    assert R.reviews(spark, file("r.jsonl", json.dumps({"overall": 5.0, "summary": "s"}))).collect()[0]["text"] == "label__5\ts\tnull"
    with pytest.raises(Exception):
        R.reddit_comments(spark, file("c.jsonl", '{"score": 1}\n{bad\n')).collect()
    assert R.parse_reddit(spark.createDataFrame([('{"score": 4, "body": "b", "x": 0}',)], "text string")).collect()[0]["score"] == 4
    xml = "<tmx><tu><tuv xml:lang='en'><seg>a</seg></tuv><tuv xml:lang='fr'><seg>b</seg></tuv></tu><tu><prop>0.0</prop><tuv xml:lang='en'><seg>c</seg></tuv><tuv xml:lang='fr'><seg>d</seg></tuv></tu></tmx>"
    assert {(r["lang"], r["text"]) for r in R.tmx(spark, file("m.tmx", xml)).collect()} == {("en", "a"), ("fr", "b")}
    wiki = "<mediawiki><page><title>T</title><revision><text>'''Bold''' [[a|b]] {{x}} [http://u.example c]</text></revision></page></mediawiki>"
    assert R.wiki_pages(spark, file("w.xml", wiki)).collect()[0]["text"].split() == ["Bold", "b", "c"]
    assert [tuple(r) for r in R.ngram_rows(spark, file("g.txt", "dog_NOUN\t1990,3,1\t2000,4,2\ncat 1999,5,1\n")).collect()] == [("dog", 7), ("cat", 5)]
    assert [tuple(r) for r in R.ngram_counts(spark, file("g2.tsv", "a b\t1999\t5\n")).collect()] == [("a b", 5)]
    assert [tuple(r) for r in R.leeds(spark, file("l.num", "header\n1 22.50 term\n2 1.00 xEOS\n")).collect()] == [("term", 2250)]
    assert [tuple(r) for r in R.mokk(spark, file("mokk.txt", "tőr\tx\t7\n".encode("iso-8859-2"))).collect()] == [("tőr", 7)]
    assert [tuple(r) for r in R.subtlex(spark, file("s.tsv", 'w\tx\tn\n"ja\t0\t3\n'), "de").collect()] == [('"ja', 3)]
    assert [tuple(r) for r in R.jieba_dictionary(spark, file("j.txt", "學 5 n\n")).collect()] == [("学", 5)]
    assert [r["text"] for r in R.voa(spark, file("v.txt", "# Headline: h\n# x\nbody\n")).collect()] == ["h", "", "body"]
    assert [tuple(r) for r in R.tsv_pairs(spark, file("p.tsv", "0\t0\ten\tja\n"), 3, 4).collect()] == [("en", "ja")]
    rows, total = R.count_list(spark, file("c.txt", "__total__\t9\na\t5\n"))
    assert [tuple(r) for r in rows.collect()] == [("a", 5)] and total.collect()[0]["total"] == 9


def read(path):
    return [x for p in sorted(path.glob("part-*")) for x in p.read_text("utf-8").splitlines()]


def test_writers(spark, tmp_path):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "token string, count long")
    O.count_file(counts, spark.createDataFrame([(11,)], "total long"), f"file://{tmp_path}/counts")
    assert read(tmp_path / "counts") == ["__total__\t11", "c\t5", "a\t2", "b\t2"]
    freqs = spark.createDataFrame([("a", 0.01), ("b", 0.01), ("c", 1e-10), ("d", 0.123456789)], "word string, freq double")
    O.frequency_file(freqs, f"file://{tmp_path}/freqs")
    assert read(tmp_path / "freqs") == ["d\t0.12346", "b\t0.01", "a\t0.01"]
    O.jieba(spark.createDataFrame([("a", 5), ("b", 9)], "word string, ppb long"), f"file://{tmp_path}/jieba")
    assert read(tmp_path / "jieba") == ["b 9", "a 5"]
    O.by_language(spark.createDataFrame([("en", "x"), ("zz", "y")], "lang string, text string"), f"file://{tmp_path}/lang", ["en"])
    assert [p.name for p in (tmp_path / "lang").glob("lang=*")] == ["lang=en"]
    tiers = spark.createDataFrame([(0, ["é"]), (2, ["a", "b"])], "neg_cb int, words array<string>")
    O.cbpack(tiers, str(tmp_path / "x.msgpack.gz"))
    assert gzip.decompress((tmp_path / "x.msgpack.gz").read_bytes()) == b"\x94\x82\xa6format\xa2cB\xa7version\x01\x91\xa2\xc3\xa9\x90\x92\xa1a\xa1b"
    O.coordinates(spark.createDataFrame([(1, 2, 2)], "idx1 int, idx2 int, n long"), str(tmp_path / "c.dat"))
    assert (tmp_path / "c.dat").read_bytes() == struct.pack("<ii", 1, 2) * 2
    O.id_stream(spark.createDataFrame([([1, 300],)], "ids array<int>"), str(tmp_path / "ids"))
    assert (tmp_path / "ids").read_bytes() == b"\x92\x01\xcd\x01\x2c"
    assert O.msgpack([None, True, -1, -200, 70000, 1.5, b"x", "y" * 40, {"k": 2**40}])[:3] == b"\x99\xc0\xc3"


def test_streaming(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",), ("a",)], "token string").write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("token string").parquet(f"file://{tmp_path}/in")
    got = ST.drain(ST.running_counts(stream, []), "running_counts_test")
    assert {r["token"]: r["count"] for r in got.collect()} == {"a": 2, "b": 1}


def test_count_file_by_first_place(spark, tmp_path):
    """Ties stand in the order in which their tokens were first seen."""
    rows = [(0, ["b", "a", "c"]), (1, ["c", "a", "b", "x"]), (2, ["b"])]
    df = spark.createDataFrame(rows, "pos long, tokens array<string>").repartition(2)
    O.count_file(C.count_tokens(df, []), spark.createDataFrame([(8,)], "total long"), f"file://{tmp_path}/counts")
    assert [r["value"] for r in spark.read.text(f"file://{tmp_path}/counts").collect()] == ["__total__\t8", "b\t3", "a\t2", "c\t2"]
