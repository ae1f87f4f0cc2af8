import pytest
from pyspark.sql import functions as F

from corpusloom import catalog
from corpusloom.functions import langid, murmur, text as X, tokenize as T
from corpusloom.operators import social as S, tokenizing as K


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).collect()[0]["y"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("read [the guide](http://a.example/b) first", "read the guide first"),
        ("a [[note]](http://a.example/) here", "a [note] here"),
        ("_so_ *very* **much** ~gone~", "so very much gone"),
        ("snake_case_name and 2*3*4", "snake_case_name and 2*3*4"),
        ("> quoted\n# title\n* item\n- other\n  last", "quoted title item other last"),
        ("see http://a.example/b?c=d now", "see  now"),
        ("", ""),
    ],
)
def test_strip_markdown(spark, raw, want):
    assert one(spark, raw, X.strip_markdown) == want


@pytest.mark.parametrize(
    "f, raw, want",
    [
        (X.strip_handles, "hi @some_one! you", "hi  you"),
        (X.strip_tco, "x https://t.co/aB9 y http://t.co/z", "x  y "),
        (X.rstrip, "a  \n\t", "a"),
        (X.drop_tab_prefix, "meta\ttext\tmore", "text\tmore"),
        (X.drop_tab_prefix, "text", "text"),
        (X.uncurl_quotes, "‘it’s’ “so”", "'it's' \"so\""),
        (X.fix_line_breaks, "a\r\nb\rc d", "a\nb\nc\nd"),
        (X.strip_ngram_tags, "The_DET Cat_NOUN ÉTÉ_.", "the cat ÉtÉ"),
        (X.drop_country_codes, "now (CNN) and (a) (X)", "now  and (a) (X)"),
        (X.mark_label, "label__5 label__", "__label__5 label__"),
        (X.headline, "# Headline: news", "news"),
        (X.headline, "# other", ""),
        (X.simplify_chinese, "漢語學習 ", "漢语学习"),
        (T.smash_digits, "a1 20 3,141.5x 7", "a1 00 0,000.0x 7"),
    ],
)
def test_text(spark, f, raw, want):
    assert one(spark, raw, f) == want


@pytest.mark.parametrize("f, want", [(0.01, "0.01"), (0.012345678, "0.012346"), (1.5e-7, "1.5e-07"), (0.99, "0.99"), (1e-9, "1e-09"), (0.00012345, "0.00012345")])
def test_five_digits(spark, f, want):
    assert spark.range(1).select(X.format_5g(F.lit(f)).alias("x")).collect()[0]["x"] == want == f"{f:.5g}"


def test_language_tag_filter(spark):
    rows = [("en\ttext\tmore", "text"), ("fr\ttexte", None), ("bare", "bare"), ("", None), ("en\t", "")]
    df = spark.createDataFrame([(r,) for r, _ in rows], "x string").select(X.language_tag_filter(F.col("x"), "en").alias("y"))
    assert [r["y"] for r in df.collect()] == [w for _, w in rows]


@pytest.mark.parametrize("a, b, want", [([], [], []), (["a"], [], ["a"]), ([], ["x", "y"], ["x", "y"]), (["a", "b", "c", "d"], ["x", "y"], ["a", "x", "b", "c", "y", "d"])])
def test_intersperse(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert df.select(X.intersperse(F.col("a"), F.col("b")).alias("y")).collect()[0]["y"] == want


def test_alignment(spark):
    df = spark.createDataFrame([("0-1 2-0",), ("  ",)], "x string").select(X.alignment(F.col("x")).alias("y"))
    assert [[tuple(p) for p in r["y"]] for r in df.collect()] == [[(0, 1), (2, 0)], [(0, 0)]]


@pytest.mark.parametrize("data, want", [(b"", 0), (b"hello", 613153351), (b"hello, world", 345750399), (b"The quick brown fox jumps over the lazy dog", 776992547)])
def test_murmur(data, want):
    assert murmur.murmur3(data) == want


@pytest.mark.parametrize(
    "text, lang, punctuation, want",
    [
        ("Heißen Spaß!", "de", False, ["heissen", "spass"]),
        ("I’m at 66.7% of 1,000", "en", False, ["i’m", "at", "66.7", "of", "1,000"]),
        ("so. (yes)", "en", True, ["so", ".", "(", "yes", ")"]),
        ("ferme l'eau", "fr", False, ["ferme", "l", "eau"]),
        ("ok 👍🏽 fine", "en", False, ["ok", "👍🏽", "fine"]),
        ("", "en", True, []),
    ],
)
def test_tokenize(text, lang, punctuation, want):
    assert T.tokenize(text, lang, punctuation) == want


def test_clean():
    assert T.clean("&lt;h1&gt; a&amp;b &copy") == "<h1> a&b &copy"
    assert T.clean("itâ€™s", mojibake=True) == "it’s"
    assert T.clean("Ã©tÃ©", mojibake=True) == "été"
    assert T.clean("Ängste à la", mojibake=True) == "Ängste à la"


def test_fold():
    assert T.fold("aa bb cc", 5) == ["aa ", "bb cc"]
    assert T.fold("abcdefg", 3) == ["abc", "def", "g"]
    assert T.fold("éé é", 4) == ["éé", " é"]
    assert "".join(T.fold("a b " * 500, 100)) == "a b " * 500


def test_tag_distance():
    assert langid.tag_distance("en", "en") == 0
    assert langid.tag_distance("zh-Hans", "zh") < 10
    assert langid.tag_distance("nb", "no") < 10
    assert langid.tag_distance("en", "fr") >= 10


def test_catalog():
    c = {"a": ["en", "nl"], "b": ["en"], "c": ["en", "de"], "d": ["en"], "e": ["en"]}
    assert catalog.language_sources(c)["en"] == list("abcde")
    assert catalog.supported(c) == ["en"]
    assert catalog.large(c) == ["en", "nl"]
    assert catalog.expand("{s}/{l}", s="ab", l=["x", "y"]) == ["a/x", "a/y", "b/x", "b/y"]
    assert catalog.opus_pair("OpenSubtitles2018", "zh-Hans", "en") == ("en-zh_cn", True)
    assert [catalog.reddit_file(m) for m in ("2017-11", "2018-10", "2018-11")] == ["RC_2017-11.bz2", "RC_2018-10.xz", "RC_2018-11.zst"]
    with pytest.raises(ValueError):
        catalog.opus_code("nothing", "en")


def test_reddit(spark):
    rows = [(3, "good *text*", "ok"), (2, "english bar", "ok"), (1, "low", "ok"), (None, "null", "ok"), (9, None, "ok"), (9, "[deleted]", "ok"), (9, "[removed]", "ok"), (9, "banned", "BAD"), (9, "https://a.example", None), (9, "**https**://x.example", "ok"), (5, "a &lt;b&gt;\nc", None)]
    comments = spark.createDataFrame(rows, "score long, body string, subreddit string")
    denied = spark.createDataFrame([(murmur.murmur3(b"bad"),)], "hash int")
    got = S.preprocess_reddit(comments, denied, lambda c: F.lit("en")).collect()
    assert sorted(r["text"] for r in got) == ["a <b> c", "good text"]
    other = S.preprocess_reddit(comments, denied, lambda c: F.lit("fr")).collect()
    assert "english bar" in [r["text"] for r in other]
    assert S.preprocess_reddit(comments, denied, lambda c: F.lit("und")).count() == 0


def test_twitter(spark):
    lines = spark.createDataFrame([("id\tsay @a_b hi https://t.co/Q1 &amp; bye \n",), ("@only",), ("plain",)], "text string")
    got = sorted(r["text"] for r in S.preprocess_twitter(lines, lambda c: F.lit("en")).collect())
    assert got == ["plain", "say  hi  & bye"]


def test_tokenize_lines(spark):
    lines = spark.createDataFrame([("One two!",), ("!!",)], "text string")
    assert [r["text"] for r in K.tokenize_lines(lines, "en").collect()] == ["one two", ""]
    assert K.tokenize_lines(lines, "en", detect=lambda c: F.lit("fr")).count() == 0
    tagged = spark.createDataFrame([("en", "A."), ("xx", "b")], "lang string, text string")
    assert [tuple(r) for r in K.tokenize_by_language(tagged, ["en"]).collect()] == [("en", "a .")]


def test_sentencepiece(spark):
    P = pytest.importorskip("public_tokenizers")
    model = P.path("piece_bpe_32k.model")
    rows = spark.createDataFrame([("Hello there",), ("",)], "text string")
    ids = K.sp_encode(rows, model)
    assert [r["text"] for r in K.sp_decode(ids, model).collect()] == ["Hello there", ""]
    assert K.sp_vocabulary(spark, model).count() == 32_000 - 3


def test_provider_codes():
    assert [catalog.opus_code("Tatoeba", x) for x in ("fa", "fil", "sh", "nb")] == ["pes", "tl", "sr", "nb"]
    assert catalog.opus_code("GlobalVoices", "ja") == "jp" and catalog.opus_code("Europarl", "pt-PT") == catalog.opus_code("OpenSubtitles2018", "pt-PT") == "pt"
    assert catalog.provider_code("google", "zh-Hans") == "chi_sim" and catalog.provider_code("google", "pl") == "pl"


def test_emphasis(spark):
    """Balanced marks that don't touch words outside them go; of unequal runs as many as both have."""
    cases = [("*", "**a** and *b*", "a and b"), ("*", "x*a*", "x*a*"), ("*", "**a*", "*a"), ("*", "*a**", "a*"), ("*", "**a**b", "*a*b"), ("*", "*a*b", "*a*b"), ("*", "*a*b*", "*a*b*"), ("*", "x**a**", "x*a*"),
             ("*", "2 * 3 * 4", "2  3  4"), ("_", "__a__", "a"), ("_", "__a_", "__a_"), ("_", "snake_case_name", "snake_case_name"), ("~", "~~x~~ ~y~", "x y"), ("*", "", ""), ("*", "***", "***"), ("_", "é_a_", "é_a_")]
    for mark in "*_~":
        own = [(t, w) for m, t, w in cases if m == mark]
        rows = spark.createDataFrame(own, "text string, want string").select("text", "want", X.unwrap_emphasis(F.col("text"), mark).alias("got")).collect()
        assert [(r["text"], r["got"]) for r in rows] == [(r["text"], r["want"]) for r in rows]


def test_lossy_tokens_fold_case(spark):
    got = spark.range(1).select(T.lossy_tokens(F.lit("Heißen ΣΟΦΟΣ σοφός STRASSE")).alias("x")).first()["x"]
    assert got == [w.casefold() for w in "heißen ΣΟΦΟΣ σοφός STRASSE".split()]


def test_fold_case_is_full_folding_on_the_test_texts(spark, sf_dir):
    """Held against str.casefold, whose letters the SQL spells out too."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null").select("text", X.fold_case(F.col("text")).alias("got")).collect()
    assert any("ß" in r["text"] for r in rows)
    assert [r["got"] for r in rows if r["got"] != r["text"].casefold()] == []
