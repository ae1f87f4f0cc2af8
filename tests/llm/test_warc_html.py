import gzip
import hashlib
import random
from collections import Counter

import duckdb
import pytest

from corpusloom.llm import html_text, warc

PAGES = "page_id long, url string, html string, host string, key string, archive string, text string"


@pytest.fixture(scope="module")
def odd_pages(spark):
    big = "<p>" + "é" * 600 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://B.example.org/x?q=a b", big), (2, "https://a.example.org/", big), (3, None, None), (4, "", ""), (5, "http://a.example.org/s", "<p>small</p>"), (6, "http://a.example.org/s", "<p>small</p>"),
            (7, "ftp://a.example.org", "x" * 999), (8, "u", "x" * 999), (9, "u", "y" * 1000), (10, "u", "y" * 1000), (10, "u", "y" * 1000), (None, "n", big), (11, "http://c.d/" + "p" * 3000, "\x00\r\n\r\n" * 500)]
    return spark.createDataFrame([(*r, "h", "k", "a", "t") for r in rows], PAGES).repartition(3)


def expected(rows):
    of = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            of[data] = max(of.get(data, page_id), page_id)
    out = Counter()
    for page_id, _, html in rows:
        data = (html or "").encode()
        owner = of.get(data)
        revisit = owner is not None and page_id != owner
        out[(page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", owner if revisit else None)] += 1
    return out


def test_archives(spark, odd_pages, tmp_path):
    path = f"file://{tmp_path}/warc"
    warc.write_archives(odd_pages, path)
    got = warc.merge_index(warc.read_archives(spark, path)).collect()
    rows = [(r["page_id"], r["url"], r["html"]) for r in odd_pages.collect()]
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows)
    order = sorted(got, key=lambda r: r["capture_no"])
    assert [r["capture_no"] for r in order] == list(range(len(got)))
    keys = [(r["url_key"].encode(), r["capture_s"]) for r in order]
    assert keys == sorted(keys)
    for f in (tmp_path / "warc").glob("part-*"):
        data = gzip.decompress(f.read_bytes())
        for r in got:
            if r["archive"] == f.name:
                assert data[r["record_offset"] :].startswith(b"WARC/1.1\r\n")


def test_no_pages(spark, odd_pages, tmp_path):
    warc.write_archives(odd_pages.limit(0), f"file://{tmp_path}/none")
    assert warc.merge_index(warc.read_archives(spark, f"file://{tmp_path}/none")).count() == 0
    assert html_text.extract(odd_pages.limit(0)).count() == 0


def test_damage_is_found(spark, odd_pages, tmp_path):
    warc.write_archives(odd_pages.filter("page_id = 9"), f"file://{tmp_path}/w")
    (f,) = [f for f in (tmp_path / "w").glob("part-*") if len(f.read_bytes()) > 30]
    f.write_bytes(gzip.compress(gzip.decompress(f.read_bytes()).replace(b"yyyy", b"yyzy", 1)))
    (tmp_path / "w" / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(spark, f"file://{tmp_path}/w").collect()


def test_dates_are_utc(spark, odd_pages, tmp_path):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        warc.write_archives(odd_pages.filter("page_id = 1"), f"file://{tmp_path}/w")
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    (data,) = [x for f in (tmp_path / "w").glob("part-*") if (x := gzip.decompress(f.read_bytes()))]
    assert b"WARC-Date: 2020-01-01T00:00:01Z\r\n" in data


def test_records_in_pieces():
    """An archive's records, however its bytes are cut."""
    rng = random.Random(1)
    blocks = [bytes(rng.choice(b"ab\r\n") for _ in range(rng.randrange(60))) for _ in range(30)]
    whole = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in blocks)
    for cut in (1, 3, 50, 10_000):
        r = warc.Records("x")
        got = [x for i in range(0, len(whole), cut) for x in r.feed(whole[i : i + cut])]
        r.close()
        assert [b for _, _, b in got] == blocks and all(whole[at:].startswith(b"WARC/1.1") for at, _, _ in got)
    with pytest.raises(ValueError, match="ends within"):
        list(r.feed(whole[:-2]))
        r.close()


def test_null_ids_against_sql(spark, odd_pages, tmp_path):
    """A page without an id revisits the page with its payload, in SQL as well."""
    odd_pages.filter("page_id IS NULL OR page_id <> 10").write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op3_warc_index_merge(spark, str(tmp_path))
    cur = duckdb.connect().execute(warc.OP3_SQL.replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'"))
    names = [c[0] for c in cur.description]
    assert Counter(cur.fetchall()) == Counter(tuple(r[n] for n in names) for r in got.collect())


def test_large_pages(spark, tmp_path):
    """Payloads of megabytes, with record separators in them."""
    rows = [(i, f"http://big.example.org/{i % 3}", ("x" * 997 + "\r\n\r\n") * (2000 + i)) for i in range(6)]
    pages = spark.createDataFrame([(*r, "h", "k", "a", "t") for r in rows], PAGES)
    warc.write_archives(pages, f"file://{tmp_path}/w")
    got = warc.merge_index(warc.read_archives(spark, f"file://{tmp_path}/w")).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows)


def test_against_sql(spark, sf_dir):
    got = warc.op3_warc_index_merge(spark, sf_dir)
    cur = duckdb.connect().execute(warc.OP3_SQL.replace("FROM pages", f"FROM '{sf_dir}/pages.parquet'"))
    names = [c[0] for c in cur.description]
    assert Counter(cur.fetchall()) == Counter(tuple(r[n] for n in names) for r in got.collect())


@pytest.mark.parametrize("k", range(10))
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(9))) for _ in range(k)]
    tagged = [[(x, i) for x in run] for i, run in enumerate(runs)]
    assert list(warc.LoserTree(tagged, lambda r: r[0])) == sorted((r for run in tagged for r in run), key=lambda r: r[0])


ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy</div>
<article><h1>Head  &amp;
 line</h1><p>One <b>bold<br>two&nbsp;three<p>a &lt;b&gt; c</p><div class="share">Share</div><ul><li>x<li>y</ul><form><p>f</p></form>
<table><tr><td>c1<td>c2</table><section id="comments"><p>Reader says</p></section><aside>side</aside><p>last &#233;</p></article><footer>&copy; foot</footer>"""


def test_article():
    article, other, chaff, found = html_text.blocks(ARTICLE)
    assert found and " ".join(article) == "Head & line One bold two three a <b> c x y c1 c2 last é"
    assert not other and "Menu" in chaff and "© foot" in chaff


def test_pages(spark, sf_dir):
    """The tables' pages: one article each, its blocks without markup."""
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br|div)\b[^>]*>", inner.replace("<b>", "").replace("</b>", "")))
        text = " ".join(filter(None, blocks))
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (text, len(text), r["url"])


def test_boilerplate_without_articles(spark):
    menu, foot = "Home News Sport Weather About us Contact", "All content belongs to the example house of pages"
    rows = [(i, "http://h.example.org/%d" % i, f"<div>{menu}</div><div>body{i} number {i} says thing{i} and thing{i * 7}</div><p>{foot}</p>") for i in range(40)]
    rows += [(100, "http://solo.example.org/", f"<div>{menu}</div>"), (101, None, None), (102, "http://h.example.org/", ""), (103, "http://h.example.org/0", rows[0][2])]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame([(*r, "h", "k", "a", "t") for r in rows], PAGES)).collect()}
    assert all(got[i] == f"body{i} number {i} says thing{i} and thing{i * 7}" for i in range(40))
    assert got[100] == menu and got[101] == got[102] == "" and got[103] == got[0]


def host_pages(rows):
    return [(i, f"http://h.example.org/{i}", x, "h", "k", "a", "t") for i, x in rows]


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_repeated_suffixes(spark, parts):
    """Suffixes that begin like one of another page, against all pairs, however the array is cut into ranges."""
    rng = random.Random(4)
    streams = [[rng.choice("abc") for _ in range(rng.randrange(40))] for _ in range(8)]
    rows = [("h", bytes([p]), [" ".join(s)] if s else [], []) for p, s in enumerate(streams)] * 2
    found = spark.createDataFrame(rows, "host string, key binary, other array<string>, chaff array<string>")
    seen: dict = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - 4):
            seen.setdefault(tuple(s[i : i + 5]), set()).add(p)
    often = {x for x, pages in seen.items() if len(pages) > 1}
    want = {(p, i) for p, s in enumerate(streams) for i in range(len(s) - 4) if tuple(s[i : i + 5]) in often}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["key"][0], r["pos"]) for r in html_text.repeated(html_text.suffixes(found)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == want and len(want) > 30


def test_rare_runs_of_a_large_host(spark):
    """A notice that two of 600 pages of a host share is found in both."""
    notice = "this one notice is on two pages"
    rows = [(i, f"<div>own{i} text{i} of page{i}</div>" + (f"<p>{notice}</p>" if i in (17, 503) else "")) for i in range(600)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(host_pages(rows), PAGES).repartition(5)).collect()}
    assert got == {i: f"own{i} text{i} of page{i}" for i in range(600)}


def test_articles_stay_whole(spark):
    """What other pages quote beyond their articles, and what articles repeat, is an article's text."""
    headline, story = "The river ran past the old mill", "All of this was said before in the other story"
    rows = [(i, f"<article><h1>{headline}</h1><p>{story}</p></article><div class='sidebar'>{headline}</div>") for i in range(3)]
    rows += [(10, f"<div>{headline}</div><p>only here</p>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(host_pages(rows), PAGES)).collect()}
    assert got == {**{i: f"{headline} {story}" for i in range(3)}, 10: "only here"}


def test_class_names_inside_articles():
    page = '<article><div class="related-work">A</div><section class="social-science">B</section><div class="share x">C</div></article><div class="top-banner">D</div>'
    article, _, chaff, _ = html_text.blocks(page)
    assert article == ["A", "B"] and chaff == ["C", "D"]


def test_long_page(spark):
    body = " ".join(f"w{i}" for i in range(200_000))
    got = html_text.extract(spark.createDataFrame(host_pages([(1, f"<nav>n</nav><article><p>{body}</p></article>"), (2, f"<p>{body}</p>")]), PAGES)).collect()
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in got} == {1: (body, len(body)), 2: (body, len(body))}
