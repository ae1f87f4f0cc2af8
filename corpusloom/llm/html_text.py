"""Main text of web pages, with a host-wide suffix array for boilerplate.

Markup is read with one scan for tags. Scripts, styles, forms, menus, headers,
footers, sidebars, adverts, notices and comments are told by their elements and
class names; what stands beyond the articles of a host's pages is the host's
token stream. Its suffixes are sorted by their first tokens: the suffix array
of all pages of the host, to the depth of the shortest run that counts, cut into
ranges over any number of tasks. Neighbours in it that begin alike in distinct
pages are repeated runs. Of a page that marks no article the unique runs are the
text; of one that does, its article's blocks, whole: pages quote the headlines
and first lines of others in their menus and sidebars, so what is repeated
beyond articles may be an article's own text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize, small_batches, table

#: Tokens that a run needs to be boilerplate; it must be on two distinct pages of its host.
RUN_TOKENS = 5

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|select|svg|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?/]?[A-Za-z][^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*>|<[!?/][^<>]*>", re.S | re.I)
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9-]*)")
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("head title nav footer aside form menu button dialog".split())
#: Elements that end where a block of the same kind begins, so that their missing end tags don't matter.
_LOOSE = frozenset("p li dt dd tr td th option b i em strong a span u small font".split())
#: Beyond articles a part of a class name tells; inside of them the whole name must be one of these.
_INSIDE = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie-notice disqus disqus_thread menu nav navigation newsletter notice popup promo related-posts share sharing sidebar social social-share sponsored subscribe toolbar widget".split())
_CHAFF = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|masthead|menu|nav|navbar|navigation|newsletter|notice|popup|promo\w*|related|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)


def squeeze(text: str) -> str:
    return " ".join(html.unescape(text).split())


def blocks(page: str) -> tuple[list[str], list[str], list[str], bool]:
    """(blocks of the article, other blocks, blocks of menus and other chaff, whether there is an article)."""
    article: list[str] = []
    other: list[str] = []
    chaff_blocks: list[str] = []
    buffer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, chaff, in an article
    chaff = inside = found = False
    at = 0

    def flush() -> None:
        text = squeeze("".join(buffer))
        buffer.clear()
        if text:
            (chaff_blocks if chaff else article if inside else other).append(text)

    for m in _TAG.finditer(page):
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at = m.end()
        tag = m[0]
        if m[1]:
            continue
        name = _NAME.match(tag)
        if name is None:
            continue
        name = name[1].lower()
        if tag[1] == "/":
            if name in _BLOCK:
                flush()
            if any(e[0] == name for e in stack):
                if name in _LOOSE and name not in (e[0] for e in stack[max(0, len(stack) - 8) :]):
                    continue
                while stack:
                    top, chaff, inside = stack.pop()
                    if top == name:
                        break
            continue
        if name in _BLOCK:
            flush()
        if name in _VOID or tag.endswith("/>"):
            continue
        if name in _LOOSE:
            while stack and stack[-1][0] in _LOOSE and (stack[-1][0] == name or name in ("p", "li", "tr")) and stack[-1][0] in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "b", "i", "em", "strong", "a", "span", "u", "small", "font"):
                if stack[-1][0] != name and stack[-1][0] in ("td", "th", "li", "dd"):
                    break
                _, chaff, inside = stack.pop()
        stack.append((name, chaff, inside))
        if name in ("article", "main") and not chaff:
            found = inside = True
        elif name in _SKIP or name == "header" and not inside:
            chaff = True
        elif name not in ("body", "html", "article", "main") and (a := " ".join(filter(None, (x for t in _ATTR.findall(tag) for x in t)))):
            chaff = chaff or (not _INSIDE.isdisjoint(a.lower().split()) if inside else _CHAFF.search(a) is not None)
    buffer.append(page[at:])
    flush()
    return article, other, chaff_blocks, found


def host_of(url: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("/")[0].split("?")[0].lower()


PARSED = "page_id long, url string, marked boolean, host string, key binary, article array<string>, other array<string>, chaff array<string>"


def parsed(pages: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                article, other, chaff, marked = blocks(page or "")
                host = host_of(url or "")
                key = hashlib.blake2b(f"{host}\0{page or ''}".encode(), digest_size=16).digest()
                out.append((page_id, url, marked, host, key, article, other, chaff))
            if out:
                kinds = [pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.binary(), *[pa.list_(pa.string())] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in PARSED.split(", ")])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, PARSED)


def stream(*parts: list[str]) -> list[str]:
    return [t for part in parts for x in part for t in x.split(" ")]


def suffixes(found: DataFrame, least: int = RUN_TOKENS) -> DataFrame:
    """(host, head, key, pos): the first ``least`` tokens of every suffix of a page's stream beyond its article."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for host, key, other, chaff in zip(*(c.to_pylist() for c in batch.columns)):
                t = stream(other, chaff)
                n = max(0, len(t) - least + 1)
                for c, x in zip(out, ([host] * n, (" ".join(t[i : i + least]) for i in range(n)), [key] * n, range(n))):
                    c.extend(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.binary(), pa.int32()))], names=["host", "head", "key", "pos"])

    return found.select("host", "key", "other", "chaff").mapInArrow(run, "host string, head string, key binary, pos int")


def repeated(array: DataFrame) -> DataFrame:
    """(key, pos) of the suffixes whose first tokens begin a suffix in another page of the host too.

    The sorted suffixes are dealt by ranges of all their columns, so neither a
    host nor a run that a third of the pages have is one task's. One pass keeps
    the suffixes of a single page until another page's follows; what stands at
    either end of a range may go on beyond it and is settled by a join with the
    heads that ends of ranges have in several pages.
    """
    names = ["host", "head", "key", "pos"]
    sure, open_, seen = 1, 2, 3

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        first = True  # in the range's first group
        pages: list[bytes] = []  # up to two different ones
        held: list[tuple] = []  # suffixes of a group's only page so far

        def ended(last: bool) -> list[tuple]:
            """What is left of a group that may go on in another range: its suffixes without a verdict, or the pages that give others theirs."""
            if not (first or last):
                return []
            return [(*now, page, -1, seen) for page in pages] if len(pages) > 1 else [(*r, open_) for r in held]

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != now:
                    if now is not None:
                        out += ended(False)
                        first = False
                    now, pages, held = row[:2], [], []
                if len(pages) < 2 and row[2] not in pages:
                    pages.append(row[2])
                    if len(pages) == 2:
                        out += [(*r, sure) for r in held]
                        held = []
                if len(pages) == 2:
                    out.append((*row, sure))
                else:
                    held.append(row)
            if out:
                yield made(out)
        if now is not None and (out := ended(True)):
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[*names, "state"])

    dealt = array.repartitionByRange(*names).sortWithinPartitions(*names)
    scanned = materialize(dealt.mapInArrow(scan, "host string, head string, key binary, pos int, state int"), "suffix-array")
    ends = scanned.filter(f"state <> {sure}").groupBy("host", "head").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    often = materialize(ends.filter("lo <> hi").select("host", "head"), "range-ends")
    settled = scanned.filter(f"state = {open_}").join(often, ["host", "head"])
    return scanned.filter(f"state = {sure}").select("key", "pos").union(settled.select("key", "pos"))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of each page.

    Null and empty html gives empty text; a null URL belongs to the nameless
    host; repeated rows give a row each and count as one page of their host; an
    empty table gives no rows. Runs that near copies without an article share
    count as repeated.
    """
    small_batches(pages.sparkSession)
    found = materialize(parsed(pages), "parsed")  # each page is parsed once
    marked = found.filter("marked").select("page_id", "url", F.array_join("article", " ").alias("text"))
    hosts = materialize(found.filter("NOT marked").select("host").distinct(), "hosts")  # the others' arrays decide nothing
    array = suffixes(found.join(hosts, "host", "left_semi"))
    runs = materialize(repeated(array).distinct().groupBy("key").agg(F.collect_list("pos").alias("at")), "runs")

    def unique(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for other, at in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                t = stream(other)
                hit = np.zeros(len(t) + 1, np.int64)
                for k in at or ():
                    if k < len(t):
                        hit[k] += 1
                        hit[min(k + RUN_TOKENS, len(t))] -= 1
                texts.append(" ".join(x for x, h in zip(t, np.cumsum(hit)) if not h))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    bare = found.filter("NOT marked").select("page_id", "url", "key", "other").join(runs, "key", "left")
    bare = bare.select("page_id", "url", "other", "at").mapInArrow(unique, "page_id long, url string, text string")
    out = marked.unionByName(bare)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_host_suffix_array(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
