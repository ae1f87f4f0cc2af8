"""Secret scans with corpus-wide ownership frequency, DataFrame operations only.

Matches of each kind are cut out with one split and one extraction per text;
their places follow from running sums of the lengths between them, over the
texts that have matches alone and once for all copies of a text. The hash of
each candidate value is counted by distinct owners and repositories: values
that several owners have are examples that people copy, values of one owner
look live. Values are first made distinct by (hash, owner, repository), so a
value with a third of all rows is pre-aggregated map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, table

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Shapes that the base kinds don't know; kept as spans where their value is owner-specific.
SHAPES = (
    r"gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]{40,}-----END"
    r"|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{0,39}[0-9])(?=[A-Za-z0-9+/_-]{0,39}[A-Z])(?=[A-Za-z0-9+/_-]{0,39}[a-z])[A-Za-z0-9+/_-]{40,}={0,2}"
)
#: kind, pattern, group of the value, its least length
KINDS = [("assign", ASSIGN, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("owned", SHAPES, 0, 16)]
BASE = 3
#: A value that so many owners share is an example.
COPIED_OWNERS = 3


def matches(text: Column, kind: int) -> Column:
    """Array of (kind, place in the order, characters since the match before, match)."""
    _, pattern, _, least = KINDS[kind]
    if kind in (1, 2):  # a run that is too short holds no longer one
        pattern = pattern[:-1] + "{%d,}" % (least - 4 if kind == 1 else least)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.when(F.size(found) > 0, F.transform(F.split(text, pattern, -1), lambda x: F.length(x)))
    return F.struct(found.alias("m"), gaps.alias("g"))


def listed(k: int):
    return lambda m, i: F.struct(F.lit(k).alias("kind"), i.alias("i"), F.get(F.col(f"k{k}.g"), i).alias("gap"), m.alias("match"))


def candidates(docs: DataFrame, owner: list[str], repo: list[str]) -> DataFrame:
    """(key, owner, repo, kind, i, gap, match) of every match, too short values included as they shift the others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = lambda cols: F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]) if cols else F.lit("")
    base = docs.select(text.alias("text"), name(owner).alias("owner"), name(repo).alias("repo"))
    base = base.select("owner", "repo", F.md5("text").alias("key"), *[matches(F.col("text"), k).alias(f"k{k}") for k in range(len(KINDS))])
    lists = [F.transform(F.col(f"k{k}.m"), listed(k)) for k in range(len(KINDS))]
    one = base.select("key", "owner", "repo", F.explode(F.concat(*lists)).alias("c"))
    return one.select("key", "owner", "repo", "c.*")


def value_hash() -> Column:
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    return F.sha2(value, 256)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value's hash, over the whole corpus."""
    each = found.select("hash", "owner", "repo").distinct()
    owners = each.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def spans_by_text(docs: DataFrame, owner: list[str] | None = None, repo: list[str] | None = None, copied: int = COPIED_OWNERS) -> DataFrame:
    """(key, spans) for every text with spans; key is its MD5, a span is (start, kind number, end, live)."""
    owner = [c for c in ("source",) if c in docs.columns] if owner is None else owner
    repo = [c for c in ("source", "lang") if c in docs.columns] if repo is None else repo
    found = materialize(candidates(docs, owner, repo), "secrets")
    before = Window.partitionBy("key", "kind").orderBy("i")
    once = found.groupBy("key", "kind", "i").agg(F.first("gap").alias("gap"), F.first("match").alias("match"))  # copies of a text agree
    end = F.sum(F.col("gap") + F.length("match")).over(before)
    placed = once.select("key", "kind", "match", end.alias("end"), (end - F.length("match")).alias("start"))
    least = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS[k][3]), range(1, len(KINDS)), F.when(F.col("kind") == 0, KINDS[0][3]))
    long = F.length(F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))) >= least
    owned = ownership(found.filter(long).withColumn("hash", value_hash()))
    judged = placed.filter(long).withColumn("hash", value_hash()).join(owned, "hash")
    live = F.col("n_owners") < copied
    kept = judged.filter((F.col("kind") < BASE) | live)
    return kept.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", live.alias("live")))).alias("spans"))


def of_kind(k: int):
    return lambda s: s.kind == k


def named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k, *_ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs: DataFrame, **how) -> DataFrame:
    """Spans and counts of each document.

    Null and empty texts have no spans; repeated rows and null ids give a row
    each; an empty table gives none. Null owners and repositories count as one
    nameless owner.
    """
    found = spans_by_text(docs, **how)
    out = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("key")).join(found, "key", "left")
    out = out.withColumn("spans", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    return out.select(
        "doc_id",
        *[count(of_kind(k)).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sha2(named(F.filter("spans", lambda s: s.kind < BASE)), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
        count(lambda s: s.live).alias("n_live"),
        count(lambda s: ~s.live).alias("n_example"),
    )


def redact(docs: DataFrame, **how) -> DataFrame:
    """The documents with every span masked: ``<SECRET>`` where its value looks live, ``<EXAMPLE>`` where owners share it.

    Overlapping spans are masked as one. ``n_chars`` follows the new text;
    documents without spans come back as they are.
    """
    found = spans_by_text(docs, **how).withColumnRenamed("key", "_key").withColumnRenamed("spans", "_spans")
    joined = docs.withColumn("_k", F.md5(F.coalesce(F.col("text"), F.lit("")))).join(found, F.col("_k") == F.col("_key"), "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def mask(a: Column, s: Column) -> Column:
        label = F.when(s.live, "<SECRET>").otherwise("<EXAMPLE>")
        gap = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s.start - a["at"]).cast("int"))
        fresh = F.struct(s.end.alias("at"), F.concat(a.out, gap, label).alias("out"))
        return F.when(s.start >= a["at"], fresh).otherwise(F.struct(F.greatest(a["at"], s.end).alias("at"), a.out.alias("out")))

    text = F.aggregate("_spans", start, mask, lambda a: F.concat(a.out, F.substr(F.col("text"), (a["at"] + 1).cast("int"))))
    clean = joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return clean.select(*docs.columns)


def op1_secret_ownership(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
