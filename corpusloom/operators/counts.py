"""Counting tokens and harmonising count lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from ..functions.tokenize import has_content, lossy_tokens, smash_digits

Smash = Callable[[Column], Column]
BAD = ("", "¶", "￼", "�")


def good_tokens(tokens: Column) -> Column:
    """Quotes uncurled, marked and empty tokens out, then apostrophes off the ends: what is left empty by that still counts in the total."""
    kept = F.filter(F.transform(tokens, X.uncurl_quotes), lambda t: ~t.startswith("__") & ~t.isin(*BAD))
    return F.transform(kept, lambda t: F.btrim(t, F.lit("'")))


def exploded(df: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    return df.select(*keys, F.explode(good_tokens(F.col(tokens))).alias("token"))


def count_tokens(df: DataFrame, keys: list[str], tokens: str = "tokens", least: int = 2) -> DataFrame:
    """(keys, token, count) of tokens met ``least`` times; with a ``pos`` column, also where each was first seen."""
    if "pos" in df.columns:
        rows = df.select(*keys, "pos", F.posexplode(good_tokens(F.col(tokens))).alias("at", "token"))
        agg = [F.count("*").alias("count"), F.min(F.struct("pos", "at")).alias("first_seen")]
    else:
        rows, agg = exploded(df, keys, tokens), [F.count("*").alias("count")]
    return rows.groupBy(*keys, "token").agg(*agg).filter((F.col("count") >= least) & has_content(F.col("token")))


def count_totals(df: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """(keys, total) over every token, rare ones and punctuation included; no explode, sizes are summed."""
    return df.groupBy(*keys).agg(F.sum(F.size(good_tokens(F.col(tokens)))).cast("bigint").alias("total"))


def recount(rows: DataFrame, keys: list[str], term: str = "term", count: str = "count", smash: Smash = smash_digits) -> DataFrame:
    """(keys, token, count): every token of a term gets the term's whole count; punctuation is left out."""
    return recounted(rows, keys, term, count, smash).groupBy(*keys, "token").agg(F.sum("count").alias("count")).filter(has_content(F.col("token")))


def recount_totals(rows: DataFrame, keys: list[str], term: str = "term", count: str = "count") -> DataFrame:
    return recounted(rows, keys, term, count).groupBy(*keys).agg(F.sum("count").alias("total"))


def recounted(rows: DataFrame, keys: list[str], term: str, count: str, smash: Smash = smash_digits) -> DataFrame:
    kept = rows.filter(~F.col(term).startswith("__total__"))
    return kept.select(*keys, F.col(count).cast("bigint").alias("count"), F.explode(lossy_tokens(F.col(term), smash)).alias("token"))


def merge_counts(*lists: DataFrame, key: str = "term") -> DataFrame:
    """Sum by term over any number of (term, count) lists; empty terms go."""
    rows = lists[0].select(key, "count")
    for other in lists[1:]:
        rows = rows.unionByName(other.select(key, "count"))
    return rows.filter(F.col(key) != "").groupBy(key).agg(F.sum("count").alias("count"))


def ngram_floor(shards: DataFrame, least: int = 100) -> DataFrame:
    """(term, count): rows of ``least`` and more in their shard, summed over shards."""
    per = shards.groupBy("shard", "term").agg(F.sum("count").alias("count")).filter(F.col("count") >= least)
    return per.groupBy("term").agg(F.sum("count").alias("count"))
