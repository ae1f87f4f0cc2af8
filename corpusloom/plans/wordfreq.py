"""Text -> tokens -> counts -> recount -> frequencies -> merged list -> tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.tokenize import plain_tokens, smash_digits
from ..operators import counts as C, freqs as Q


def tokenized(docs: DataFrame) -> DataFrame:
    return docs.select("lang", "source", plain_tokens(F.col("text")).alias("tokens"))


def source_counts(docs: DataFrame, smash: C.Smash = smash_digits) -> tuple[DataFrame, DataFrame]:
    """Harmonised counts and totals of each language and source: counted, then recounted."""
    counted = C.count_tokens(tokenized(docs), ["lang", "source"]).select("lang", "source", F.col("token").alias("term"), "count")
    keys = ["lang", "source"]
    rows = C.recounted(counted, keys, "term", "count", smash).groupBy(*keys, "token").agg(F.sum("count").alias("count"))
    totals = rows.groupBy(*keys).agg(F.sum("count").alias("total"))
    return rows, totals


def merged(docs: DataFrame, lists: DataFrame | None = None, smash: C.Smash = smash_digits) -> DataFrame:
    """(lang, word, freq) merged over the sources; ``lists`` (lang, n) defaults to the sources met."""
    rows, totals = source_counts(docs, smash)
    lists = docs.groupBy("lang").agg(F.countDistinct("source").alias("n")) if lists is None else lists
    return Q.merge_freqs(Q.frequencies(rows, totals, ["lang", "source"]), lists)


def tiers(docs: DataFrame, cutoff: int = 600, smash: C.Smash = smash_digits) -> DataFrame:
    return Q.cb_tiers(merged(docs, smash=smash), cutoff)
