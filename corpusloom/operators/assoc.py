"""Co-occurrence of vocabulary words across and within the languages of parallel lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as X
from .freqs import top_words


def vocabulary(freqs: DataFrame, size: int) -> DataFrame:
    """(idx, uri): languages sorted, each one's first words; bounded by size times languages, so one window numbers it."""
    top = top_words(freqs, size)
    return top.select((F.row_number().over(Window.orderBy("lang", "rank")) - 1).alias("idx"), X.short_uri(F.col("lang"), F.col("word")).alias("uri"))


def line_words(pairs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(line, idx) of the words of both sides that the vocabulary has; pairs: (line, lang1, tokens1, lang2, tokens2)."""
    side = lambda n: pairs.select("line", F.explode(F.transform(f"tokens{n}", lambda t: F.concat_ws("/", F.col(f"lang{n}"), t))).alias("uri"))
    return side(1).union(side(2)).join(vocab, "uri").select("line", "idx")


def cooccurrences(pairs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(idx1, idx2, n): ordered pairs of one line with multiplicity, self-pairs included.

    Words of a line are counted first, so a repeated word costs one row, and the
    pairs of counts are added up; what a line emits depends on its different
    words alone.
    """
    per = line_words(pairs, vocab).groupBy("line", "idx").agg(F.count("*").alias("c"))
    lines = per.groupBy("line").agg(F.collect_list(F.struct("idx", "c")).alias("w"))
    firsts = lines.select(F.explode("w").alias("a"), "w").select("a", F.explode("w").alias("b"))
    return firsts.groupBy(F.col("a.idx").alias("idx1"), F.col("b.idx").alias("idx2")).agg(F.sum(F.col("a.c") * F.col("b.c")).alias("n"))
