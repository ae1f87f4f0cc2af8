"""Parallel text: alignment by position, cleaning, splitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X
from ..sources.shared import written


def numbered(df: DataFrame, *order: str, out: str = "pos") -> DataFrame:
    """Positions from 0 in a total order, without bringing all rows together.

    Rows are dealt by ranges of the order and numbered in them; a row for each
    range carries the offsets.
    """
    dealt = written(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(starts), "_pid").withColumn(out, (F.col("_start") + F.col("_own") - 1).cast("bigint")).drop("_pid", "_own", "_start")


def zip_lines(a: DataFrame, b: DataFrame) -> DataFrame:
    """(pos, text1, text2) of (pos, text) sides; the shorter one is filled with empty lines."""
    both = a.select("pos", F.col("text").alias("text1")).join(b.select("pos", F.col("text").alias("text2")), "pos", "full_outer")
    return both.select("pos", F.coalesce("text1", F.lit("")).alias("text1"), F.coalesce("text2", F.lit("")).alias("text2"))


def no_private_use(*texts: Column) -> Column:
    """No character of U+E000 to U+EFFF in any of them."""
    return ~reduce(lambda a, b: a | b, [t.rlike("[\ue000-\uefff]") for t in texts])


def notes(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^♪]", ""))


def fits(text1: Column, text2: Column) -> Column:
    """Equal numbers of ♪ and a length ratio between a quarter and four, ends left out."""
    a, b = (F.length(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")) for t in (text1, text2))
    ratio = F.when(b > 0, a / b).otherwise(0.0)
    return (notes(text1) == notes(text2)) & (ratio > 0.25) & (ratio < 4.0)


def clean_pairs(lines: DataFrame, lang1: Column, lang2: Column, want1: str, want2: str, column: str = "line") -> DataFrame:
    """Lines of exactly two fields that fit, each side detected as the language it should be; (text1, text2), ends trimmed."""
    plain = lambda x: "zh" if x == "zh-x-oversimplified" else x
    parts = F.split(F.replace(F.col(column), F.lit("\n"), F.lit(" ")), "\t")
    rows = lines.filter(F.size(parts) == 2).withColumns({"text1": parts[0], "text2": parts[1]}).filter(fits(F.col("text1"), F.col("text2")))
    rows = rows.filter((lang1 == plain(want1)) & (lang2 == plain(want2)))
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return rows.select(trim(F.col("text1")).alias("text1"), trim(F.col("text2")).alias("text2"))


def shuffled_key(*columns: str) -> Column:
    """A fixed pseudo-random order: the digest of the columns."""
    return F.md5(F.concat_ws("\x1f", *[F.col(c).cast("string") for c in columns]))


def split_sets(pairs: DataFrame, id_column: str, test: int = 10_000, valid: int = 10_000) -> DataFrame:
    """Adds ``part``: the first rows of a shuffled order are the test set, the next the validation set, the rest training."""
    order = pairs.withColumn("_key", shuffled_key(id_column))
    placed = numbered(order, "_key", id_column, out="_pos")
    part = F.when(F.col("_pos") < test, "test").when(F.col("_pos") < test + valid, "valid").otherwise("train")
    return placed.withColumn("part", part).drop("_key", "_pos")


def every_nth(df: DataFrame, order: str, n: int, first: int) -> DataFrame:
    """Rows ``first``, first + n, ... in an order, counted from 1."""
    return numbered(df, order, out="_pos").filter((F.col("_pos") + 1) % n == first % n).drop("_pos")


def aligner_lines(pairs: DataFrame) -> DataFrame:
    """(direction, line): both directions of pairs without an empty side."""
    kept = pairs.filter("text1 <> '' AND text2 <> ''")
    lines = F.array(F.struct(F.lit("forward").alias("direction"), X.aligner_line(F.col("text1"), F.col("text2")).alias("line")), F.struct(F.lit("backward").alias("direction"), X.aligner_line(F.col("text2"), F.col("text1")).alias("line")))
    return kept.select(F.explode(lines).alias("x")).select("x.*")


def without_cyrillic(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(~F.col(column).rlike("[А-Яа-я]"))


def non_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(F.length(column) > 0)
