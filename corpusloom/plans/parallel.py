"""Parallel text from line-aligned sides to aligner input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import parallel as P


def prepare(side1: DataFrame, side2: DataFrame, lang1: str, lang2: str, detect=None, test: int = 10_000, valid: int = 10_000) -> DataFrame:
    """(part, text1, text2) of two (pos, text) sides: zipped, private use out, cleaned, shuffled and split. One row holds a pair from end to end."""
    pairs = P.zip_lines(side1, side2).filter(P.no_private_use(F.col("text1"), F.col("text2")))
    lines = pairs.select(F.concat_ws("\t", "text1", "text2").alias("line"), "pos")
    given: tuple[Column, Column] = (F.lit(lang1), F.lit(lang2))
    if detect is not None:
        lines = lines.withColumns({"_l1": detect(F.split("line", "\t")[0]), "_l2": detect(F.split("line", "\t")[1])})
        given = (F.col("_l1"), F.col("_l2"))
    kept = P.clean_pairs(lines, *given, lang1, lang2)
    keyed = kept.withColumn("_id", F.md5(F.concat_ws("\t", "text1", "text2")))
    return P.split_sets(keyed, "_id", test, valid).drop("_id")


def aligner_input(pairs: DataFrame) -> DataFrame:
    return P.aligner_lines(pairs)
