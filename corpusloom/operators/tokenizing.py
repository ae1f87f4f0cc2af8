"""Tokenizing drivers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.langid import tag_distance
from ..functions.tokenize import token_text
from ..sources.shared import small_batches


def tokenize_lines(lines: DataFrame, lang: str, punctuation: bool = False, mojibake: bool = False, detect: Callable[[Column], Column] | None = None) -> DataFrame:
    """(text): tokens joined by spaces; with a detector only lines in the language or a close one. A line without tokens stays, empty."""
    small_batches(lines.sparkSession)
    rows = lines
    if detect is not None:
        near = F.udf(lambda d: tag_distance(d, lang) < 10, "boolean")
        langs = rows.withColumn("_lang", detect(F.col("text")))
        rows = langs.filter(near(F.col("_lang"))).drop("_lang")
    return rows.select(token_text(F.col("text"), F.lit(lang), punctuation, mojibake).alias("text"))


def tokenize_by_language(tagged: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, text) of the languages asked for, punctuation as tokens."""
    small_batches(tagged.sparkSession)
    kept = tagged.filter(F.col("lang").isin(languages))
    return kept.select("lang", token_text(F.col("text"), F.col("lang"), True).alias("text"))


def sp_encode(lines: DataFrame, model: str, column: str = "text") -> DataFrame:
    """Adds ``ids`` and ``pieces`` of a SentencePiece model; the model is read once per batch stream."""
    schema = T.StructType([*lines.select(column).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("pieces", T.ArrayType(T.StringType()))])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for frame in frames:
            texts = frame[column].fillna("").tolist()
            yield pd.DataFrame({column: frame[column], "ids": sp.encode(texts, num_threads=1) if texts else [], "pieces": sp.encode(texts, out_type=str, num_threads=1) if texts else []})

    return lines.select(column).mapInPandas(run, schema)


def sp_decode(rows: DataFrame, model: str, column: str = "ids") -> DataFrame:
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for frame in frames:
            yield pd.DataFrame({"text": [sp.decode([int(i) for i in ids]) for ids in frame[column]]}, dtype="object")

    return rows.select(column).mapInPandas(run, "text string")


def sp_vocabulary(spark, model: str, skip: int = 3) -> DataFrame:
    """(id, piece) of a model, but for its first ids, which are control pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    return spark.createDataFrame([(i, sp.id_to_piece(i)) for i in range(skip, sp.get_piece_size())], "id int, piece string")
