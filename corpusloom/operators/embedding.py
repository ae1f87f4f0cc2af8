"""Word vectors by skip-grams; without subwords, so not the same vectors as tools that use them."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import DataFrame


def skipgrams(lines: DataFrame, tokens: str = "tokens", size: int = 200, epochs: int = 20, least: int = 5, seed: int = 1) -> Word2VecModel:
    return Word2Vec(vectorSize=size, maxIter=epochs, minCount=least, seed=seed, inputCol=tokens, outputCol="vector").fit(lines)
