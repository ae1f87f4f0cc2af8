"""Cleaning of comments and tweets, in the order that matters: cheap filters first, detection last."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from ..functions.murmur import name_hash
from ..functions.tokenize import clean
from ..sources.shared import small_batches

DELETED = ("[deleted]", "[removed]")


def targeted_fixes(text: Column) -> Column:
    """Declared non-deterministic, so that a filter on what is made of it doesn't make it a second time."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else clean(t))

    return run.asNondeterministic()(text)


def good_comments(comments: DataFrame, least: int = 2) -> DataFrame:
    """Scored ``least`` and more, with a body that is still there."""
    return comments.filter((F.col("score") >= least) & F.col("body").isNotNull() & ~F.col("body").isin(*DELETED))


def allowed(comments: DataFrame, denied: DataFrame, name: str = "subreddit") -> DataFrame:
    """Comments of names whose hash isn't on the list (hash). Each name is hashed once; a missing name is allowed.

    The names met that are on the list are fewer than the list, so they go to
    the comments: dealt by name, those of a frequent one would meet in a task.
    """
    names = comments.select(F.col(name).alias("_name")).filter("_name IS NOT NULL").distinct()
    bad = names.withColumn("hash", name_hash(F.col("_name"))).join(denied.select("hash").distinct(), "hash", "left_semi").select("_name")
    return comments.join(F.broadcast(bad), F.col(name) == F.col("_name"), "left_anti")


def comment_text(body: Column) -> Column:
    """Line breaks, references and markup fixed; one line, without zero-width spaces and URLs."""
    out = X.strip_markdown(targeted_fixes(body))
    return X.strip_urls(F.translate(out, "\n​", " "))


def english_bar(lang: Column, score: Column, least: int = 2) -> Column:
    return (lang != "en") | (score > least)


def preprocess_reddit(comments: DataFrame, denied: DataFrame, detect: Callable[[Column], Column]) -> DataFrame:
    """(lang, text) of comments that pass every filter. The detected language is a column of its own, so it is found once."""
    small_batches(comments.sparkSession)
    kept = allowed(good_comments(comments), denied).select("score", comment_text(F.col("body")).alias("text")).filter("text <> ''")
    tagged = kept.withColumn("lang", detect(F.col("text"))).filter("lang <> 'und'")
    return tagged.filter(english_bar(F.col("lang"), F.col("score"))).select("lang", "text")


def tweet_text(line: Column) -> Column:
    out = X.strip_tco(X.strip_handles(X.rstrip(X.drop_tab_prefix(line))))
    return targeted_fixes(out)


def preprocess_twitter(lines: DataFrame, detect: Callable[[Column], Column], column: str = "text") -> DataFrame:
    small_batches(lines.sparkSession)
    kept = lines.select(tweet_text(F.col(column)).alias("text")).filter("text <> ''")
    return kept.withColumn("lang", detect(F.col("text"))).filter("lang <> 'und'").select("lang", "text")
