"""Frequencies, the trimmed-mean merge and the exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as X

LEAST, MASS = 1e-9, 0.99


def guard(rows: DataFrame, word: str = "word") -> DataFrame:
    """Refuses count files: a total among the rows is an error."""
    bad = F.col(word) == "__total__"
    return rows.withColumn(word, F.when(bad, F.raise_error(F.lit("this is a count file, not a frequency file"))).otherwise(F.col(word)))


def frequencies(counts: DataFrame, totals: DataFrame, keys: list[str], merge: bool = True) -> DataFrame:
    """(keys, word, freq) of counts over their list's total.

    Totals are a row per list and small, but joined as equals: adaptive
    execution broadcasts them where they are. For a merge, quotes are uncurled
    and stripped, empty words go and collided words add up.
    """
    joined = counts.join(totals.withColumnRenamed("total", "_total"), keys)
    rows = joined.select(*keys, F.col("token").alias("word"), (F.col("count") / F.col("_total")).alias("freq")).filter(F.col("freq") >= LEAST)
    if merge:
        rows = rows.withColumn("word", X.strip_quotes(X.uncurl_quotes(F.col("word")))).filter("word <> ''")
    return rows.groupBy(*keys, "word").agg(F.sum("freq").alias("freq")) if merge else rows


def trimmed_mean(values: Column, n: Column) -> Column:
    """Mean of ``n`` values without the least and the greatest; missing ones are 0."""
    all_ = F.array_sort(F.concat(values, F.array_repeat(F.lit(0.0), (n - F.size(values)).cast("int"))))
    return F.aggregate(F.slice(all_, F.lit(2), (n - 2).cast("int")), F.lit(0.0), lambda a, x: a + x) / (n - 2)


def merge_freqs(freqs: DataFrame, lists: DataFrame, key: str = "lang") -> DataFrame:
    """(key, word, freq): trimmed mean over each key's lists, scaled to sum to 0.99.

    ``lists`` has (key, n), the number of lists by the catalogue, whether or not
    they have rows; fewer than three are an error. A word's array has at most n
    values, so no group grows with the data.
    """
    per = freqs.groupBy(key, "word").agg(F.collect_list("freq").alias("f")).join(lists, key)
    n = F.when(F.col("n") < 3, F.raise_error(F.lit("a merge needs three lists"))).otherwise(F.col("n"))
    means = per.select(key, "word", trimmed_mean(F.col("f"), n).alias("freq")).filter("freq > 0")
    totals = means.groupBy(key).agg(F.sum("freq").alias("_total"))  # combined map-side: no window over a whole language
    return means.join(totals, key).select(key, "word", (F.col("freq") / F.col("_total") * MASS).alias("freq"))


def neg_cb(freq: Column) -> Column:
    """Negative centibels of the frequency as its text has it, rounded half to even."""
    return (-F.rint(F.log10(X.to_5g(freq)) * 100)).cast("int")


def cb_rows(freqs: DataFrame, cutoff: int) -> DataFrame:
    """(lang, word, neg_cb) under the cutoff."""
    return guard(freqs).withColumn("neg_cb", neg_cb(F.col("freq"))).filter(F.col("neg_cb") < cutoff).drop("freq")


def cb_tiers(freqs: DataFrame, cutoff: int, key: str = "lang") -> DataFrame:
    """(key, neg_cb, words): tiers from 0 to the last, empty ones too, each sorted."""
    tiers = cb_rows(freqs, cutoff).groupBy(key, "neg_cb").agg(F.array_sort(F.collect_list("word")).alias("words"))
    all_ = tiers.groupBy(key).agg(F.max("neg_cb").alias("_m")).select(key, F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("neg_cb"))
    return all_.join(tiers, [key, "neg_cb"], "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))


def jieba_rows(freqs: DataFrame, cutoff: int) -> DataFrame:
    """(word, ppb): parts per billion rounded half to even, under the cutoff, blank words out."""
    rounded = X.to_5g(F.col("freq"))
    kept = guard(freqs).filter(-F.log10(rounded) * 100 < cutoff).filter(F.trim("word") != "")
    return kept.withColumn("ppb", F.rint(rounded * 1e9).cast("bigint")).drop("freq")


def top_words(freqs: DataFrame, k: int, key: str = "lang") -> DataFrame:
    """(key, word, freq, rank): the k first words of each key, by frequency and word, both falling. Limited before the shuffle by Spark's group limit."""
    order = Window.partitionBy(key).orderBy(F.desc("freq"), F.desc("word"))
    return freqs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
