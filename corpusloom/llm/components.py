"""Connected components of a graph of links, as equi-joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import forget, materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).collect()[0]
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with a link, the label being its component's least node.

    Large-star and small-star steps in turn until nothing changes: a number of
    rounds logarithmic in the longest chain, each an aggregate that combines
    map-side and an equi-join, written to the shared folder. No group is ever
    collected, so a component may hold any share of the nodes. The least
    neighbours are written before they are joined: both sides of the join are
    then plain exchanges, and adaptive execution splits a node with many links.
    """
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before, old = now, edges
        both = _both(edges)
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        edges = materialize(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large-star")
        forget(old, least)
        old = edges
        least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = edges.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "small-star")
        forget(old, least)
    labels = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
