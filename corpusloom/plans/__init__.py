"""Whole plans and the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import registry, wordfreq


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordfreq.tiers(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
