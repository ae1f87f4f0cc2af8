"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows and bytes in an Arrow batch, the same for all operators: whole texts travel in them, so the bytes count too.
ARROW_ROWS, ARROW_BYTES = 4096, 1 << 22


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Where the session names none, one of our own is made for a local master
    alone: on a cluster each executor would write to its own disk.
    """
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder; what is there when the application ends goes with it."""
    path = f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    fs, at = _store(spark, path)
    fs.deleteOnExit(at)
    return path


def _store(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read it back.

    Non-deterministic columns (row numbers, partition numbers) are frozen by it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes materialized tables that no later plan reads."""
    for df in tables:
        fs, at = _store(df.sparkSession, df._written_to)
        fs.delete(at, True)


def small_batches(spark: SparkSession) -> None:
    """One size for all operators, as plans read it when they run, not when they are made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@contextmanager
def bloom_filtered(spark: SparkSession) -> Iterator[None]:
    """Joins that are planned inside drop rows of a wide side by a Bloom filter of the other's keys before they shuffle them.

    Spark makes such filters itself, but by default only for sides of 10 GB
    and a million keys. The filter has 8 MB at any size; keys beyond some ten
    million weaken it, and then more rows are shuffled with the same result.
    The narrow side has to be a scan under a comparison.
    """
    name = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": "0",
        "creationSideThreshold": str(1 << 50),
        "expectedNumItems": "4000000",
        "numBits": str(1 << 26),
    }
    before = {k: spark.conf.get(name + k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(name + k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(name + k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text) alone, null texts as empty ones; other columns can't clash."""
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
