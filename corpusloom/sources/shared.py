"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of texts that a Python worker gets at once.
ARROW_ROWS, ARROW_BYTES = 4096, 1 << 22


def small_batches(spark: SparkSession) -> None:
    """One size for all operators, as plans read it when they run: a worker's memory doesn't grow with the files."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a folder of our own for a local master alone, as executors of a cluster don't share one."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, which goes when the application ends: what numbering or sampling gave stays as it is when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
