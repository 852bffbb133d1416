"""Tables in the cluster's shared folder, in place of lineage: what is written there outlives any executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; one of our own only where it is unset and Spark runs in this process, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="sluice-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written once as Parquet and read back, so that random or costly columns are computed a single time.

    Without a path of its own the table is deleted when the driver's JVM ends.
    """
    spark, own = df.sparkSession, path
    path = path or f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if not own:
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(file)
    return spark.read.schema(df.schema).parquet(path)
