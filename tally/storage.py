"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Where none is set, a local session, whose driver is its only executor, gets a new
    temporary folder; on a cluster that is an error, since executors would not see it.
    """
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{_SETTING} is not set; name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tally-")
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: its lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder, in whatever store it lies; one that does not exist is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
