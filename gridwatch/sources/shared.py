"""Tables in the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own on one machine (as in tests) and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-gridwatch-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/gridwatch-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
