"""Cutting lineage where a plan must not be computed twice with different outcomes, or grows in a loop."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder. Where none is set, a local session gets a folder of its own; on a cluster it is
    an error, as machines would not see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_path(spark))
    return df.checkpoint()


def saved(df: DataFrame) -> DataFrame:
    """A table in the shared folder, for loops: unlike a checkpoint it starts afresh for the optimizer, which would else carry what
    it knows of all earlier rounds' expressions from round to round."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
