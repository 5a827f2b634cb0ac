"""Shared tables: lineage is cut by Parquet tables below ``spark.checkpoint.dir``.

A table that is written there is committed once and can be read by any executor,
so a lost executor costs no more than the tasks it was running. Results read these
tables, so they stay until ``drop_tables`` is called once the results are written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_FOLDERS: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``. Where that is unset, a local session gets a folder of its own;
    on a cluster it is an error, as machines would not see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        base = _LOCAL[app]
    path = f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def save(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a new shared table and return a reader of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, buckets: int, column: str) -> DataFrame:
    spark = df.sparkSession
    name = f"ledgerloom_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", f"{shared_dir(spark)}/blocks").saveAsTable(name)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's shared tables; what reads them cannot be run again."""
    app = spark.sparkContext.applicationId
    for name in _TABLES.pop(app, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for folder in _FOLDERS.pop(app, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
