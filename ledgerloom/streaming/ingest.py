"""Strict ingestion of row families that arrive as files: the batch operators, unchanged, over a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ledgerloom.sources.files import parse_rows


def stream_rows(spark: SparkSession, path: str, family: str) -> DataFrame:
    """family, id, row, error of each line of the files that come to ``path``."""
    return parse_rows(spark.readStream.schema("value string").text(path), family)


def append_available(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append all that has arrived, once each, and stop."""
    flat = rows.selectExpr("family", "id", "to_json(row) AS row", "error")
    return flat.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
