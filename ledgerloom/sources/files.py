"""Strict readers of row families, and writers of rows in order. Files, objects and packs are in ``storage``, releases in ``releases``."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalars import json_identity, strict_object
from ledgerloom.operators.tables import sequence_digest

MAX_LINE_BYTES = 2 << 20
#: Where a line stands in a folder of files written in order.
PLACE = ["file", "block", "line"]


def _unzip(data: bytes, step: int = 1 << 20) -> dict:
    """Size and digest of decoded gzip, a piece at a time; nulls if it is broken or cut off."""
    size, sha = 0, hashlib.sha256()
    try:
        while data:
            d = zlib.decompressobj(31)
            while not d.eof:
                piece = d.decompress(data, step)
                if not piece and not d.unconsumed_tail and not d.eof:
                    raise EOFError
                size, data = size + len(piece), d.unconsumed_tail
                sha.update(piece)
            data = d.unused_data
    except (zlib.error, EOFError):
        return {"bytes": None, "sha": None}
    return {"bytes": size, "sha": sha.hexdigest()}


@F.arrow_udf(T.StructType([T.StructField("bytes", T.LongType()), T.StructField("sha", T.StringType())]))
def gzip_measure(content: pa.Array) -> pa.Array:
    """``bytes`` and ``sha`` of gzip content once decoded; nulls for null and for content that is no gzip. Objects leave their Arrow
    batch, whose bytes Spark bounds, one at a time."""
    found = [_unzip(x.as_py()) if x.is_valid else {"bytes": None, "sha": None} for x in content]
    return pa.array(found, pa.struct([("bytes", pa.int64()), ("sha", pa.string())]))


def measure_objects(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """path, sha, bytes of stored content, and ``decoded_bytes`` of what it holds as gzip."""
    return df.select(path, F.sha2(content, 256).alias("sha"), F.octet_length(content).cast("long").alias("bytes"), gzip_measure(content)["bytes"].alias("decoded_bytes"))


def parse_rows(lines: DataFrame, family: str, text: str = "value") -> DataFrame:
    """family, id (JSON text), row (variant), error of each line; ``error`` is null for a good row."""
    v = strict_object(F.col(text))
    ident = json_identity(v)
    error = F.when(F.octet_length(text) > MAX_LINE_BYTES, "too long").when(v.isNull(), "not one object").when(ident.isNull(), "no id")
    return lines.select(F.lit(family).alias("family"), F.when(error.isNull(), ident).alias("id"), F.when(error.isNull(), v).alias("row"), error.alias("error"))


def scan_ndjson_strict(spark: SparkSession, path: str, family: str, expected: int | None = None) -> DataFrame:
    """Rows of a newline-delimited family; errors stay as rows, and with ``expected`` a wrong count is one more."""
    rows = parse_rows(spark.read.text(path), family)
    if expected is None:
        return rows
    count = rows.agg(F.count("*").alias("n")).filter(F.col("n") != expected)
    wrong = count.select(F.lit(family).alias("family"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("variant").alias("row"), F.concat(F.lit("count is "), F.col("n").cast("string")).alias("error"))
    return rows.unionByName(wrong)


def release_body(pointers: DataFrame, releases: DataFrame, channel: str) -> DataFrame:
    """The release a channel points to, with ``ok`` false if its hash differs; no row for an absent pointer."""
    p = pointers.filter(F.col("channel") == channel).select("channel", F.col("release_sha").alias("wanted"))
    found = p.join(releases, p["wanted"] == releases["release_sha"], "left")
    return found.select("channel", F.col("wanted").alias("release_sha"), "body", F.coalesce(F.sha2("body", 256) == F.col("wanted"), F.lit(False)).alias("ok"))


def write_ordered_detail(changes: DataFrame, order: list[Column], path: str) -> DataFrame:
    """Write rows as JSON lines in order, range by range; returns rows, bytes and digest of what was written."""
    line = F.to_json(F.struct(*changes.columns), {"ignoreNullFields": "false"})
    ordered = changes.repartitionByRange(*order).sortWithinPartitions(*order).select(line.alias("value"))
    ordered.write.text(path)
    return describe_detail(changes.sparkSession, path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """value and its ``PLACE`` of lines that were written in order, file by file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def describe_detail(spark: SparkSession, path: str) -> DataFrame:
    """rows, bytes, digest of a detail as it is stored; the digest depends on the lines and their order alone."""
    lines = read_ordered(spark, path)
    size = lines.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).cast("long").alias("bytes"))
    return size.crossJoin(sequence_digest(lines, PLACE, F.col("value")))


def dimensions(catalog: DataFrame, key: str = "key") -> DataFrame:
    return catalog.select(F.col(key).alias("id"), "width", "height")


def write_dimensions(catalog: DataFrame, path: str, key: str = "key") -> None:
    """One JSON line a key, in the keys' order."""
    dimensions(catalog, key).orderBy("id").write.json(path)
