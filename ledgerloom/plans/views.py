"""Views over the test tables that stand in for release data; the same text serves Spark and the oracle."""

from __future__ import annotations

import gzip
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations"]

#: In the texts {sha}, {shaarg}, {div} and {olen} differ between the engines.
VIEWS = {
    "v_rows_base": """SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part WHERE p_partkey % 17 <> 0""",
    "v_rows_cand": """SELECT p_partkey AS id, p_name, CASE WHEN p_partkey % 7 = 0 THEN concat(p_brand, 'X') ELSE p_brand END AS p_brand, p_type, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size, CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN p_partkey % 14 = 0 THEN CAST(1 AS DECIMAL(1,0)) ELSE CAST(0 AS DECIMAL(1,0)) END AS p_retailprice FROM part WHERE p_partkey % 13 <> 0""",
    "v_objects": """SELECT concat(source, '/', CAST(doc_id AS STRING)) AS logical_key, doc_id, {sha}(text{shaarg}) AS sha, CAST({olen} AS BIGINT) AS bytes FROM documents""",
    "v_refs": """SELECT doc_id AS ref_id, CASE WHEN doc_id % 50 = 0 THEN doc_id + 1000000 ELSE doc_id END AS asset_id FROM labels""",
    "v_colors": """SELECT p_partkey AS ord, CASE WHEN p_partkey % 2 = 0 THEN 'tile' ELSE 'wall' END AS kind, CAST(p_partkey % 700 AS INT) AS type, CAST(p_partkey % 5 AS INT) AS variant, CAST(p_partkey % 4 AS INT) AS paint, CAST((p_partkey * 37) % 256 AS INT) AS r, CAST((p_partkey * 91) % 256 AS INT) AS g, CAST((p_size * 5) % 256 AS INT) AS b, p_size % 3 = 0 AS stable FROM part""",
    "v_query_colors": """SELECT c_custkey AS qid, CAST((c_custkey * 53) % 256 AS INT) AS r, CAST((c_custkey * 29) % 256 AS INT) AS g, CAST((c_custkey * 11) % 256 AS INT) AS b FROM customer""",
    "v_ops": """SELECT conv_id, turn, concat(role, ':', CAST(length(text) % 97 AS STRING)) AS op FROM conversations""",
    "v_line_cells": """SELECT user_id AS line, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS cell, event_type AS a, CAST(event_id % 2 AS INT) AS w FROM events""",
    "v_stage_samples": """SELECT event_type AS stage, event_id AS seq, CAST(value AS DECIMAL(18,2)) AS metric, ts AS taken FROM events""",
    "v_alias": """SELECT p_partkey AS id, CASE WHEN p_partkey > 0 AND p_partkey % 5 = 0 THEN CAST(p_partkey {div} 5 AS BIGINT) END AS copy_of FROM part""",
    "v_edges": """SELECT p_partkey AS src, 2 * p_partkey + 1 AS dst, 1 + p_size AS w FROM part WHERE p_partkey % 3 <> 2 UNION ALL SELECT p_partkey, 2 * p_partkey + 2, 1 + p_size FROM part""",
    "v_paths": """SELECT page_id, CASE WHEN page_id % 10 = 0 THEN concat('../', CAST(page_id AS STRING)) WHEN page_id % 10 = 1 THEN 'CON.txt' WHEN page_id % 10 = 2 THEN concat('dir', CAST(page_id AS STRING), '/') WHEN page_id % 10 = 3 THEN concat('a/b', CAST(page_id AS STRING), '.') ELSE regexp_replace(url, '^https?://', '') END AS path FROM pages""",
    "v_locale_en": """SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey % 3 <> 0""",
    "v_locale_zh": """SELECT p_partkey AS id, concat('zh-', p_name) AS name FROM part WHERE p_partkey % 4 <> 0""",
    "v_declared": """SELECT l_orderkey AS pack, count(*) + CASE WHEN l_orderkey % 40 = 0 THEN 1 ELSE 0 END AS declared_rows FROM lineitem GROUP BY l_orderkey""",
    "v_nested": """SELECT page_id AS id, concat('{"id":', CAST(page_id AS STRING), ',"slots":[{"assigned":true,"assetId":"k', CAST(page_id % 30 AS STRING), '"},{"assigned":', CASE WHEN page_id % 9 = 0 THEN 'true' ELSE 'false' END, ',"assetId":null}],"sub":{"assetId":"k', CAST(page_id % 40 AS STRING), '"}}') AS raw FROM pages""",
    "v_catalog_keys": """SELECT concat('k', CAST(n_nationkey AS STRING)) AS key FROM nation""",
    "v_part_keys": """SELECT concat('Item_', CAST(1000000000 + p_partkey AS STRING)) AS key FROM part WHERE p_partkey % 15 <> 14""",
    "v_selection": """SELECT p_partkey AS place, CASE WHEN p_partkey % 90 = 7 THEN '' ELSE concat('Item_', CAST(1000000000 + p_partkey - CASE WHEN p_partkey % 70 = 0 THEN 2 WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END AS STRING)) END AS key FROM part WHERE p_partkey % 4 <> 1""",
    "v_items": """SELECT p_partkey AS id, p_name AS name, p_size AS required, p_brand AS brand FROM part WHERE p_partkey > 0""",
    "v_research": """SELECT p_partkey AS id, CASE WHEN p_partkey % 41 = 0 THEN p_size + 1 ELSE p_size END AS required, concat('P', CAST(p_partkey AS STRING)) AS persistent_id FROM part WHERE p_partkey > 0 AND p_partkey % 37 <> 0""",
    "v_tooltips": """SELECT p_partkey AS id, p_type AS tooltip FROM part WHERE p_partkey % 2 = 0""",
    "v_ui_tooltips": """SELECT p_partkey AS id, concat(p_brand, ' ', p_type) AS ui_tooltip FROM part WHERE p_partkey % 3 = 0""",
    "v_bindings": """SELECT p_partkey AS id, concat(CASE WHEN p_partkey % 10 = 0 THEN 'ITEM_' ELSE 'Item_' END, CAST(p_partkey % 150 AS STRING)) AS asset FROM part WHERE p_partkey > 0""",
    "v_asset_catalog": """SELECT concat('Item_', CAST(p_partkey AS STRING)) AS key, p_size * 2 AS width, p_size + 3 AS height FROM part WHERE p_partkey % 15 <> 14""",
    "v_placements": """SELECT l_partkey % 50 AS tile, l_linenumber - 3 AS style, CAST(l_quantity AS INT) % 4 AS alternates, CASE WHEN l_partkey % 3 = 0 THEN 4 ELSE 0 END AS wrap FROM lineitem""",
    "v_flags": """SELECT p_partkey AS id, CAST(1 + p_size % 3 AS INT) AS options, p_partkey % 5 = 0 AS frame_important, p_partkey % 7 = 0 AS spreads, CAST(1 + p_partkey % 2 AS INT) AS width FROM part""",
    "v_pools": """SELECT p_type AS pool, p_partkey AS member FROM part UNION ALL SELECT 'EVEN', p_partkey FROM part WHERE p_partkey % 2 = 0""",
    "v_identity": """SELECT concat('s', CAST(s_suppkey AS STRING)) AS attr, r_name AS source, CASE WHEN s_suppkey % 6 = 0 AND r_regionkey = 2 THEN 'other' ELSE CAST(s_suppkey * 7 AS STRING) END AS value FROM supplier CROSS JOIN region""",
    "v_revoked": """SELECT CAST(s_suppkey * 7 AS STRING) AS value FROM supplier WHERE s_suppkey % 4 = 0""",
    "v_blobs": """SELECT concat(source, '/', CAST(doc_id AS STRING)) AS path, doc_id, coalesce(text, '') AS body FROM documents""",
    "v_shas": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN upper(concat('a', substr({sha}(text{shaarg}), 2))) WHEN doc_id % 7 = 0 THEN substr({sha}(text{shaarg}), 2) ELSE {sha}(text{shaarg}) END AS sha FROM documents""",
    "v_described": """SELECT doc_id, concat('objects/', substr({sha}(text{shaarg}), 1, 2), '/', {sha}(text{shaarg})) AS path, CASE WHEN doc_id % 31 = 0 THEN {sha}({sha}(text{shaarg}){shaarg}) ELSE {sha}(text{shaarg}) END AS sha, CAST({olen} AS BIGINT) AS bytes FROM documents""",
    "v_cases": """SELECT doc_id AS id, lang AS category, {sha}(text{shaarg}) AS out_a, CASE WHEN doc_id % 23 = 0 THEN 'x' ELSE {sha}(text{shaarg}) END AS out_b FROM documents""",
    "v_bucket_expected": """SELECT DISTINCT substr({sha}(text{shaarg}), 1, 2) AS bucket, {sha}(text{shaarg}) AS sha FROM documents""",
    "v_bucket_actual": """SELECT substr({sha}(text{shaarg}), 1, 2) AS bucket, {sha}(text{shaarg}) AS sha FROM documents WHERE doc_id % 29 <> 0""",
    "v_pointer": """SELECT 'stable' AS channel, {sha}(concat('release ', CAST(min(doc_id) AS STRING)){shaarg}) AS release_sha FROM documents""",
    "v_releases": """SELECT {sha}(concat('release ', CAST(doc_id AS STRING)){shaarg}) AS release_sha, concat('release ', CAST(doc_id AS STRING)) AS body FROM documents""",
    "v_literals": """SELECT s_suppkey AS lit_id, concat('item_', CAST(s_suppkey AS STRING)) AS literal FROM supplier""",
    "v_ids": """SELECT p_partkey AS ord, CASE WHEN p_partkey % 3 = 0 THEN concat('"', p_name, '"') ELSE CAST(p_partkey * 7 - 300 AS STRING) END AS id FROM part""",
    "v_path_tree": """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN concat('A', CAST(page_id % 7 AS STRING)) ELSE concat('a', CAST(page_id % 7 AS STRING), '/x', CAST(page_id AS STRING)) END AS path FROM pages""",
}
_SPARK = {"sha": "sha2", "shaarg": ", 256", "div": "DIV", "olen": "octet_length(text)"}
_DUCK = {"sha": "sha256", "shaarg": "", "div": "//", "olen": "strlen(text)"}


@F.arrow_udf(BinaryType())
def gzipped(content: pa.Array) -> pa.Array:
    """Content or UTF-8 text as gzip, the same bytes each time: what the views' objects are stored as."""
    return pa.array((gzip.compress(x.as_buffer(), mtime=0) if x.is_valid else None for x in content), pa.binary())


def _fill(text: str, names: dict[str, str]) -> str:
    for k, v in names.items():
        text = text.replace("{" + k + "}", v)
    return text


class Source:
    """The tables of a directory, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """A query over tables by name."""
        text = _fill(text, _SPARK)
        for t in TABLES:
            if re.search(rf"\b{t}\b", text):
                self.table(t).createOrReplaceTempView(t)
        return self.spark.sql(text)

    def __getitem__(self, view: str) -> DataFrame:
        return self.sql(VIEWS[f"v_{view}"])


def with_views(sql: str) -> str:
    """The oracle's SQL with the views that it names put in front."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    head = ", ".join(f"{n} AS ({_fill(VIEWS[n], _DUCK)})" for n in used)
    sql = _fill(sql, _DUCK).strip()
    if not used:
        return sql
    if sql.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {sql[14:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {head}, {sql[5:]}"
    return f"WITH {head} {sql}"
