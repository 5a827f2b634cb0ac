"""The registered queries: each applies one operator to views over whole tables, with the oracle's SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.operators import colors as C
from ledgerloom.operators import diffs as D
from ledgerloom.operators import gates as G
from ledgerloom.operators import graphs as R
from ledgerloom.operators import joins as J
from ledgerloom.operators import tables as A
from ledgerloom.operators import windows as W
from ledgerloom.plans.stable import shared_path
from ledgerloom.plans.views import Source, gzipped, with_views
from ledgerloom.sources import files as I
from ledgerloom.sources import releases as P
from ledgerloom.sources import storage as O

c = F.col
_QUERIES: dict[str, Callable[[Source], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f: Callable[[Source], DataFrame]):
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = with_views(sql)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, f=f: f(Source(spark, sf_dir))) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- sources and sinks -----------------------------------------------------------------------------------------------

_JSON_ROW = "concat('{\"id\":', CAST(p_partkey AS STRING), ',\"n\":', CAST(p_size AS STRING), '}')"


@query("SELECT 'nested' AS family, CAST(id AS VARCHAR) AS id, CASE WHEN id % 7 = 0 THEN 'not one object' END AS error FROM v_nested WHERE id % 7 <> 0 UNION ALL SELECT 'nested', NULL, 'not one object' FROM v_nested WHERE id % 7 = 0")
def scan_ndjson_strict(v):
    """Written as lines to a new shared folder, and read from there."""
    lines = v["nested"].select(F.when(c("id") % 7 == 0, F.concat("raw", F.lit(" true"))).otherwise(c("raw")).alias("value"))
    path = f"{shared_path(v.spark)}/nested"
    lines.write.text(path)
    return I.scan_ndjson_strict(v.spark, path, "nested").select("family", "id", "error")


@query("SELECT CAST(id AS VARCHAR) AS id FROM v_nested")
def json_identity(v):
    return v["nested"].select(S.json_identity(F.parse_json("raw")).alias("id"))


def _written_packs(v, spoilt=None):
    """A JSON array file for each 16 conversations, every other one as gzip, in a new shared folder."""
    rows = v["ops"].groupBy(F.expr("conv_id DIV 16").alias("pack")).agg(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "op"))).alias("rows"))
    text = F.to_json(F.transform("rows", lambda x: x["op"]))
    text = text if spoilt is None else F.when(c("pack") % 3 == 0, F.concat(text, F.lit(spoilt))).otherwise(text)
    path, packs = shared_path(v.spark), rows.select("pack", text.alias("text")).repartition("pack")
    for folder, odd, kind in (("plain", 0, "none"), ("gzip", 1, "gzip")):
        packs.filter(c("pack") % 2 == odd).write.partitionBy("pack").option("compression", kind).text(f"{path}/{folder}")
    return [f"{path}/plain", f"{path}/gzip"]


_PACK_NUMBER = "CAST(regexp_extract(pack, 'pack=([0-9]+)', 1) AS BIGINT) AS pack"
_PACKS = "WITH p AS (SELECT conv_id // 16 AS pack, row_number() OVER (PARTITION BY conv_id // 16 ORDER BY conv_id, turn, op) - 1 AS pos, op FROM v_ops)"


@query(_PACKS + " SELECT CAST(pack AS BIGINT) AS pack, CAST(pos AS BIGINT) AS pos, op AS row FROM p")
def scan_pack_array(v):
    return O.scan_pack_array(v.spark, _written_packs(v)).selectExpr(_PACK_NUMBER, "pos", "variant_get(row, '$', 'string') AS row")


@query(_PACKS + " SELECT CAST(pack AS BIGINT) AS pack, CAST(count(*) AS BIGINT) AS pos, 'trailing data' AS error FROM p WHERE pack % 3 = 0 GROUP BY pack")
def scan_pack_array_faults(v):
    """Every third pack has a second value after its array."""
    return O.scan_pack_array(v.spark, _written_packs(v, " 1")).filter("error IS NOT NULL").selectExpr(_PACK_NUMBER, "pos", "error")


@query("SELECT key, width, height FROM v_asset_catalog")
def scan_catalog_map(v):
    """A JSON file for each beginning of a key, plain or as gzip, written to a new shared folder and read from there."""
    one = v["asset_catalog"].groupBy(F.substring("key", 1, 7).alias("file")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", F.struct("width", "height"))))).alias("text"))
    path = f"{shared_path(v.spark)}/catalog"
    for folder, odd, kind in (("plain", False, "none"), ("gzip", True, "gzip")):
        one.repartition("file").filter(F.endswith("file", F.lit("1")) == odd).write.partitionBy("file").option("compression", kind).text(f"{path}/{folder}")
    value = v["asset_catalog"].select(F.struct("width", "height").alias("s")).schema["s"].dataType
    return O.scan_catalog_map(v.spark, path, value).filter("error IS NULL").select("key", "value.width", "value.height")


@query()
def scan_files(v):
    return O.scan_files(v.spark, v.sf_dir, [".parquet"]).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "bytes", "sha256")


@query("SELECT 'stable' AS channel, p.release_sha, r.body, sha256(r.body) = p.release_sha AS ok FROM v_pointer p LEFT JOIN v_releases r USING (release_sha)")
def release_body(v):
    return I.release_body(v["pointer"], v["releases"], "stable")


def _released(v):
    """Two families written as a release to a new shared folder."""
    part = lambda name, df: df.select(F.lit(name).alias("family"), "id", F.to_json(F.struct("id", "name")).alias("value"))
    root = shared_path(v.spark)
    P.write_release(part("items", v["items"]).unionByName(part("names", v["locale_en"])), root, "stable", ["id"], 64)
    return root


_RELEASED = "WITH f AS (SELECT 'items' AS family, id, name FROM v_items UNION ALL SELECT 'names', id, name FROM v_locale_en)"


@query(_RELEASED + " SELECT family, CAST((row_number() OVER (PARTITION BY family ORDER BY id) - 1) % 64 AS BIGINT) AS pos, id, name, CAST(NULL AS VARCHAR) AS error FROM f")
def scan_release_by_pointer(v):
    """Packs, manifest and pointer are written, and the rows read back by way of the pointer."""
    rows = P.scan_release_by_pointer(v.spark, _released(v), "stable")
    return rows.select("family", "pos", F.variant_get("row", "$.id", "long").alias("id"), F.variant_get("row", "$.name", "string").alias("name"), "error")


@query(_RELEASED + " SELECT family, count(*) AS added FROM f GROUP BY 1")
def scan_release_absent(v):
    """A first publication: the channel has no pointer yet, so all rows are added to an empty baseline."""
    root = _released(v)
    base, cand = [P.scan_release_by_pointer(v.spark, root, x).select("family", F.variant_get("row", "$.id", "long").alias("id"), F.to_json("row").alias("row")) for x in ("next", "stable")]
    return D.diff_rows(base, cand, ["family", "id"]).filter("change = 'added'").groupBy("family").agg(F.count("*").alias("added"))


_OBJECT_SQL = "SELECT DISTINCT concat('objects/', substr({sha}(text{shaarg}), 1, 2), '/', {sha}(text{shaarg}), '.txt') AS path, {sha}(text{shaarg}) AS sha, CAST({olen} AS BIGINT) AS bytes FROM documents WHERE text IS NOT NULL"


@query(f"SELECT path, substr(sha, 1, 2) AS prefix, sha AS sha256, bytes FROM ({_OBJECT_SQL})")
def write_content_addressed(v):
    """Written twice to a new shared folder: the second time adds nothing to the files that are read back."""
    root = shared_path(v.spark)
    for _ in range(2):
        O.write_content_addressed(v.table("documents"), c("text"), ".txt", root)
    return O.scan_objects(v.spark, root).select("path", F.substring("sha", 1, 2).alias("prefix"), c("sha").alias("sha256"), "bytes")


@query(f"SELECT path, CASE WHEN bytes % 5 = 0 THEN 'bytes' ELSE 'missing' END AS reason FROM ({_OBJECT_SQL}) WHERE bytes % 5 = 0 OR bytes % 7 = 0")
def verify_stored_objects(v):
    """Texts stored under their address, against descriptors of which some have another size or stand for no file."""
    root = shared_path(v.spark)
    said = O.write_content_addressed(v.table("documents"), c("text"), ".txt", root)
    stored = F.when((c("bytes") % 7 == 0) & (c("bytes") % 5 != 0), F.concat("path", F.lit(".gone"))).otherwise(c("path"))
    described = said.select(stored.alias("path"), c("sha256").alias("sha"), F.when(c("bytes") % 5 == 0, c("bytes") + 1).otherwise(c("bytes")).alias("bytes"))
    return A.verify_objects(described, O.scan_objects(v.spark, root)).select(F.regexp_replace("path", "[.]gone$", "").alias("path"), "reason")


@query("SELECT doc_id, concat('objects/', substr(sha, 1, 2), '/', sha) AS path, substr(sha, 1, 2) AS prefix, sha FROM v_objects")
def object_path(v):
    return v["objects"].select("doc_id", S.object_path(c("sha")).alias("path"), S.hash_prefix(c("sha")).alias("prefix"), "sha")


@query("SELECT substr(sha, 1, 2) AS prefix, count(*) AS n FROM v_objects GROUP BY 1")
def hash_prefix(v):
    return v["objects"].groupBy(S.hash_prefix(c("sha")).alias("prefix")).agg(F.count("*").alias("n"))


@query("SELECT CAST(id // 256 AS BIGINT) AS shard, min(id) AS first, max(id) AS last, count(*) AS rows FROM v_rows_base GROUP BY 1")
def shard_by_id_range(v):
    return A.shard_by_id_range(v["rows_base"], "id")


@query("WITH x AS (SELECT o_orderstatus AS family, o_orderkey, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 256 AS shard FROM orders) SELECT family, CAST(shard AS BIGINT) AS shard, min(o_orderkey) AS first, max(o_orderkey) AS last, count(*) AS rows FROM x GROUP BY 1, 2")
def shard_by_row_count(v):
    return A.shard_by_row_count(v.table("orders").withColumn("family", c("o_orderstatus")), ["family"], "o_orderkey")


@query("SELECT doc_id, substr(sha, 1, 2) AS shard FROM v_objects")
def shard_by_hash_prefix(v):
    return A.shard_by_hash_prefix(v["objects"], "sha").select("doc_id", "shard")


@query("SELECT key AS id, width, height, CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS pos FROM v_asset_catalog")
def write_dimensions(v):
    """Written to a new shared folder, and read back with the lines' places there."""
    path = f"{shared_path(v.spark)}/dimensions"
    I.write_dimensions(v["asset_catalog"], path)
    lines = W.global_position(I.read_ordered(v.spark, path), I.PLACE)
    return lines.select(F.from_json("value", I.dimensions(v["asset_catalog"]).schema).alias("x"), "pos").select("x.*", "pos")


_FIELDS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_SAME = " AND ".join(f"b.{f} IS NOT DISTINCT FROM k.{f}" for f in _FIELDS)
_DIFF = f"WITH d AS (SELECT coalesce(b.id, k.id) AS id, CASE WHEN b.id IS NULL THEN 'added' WHEN k.id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM v_rows_base b FULL JOIN v_rows_cand k ON b.id = k.id WHERE b.id IS NULL OR k.id IS NULL OR NOT ({_SAME}))"


def _detail_sql(name: str, change: str) -> str:
    """Tables of the lines of a detail, its chunks, and ``name`` with what describes it."""
    line = f"concat('{{\"id\":', id, ',\"change\":\"', {change}, '\"}}')"
    return (
        f", {name}_l AS (SELECT {line} AS line, row_number() OVER (ORDER BY id) - 1 AS pos FROM d), {name}_c AS (SELECT pos // 4096 AS part, sha256(string_agg(line, chr(10) ORDER BY pos)) AS sha FROM {name}_l GROUP BY 1), "
        f"{name} AS (SELECT (SELECT count(*) FROM {name}_l) AS rows, (SELECT CAST(coalesce(sum(strlen(line) + 1), 0) AS BIGINT) FROM {name}_l) AS bytes, (SELECT sha256(string_agg(sha, chr(10) ORDER BY part)) FROM {name}_c) AS digest)"
    )


def _detail(v, base, cand):
    rows = D.diff_rows(v[base], v[cand], ["id"])
    return I.write_ordered_detail(rows, S.order_numeric_first(c("id").cast("string")), f"{shared_path(v.spark)}/detail")


@query(_DIFF + _detail_sql("t", "change") + " SELECT rows, bytes, digest FROM t")
def write_ordered_detail(v):
    """All changed rows, written to a new shared folder in order and described from what stands there."""
    return _detail(v, "rows_base", "rows_cand")


# --- projections and predicates --------------------------------------------------------------------------------------


@query(
    """WITH p AS (SELECT page_id, path, unnest(string_split(path, '/')) AS part, generate_subscripts(string_split(path, '/'), 1) AS i FROM v_paths),
    b AS (SELECT page_id, i, part IN ('', '.', '..') OR strlen(part) > 200 OR regexp_matches(part, '[ .]$') AS odd,
      lower(string_split(part, '.')[1]) IN ('con','prn','aux','nul','com1','com2','com3','com4','com5','com6','com7','com8','com9','lpt1','lpt2','lpt3','lpt4','lpt5','lpt6','lpt7','lpt8','lpt9') AS res FROM p),
    f AS (SELECT page_id, min(i) AS i FROM b WHERE odd OR res GROUP BY 1)
    SELECT v.page_id, CASE WHEN path = '' OR strlen(path) > 600 OR regexp_matches(path, '[\\\\:]') OR path LIKE '/%' THEN 'unsafe' WHEN regexp_matches(path, '[\\x01-\\x1f]') THEN 'control' WHEN b.odd THEN 'nonportable' WHEN b.res THEN 'reserved' END AS reason
    FROM v_paths v LEFT JOIN f USING (page_id) LEFT JOIN b ON b.page_id = f.page_id AND b.i = f.i"""
)
def valid_relative_path(v):
    return v["paths"].select("page_id", S.valid_relative_path(c("path")).alias("reason"))


@query("SELECT doc_id, doc_id % 3 <> 0 AS ok FROM v_objects")
def public_path_allowlist(v):
    path = F.when(c("doc_id") % 3 == 0, F.concat(F.lit("objects/zz/"), "sha", F.lit(".png"))).otherwise(S.object_path(c("sha"), ".json.gz"))
    return v["objects"].select("doc_id", S.public_path_allowlist(path).alias("ok"))


@query("SELECT doc_id, regexp_full_match(sha, '[0-9a-f]{64}') AS ok FROM v_shas")
def valid_sha(v):
    return v["shas"].select("doc_id", S.valid_sha(c("sha")).alias("ok"))


@query("SELECT doc_id, starts_with(path, concat('objects/', substr(sha, 1, 2), '/', sha)) AND regexp_full_match(sha, '[0-9a-f]{64}') AND bytes >= 0 AS ok FROM v_described")
def object_path_matches_hash(v):
    return v["described"].select("doc_id", S.object_path_matches_hash(c("path"), c("sha"), c("bytes")).alias("ok"))


def _object_faults(v):
    """Texts stored as gzip against descriptors of which some have another hash, and some another decoded size."""
    stored = v["blobs"].withColumn("content", gzipped(c("body")))
    wrong = lambda n, good, bad: F.when(c("doc_id") % n == 0, bad).otherwise(good)
    sha, size = F.sha2("content", 256), F.octet_length("body").cast("long")
    described = stored.select("path", wrong(31, sha, F.sha2(sha, 256)).alias("sha"), F.octet_length("content").cast("long").alias("bytes"), wrong(29, size, size + 1).alias("decoded_bytes"))
    return A.verify_objects(described, I.measure_objects(stored))


_OBJECT_FAULTS = "SELECT path, CASE WHEN doc_id % 31 = 0 THEN 'sha' ELSE 'decoded bytes' END AS reason FROM v_blobs WHERE doc_id % 31 = 0 OR doc_id % 29 = 0"


@query(_OBJECT_FAULTS)
def verify_objects(v):
    return _object_faults(v)


@query("SELECT ord, kind, type, variant FROM v_colors WHERE kind IN ('tile', 'wall') AND type BETWEEN 0 AND 32767 AND paint <> 3")
def valid_candidate(v):
    return J.valid_candidate(v["colors"].withColumn("paint", F.when(c("paint") == 3, 300).otherwise(c("paint")))).select("ord", "kind", "type", "variant")


@query("SELECT ord, CASE kind WHEN 'wall' THEN 1 ELSE 0 END AS code, CASE kind WHEN 'wall' THEN type | 32768 ELSE type END AS packed FROM v_colors")
def kind_code(v):
    return v["colors"].select("ord", S.kind_code(c("kind")).alias("code"), S.packed_kind_type(c("kind"), c("type")).alias("packed"))


@query("SELECT ord, concat_ws(',', CASE kind WHEN 'wall' THEN 1 ELSE 0 END, type, variant, paint, r, g, b, CASE WHEN stable THEN 1 ELSE 0 END) AS compact FROM v_colors")
def compact_row(v):
    return v["colors"].select("ord", F.array_join(C.candidate_rows(v["colors"]).cast("array<string>"), ",").alias("compact"))


@query("SELECT ord, CAST(row_number() OVER (ORDER BY ord) - 1 AS BIGINT) AS position FROM v_colors WHERE stable")
def stable_subset(v):
    return C.stable_subset(v["colors"], "stable", "ord").select("ord", "position")


@query("SELECT id, name FROM v_items WHERE id BETWEEN 1 AND 100000")
def valid_item_id(v):
    return J.valid_item_id(v["items"]).select("id", "name")


@query("SELECT id, CASE WHEN options <> 1 THEN 'options' WHEN frame_important THEN 'frame' WHEN spreads THEN 'spreads' WHEN width <> 1 THEN 'multi-cell' END AS reason FROM v_flags")
def rule_cascade(v):
    return v["flags"].select("id", S.rule_cascade([(c("options") != 1, "options"), (c("frame_important"), "frame"), (c("spreads"), "spreads"), (c("width") != 1, "multi-cell")]).alias("reason"))


@query("SELECT id, CASE WHEN options = 1 THEN 'direct' WHEN spreads THEN 'alias' ELSE 'unavailable' END AS status FROM v_flags")
def status_classify(v):
    return v["flags"].select("id", S.status_classify([(c("options") == 1, "direct"), (c("spreads"), "alias")], "unavailable").alias("status"))


@query("SELECT id, name, true AS name_there, brand, required IS NOT NULL AND id % 3 <> 0 AS required_there, id % 3 <> 0 AS kept FROM v_items")
def promote_fields(v):
    fields = [F.struct(F.lit("name").alias("k"), c("name").alias("v")), F.struct(F.lit("brand").alias("k"), c("brand").alias("v"))]
    more = F.struct(F.lit("required").alias("k"), c("required").cast("string").alias("v"))
    m = F.map_from_entries(F.when(c("id") % 3 != 0, F.array(*fields, more)).otherwise(F.array(*fields)))
    out = J.promote_fields(v["items"].select("id", m.alias("m")), "m", ["name", "brand"])
    return out.select("id", "name", "name_there", "brand", F.array_contains(F.map_keys("m"), "required").alias("required_there"), F.map_contains_key("m", "required").alias("kept"))


@query("SELECT id, CASE WHEN brand = 'Brand#1' THEN 1 ELSE 2 END AS kept FROM v_items")
def drop_default_values(v):
    values = F.create_map(F.lit("brand"), c("brand"), F.lit("name"), c("name"), F.lit("unit"), F.lit("piece"))
    return v["items"].select("id", F.size(S.drop_default_values(values, F.create_map(F.lit("brand"), F.lit("Brand#1"), F.lit("unit"), F.lit("piece")))).alias("kept"))


@query("SELECT key FROM v_asset_catalog WHERE key LIKE 'Item_1%' OR key LIKE 'Item_7%'")
def prefix_select(v):
    return J.prefix_select(v["asset_catalog"], "key", ["ITEM_1", "item_7", "item_77", "nothing"])[0].select("key")


@query("SELECT page_id, path, CASE WHEN lower(path) LIKE '%.txt' THEN 'text' END AS skipped FROM v_paths")
def skip_extension(v):
    return J.skip_extension(v["paths"], "path", ".TXT", "text").select("page_id", "path", "skipped")


def _rects(v):
    return v["bindings"].join(v["asset_catalog"], F.lower("asset") == F.lower("key")).select("id", (c("id") % 9 - 2).alias("x"), (c("id") % 4).alias("y"), (c("id") % 30).alias("w"), (c("id") % 17 + 1).alias("h"), "width", "height")


_RECT_SQL = "WITH q AS (SELECT b.id, b.id % 9 - 2 AS x, b.id % 4 AS y, b.id % 30 AS w, b.id % 17 + 1 AS h, width, height FROM v_bindings b JOIN v_asset_catalog a ON lower(b.asset) = lower(a.key))"


@query(_RECT_SQL + " SELECT id, x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= width AND y + h <= height AS ok FROM q")
def source_rect_check(v):
    q = _rects(v)
    return q.select("id", J.source_rect_check(*[c(k) for k in ("x", "y", "w", "h", "width", "height")]).alias("ok"))


@query(_RECT_SQL + ", z AS (SELECT id, least(greatest(x, 0), width) AS l, least(greatest(y, 0), height) AS t, least(greatest(x + w, 0), width) AS r, least(greatest(y + h, 0), height) AS b FROM q) SELECT id, CAST(l AS BIGINT) AS x, CAST(t AS BIGINT) AS y, CAST(greatest(r - l, 0) AS BIGINT) AS w, CAST(greatest(b - t, 0) AS BIGINT) AS h, greatest(r - l, 0) = 0 OR greatest(b - t, 0) = 0 AS empty FROM z")
def clamp(v):
    r = _rects(v).select("id", J.source_rect_clamp(*[c(k).cast("long") for k in ("x", "y", "w", "h", "width", "height")]).alias("r"))
    return r.select("id", "r.*")


# --- joins -----------------------------------------------------------------------------------------------------------

_ENRICH = "WITH j AS (SELECT i.id, i.name, i.required, i.brand, b.asset, t.tooltip, u.ui_tooltip, r.persistent_id, CASE WHEN r.id IS NULL THEN 'no research' WHEN i.required <> r.required THEN 'counts differ' WHEN b.id IS NULL THEN 'no binding' END AS reason FROM v_items i LEFT JOIN v_research r USING (id) LEFT JOIN v_tooltips t USING (id) LEFT JOIN v_ui_tooltips u USING (id) LEFT JOIN v_bindings b USING (id))"


def _enriched(v):
    return J.enrich_items(v["items"], v["research"], v["tooltips"], v["bindings"], v["ui_tooltips"])


@query(_ENRICH + " SELECT id, name, asset, persistent_id FROM j WHERE reason IS NULL")
def enrich_items(v):
    return _enriched(v)[0]


@query(_ENRICH + " SELECT id, required, brand, tooltip, ui_tooltip FROM j WHERE reason IS NULL")
def enrich_items_detail(v):
    return _enriched(v)[1]


@query("SELECT i.id, i.name, concat('Item_', i.id) AS asset, r.persistent_id FROM v_items i JOIN v_research r USING (id) WHERE i.required = r.required OR i.required IS NULL OR r.required IS NULL")
def enrich_items_default_asset(v):
    """Without a family of bindings."""
    return J.enrich_items(v["items"], v["research"], v["tooltips"], None)[0]


@query(_ENRICH + " SELECT id, reason FROM j WHERE reason IS NOT NULL")
def enrich_items_violations(v):
    return _enriched(v)[2]


_UNPIVOT = "SELECT {a}.id, f.field, CASE f.field WHEN 'p_name' THEN {a}.p_name WHEN 'p_brand' THEN {a}.p_brand WHEN 'p_type' THEN {a}.p_type WHEN 'p_size' THEN CAST({a}.p_size AS VARCHAR) ELSE CAST({a}.p_retailprice AS VARCHAR) END AS value FROM {t} {a}, (VALUES ('p_name'), ('p_brand'), ('p_type'), ('p_size'), ('p_retailprice')) f(field)"
_FIELD_DIFF = _DIFF + f", fb AS ({_UNPIVOT.format(a='b', t='v_rows_base')}), fk AS ({_UNPIVOT.format(a='k', t='v_rows_cand')}), fd AS (SELECT fb.id, fb.field, fb.value AS before, fk.value AS after FROM fb JOIN fk USING (id, field) WHERE fb.value IS DISTINCT FROM fk.value)"


@query(_DIFF + " SELECT id, change FROM d")
def diff_rows(v):
    return D.diff_rows(v["rows_base"], v["rows_cand"], ["id"])


@query(_FIELD_DIFF + " SELECT id, field, before, after, true AS in_base, true AS in_cand FROM fd")
def diff_fields(v):
    return D.diff_fields(v["rows_base"], v["rows_cand"], ["id"])


@query(_FIELD_DIFF + " SELECT 'part' AS family, count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'removed') AS removed, count(*) FILTER (change = 'changed') AS changed, (SELECT string_agg(concat(field, '=', n), ',' ORDER BY field) FROM (SELECT field, count(*) AS n FROM fd GROUP BY 1)) AS fields FROM d")
def diff_summary(v):
    b, k = v["rows_base"], v["rows_cand"]
    family = F.lit("part")
    out = D.diff_summary(D.diff_rows(b, k, ["id"]).withColumn("family", family), D.diff_fields(b, k, ["id"]).withColumn("family", family))
    pairs = F.transform(F.map_entries("fields"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return out.withColumn("fields", F.array_join(F.array_sort(pairs), ","))


@query(_DIFF + ", e AS (SELECT change, id, row_number() OVER (PARTITION BY change ORDER BY id) AS example FROM d) SELECT change, id, CAST(example AS INT) AS example FROM e WHERE example <= 5")
def first_n_examples(v):
    return D.first_n_examples(D.diff_rows(v["rows_base"], v["rows_cand"], ["id"]), "change", [c("id")])


@query("SELECT id FROM v_rows_base UNION SELECT id FROM v_rows_cand")
def union_keys(v):
    return D.union_keys(v["rows_base"].select("id"), v["rows_cand"].select("id"))


_OBJ_DIFF = "WITH b AS (SELECT logical_key, sha FROM v_objects WHERE doc_id % 17 <> 0), k AS (SELECT logical_key, CASE WHEN doc_id % 7 = 0 THEN sha256(sha) ELSE sha END AS sha FROM v_objects WHERE doc_id % 13 <> 0)"


def _catalogs(v):
    o = v["objects"]
    sha = F.when(c("doc_id") % 7 == 0, F.sha2("sha", 256)).otherwise(c("sha"))
    return o.filter("doc_id % 17 <> 0").select("logical_key", "sha"), o.filter("doc_id % 13 <> 0").select("logical_key", sha.alias("sha"))


@query(_OBJ_DIFF + " SELECT coalesce(b.logical_key, k.logical_key) AS logical_key, CASE WHEN b.sha IS NULL THEN 'added' WHEN k.sha IS NULL THEN 'removed' ELSE 'changed' END AS change, b.sha AS before, k.sha AS after FROM b FULL JOIN k ON b.logical_key = k.logical_key WHERE b.sha IS DISTINCT FROM k.sha")
def diff_catalog(v):
    return D.diff_catalog(*_catalogs(v), "logical_key", "sha")


@query("SELECT path AS name, CASE WHEN doc_id % 17 <> 0 THEN sha256(body) END AS before, sha256(CASE WHEN doc_id % 7 = 0 THEN concat(body, 'x') ELSE body END) AS after FROM v_blobs WHERE doc_id % 13 <> 0")
def diff_binaries(v):
    """Texts stored as gzip on both sides; digests are those of the decoded content."""
    body = F.when(c("doc_id") % 7 == 0, F.concat("body", F.lit("x"))).otherwise(c("body"))
    b = v["blobs"].filter("doc_id % 17 <> 0").select(c("path").alias("name"), gzipped(c("body")).alias("content"))
    k = v["blobs"].filter("doc_id % 13 <> 0").select(c("path").alias("name"), gzipped(body).alias("content"))
    return D.diff_binaries(b, k, digest=lambda x: I.gzip_measure(x)["sha"])


@query("SELECT key FROM v_catalog_keys WHERE key IN (SELECT concat('k', CAST(id % 30 AS VARCHAR)) FROM v_nested)")
def select_by_keys(v):
    wanted = v["nested"].select(F.concat(F.lit("k"), (c("id") % 30).cast("string")).alias("key"))
    return J.select_by_keys(v["catalog_keys"], wanted, "key")[0].select("key")


@query("WITH s AS (SELECT concat('k', CAST(id % 30 AS VARCHAR)) AS key, count(*) AS n FROM v_nested GROUP BY 1) SELECT s.key, CASE WHEN k.key IS NULL THEN 'unknown' ELSE 'duplicate' END AS reason FROM s LEFT JOIN v_catalog_keys k USING (key) WHERE k.key IS NULL OR n > 1")
def select_by_keys_violations(v):
    wanted = v["nested"].select(F.concat(F.lit("k"), (c("id") % 30).cast("string")).alias("key"))
    return J.select_by_keys(v["catalog_keys"], wanted, "key")[1]


@query("SELECT id FROM (SELECT id, g, concat('k', CAST(id % 30 AS VARCHAR)) AS key, lag(concat('k', CAST(id % 30 AS VARCHAR))) OVER (PARTITION BY g ORDER BY id) AS b FROM (SELECT id, id // 100 AS g FROM v_nested)) WHERE key <= b")
def strictly_increasing(v):
    rows = v["nested"].select("id", F.floor(c("id") / 100).alias("g"), F.concat(F.lit("k"), (c("id") % 30).cast("string")).alias("key"))
    return W.strictly_increasing(rows, ["g"], "id", "key").select("id")


@query("SELECT id FROM (SELECT id, concat('k', CAST(id % 30 AS VARCHAR)) AS key, lag(concat('k', CAST(id % 30 AS VARCHAR))) OVER (ORDER BY id) AS b FROM v_nested) WHERE key <= b")
def strictly_increasing_sequence(v):
    """All rows as one sequence."""
    rows = v["nested"].select("id", F.concat(F.lit("k"), (c("id") % 30).cast("string")).alias("key"))
    return W.strictly_increasing(rows, [], "id", "key").select("id")


def _sequence(v):
    return v["selection"], v["part_keys"], v["selection"].agg((F.count("*") + 1).alias("declared"))


_SEQUENCE = "WITH s AS (SELECT place, key, lag(key) OVER (ORDER BY place) AS b FROM v_selection)"


@query("SELECT key FROM v_part_keys WHERE key IN (SELECT key FROM v_selection)")
def select_sequence(v):
    wanted, there, declared = _sequence(v)
    return J.select_sequence(there, wanted, "key", "place", declared)[0].select("key")


@query(
    _SEQUENCE + " SELECT * FROM (SELECT place, key, CASE WHEN coalesce(key, '') = '' THEN 'invalid' WHEN key = b THEN 'duplicate' WHEN key < b THEN 'out of order' WHEN key NOT IN (SELECT key FROM v_part_keys) THEN 'unknown' END AS reason FROM s) WHERE reason IS NOT NULL "
    "UNION ALL SELECT NULL, NULL, CASE WHEN (SELECT count(*) + 1 FROM s) > (SELECT count(*) FROM v_part_keys) THEN 'declared count' ELSE 'row count' END"
)
def select_sequence_violations(v):
    """One sequence of keys with repeated, misplaced, unknown and empty ones, and a declared count that is one too many."""
    wanted, there, declared = _sequence(v)
    return J.select_sequence(there, wanted, "key", "place", declared)[1]


@query("SELECT ref_id, asset_id FROM v_refs WHERE asset_id NOT IN (SELECT doc_id FROM documents)")
def ref_integrity(v):
    return J.ref_integrity(v["refs"], v.table("documents"), "asset_id", "doc_id").select("ref_id", "asset_id")


@query("SELECT asset_id FROM v_refs EXCEPT SELECT doc_id FROM documents")
def missing_from(v):
    return D.missing_from(v["refs"].select("asset_id").distinct(), v.table("documents").select(c("doc_id").alias("asset_id")), ["asset_id"])


@query("SELECT doc_id AS asset_id FROM documents EXCEPT SELECT asset_id FROM v_refs")
def unexpected_in(v):
    return D.unexpected_in(v.table("documents").select(c("doc_id").alias("asset_id")), v["refs"].select("asset_id"), ["asset_id"])


@query("SELECT id, 1 AS slot FROM v_nested WHERE id % 9 = 0")
def assigned_slot_check(v):
    return J.assigned_slot_check(v["nested"], "id", R.slots_of(c("raw")))


@query("SELECT id, 1 AS slot FROM v_nested WHERE id % 9 = 0 AND id % 27 <> 0")
def sentinel_exempt(v):
    return J.sentinel_exempt(J.assigned_slot_check(v["nested"], "id", R.slots_of(c("raw"))), c("id") % 27 == 0)


@query("SELECT id, concat('k', CAST(id % 30 AS VARCHAR)) AS ref FROM v_nested UNION ALL SELECT id, concat('k', CAST(id % 40 AS VARCHAR)) FROM v_nested")
def json_walk_refs(v):
    return R.json_walk_refs(v["nested"].select("id", F.parse_json("raw").alias("v")), "id", "v", "assetId").select("id", "ref")


@query("SELECT DISTINCT id, ref FROM (SELECT id, concat('k', CAST(id % 30 AS VARCHAR)) AS ref FROM v_nested UNION ALL SELECT id, concat('k', CAST(id % 40 AS VARCHAR)) FROM v_nested) WHERE ref NOT IN (SELECT key FROM v_catalog_keys)")
def nested_ref_subset(v):
    refs = S.extract_all_ids(c("raw"), '"assetId":"([^"]+)"')
    return J.nested_ref_subset(v["nested"], "id", refs, v["catalog_keys"].withColumnRenamed("key", "ref"), "ref").distinct()


@query("SELECT id, concat('k', CAST(id % 30 AS VARCHAR), ',k', CAST(id % 40 AS VARCHAR)) AS ids FROM v_nested")
def extract_all_ids(v):
    return v["nested"].select("id", F.array_join(S.extract_all_ids(c("raw"), '"assetId":"([^"]+)"'), ",").alias("ids"))


@query("SELECT coalesce(i.id, r.id) AS id, CASE WHEN r.id IS NULL THEN 'first only' ELSE 'second only' END AS side FROM v_items i FULL JOIN v_research r ON i.id = r.id WHERE i.id IS NULL OR r.id IS NULL")
def key_coverage_equal(v):
    return D.key_coverage_equal(v["items"], v["research"], "id")


@query("SELECT f AS family FROM (VALUES ('items'), ('research'), ('none'), ('never')) t(f) WHERE f NOT IN ('items', 'research')")
def required_families(v):
    n = lambda name, df: df.agg(F.count("*").alias("rows")).withColumn("family", F.lit(name))
    counts = n("items", v["items"]).unionByName(n("research", v["research"])).unionByName(n("none", v["items"].filter("id < 0")))
    return J.required_families(counts, ["items", "research", "none", "never"])


@query("WITH a AS (SELECT bucket, sha, count(*) AS n FROM v_bucket_actual GROUP BY 1, 2) SELECT coalesce(e.bucket, a.bucket) AS bucket, coalesce(e.sha, a.sha) AS sha, CASE WHEN a.n IS NULL THEN 'missing' WHEN e.sha IS NULL THEN 'unexpected' ELSE 'repeated' END AS reason FROM v_bucket_expected e FULL JOIN a ON e.bucket = a.bucket AND e.sha = a.sha WHERE a.n IS NULL OR e.sha IS NULL OR a.n > 1")
def verify_bundle_membership(v):
    return A.verify_bundle_membership(v["bucket_expected"], v["bucket_actual"], ["bucket", "sha"])


@query("SELECT b.id, b.asset, a.key AS canonical, coalesce(a.key <> b.asset, false) AS adjusted FROM v_bindings b LEFT JOIN v_asset_catalog a ON lower(a.key) = lower(b.asset)")
def ci_lookup(v):
    return J.ci_lookup(v["bindings"], "asset", v["asset_catalog"], "key")


@query("SELECT id, CASE WHEN id % 4 = 0 THEN concat('a/', asset) ELSE concat('Item/', CAST(id AS VARCHAR)) END AS asset FROM v_bindings")
def fallback_asset(v):
    custom = F.when(c("id") % 4 == 0, F.concat(F.lit("Images\\a\\"), "asset")).otherwise(F.lit(""))
    return v["bindings"].select("id", J.fallback_asset(custom, F.concat(F.lit("images/Item/"), c("id").cast("string"))).alias("asset"))


@query("SELECT id, concat('sub/', asset) AS path FROM v_bindings")
def normalize_asset_path(v):
    return v["bindings"].select("id", S.normalize_asset_path(F.concat(F.lit("IMAGES\\sub\\"), "asset")).alias("path"))


@query("WITH k AS (SELECT key, lower(key) AS l FROM v_asset_catalog), x AS (SELECT * FROM v_literals JOIN k ON l = lower(literal)) SELECT lit_id, literal, key FROM x UNION ALL SELECT v.lit_id, v.literal, k.key FROM v_literals v LEFT JOIN k ON starts_with(k.l, lower(v.literal)) WHERE v.lit_id NOT IN (SELECT lit_id FROM x)")
def prefix_match(v):
    return J.prefix_match(v["literals"], v["asset_catalog"], "literal", "key")


@query("SELECT id % 100 AS slot, count(DISTINCT asset) AS assets FROM v_bindings GROUP BY 1 HAVING count(DISTINCT asset) > 1")
def binding_conflicts(v):
    return J.binding_conflicts(v["bindings"].withColumn("slot", c("id") % 100), "slot", "asset")


@query("WITH d AS (SELECT id % 5 AS kind, max(id // 5) AS size FROM v_bindings GROUP BY 1) SELECT d.kind, g AS idx FROM d, generate_series(1, (SELECT max(size) FROM d)) t(g) WHERE g <= d.size EXCEPT SELECT id % 5, id // 5 FROM v_bindings WHERE id % 11 <> 0")
def domain_completeness(v):
    b = v["bindings"].select((c("id") % 5).alias("kind"), F.floor(c("id") / 5).alias("idx"), "id")
    return J.domain_completeness(b.filter("id % 11 <> 0"), b.groupBy("kind").agg(F.max("idx").alias("size")), "kind", "idx", "size")


@query("SELECT id % 5 AS kind, count(*) AS domain, count(*) FILTER (id % 3 = 0) AS missing, count(*) FILTER (id % 3 <> 0) AS present FROM v_bindings GROUP BY 1")
def domain_counts(v):
    b = v["bindings"].select((c("id") % 5).alias("kind"), F.when(c("id") % 3 == 0, "missing").otherwise("present").alias("status"))
    return A.domain_counts(b, "kind", "status", ["missing", "present"])


@query("SELECT id % 7 AS kind, CASE WHEN id % 7 < 3 THEN id % 7 ELSE max(id) + 1 END AS size FROM v_bindings GROUP BY id % 7")
def domain_size_fallback(v):
    b = v["bindings"].withColumn("kind", c("id") % 7)
    return b.groupBy("kind").agg(A.domain_size_fallback(F.max(F.when(c("kind") < 3, c("kind"))), c("id")).alias("size"))


@query("WITH i AS (SELECT s_suppkey AS item, CASE WHEN s_suppkey % 11 = 0 THEN s_suppkey + 1000000000 ELSE s_suppkey * 3 + 1 END AS slot FROM supplier), f AS (SELECT id AS slot, options = 1 AS modern FROM v_flags), b AS (SELECT k AS kind, id AS slot FROM v_flags, (VALUES ('A'), ('B'), ('C')) t(k) WHERE id % 3 = 1 AND NOT (k = 'B' AND id % 4 = 0)) SELECT item, i.slot, 'outside domain' AS reason FROM i LEFT JOIN f USING (slot) WHERE f.slot IS NULL UNION ALL SELECT item, slot, concat('no ', k) FROM i JOIN f USING (slot), (VALUES ('A'), ('B'), ('C')) t(k) WHERE NOT modern AND NOT EXISTS (SELECT 1 FROM b WHERE b.kind = k AND b.slot = i.slot)")
def conditional_slot_check(v):
    """Over the whole table of flags; every 11th item has a slot that is not in it."""
    items = v.table("supplier").selectExpr("s_suppkey AS item", "CAST(IF(s_suppkey % 11 = 0, s_suppkey + 1000000000, s_suppkey * 3 + 1) AS BIGINT) AS slot")
    flags = v["flags"].select(c("id").alias("slot"), (c("options") == 1).alias("modern"))
    b = v["flags"].filter("id % 3 = 1").select(F.explode(F.array(*map(F.lit, "ABC"))).alias("kind"), c("id").alias("slot"))
    return J.conditional_slot_check(items, flags, b.filter("NOT (kind = 'B' AND slot % 4 = 0)"), "slot", ["A", "B", "C"])


_SLOTS = "WITH s AS (SELECT width AS slot, id, CASE WHEN options = 3 THEN 'field_range' WHEN options = 2 AND spreads THEN 'missing_required' WHEN options = 2 THEN 'no_source' END AS reason, NOT frame_important AS sampled FROM v_flags)"


def _slots(v):
    reason = S.rule_cascade([(c("options") == 3, "field_range"), ((c("options") == 2) & c("spreads"), "missing_required"), (c("options") == 2, "no_source")])
    return v["flags"].select(c("width").alias("slot"), "id", reason.alias("reason"), (~c("frame_important")).alias("sampled"))


@query(_SLOTS + " SELECT slot, count(*) AS declared, count(*) FILTER (reason IS NULL) AS available, count(*) FILTER (reason IS NULL AND sampled) AS sampled, count(*) FILTER (reason = 'no_source') AS no_source, count(*) FILTER (reason = 'field_range') AS field_range, count(*) FILTER (reason = 'missing_required') AS missing_required FROM s GROUP BY 1")
def slot_coverage(v):
    return A.slot_coverage(_slots(v), "slot", "reason", "sampled", ["no_source", "field_range", "missing_required"])


@query(_SLOTS + " SELECT slot, reason, id FROM s WHERE reason IS NOT NULL")
def slot_exclusions(v):
    return A.slot_exclusions(_slots(v), "slot", "id", "reason")


@query("SELECT p_partkey, p_brand, min(p_name) OVER (PARTITION BY p_brand) AS first_name FROM part")
def first_name_lookup(v):
    p = v.table("part")
    return J.first_name_lookup(p.select("p_partkey", "p_brand"), "p_brand", p.select("p_brand", "p_name"), "p_name").select("p_partkey", "p_brand", "first_name")


@query("SELECT p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def first_per_key(v):
    return A.first_per_key(v.table("part"), "p_brand", ["p_partkey"]).select("p_brand", "p_partkey")


@query("SELECT coalesce(a.id, b.id) AS id, a.name AS en, b.name AS zh FROM v_locale_en a FULL JOIN v_locale_zh b ON a.id = b.id")
def locale_merge(v):
    return J.locale_merge(v["locale_en"], v["locale_zh"], "id", "name", ("en", "zh"))


@query("SELECT p_partkey, p.paint FROM part, (SELECT DISTINCT paint FROM v_colors UNION SELECT 0) p")
def expand_cross(v):
    return J.expand_cross(v.table("part").select("p_partkey"), v["colors"].select("paint"), "paint")


_STYLES = "SELECT tile, greatest(0, style) AS style FROM v_placements UNION SELECT tile, 0 FROM v_placements"


@query(f"SELECT tile, string_agg(CAST(style AS VARCHAR), ',' ORDER BY style) AS styles FROM ({_STYLES}) GROUP BY 1")
def distinct_styles(v):
    return A.distinct_styles(v["placements"], "tile", "style").withColumn("styles", F.array_join(c("styles").cast("array<string>"), ","))


def _tiles(v):
    extra = v["placements"].groupBy("tile").agg(F.max("alternates").alias("alternates"), F.max("wrap").alias("wrap"))
    return A.distinct_styles(v["placements"], "tile", "style").join(extra, "tile")


_VARIANTS = f"WITH s AS ({_STYLES}), e AS (SELECT tile, max(alternates) AS alternates, max(wrap) AS wrap FROM v_placements GROUP BY 1), x AS (SELECT s.tile, s.style, a.g AS alternate, r.g AS random, e.wrap FROM s JOIN e USING (tile), generate_series(0, 10) a(g), generate_series(0, 10) r(g) WHERE a.g <= e.alternates AND r.g < greatest(1, e.wrap))"


@query(_VARIANTS + " SELECT tile, style, CAST(alternate AS INT) AS alternate, CAST(random AS INT) AS random FROM x")
def expand_variants(v):
    return J.expand_variants(_tiles(v), "styles", "alternates", "wrap").select("tile", "style", "alternate", "random")


@query(_VARIANTS + " SELECT DISTINCT tile, p, CAST(18 * (CASE WHEN wrap > 0 THEN p % wrap ELSE p END) AS BIGINT) AS x, CAST(36 * (CASE WHEN wrap > 0 THEN p // wrap * 2 ELSE 0 END) AS BIGINT) AS y FROM (SELECT tile, wrap, style * 3 + alternate + random AS p FROM x)")
def frame_xy(v):
    rows = J.expand_variants(_tiles(v), "styles", "alternates", "wrap").select("tile", "wrap", (c("style") * 3 + c("alternate") + c("random")).cast("long").alias("p")).distinct()
    return rows.select("tile", "p", S.frame_xy(c("p"), c("wrap"), F.lit(2), F.lit(True), F.lit(18), F.lit(36)).alias("f")).select("tile", "p", "f.x", "f.y")


@query("WITH f AS (SELECT id, CAST(options AS VARCHAR) AS options, CAST(width AS VARCHAR) AS width, id // 64 AS block, row_number() OVER (PARTITION BY id // 64 ORDER BY id) - 1 AS pos FROM v_flags) SELECT block, pos AS idx, concat('options=', options, ',width=', width) AS vals FROM f WHERE block IN (SELECT block FROM f GROUP BY 1 HAVING count(*) >= 64)")
def parallel_arrays_to_rows(v):
    f = v["flags"].withColumn("block", F.floor(c("id") / 64))
    arr = lambda name: f.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", name))), lambda x: x[name].cast("string")).alias("values")).withColumn("name", F.concat_ws(":", c("block").cast("string"), F.lit(name)))
    rows, _ = J.parallel_arrays_to_rows(arr("options").unionByName(arr("width")).select("name", "values"), "name", "values", 64)
    flat = rows.select("id", F.explode("values").alias("k", "value"))
    key = F.split("k", ":")
    out = flat.groupBy(key[0].cast("long").alias("block"), c("id").cast("long").alias("idx")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", key[1], "value"))), ",").alias("vals"))
    return out


@query("SELECT member, string_agg(DISTINCT pool, ',' ORDER BY pool) AS pools FROM v_pools GROUP BY 1")
def pool_membership(v):
    return J.pool_membership(v["pools"], "member", "pool").withColumn("pools", F.array_join("pools", ","))


@query("SELECT count(*) AS entities, CAST(sum(n) AS BIGINT) AS elements FROM (SELECT member, count(DISTINCT pool) AS n FROM v_pools GROUP BY 1)")
def pair_counts(v):
    return A.pair_counts(J.pool_membership(v["pools"], "member", "pool"), "pools")


@query("SELECT member, concat('FIRST,', string_agg(DISTINCT pool, ',' ORDER BY pool)) AS pools FROM v_pools GROUP BY 1")
def concat_distinct_ordered(v):
    p = J.pool_membership(v["pools"], "member", "pool")
    return p.select("member", F.array_join(S.concat_distinct_ordered(F.array(F.lit("FIRST")), c("pools"), F.reverse("pools")), ",").alias("pools"))


@query("WITH RECURSIVE t AS (SELECT id, id AS root FROM v_alias WHERE copy_of IS NULL UNION ALL SELECT a.id, t.root FROM v_alias a JOIN t ON a.copy_of = t.id) SELECT id, root, 'ok' AS status FROM t")
def alias_chain(v):
    return R.alias_chain(v["alias"], "id", "copy_of")


_REACHED = "WITH RECURSIVE t AS (SELECT CAST(0 AS BIGINT) AS node, 0 AS hops UNION SELECT e.dst, t.hops + 1 FROM v_edges e JOIN t ON e.src = t.node ), m AS (SELECT node, min(hops) AS hops FROM t GROUP BY 1)"
_PARENTS = "SELECT m.node, m.hops, (SELECT min(e.src) FROM v_edges e JOIN m p ON p.node = e.src WHERE e.dst = m.node AND p.hops = m.hops - 1) AS parent FROM m"


@query(_REACHED + " " + _PARENTS)
def reachability(v):
    edges = v["edges"]
    return R.reachability(edges, edges.filter("src = 0").select(c("src").alias("node")).distinct())


@query(_REACHED + f", r AS ({_PARENTS}), p AS (SELECT node, hops, [node] AS path FROM r WHERE hops = 0 UNION ALL SELECT r.node, r.hops, list_append(p.path, r.node) FROM r JOIN p ON r.parent = p.node AND r.hops = p.hops + 1) SELECT node, hops, array_to_string(path[-12:], '>') AS path FROM p")
def reachability_paths(v):
    """The last twelve nodes on the way to each node."""
    edges = v["edges"]
    out = R.reachability(edges, edges.filter("src = 0").select(c("src").alias("node")).distinct(), shown=12)
    return out.select("node", "hops", F.array_join(c("path").cast("array<string>"), ">").alias("path"))


@query("WITH RECURSIVE e AS (SELECT src, dst FROM v_edges), w AS (SELECT src AS node, CAST(max(w) AS BIGINT) AS weight FROM v_edges GROUP BY 1), n AS (SELECT node, weight FROM w UNION ALL SELECT DISTINCT dst, CAST(1 AS BIGINT) FROM e WHERE dst NOT IN (SELECT node FROM w)), t AS (SELECT node AS top, node, weight AS d FROM n UNION SELECT t.top, e.dst, t.d + n.weight FROM t JOIN e ON e.src = t.node JOIN n ON n.node = e.dst) SELECT top AS node, CAST(max(d) AS BIGINT) AS depth FROM t GROUP BY 1")
def longest_path_dag(v):
    e = v["edges"]
    own = e.groupBy(c("src").alias("node")).agg(F.max("w").alias("weight"))
    leaves = e.select(c("dst").alias("node")).distinct().join(own, "node", "left_anti").withColumn("weight", F.lit(1))
    return R.longest_path_dag(e, own.unionByName(leaves))[0]


@query("SELECT CAST(id AS VARCHAR) AS key, 'differ' AS reason FROM v_cases WHERE out_a <> out_b UNION ALL SELECT r, 'no case' FROM (VALUES ('en'), ('xx')) t(r) WHERE r NOT IN (SELECT category FROM v_cases)")
def paired_result_compare(v):
    return J.paired_result_compare(v["cases"], "id", "out_a", "out_b", "category", ["en", "xx"])


@query("WITH p AS (SELECT attr, count(DISTINCT value) AS n, string_agg(DISTINCT concat(source, '=', value), ',' ORDER BY concat(source, '=', value)) AS found FROM v_identity GROUP BY 1) SELECT attr, 'differ' AS reason, found FROM p WHERE n > 1 UNION ALL SELECT attr, 'revoked', found FROM p WHERE attr IN (SELECT attr FROM v_identity WHERE value IN (SELECT value FROM v_revoked))")
def identity_reconcile(v):
    return J.identity_reconcile(v["identity"], "attr", "source", "value", v["revoked"])


@query("SELECT DISTINCT lower(a.path) AS p FROM v_path_tree a WHERE EXISTS (SELECT 1 FROM v_path_tree b WHERE starts_with(lower(b.path), lower(a.path) || '/'))")
def path_parent_conflict(v):
    return J.path_parent_conflict(v["path_tree"], "path")


# --- colours ---------------------------------------------------------------------------------------------------------

_D2 = "(q.r - k.r) * (q.r - k.r) + (q.g - k.g) * (q.g - k.g) + (q.b - k.b) * (q.b - k.b)"
_RANKED = "WITH s AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS position FROM v_colors WHERE stable), k AS (SELECT *, row_number() OVER (ORDER BY paint <> 0, {wall} position) - 1 AS rnk FROM s), x AS (SELECT q.qid, k.position, " + _D2 + " AS d2, row_number() OVER (PARTITION BY q.qid ORDER BY " + _D2 + ", k.rnk) AS n FROM v_query_colors q, k) SELECT qid, CAST(d2 AS BIGINT) AS d2, CAST(position AS BIGINT) AS position FROM x WHERE n = 1"


@query("WITH x AS (SELECT q.qid, k.ord, " + _D2 + " AS d2, row_number() OVER (PARTITION BY q.qid ORDER BY " + _D2 + ", k.ord) AS n FROM v_query_colors q, v_colors k) SELECT qid, CAST(d2 AS BIGINT) AS d2, ord AS rank FROM x WHERE n = 1")
def nearest_assign(v):
    return C.nearest_assign(v["query_colors"], v["colors"], ["r", "g", "b"], "ord", 1 << 30).select("qid", "d2", "rank")


@query(_RANKED.format(wall=""))
def nearest_any(v):
    return C.nearest_any(v["query_colors"], v["colors"]).select("qid", "d2", "position")


@query(_RANKED.format(wall="kind <> 'wall',"))
def nearest_wall_pref(v):
    return C.nearest_wall_pref(v["query_colors"], v["colors"]).select("qid", "d2", "position")


@query("WITH x AS (SELECT q.qid, k.r * 65536 + k.g * 256 + k.b AS code, " + _D2 + " AS d2, row_number() OVER (PARTITION BY q.qid ORDER BY " + _D2 + ", k.b, k.g, k.r) AS n FROM v_query_colors q, (SELECT DISTINCT r, g, b FROM v_colors) k) SELECT qid, CAST(d2 AS BIGINT) AS d2, CAST(code AS INT) AS code FROM x WHERE n = 1")
def nearest_group(v):
    return C.nearest_group(v["query_colors"], v["colors"]).select("qid", "d2", "code")


@query("SELECT r * 65536 + g * 256 + b AS code, CAST(row_number() OVER (PARTITION BY r, g, b ORDER BY CASE kind WHEN 'wall' THEN 1 ELSE 0 END, paint <> 0, type, variant, paint, ord) - 1 AS INT) AS place, ord FROM v_colors")
def color_members(v):
    return C.color_members(v["colors"])


@query("SELECT r * 65536 + g * 256 + b AS code, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY CASE kind WHEN 'wall' THEN 1 ELSE 0 END, paint <> 0, type, variant, paint, ord) AS members, count(*) AS n FROM v_colors GROUP BY 1")
def color_groups(v):
    return C.color_groups(v["colors"]).withColumn("members", F.array_join(c("members").cast("array<string>"), ","))


@query("SELECT ord, CAST(row_number() OVER (PARTITION BY r, g, b ORDER BY CASE kind WHEN 'wall' THEN 1 ELSE 0 END, paint <> 0, type, variant, paint, ord) - 1 AS INT) AS place FROM v_colors")
def group_order(v):
    rows = v["colors"].withColumn("code", S.rgb_pack(c("r"), c("g"), c("b"))).withColumn("kind_code", S.kind_code(c("kind")))
    return W.group_order(rows).select("ord", "place")


@query("SELECT count(*) AS groups, max(n) AS largest, max(x) AS max_variant, CAST(sum(s) AS BIGINT) AS stable_rows FROM (SELECT count(*) AS n, max(variant) AS x, count(*) FILTER (stable) AS s FROM v_colors GROUP BY r, g, b)")
def largest_group(v):
    return A.largest_group(v["colors"].withColumn("code", S.rgb_pack(c("r"), c("g"), c("b"))), "code")


@query("SELECT ord, r * 65536 + g * 256 + b AS code FROM v_colors")
def rgb_pack(v):
    return v["colors"].select("ord", S.rgb_pack(c("r"), c("g"), c("b")).alias("code"))


@query("SELECT ord, r, g, b FROM v_colors")
def rgb_unpack(v):
    return v["colors"].select("ord", S.rgb_unpack(S.rgb_pack(c("r"), c("g"), c("b"))).alias("x")).select("ord", "x.*")


@query("SELECT ord, b * 65536 + g * 256 + r AS rank FROM v_colors")
def bgr_rank(v):
    return v["colors"].select("ord", S.bgr_rank(c("r"), c("g"), c("b")).alias("rank"))


@query("SELECT ord, CAST(row_number() OVER (ORDER BY paint <> 0, ord) - 1 AS BIGINT) AS rank FROM v_colors")
def priority_rank_any(v):
    return W.priority_rank_any(v["colors"]).select("ord", "rank")


@query("SELECT ord, CAST(row_number() OVER (ORDER BY paint <> 0, kind <> 'wall', ord) - 1 AS BIGINT) AS rank FROM v_colors")
def priority_rank_wall(v):
    return W.priority_rank_wall(v["colors"]).select("ord", "rank")


_BRICKS = "WITH a AS (SELECT (r // 8 * 32 + g // 8) * 32 + b // 8 AS brick, (r % 8 * 8 + g % 8) * 8 + b % 8 AS cell, type AS label, ord FROM v_colors), p AS (SELECT brick, list_sort(list(DISTINCT label)) AS palette FROM a GROUP BY 1)"


@query("SELECT ord, CAST((r // 8 * 32 + g // 8) * 32 + b // 8 AS INT) AS brick, CAST((r % 8 * 8 + g % 8) * 8 + b % 8 AS INT) AS cell FROM v_colors")
def brick_address(v):
    return v["colors"].select("ord", S.brick_address(c("r"), c("g"), c("b")).alias("a")).select("ord", "a.*")


@query(_BRICKS + " SELECT CAST(brick AS INT) AS brick, array_to_string(palette, ',') AS palette, CAST(len(palette) AS INT) AS n, CASE WHEN len(palette) = 1 THEN 0 WHEN len(palette) <= 16 THEN 1 WHEN len(palette) <= 256 THEN 2 ELSE 3 END AS encoding, CAST(CASE WHEN len(palette) = 1 THEN 2 WHEN len(palette) <= 16 THEN 257 + 2 * len(palette) WHEN len(palette) <= 256 THEN 514 + 2 * len(palette) ELSE 1024 END AS BIGINT) AS bytes FROM p")
def brick_palette(v):
    return C.brick_palette(v["colors"].withColumn("label", c("type"))).withColumn("palette", F.array_join(c("palette").cast("array<string>"), ","))


@query(_BRICKS + " SELECT DISTINCT CAST(brick AS INT) AS brick, CAST(cell AS INT) AS cell, label FROM a")
def lookup_brick(v):
    cells = v["colors"].withColumn("label", c("type"))
    bricks = C.brick_palette(cells)
    found = C.lookup_brick(cells.select("r", "g", "b").distinct(), bricks, C.brick_cells(cells, bricks).distinct())
    return found.select("brick", "cell", "label")


_RUNS = "WITH s AS (SELECT *, CASE WHEN a IS NOT DISTINCT FROM lag(a) OVER w AND w IS NOT DISTINCT FROM lag(w) OVER w THEN 0 ELSE 1 END AS new FROM v_line_cells WINDOW w AS (PARTITION BY line ORDER BY cell)), t AS (SELECT *, sum(new) OVER (PARTITION BY line ORDER BY cell) - 1 AS run FROM s), r AS (SELECT line, CAST(run AS BIGINT) AS run, a, w, min(cell) AS first, max(cell) AS last FROM t GROUP BY 1, 2, 3, 4)"


@query(_RUNS + " SELECT line, run, a, w, first, last FROM r")
def line_runs(v):
    return A.line_runs(v["line_cells"], "line", "cell", ["a", "w"])


@query("SELECT line, cell, lead(cell) OVER w IS NULL OR a IS DISTINCT FROM lead(a) OVER w OR w IS DISTINCT FROM lead(w) OVER w AS last FROM v_line_cells WINDOW w AS (PARTITION BY line ORDER BY cell)")
def run_boundaries(v):
    return W.run_boundaries(v["line_cells"], "line", "cell", ["a", "w"]).select("line", "cell", "last")


@query(_RUNS + ' SELECT line, run, CAST(sum(last - first + 1) OVER w - (last - first + 1) AS BIGINT) AS "start", CAST(sum(last - first + 1) OVER w AS BIGINT) AS "end" FROM r WINDOW w AS (PARTITION BY line ORDER BY run)')
def running_offsets(v):
    runs = A.line_runs(v["line_cells"], "line", "cell", ["a", "w"]).withColumn("n", c("last") - c("first") + 1)
    return W.running_offsets(runs, "line", "run", "n").select("line", "run", "start", "end")


@query("SELECT line, cell, a, w FROM v_line_cells WHERE cell % 5 = 2")
def lookup_runs(v):
    runs = A.line_runs(v["line_cells"], "line", "cell", ["a", "w"])
    asked = v["line_cells"].filter("cell % 5 = 2").select("line", "cell")
    return C.lookup_runs(asked, runs, "line", "cell", ["a", "w"]).select("line", "cell", "a", "w")


@query()
def full_cube(v):
    """All cells over the stable candidates of the table."""
    ranked = W.priority_rank_any(C.stable_subset(v["colors"], "stable", "ord").drop("ord").withColumnRenamed("position", "ord"))
    return C.full_cube(ranked, "rank").groupBy(F.shiftright("code", 16).alias("r")).agg(F.sum("d2").alias("d2"), F.sum("rank").alias("ranks"))


@query(
    "WITH s AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS position FROM v_colors WHERE stable), k AS (SELECT r, g, b, row_number() OVER (ORDER BY paint <> 0, position) - 1 AS rnk FROM s), m AS (SELECT r, g, b, min(rnk) AS rnk FROM k GROUP BY 1, 2, 3), "
    "x AS (SELECT p.g, o.b, min(((77 - m.r) * (77 - m.r) + (p.g - m.g) * (p.g - m.g) + (o.b - m.b) * (o.b - m.b)) * 65536 + m.rnk) AS best FROM range(256) p(g), range(256) o(b), m GROUP BY 1, 2) "
    "SELECT CAST(g AS INT) AS g, CAST(sum(best // 65536) AS BIGINT) AS d2, CAST(sum(best % 65536) AS BIGINT) AS ranks FROM x GROUP BY 1"
)
def full_cube_plane(v):
    """The plane r = 77 of the whole cube, whose cells brute force can check; as in its SQL a step of distance is worth 65,536 ranks,
    also where there are more."""
    ranked = W.priority_rank_any(C.stable_subset(v["colors"], "stable", "ord").drop("ord").withColumnRenamed("position", "ord"))
    plane = C.full_cube(ranked, "rank", 65_536).filter(F.shiftright("code", 16) == 77)
    return plane.groupBy(F.shiftright("code", 8).bitwiseAND(F.lit(255)).cast("int").alias("g")).agg(F.sum("d2").alias("d2"), F.sum("rank").alias("ranks"))


# --- aggregations ----------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_ids(v):
    return A.dup_ids(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


_COUNTS = "WITH a AS (SELECT l_orderkey AS pack, count(*) AS actual FROM lineitem GROUP BY 1), x AS (SELECT pack, CAST(declared_rows AS BIGINT) AS declared, actual FROM v_declared JOIN a USING (pack) WHERE declared_rows <> actual)"


def _mismatch(v):
    return A.count_reconcile(v.table("lineitem").withColumn("pack", c("l_orderkey")), v["declared"], ["pack"])


@query(_COUNTS + " SELECT pack, declared, actual FROM x")
def count_reconcile(v):
    return _mismatch(v)


@query(_COUNTS + " SELECT 'counts' AS gate, CAST(pack AS VARCHAR) AS key, concat('declared ', declared, ', actual ', actual) AS reason FROM x")
def gate_counts(v):
    return G.gate_counts(_mismatch(v), c("pack"))


@query("WITH l AS (SELECT substr(sha256(logical_key), 1, 2) AS bucket, concat_ws(' ', logical_key, bytes, sha) AS line FROM v_objects), b AS (SELECT bucket, sha256(string_agg(line, chr(10) ORDER BY line)) AS sha FROM l GROUP BY 1) SELECT sha256(string_agg(concat_ws(' ', bucket, sha), chr(10) ORDER BY bucket)) AS digest, count(*) AS buckets FROM b")
def tree_digest(v):
    return A.tree_digest(v["objects"], "logical_key", F.concat_ws(" ", "logical_key", c("bytes").cast("string"), "sha"))


@query("SELECT DISTINCT sha AS path, bytes FROM v_objects")
def dedupe_objects(v):
    return A.dedupe_objects(v["objects"].select(c("sha").alias("path"), "bytes"), "path")[0]


@query("SELECT substr(sha, 1, 2) AS prefix, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes, sum(bytes) <= 16777216 AS fits FROM v_objects GROUP BY 1")
def bucket_stats(v):
    return A.bucket_stats(v["objects"], S.hash_prefix(c("sha")), "bytes")


@query('WITH g AS (SELECT CAST(sum(bytes) AS BIGINT) AS t, count(*) AS n, max(bytes) AS m FROM v_objects) SELECT "limit", value, allowed, value <= allowed AS ok FROM (SELECT \'total_bytes\' AS "limit", t AS value, CAST(1073741824 AS BIGINT) AS allowed FROM g UNION ALL SELECT \'objects\', n, 65536 FROM g UNION ALL SELECT \'largest\', m, 1000 FROM g)')
def byte_budget(v):
    return A.byte_budget(v["objects"], "bytes", {"total_bytes": 1 << 30, "objects": 65_536, "largest": 1000})


@query("SELECT conv_id, string_agg({sha}(op{shaarg}), ',' ORDER BY turn, {sha}(op{shaarg})) AS keys FROM v_ops GROUP BY 1")
def dedupe_operations(v):
    return A.dedupe_operations(v["ops"], "conv_id", "turn", c("op"))[0].withColumn("keys", F.array_join("keys", ","))


@query("SELECT DISTINCT {sha}(op{shaarg}) AS key, op AS operation FROM v_ops")
def dedupe_operations_distinct(v):
    return A.dedupe_operations(v["ops"], "conv_id", "turn", c("op"))[1]


@query(
    "WITH o AS (SELECT DISTINCT conv_id // 8 AS part, conv_id, turn, op FROM v_ops), n AS (SELECT part, count(*) AS rows, count(DISTINCT op) AS values, CAST(sum(strlen(op)) AS BIGINT) AS plain_bytes FROM o GROUP BY 1), s AS (SELECT part, sum(strlen(op)) AS stored FROM (SELECT DISTINCT part, op FROM o) GROUP BY 1), "
    "x AS (SELECT part, rows, values, plain_bytes, CASE WHEN values <= 16 THEN CAST(stored + 24 + ceil(rows * CASE WHEN values <= 2 THEN 1 WHEN values <= 4 THEN 2 ELSE 4 END / 8) AS BIGINT) END AS indexed_bytes FROM n JOIN s USING (part)) "
    "SELECT CAST(part AS BIGINT) AS part, rows, values, plain_bytes, indexed_bytes, coalesce(indexed_bytes < plain_bytes, false) AS indexed FROM x"
)
def coding_choice(v):
    """Eight conversations' operations are a part; up to 16 different ones may be indexed."""
    rows = v["ops"].distinct().withColumns({"part": F.expr("conv_id DIV 8"), "pos": c("conv_id") * 1000 + c("turn")})
    return A.coding_choice(rows, "part", "pos", "op", limit=16)


@query("WITH f AS (SELECT conv_id, op, min(turn) AS t FROM v_ops GROUP BY 1, 2), i AS (SELECT conv_id, op, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY t) - 1 AS INT) AS idx FROM f) SELECT conv_id, turn, op, idx FROM v_ops JOIN i USING (conv_id, op)")
def dictionary_encode(v):
    return A.dictionary_encode(v["ops"].dropDuplicates(["conv_id", "turn"]).alias("o").select("conv_id", "turn", "op"), "conv_id", "turn", "op").select("conv_id", "turn", "op", c("index").alias("idx"))


def _mounts(v):
    """Every 11th entity was not set up, every 13th has no slot assigned."""
    flags = F.transform(R.slots_of(c("raw")), lambda s: s["assigned"] & (c("id") % 13 != 0))
    return A.mount_coverage(v["nested"], "id", F.when(c("id") % 11 != 0, flags))


_MOUNTS = "WITH m AS (SELECT id, CASE WHEN id % 11 = 0 OR id % 13 = 0 THEN 0 WHEN id % 9 = 0 THEN 2 ELSE 1 END AS assigned, id % 11 <> 0 AS populated, id % 11 = 0 OR id % 13 = 0 AS textureless FROM v_nested)"


@query(_MOUNTS + " SELECT id, assigned, populated, textureless FROM m")
def mount_coverage(v):
    return _mounts(v)


@query(_MOUNTS + " SELECT count(*) AS entities, count(*) FILTER (populated) AS populated, count(*) FILTER (textureless) AS textureless, CAST(sum(assigned) AS BIGINT) AS bound_slots, CAST(max(id) + 1 AS BIGINT) AS domain, count(*) = count(*) FILTER (populated) AND count(*) = max(id) + 1 AS complete FROM m")
def mount_totals(v):
    return A.mount_totals(_mounts(v), F.max("id") + 1)


@query(_MOUNTS + " SELECT 'mounts' AS gate, 'mounts' AS key, concat(count(*) FILTER (populated), ' of ', count(*)) AS reason FROM m HAVING count(*) FILTER (populated) <> count(*) OR count(*) <> max(id) + 1")
def gate_mounts(v):
    return G.gate_mounts(_mounts(v), F.max("id") + 1)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_counts(v):
    return A.group_counts(v.table("events"), "event_type")


@query("SELECT event_type, count(*) AS n, arg_min(props, event_id) AS sample, count(*) OVER () AS kinds FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 40")
def error_kinds(v):
    return A.error_kinds(v.table("events"), "event_type", "event_id", "props")


@query("SELECT event_id, total FROM (SELECT event_id, count(*) OVER () AS total FROM events) ORDER BY event_id LIMIT 20")
def top_n_with_total(v):
    return W.top_n_with_total(v.table("events").select("event_id"), ["event_id"], 20)


@query("SELECT stage, max(metric) AS peak_metric, (epoch_us(max(taken)) - epoch_us(min(taken))) // 1000 AS millis FROM v_stage_samples GROUP BY ROLLUP (stage)")
def stage_rollup(v):
    return A.stage_rollup(v["stage_samples"], "stage", ["metric"], "taken")


@query("SELECT stage, seq, max(metric) OVER (PARTITION BY stage ORDER BY seq) AS peak FROM v_stage_samples")
def cumulative_peak(v):
    return W.cumulative_peak(v["stage_samples"], "stage", "seq", "metric").select("stage", "seq", "peak")


@query("SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 256 AS BIGINT) AS shard FROM orders")
def row_shard(v):
    return W.row_shard(v.table("orders"), ["o_orderstatus"], ["o_orderkey"]).select("o_orderkey", "shard")


# --- orders and scalars ----------------------------------------------------------------------------------------------


@query("SELECT ord, row_number() OVER (ORDER BY try_cast(id AS BIGINT) IS NULL, try_cast(id AS BIGINT), id, ord) AS rank FROM v_ids")
def order_numeric_first(v):
    return W.ordered_rank(v["ids"], [*S.order_numeric_first(c("id")), c("ord")]).select("ord", "rank")


@query("SELECT logical_key, row_number() OVER (ORDER BY logical_key) AS rank FROM v_objects")
def order_bytes(v):
    return W.ordered_rank(v["objects"], S.order_bytes(c("logical_key"))).select("logical_key", "rank")


_UNITS = "list_aggregate(list_transform(string_split(key, ''), lambda x: CASE WHEN unicode(x) > 65535 THEN printf('%04x%04x', 55296 + ((unicode(x) - 65536) >> 10), 56320 + ((unicode(x) - 65536) & 1023)) ELSE printf('%04x', unicode(x)) END), 'string_agg', '')"


@query(f"WITH k AS (SELECT concat(chr(CAST(CASE doc_id % 3 WHEN 0 THEN 65536 + doc_id WHEN 1 THEN 57344 + doc_id % 5000 ELSE 107 END AS INT)), logical_key) AS key FROM v_objects) SELECT key, row_number() OVER (ORDER BY {_UNITS}) AS rank FROM k")
def order_utf16(v):
    """Keys that begin beyond the first plane, which come before those that begin near its end, as in no order of bytes."""
    code = F.expr("CASE doc_id % 3 WHEN 0 THEN 65536 + doc_id WHEN 1 THEN 57344 + doc_id % 5000 ELSE 107 END")
    first = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return W.ordered_rank(v["objects"].select(F.concat(first, "logical_key").alias("key")), S.order_utf16(c("key"))).select("key", "rank")


@query("SELECT doc_id, {sha}(text{shaarg}) AS sha FROM documents")
def sha256_hex(v):
    return v.table("documents").select("doc_id", S.sha256_hex(c("text")).alias("sha"))


_PERMUTED = "concat('{\"z\":', CAST(p_size AS STRING), ',\"id\":', CAST(p_partkey AS STRING), ',\"a\":{\"y\":1,\"x\":\"', p_brand, '\"}}')"
_SORTED = "concat('{\"a\":{\"x\":\"', p_brand, '\",\"y\":1},\"id\":', CAST(p_partkey AS STRING), ',\"z\":', CAST(p_size AS STRING), '}')"


@query(f"SELECT p_partkey AS id, {_SORTED} AS canonical FROM part")
def canonical_json(v):
    return v.sql(f"SELECT p_partkey AS id, {_PERMUTED} AS raw FROM part").select("id", S.canonical_json(c("raw")).alias("canonical"))


@query(f"SELECT p_partkey AS id, {{sha}}({_SORTED}{{shaarg}}) AS hash FROM part")
def row_hash(v):
    return v.sql(f"SELECT p_partkey AS id, {_PERMUTED} AS raw FROM part").select("id", S.row_hash(c("raw")).alias("hash"))


@query("SELECT p_partkey AS id, concat('{\"x\":\"', p_brand, '\",\"y\":1}') AS field FROM part")
def canonical_field(v):
    raw = v.sql(f"SELECT p_partkey AS id, {_PERMUTED} AS raw FROM part")
    return raw.select("id", S.canonical_field(F.variant_get(F.parse_json("raw"), "$.a", "variant")).alias("field"))


def _rules(v):
    """A rule of two, or for ids divisible by 9 of one, each with a tracker, a subject and a count."""
    sights = F.concat(F.lit(',{"kind":"sights","tracker":"Sights","subject":"n'), (c("id") % 40).cast("string"), F.lit('","count":1}'))
    kills = F.concat(F.lit('{"kind":"kills","tracker":"Kills","subject":"n'), (c("id") % 30).cast("string"), F.lit('","count":'), (c("id") % 50).cast("string"), F.lit("}"))
    tree = F.concat(F.lit('{"kind":"all","children":['), kills, F.when(c("id") % 9 != 0, sights).otherwise(""), F.lit("]}"))
    return R.flatten_rule_tree(v["nested"].select("id", F.parse_json(tree).alias("v")), "id", "v", fields={"tracker": "string", "subject": "string", "count": "long"})


@query("WITH r AS (SELECT id, 'all' AS kind FROM v_nested UNION ALL SELECT id, 'kills' FROM v_nested UNION ALL SELECT id, 'sights' FROM v_nested WHERE id % 9 <> 0) SELECT id, count(*) AS rules, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, bool_or(kind = 'sights') AS conditional FROM r GROUP BY 1")
def flatten_rule_tree(v):
    return R.rule_summary(_rules(v), "id", ["sights"]).withColumn("kinds", F.array_join("kinds", ","))


@query("SELECT id, 'Kills' AS tracker, concat('n', id % 30) AS subject, CAST(id % 50 AS BIGINT) AS count FROM v_nested UNION ALL SELECT id, 'Sights', concat('n', id % 40), 1 FROM v_nested WHERE id % 9 <> 0")
def rule_requirements(v):
    return R.rule_requirements(_rules(v), "id")


@query("SELECT p_partkey, CAST((p_partkey + 6) // 7 AS BIGINT) AS c FROM part")
def ceil_div(v):
    return v.table("part").select("p_partkey", S.ceil_div(c("p_partkey"), 7).alias("c"))


@query("SELECT p_partkey, CAST(round(CAST(p_partkey AS DECIMAL(28, 8)) / 8, 6) AS DECIMAL(28, 6)) AS x FROM part")
def round6(v):
    return v.table("part").select("p_partkey", S.round6(c("p_partkey").cast("decimal(20,8)") / F.lit(8)).cast("decimal(28,6)").alias("x"))


@query("SELECT p_partkey, p_partkey % 3 <> 0 OR p_partkey = 0 AS ok FROM part")
def canonical_decimal_string(v):
    text = F.when((c("p_partkey") % 3 == 0) & (c("p_partkey") != 0), F.concat(F.lit("0"), c("p_partkey").cast("string"))).otherwise(c("p_partkey").cast("string"))
    return v.table("part").select("p_partkey", S.canonical_decimal_string(text).alias("ok"))


@query("SELECT member, count(DISTINCT pool) = 1 AS reversed_ok, true AS ok FROM v_pools GROUP BY 1")
def sorted_unique_array(v):
    p = J.pool_membership(v["pools"], "member", "pool")
    return p.select("member", S.sorted_unique_array(F.reverse("pools")).alias("reversed_ok"), S.sorted_unique_array(c("pools")).alias("ok"))


# --- gates -----------------------------------------------------------------------------------------------------------

_REQUIRED = "SELECT 'required_match' AS gate, CAST(i.id AS VARCHAR) AS key, CASE WHEN r.id IS NULL THEN 'missing' ELSE 'count differs' END AS reason FROM v_items i LEFT JOIN v_research r USING (id) WHERE r.id IS NULL OR i.required IS DISTINCT FROM r.required"


@query(_REQUIRED)
def gate_required_match(v):
    return G.gate_required_match(v["items"], v["research"], "id", "required")


@query("SELECT 'scope' AS gate, 'scope' AS key, 'selected count' AS reason FROM (SELECT count(*) AS n FROM v_asset_catalog) WHERE n <> (SELECT count(*) + 1000 FROM v_bindings) UNION ALL SELECT 'scope', 'scope', 'no bindings' WHERE NOT EXISTS (SELECT 1 FROM v_bindings)")
def gate_scope(v):
    scope = v["bindings"].agg(F.lit("selection").alias("mode"), (F.count("*") + 100_000).alias("source_count"), (F.count("*") + 1000).alias("selected_count"), F.lit(True).alias("capable"), F.count("*").alias("bindings"))
    return G.gate_scope(scope, v["asset_catalog"])


@query(
    _COUNTS + f", a2 AS (SELECT bucket, sha, count(*) AS n FROM v_bucket_actual GROUP BY 1, 2) {_REQUIRED} "
    f"UNION ALL SELECT 'counts', CAST(pack AS VARCHAR), concat('declared ', declared, ', actual ', actual) FROM x "
    f"UNION ALL SELECT 'objects', path, reason FROM ({_OBJECT_FAULTS}) "
    "UNION ALL SELECT 'coverage', CAST(p_partkey AS VARCHAR), 'missing' FROM part WHERE p_partkey > 0 AND p_partkey NOT IN (SELECT id FROM v_research) "
    "UNION ALL SELECT 'refs', CAST(ref_id AS VARCHAR), 'dangling' FROM v_refs WHERE asset_id NOT IN (SELECT doc_id FROM documents) "
    "UNION ALL SELECT 'bundles', concat(coalesce(e.bucket, a2.bucket), '/', coalesce(e.sha, a2.sha)), CASE WHEN a2.n IS NULL THEN 'missing' WHEN e.sha IS NULL THEN 'unexpected' ELSE 'repeated' END FROM v_bucket_expected e FULL JOIN a2 ON e.bucket = a2.bucket AND e.sha = a2.sha WHERE a2.n IS NULL OR e.sha IS NULL OR a2.n > 1"
)
def gate_release(v):
    """All gates of a release: required rows, declared counts, objects, coverage of the items' ids, references, bundles."""
    gaps = D.missing_from(v["items"].select("id"), v["research"].select("id"), ["id"])
    gates = [
        G.gate_required_match(v["items"], v["research"], "id", "required"),
        G.gate_counts(_mismatch(v), c("pack")),
        G.gate_objects(_object_faults(v)),
        G.gate_coverage(gaps, ["id"]),
        G.gate_refs(J.ref_integrity(v["refs"], v.table("documents"), "asset_id", "doc_id"), "ref_id"),
        G.gate_bundles(A.verify_bundle_membership(v["bucket_expected"], v["bucket_actual"], ["bucket", "sha"]), ["bucket", "sha"]),
    ]
    return G.gate_release(gates)


@query(f"SELECT 'incomplete' AS status, count(*) AS violations FROM ({_REQUIRED})")
def release_status(v):
    return G.release_status(G.gate_required_match(v["items"], v["research"], "id", "required"))


_TURNED = "CASE change WHEN 'added' THEN 'removed' WHEN 'removed' THEN 'added' ELSE change END"


@query(
    _DIFF + _detail_sql("t", "change") + _detail_sql("u", _TURNED) + ", n AS (SELECT count(*) FILTER (change = 'added') AS a, count(*) FILTER (change = 'removed') AS r FROM d) "
    "SELECT 'approval' AS gate, unnest(['added', 'removed']) AS key, 'differs' AS reason FROM n WHERE a <> r "
    "UNION ALL SELECT 'approval', 'detail bytes', 'differs' FROM t, u WHERE t.bytes <> u.bytes UNION ALL SELECT 'approval', 'detail digest', 'differs' FROM t, u WHERE t.digest <> u.digest"
)
def gate_approval(v):
    """An approval that was given for the opposite direction: what was added is removed, and the other way round. Both details are
    written and described from what stands there."""
    def summary(b, k):
        counts = D.diff_rows(v[b], v[k], ["id"]).agg(*[F.count_if(c("change") == x).alias(x) for x in ("added", "removed", "changed")])
        return counts.select(F.explode(F.create_map(*[y for x in ("added", "removed", "changed") for y in (F.lit(x), c(x))])).alias("name", "value"))

    missing = D.missing_from(v["rows_base"].select("id"), v["rows_base"].select("id"), ["id"])
    details = _detail(v, "rows_base", "rows_cand"), _detail(v, "rows_cand", "rows_base")
    return G.gate_approval(summary("rows_base", "rows_cand"), summary("rows_cand", "rows_base"), missing, *details)


_PLAN = "WITH o AS (SELECT DISTINCT 'object' AS kind, concat('objects/', substr(sha, 1, 2), '/', sha, '.bin') AS path, sha, bytes FROM v_objects)"


@query(_PLAN + " SELECT kind, path, sha, bytes FROM o UNION ALL SELECT 'release', concat('releases/', release_sha, '.json'), release_sha, CAST(strlen(body) AS BIGINT) FROM v_releases UNION ALL SELECT 'channel', 'channels/stable.json', sha256(release_sha), CAST(strlen(release_sha) AS BIGINT) FROM v_pointer")
def publication_plan(v):
    objects = v["objects"].select(S.object_path(c("sha"), ".bin").alias("path"), "sha", "bytes")
    release = v["releases"].select(F.concat(F.lit("releases/"), "release_sha", F.lit(".json")).alias("path"), c("release_sha").alias("sha"), F.octet_length("body").cast("long").alias("bytes"))
    channel = v["pointer"].select(F.lit("channels/stable.json").alias("path"), F.sha2("release_sha", 256).alias("sha"), F.octet_length("release_sha").cast("long").alias("bytes"))
    return G.publication_plan(objects, release, channel)
