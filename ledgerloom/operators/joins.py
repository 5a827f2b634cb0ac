"""Enrichment, lookups, references and expansions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.windows import neighbour

#: The most values that every row is crossed with.
MOST_VALUES = 4096


def valid_candidate(df: DataFrame) -> DataFrame:
    inside = F.col("kind").isin("tile", "wall") & F.col("type").between(0, 32767) & F.col("variant").between(0, 65535)
    for c in ("paint", "r", "g", "b"):
        inside = inside & F.col(c).between(0, 255)
    return df.filter(inside)


def valid_item_id(df: DataFrame, id: str = "id") -> DataFrame:
    return df.filter(F.col(id).between(1, 100_000))


def promote_fields(df: DataFrame, src: str, names: list[str]) -> DataFrame:
    """Map entries moved to columns of their own; ``<name>_there`` tells an absent key from a null."""
    out = df
    for n in names:
        out = out.withColumn(n, F.element_at(src, F.lit(n))).withColumn(f"{n}_there", F.array_contains(F.map_keys(src), n))
    return out.withColumn(src, F.map_filter(src, lambda k, v: ~k.isin(names)))


def prefix_select(df: DataFrame, key: str, prefixes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key starts with a prefix, in either case; and the prefixes without a row."""
    spark = df.sparkSession
    p = spark.createDataFrame([(x.lower(),) for x in prefixes], "prefix string")
    hits = df.join(F.broadcast(p), F.lower(F.col(key)).startswith(F.col("prefix")))
    return hits.drop("prefix").distinct(), p.join(hits.select("prefix").distinct(), "prefix", "left_anti")


def skip_extension(df: DataFrame, path: str, ext: str, reason: str) -> DataFrame:
    return df.withColumn("skipped", F.when(F.lower(path).endswith(ext.lower()), F.lit(reason)))


def source_rect_check(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Whether a rectangle has an area and lies in the texture."""
    return (x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x + w <= width) & (y + h <= height)


def source_rect_clamp(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """The rectangle cut to the texture, and whether nothing is left."""
    left, top = F.least(F.greatest(x, F.lit(0)), width), F.least(F.greatest(y, F.lit(0)), height)
    right, bottom = F.least(F.greatest(x + w, F.lit(0)), width), F.least(F.greatest(y + h, F.lit(0)), height)
    cw, ch = F.greatest(right - left, F.lit(0)), F.greatest(bottom - top, F.lit(0))
    return F.struct(left.alias("x"), top.alias("y"), cw.alias("w"), ch.alias("h"), ((cw == 0) | (ch == 0)).alias("empty"))


def enrich_items(items: DataFrame, research: DataFrame, tooltips: DataFrame, bindings: DataFrame | None, ui_tooltips: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Index rows, detail rows and violations. Research is required and must agree; both kinds of tooltips may be absent. Where
    there is a family of bindings each item needs one; without the family an item's asset is ``Item_<id>``."""
    j = items.join(research.withColumnsRenamed({"required": "r_required"}).withColumn("__r", F.lit(True)), "id", "left")
    j = j.join(tooltips, "id", "left")
    j = j.withColumn("ui_tooltip", F.lit(None).cast("string")) if ui_tooltips is None else j.join(ui_tooltips, "id", "left")
    if bindings is None:
        j = j.withColumns({"asset": F.concat(F.lit("Item_"), F.col("id").cast("string")), "__b": F.lit(True)})
    else:
        j = j.join(bindings.withColumn("__b", F.lit(True)), "id", "left")
    reason = F.when(F.col("__r").isNull(), "no research").when(F.col("required") != F.col("r_required"), "counts differ").when(F.col("__b").isNull(), "no binding")
    j = j.withColumn("reason", reason)
    good = j.filter("reason IS NULL")
    index = good.select("id", "name", "asset", "persistent_id")
    detail = good.select("id", *[c for c in items.columns if c not in ("id", "name")], "tooltip", "ui_tooltip")
    return index, detail, j.filter("reason IS NOT NULL").select("id", "reason")


def select_by_keys(catalog: DataFrame, selection: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Selected rows; and keys of the selection that are unknown or stand there twice."""
    n = selection.groupBy(key).agg(F.count("*").alias("n"))
    chosen = catalog.join(n, key, "left_semi")
    bad = n.join(catalog.select(key).distinct().withColumn("__there", F.lit(True)), key, "left")
    bad = bad.select(key, F.when(F.col("__there").isNull(), "unknown").when(F.col("n") > 1, "duplicate").alias("reason"))
    return chosen, bad.filter("reason IS NOT NULL")


def select_sequence(catalog: DataFrame, selection: DataFrame, key: str, place: str, declared: int | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selected rows of a sequence of keys; and (place, key, reason) of what is wrong with it.

    Keys must rise from row to row in UTF-16 order, so each is compared with the one before, over range borders and however long
    the sequence is. A row's reason is that its key is invalid (null or empty), a duplicate of or out of order after the one
    before, or unknown; of the whole sequence (place and key null), that it has not as many rows as ``declared``, or that none are
    declared, or more than the catalog has. ``declared`` is a number, or one row of one."""
    rows = neighbour(selection.select(place, key), [], [place], F.col(key), "__before")
    rows = rows.join(catalog.select(F.col(key)).distinct().withColumn("__there", F.lit(True)), key, "left")
    code = lambda x: F.encode(x, "UTF-16BE")
    before = F.col("__before.value")
    reason = F.when(F.coalesce(F.col(key), F.lit("")) == "", "invalid").when(code(F.col(key)) == code(before), "duplicate").when(code(F.col(key)) < code(before), "out of order").when(F.col("__there").isNull(), "unknown")
    bad = rows.select(place, key, reason.alias("reason")).filter("reason IS NOT NULL")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    said = n(selection, "__n").crossJoin(n(catalog, "__most"))
    said = said.withColumn("__said", F.lit(declared)) if isinstance(declared, int) else said.crossJoin(declared.select(F.col(declared.columns[0]).alias("__said")))
    whole = F.when((F.col("__said") <= 0) | (F.col("__said") > F.col("__most")), "declared count").when(F.col("__said") != F.col("__n"), "row count")
    kinds = {f.name: f.dataType for f in bad.schema}
    whole = said.select(F.lit(None).cast(kinds[place]).alias(place), F.lit(None).cast(kinds[key]).alias(key), whole.alias("reason")).filter("reason IS NOT NULL")
    return catalog.join(selection.select(key).distinct(), key, "left_semi"), bad.unionByName(whole)


def ref_integrity(refs: DataFrame, catalog: DataFrame, ref: str, key: str) -> DataFrame:
    """Rows with a reference that the catalog has not; nulls refer to nothing."""
    there = catalog.select(F.col(key).alias("__key"))
    return refs.filter(F.col(ref).isNotNull()).join(there, F.col(ref) == F.col("__key"), "left_anti")


def assigned_slot_check(df: DataFrame, key: str, slots: Column) -> DataFrame:
    """Keys and places of slots that are assigned but refer to nothing; ``slots``: array<struct<assigned, assetId>>."""
    one = df.select(key, F.posexplode(slots).alias("slot", "s"))
    return one.filter(F.col("s.assigned") & (F.col("s.assetId").isNull() | (F.col("s.assetId") == ""))).select(key, "slot")


def sentinel_exempt(missing: DataFrame, pattern: Column) -> DataFrame:
    """Missing references other than the one exact row that may stay."""
    return missing.filter(~F.coalesce(pattern, F.lit(False)))


def required_families(counts: DataFrame, required: list[str], family: str = "family", rows: str = "rows") -> DataFrame:
    """Required families that are absent or empty."""
    r = counts.sparkSession.createDataFrame([(x,) for x in required], f"{family} string")
    return r.join(counts.filter(F.col(rows) > 0), family, "left_anti")


def ci_lookup(df: DataFrame, key: str, catalog: DataFrame, canon: str) -> DataFrame:
    """``canonical``: the catalog's spelling, null if it has none; ``adjusted``: whether the letter case differs."""
    c = catalog.groupBy(F.lower(canon).alias("__l")).agg(F.min(canon).alias("canonical"))
    out = df.join(c, F.lower(key) == F.col("__l"), "left").drop("__l")
    return out.withColumn("adjusted", F.coalesce(F.col("canonical") != F.col(key), F.lit(False)))


def prefix_match(literals: DataFrame, catalog: DataFrame, literal: str, key: str) -> DataFrame:
    """Each literal with its exact key, or else all keys that start with it, in either case; key is null if there is none.

    A key meets literals by equality, through its beginnings of each length that a literal has; so only matches are joined."""
    keys = catalog.select(F.col(key).alias("key"), F.lower(key).alias("__k"))
    lits = literals.withColumn("__l", F.lower(literal))
    exact = lits.join(keys, F.col("__l") == F.col("__k")).drop("__k")
    rest = lits.join(keys.select("__k"), F.col("__l") == F.col("__k"), "left_anti")
    # One row: the distinct lengths of literals.
    sizes = rest.agg(F.collect_set(F.length("__l")).alias("__sizes"))
    begun = keys.crossJoin(F.broadcast(sizes)).withColumn("__size", F.explode(F.filter("__sizes", lambda n: n <= F.length("__k"))))
    begun = begun.select("key", F.expr("substring(__k, 1, __size)").alias("__l"))
    hit = rest.join(begun, "__l")
    found = exact.unionByName(hit)
    none = lits.join(found.select("__l").distinct(), "__l", "left_anti").withColumn("key", F.lit(None).cast("string"))
    return found.unionByName(none).drop("__l")


def binding_conflicts(df: DataFrame, slot: str, asset: str) -> DataFrame:
    return df.groupBy(slot).agg(F.count_distinct(asset).alias("assets")).filter("assets > 1")


def domain_completeness(bindings: DataFrame, domains: DataFrame, domain: str, index: str, size: str, start: int = 1) -> DataFrame:
    """Indexes of each domain, ``start`` and on, that no binding has."""
    full = domains.filter(F.col(size) > 0).select(domain, F.explode(F.sequence(F.lit(start).cast("long"), F.col(size).cast("long") + start - 1)).alias(index))
    return full.join(bindings.select(domain, index).distinct(), [domain, index], "left_anti")


def conditional_slot_check(items: DataFrame, flags: DataFrame, bindings: DataFrame, slot: str, kinds: list[str]) -> DataFrame:
    """item, slot, reason: slots outside the flags' domain; and, for old-style slots, each derived binding that is missing."""
    j = items.join(flags.select(F.col(slot), "modern"), slot, "left")
    unknown = j.filter("modern IS NULL").select("item", slot, F.lit("outside domain").alias("reason"))
    old = j.filter("NOT modern").select("item", slot, F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))
    gone = old.join(bindings.select("kind", slot), ["kind", slot], "left_anti").select("item", slot, F.concat(F.lit("no "), "kind").alias("reason"))
    return unknown.unionByName(gone)


def nested_ref_subset(df: DataFrame, key: str, refs: Column, selected: DataFrame, name: str) -> DataFrame:
    """Nested references outside the selected set."""
    one = df.select(key, F.explode(refs).alias(name)).filter(F.col(name).isNotNull())
    return one.join(selected.select(name), name, "left_anti").select(key, name)


def first_name_lookup(df: DataFrame, value: str, constants: DataFrame, name: str) -> DataFrame:
    """The first constant name, in byte order, of each value."""
    return df.join(constants.groupBy(value).agg(F.min(name).alias("first_name")), value, "left")


def locale_merge(a: DataFrame, b: DataFrame, key: str, text: str, names: tuple[str, str]) -> DataFrame:
    return a.select(key, F.col(text).alias(names[0])).join(b.select(key, F.col(text).alias(names[1])), key, "full_outer")


def expand_cross(df: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Each row with 0 and every distinct value; values are a small closed set (paints), checked to be at most MOST_VALUES and held
    as one array."""
    n = values.select(name).distinct().limit(MOST_VALUES + 1).count()
    if n > MOST_VALUES:
        raise ValueError(f"more than {MOST_VALUES} values to cross with")
    every = values.agg(F.array_sort(F.array_union(F.array(F.lit(0)), F.collect_set(name))).alias("__v"))
    return df.crossJoin(F.broadcast(every)).withColumn(name, F.explode("__v")).drop("__v")


def expand_variants(df: DataFrame, styles: str, alternates: str, randoms: str) -> DataFrame:
    """Each entity's styles times its alternates, 0 included, times its random range, one at least."""
    out = df.withColumn("style", F.explode(styles)).withColumn("alternate", F.explode(F.sequence(F.lit(0), F.col(alternates).cast("int"))))
    return out.withColumn("random", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.col(randoms).cast("int")) - 1)))


def parallel_arrays_to_rows(arrays: DataFrame, name: str, values: str, size: int) -> tuple[DataFrame, DataFrame]:
    """One row an index with a map of the arrays' values; and the arrays that are too short and so left out."""
    full = arrays.filter(F.size(values) >= size)
    cells = full.select(name, F.posexplode(F.slice(values, 1, size)).alias("id", "value"))
    rows = cells.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(name).alias("k"), F.col("value").alias("v"))))).alias("values"))
    return rows, arrays.filter(F.size(values) < size).select(name, F.size(values).alias("size"))


def pool_membership(pools: DataFrame, member: str, pool: str) -> DataFrame:
    return pools.groupBy(member).agg(F.array_sort(F.collect_set(pool)).alias("pools"))


def fallback_asset(custom: Column, default: Column) -> Column:
    from ledgerloom.functions.scalars import normalize_asset_path

    return normalize_asset_path(F.coalesce(F.when(custom != "", custom), default))


def paired_result_compare(cases: DataFrame, id: str, a: str, b: str, category: str, required: list[str]) -> DataFrame:
    """key, reason: cases whose outputs differ or whose id repeats, and required categories without a case."""
    differ = cases.filter(~F.col(a).eqNullSafe(F.col(b))).select(F.col(id).cast("string").alias("key"), F.lit("differ").alias("reason"))
    twice = cases.groupBy(id).count().filter("count > 1").select(F.col(id).cast("string").alias("key"), F.lit("duplicate").alias("reason"))
    need = cases.sparkSession.createDataFrame([(x,) for x in required], "key string")
    gone = need.join(cases.select(F.col(category).alias("key")).distinct(), "key", "left_anti").withColumn("reason", F.lit("no case"))
    return differ.unionByName(twice).unionByName(gone)


def identity_reconcile(values: DataFrame, attr: str, source: str, value: str, revoked: DataFrame | None = None) -> DataFrame:
    """attr, reason, found: attributes whose sources do not agree, or of which one has no value; and those with a revoked value.
    ``found`` lists the values by source, of which an attribute has a few; ``revoked`` is a table of values."""
    said = F.concat_ws("=", F.col(source), F.coalesce(F.col(value), F.lit("")))
    per = values.groupBy(attr).agg(F.count_distinct(value).alias("__n"), F.count_if(F.col(value).isNull()).alias("__none"), F.array_join(F.array_sort(F.collect_set(said)), ",").alias("found"))
    reason = F.when(F.col("__n") > 1, "differ").when(F.col("__none") > 0, "absent")
    out = per.select(attr, reason.alias("reason"), "found").filter("reason IS NOT NULL")
    if revoked is None:
        return out
    barred = values.join(revoked.select(F.col(revoked.columns[0]).alias(value)), value, "left_semi").select(attr).distinct()
    return out.unionByName(per.join(barred, attr, "left_semi").select(attr, F.lit("revoked").alias("reason"), "found"))


def path_parent_conflict(paths: DataFrame, path: str) -> DataFrame:
    """Paths that are also an ancestor of another path, in either case."""
    lower = paths.select(F.lower(path).alias("p")).distinct()
    parts = F.split("p", "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = lower.filter(F.contains("p", F.lit("/"))).select(F.explode(ups).alias("p")).distinct()
    return lower.join(above, "p", "left_semi")
