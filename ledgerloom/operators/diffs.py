"""Keyed differences between two releases. Keys and hashes meet first; payloads are joined to changed keys only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _hash(df: DataFrame, keys: list[str]) -> Column:
    rest = sorted(c for c in df.columns if c not in keys)
    return F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)


def diff_hashes(base: DataFrame, cand: DataFrame, keys: list[str], sha: str) -> DataFrame:
    """keys, change (added, removed, changed) by a hash column that both sides have."""
    b, c = base.select(*keys, F.col(sha).alias("before")), cand.select(*keys, F.col(sha).alias("after"))
    both = b.withColumn("in_b", F.lit(True)).join(c.withColumn("in_c", F.lit(True)), keys, "full_outer")
    change = F.when(F.col("in_b").isNull(), "added").when(F.col("in_c").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return both.withColumn("change", change).filter("change IS NOT NULL").select(*keys, "change", "before", "after")


def diff_rows(base: DataFrame, cand: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change of whole rows."""
    return diff_hashes(base.select(*keys, _hash(base, keys).alias("sha")), cand.select(*keys, _hash(cand, keys).alias("sha")), keys, "sha").select(*keys, "change")


def diff_catalog(base: DataFrame, cand: DataFrame, key: str, sha: str) -> DataFrame:
    """Catalog changes by content hash alone."""
    return diff_hashes(base, cand, [key], sha)


def _fields(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a field; a field that a table has not is absent, one that is null there is null."""
    rest = [c for c in df.columns if c not in keys]
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in rest])
    return df.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.field", "x.value")


def diff_fields(base: DataFrame, cand: DataFrame, keys: list[str]) -> DataFrame:
    """keys, field, before, after, in_base, in_cand for each top-level field of changed rows that differs."""
    changed = diff_rows(base, cand, keys).filter("change = 'changed'").select(*keys)
    b = _fields(base.join(changed, keys, "left_semi"), keys).withColumnRenamed("value", "before").withColumn("in_base", F.lit(True))
    c = _fields(cand.join(changed, keys, "left_semi"), keys).withColumnRenamed("value", "after").withColumn("in_cand", F.lit(True))
    both = b.join(c, [*keys, "field"], "full_outer").withColumn("in_base", F.coalesce("in_base", F.lit(False))).withColumn("in_cand", F.coalesce("in_cand", F.lit(False)))
    return both.filter((F.col("in_base") != F.col("in_cand")) | ~F.col("before").eqNullSafe(F.col("after")))


def diff_binaries(base: DataFrame, cand: DataFrame, name: str = "name", content: str = "content", digest: Callable[[Column], Column] = lambda x: F.sha2(x, 256)) -> DataFrame:
    """name, before, after digests of the candidate's objects; before is null where there is no baseline. ``digest`` is that of
    decoded content (``sources.files.gzip_measure`` for gzip), so that another compression of the same bytes is no change."""
    c = cand.select(name, digest(F.col(content)).alias("after"))
    return c.join(base.select(name, digest(F.col(content)).alias("before")), name, "left").select(name, "before", "after")


def diff_summary(changes: DataFrame, fields: DataFrame, family: str = "family") -> DataFrame:
    """Per family: added, removed, changed, and a histogram of changed fields."""
    n = lambda k: F.count_if(F.col("change") == k).alias(k)
    counts = changes.groupBy(family).agg(n("added"), n("removed"), n("changed"))
    per = fields.groupBy(family, "field").count().groupBy(family).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "count")))).alias("fields"))
    return counts.join(per, family, "left")


def first_n_examples(changes: DataFrame, family: str, order: list[Column], n: int = 5) -> DataFrame:
    w = Window.partitionBy(family).orderBy(*order)
    return changes.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= n)


def union_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def missing_from(wanted: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(there, keys, "left_anti")


def unexpected_in(there: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return there.join(wanted, keys, "left_anti")


def key_coverage_equal(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that one side alone has, with the side."""
    both = a.select(key).distinct().withColumn("in_a", F.lit(True)).join(b.select(key).distinct().withColumn("in_b", F.lit(True)), key, "full_outer")
    return both.filter("in_a IS NULL OR in_b IS NULL").select(key, F.when(F.col("in_b").isNull(), "first only").otherwise("second only").alias("side"))
