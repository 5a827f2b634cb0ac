"""Aggregations, shards, objects and their checks."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import hash_prefix
from ledgerloom.operators.windows import global_position, row_shard, runs

BUCKET_BYTES = 16 << 20


# --- shards ----------------------------------------------------------------------------------------------------------


def shard_by_id_range(df: DataFrame, id: str, width: int = 256) -> DataFrame:
    """shard, first, last, rows of shards of ``width`` consecutive ids."""
    return df.groupBy(F.floor(F.col(id) / width).cast("long").alias("shard")).agg(F.min(id).alias("first"), F.max(id).alias("last"), F.count("*").alias("rows"))


def shard_by_row_count(df: DataFrame, part: list[str], order: str, size: int = 256) -> DataFrame:
    """shard, first, last, rows of runs of ``size`` consecutive rows of each family."""
    rows = row_shard(df, part, [order], size)
    return rows.groupBy(*part, "shard").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("rows"))


def shard_by_hash_prefix(df: DataFrame, sha: str, digits: int = 2) -> DataFrame:
    return df.withColumn("shard", hash_prefix(F.col(sha), digits))


# --- counts ----------------------------------------------------------------------------------------------------------


def dup_ids(df: DataFrame, keys: list[str], ci: bool = False) -> DataFrame:
    """Keys that occur more than once; ``ci`` ignores letter case."""
    cols = [(F.lower(k) if ci else F.col(k)).alias(k) for k in keys]
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")


def count_reconcile(df: DataFrame, declared: DataFrame, keys: list[str], rows: str = "declared_rows") -> DataFrame:
    """keys, declared, actual where the counts differ; a side that is absent counts 0."""
    actual = df.groupBy(*keys).agg(F.count("*").alias("actual"))
    both = declared.select(*keys, F.col(rows).cast("long").alias("declared")).join(actual, keys, "full_outer")
    both = both.select(*keys, F.coalesce("declared", F.lit(0).cast("long")).alias("declared"), F.coalesce("actual", F.lit(0).cast("long")).alias("actual"))
    return both.filter("declared <> actual")


def tree_digest(df: DataFrame, path: str, line: Column, bucket_rows: int = 1 << 16) -> DataFrame:
    """One digest of all lines: each bucket of paths hashes its sorted lines, then buckets are hashed, 256 together, until one is
    left. There are 256 buckets, or 256 times more for as long as one would hold over ``bucket_rows`` lines."""
    n, digits = df.count(), 2
    while n > bucket_rows * 16**digits:
        digits += 2
    rows = df.select(hash_prefix(F.sha2(F.col(path), 256), digits).alias("bucket"), line.alias("line"))
    buckets = rows.groupBy("bucket").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "\n"), 256).alias("sha"))
    both = F.concat_ws(" ", "bucket", "sha")
    while digits > 2:
        digits -= 2
        buckets = buckets.groupBy(F.substring("bucket", 1, digits).alias("bucket")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(both)), "\n"), 256).alias("sha"))
    return buckets.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(both)), "\n"), 256).alias("digest"), F.count("*").alias("buckets"))


def sequence_digest(df: DataFrame, order: list[Column | str], line: Column, chunk: int = 4096) -> DataFrame:
    """One digest of all lines in their order: ``chunk`` lines are hashed together, then as many of those hashes, twice at least
    and until one is left; no task reads the whole. An empty table has the digest of no bytes."""
    keys = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)]
    rows = global_position(df.select(line.alias("line"), *keys), [f"__o{i}" for i in range(len(order))]).select("pos", "line")
    n, levels = rows.count(), 0
    while n > 1 or levels < 2:
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
        rows = rows.groupBy(F.floor(F.col("pos") / chunk).cast("long").alias("pos")).agg(F.sha2(text, 256).alias("line"))
        n, levels = -(-n // chunk), levels + 1
    return rows.agg(F.coalesce(F.max("line"), F.sha2(F.lit(""), 256)).alias("digest"))


def dedupe_objects(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Distinct descriptors by path, and the paths with more than one descriptor."""
    rest = [c for c in df.columns if c != path]
    kinds = df.distinct().groupBy(path).agg(F.count("*").alias("descriptors"), *[F.min(c).alias(c) for c in rest])
    return kinds.filter("descriptors = 1").select(path, *rest), kinds.filter("descriptors > 1").select(path, "descriptors")


def bucket_stats(df: DataFrame, prefix: Column, size: str, limit: int = BUCKET_BYTES) -> DataFrame:
    return df.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("objects"), F.sum(size).cast("long").alias("bytes"), (F.sum(size) <= limit).alias("fits"))


def byte_budget(df: DataFrame, size: str, limits: dict[str, int]) -> DataFrame:
    """limit, value, allowed, ok for total bytes, objects and the largest object."""
    got = df.agg(F.sum(size).cast("long").alias("total_bytes"), F.count("*").alias("objects"), F.max(size).cast("long").alias("largest"))
    rows = F.array(*[F.struct(F.lit(k).alias("limit"), F.coalesce(F.col(k), F.lit(0).cast("long")).alias("value"), F.lit(v).cast("long").alias("allowed")) for k, v in limits.items()])
    return got.select(F.inline(rows)).withColumn("ok", F.col("value") <= F.col("allowed"))


def dedupe_operations(df: DataFrame, parent: str, pos: str, op: Column) -> tuple[DataFrame, DataFrame]:
    """Each parent's ordered operation keys, and the distinct operations by key."""
    rows = df.select(parent, pos, op.alias("operation")).withColumn("key", F.sha2("operation", 256))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(pos, "key"))), lambda x: x["key"])
    return rows.groupBy(parent).agg(ordered.alias("keys")), rows.select("key", "operation").dropDuplicates(["key"])


def _first_values(df: DataFrame, part: str, pos: str, value: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """Each part's distinct values with their rows, and ``index`` by first appearance; and (part, values). A part with more than
    ``limit`` values is only counted, so that no window goes over more than ``limit`` rows."""
    firsts = df.groupBy(part, value).agg(F.min(pos).alias("__first"), F.count("*").alias("__rows"))
    counts = firsts.groupBy(part).agg(F.count("*").alias("__values"))
    few = firsts.join(counts.filter(F.col("__values") <= limit), part)
    return few.withColumn("index", F.row_number().over(Window.partitionBy(part).orderBy("__first")) - 1), counts


def dictionary_encode(df: DataFrame, part: str, pos: str, value: str, limit: int = 256) -> DataFrame:
    """``index`` of each value by first appearance in its part; null where a part has more than ``limit`` values."""
    index = _first_values(df, part, pos, value, limit)[0].select(F.col(part).alias("__p"), F.col(value).alias("__v"), "index")
    return df.join(index, (df[part] == F.col("__p")) & df[value].eqNullSafe(F.col("__v")), "left").drop("__p", "__v")


def _deflated(block: pa.Table) -> pa.Table:
    """Bytes of a block's values one after the other, and of its indexes in whole bytes or parts of them, both deflated."""
    rows = block.sort_by("pos")
    plain = len(zlib.compress(b"".join(x or b"" for x in rows.column("content").to_pylist())))
    index = None
    if rows.num_rows and rows.column("bits")[0].as_py() is not None:
        bits, codes = rows.column("bits")[0].as_py(), rows.column("index").to_numpy().astype(np.uint8)
        index = len(zlib.compress(np.packbits(np.unpackbits(codes[:, None], axis=1)[:, 8 - bits :].ravel()).tobytes()))
    return pa.table({"part": rows.column("part").slice(0, 1), "plain": pa.array([plain], pa.int64()), "coded": pa.array([index], pa.int64())})


def coding_choice(df: DataFrame, part: str, pos: str, value: str, limit: int = 256, deflate: bool = False, overhead: int = 24, block: int = 1 << 16) -> DataFrame:
    """part, rows, values, plain_bytes, indexed_bytes, indexed: whether a part is smaller with its distinct values stored once, in
    order of first appearance, and an index of 1, 2, 4 or 8 bits a row. A tie stays plain, as does a part with more than ``limit``
    values, which has no indexed size.

    Sizes are those of the bytes, or with ``deflate`` of both forms compressed, in blocks of ``block`` rows whose sizes are summed,
    so that a part may be of any length. ``overhead`` is what the stored values cost besides their bytes. A null has no bytes."""
    firsts, counts = _first_values(df, part, pos, value, limit)
    bits = F.when(F.col("__values") <= 2, 1).when(F.col("__values") <= 4, 2).when(F.col("__values") <= 16, 4).when(F.col("__values") <= limit, 8)
    size = F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    stored = firsts.groupBy(F.col(part).alias("__p")).agg(F.sum(size).alias("__stored"))
    rows = df.groupBy(part).agg(F.count("*").alias("rows"), F.sum(size).alias("plain")).join(counts, part)
    if deflate:
        placed = row_shard(dictionary_encode(df, part, pos, value, limit), [part], [pos], block).join(counts.withColumnRenamed(part, "__p"), F.col(part) == F.col("__p"))
        cut = placed.select(F.col(part).cast("string").alias("part"), "shard", F.col(pos).alias("pos"), F.col(value).cast("binary").alias("content"), "index", bits.alias("bits"))
        each = cut.groupBy("part", "shard").applyInArrow(_deflated, "part string, plain long, coded long")
        each = each.groupBy(F.col("part").alias("__part")).agg(F.sum("plain").alias("plain"), F.sum("coded").alias("coded"))
        rows = rows.drop("plain").join(each, F.col(part).cast("string") == F.col("__part")).drop("__part")
    else:
        rows = rows.withColumn("coded", F.ceil(F.col("rows") * bits / 8))
    rows = rows.join(stored, F.col(part) == F.col("__p"), "left")
    indexed = F.when(F.col("__values") <= limit, F.col("coded") + F.col("__stored") + overhead).cast("long")
    out = rows.select(part, "rows", F.col("__values").alias("values"), F.col("plain").alias("plain_bytes"), indexed.alias("indexed_bytes"))
    return out.withColumn("indexed", F.coalesce(F.col("indexed_bytes") < F.col("plain_bytes"), F.lit(False)))


def largest_group(df: DataFrame, key: str, variant: str = "variant", stable: str = "stable") -> DataFrame:
    per = df.groupBy(key).agg(F.count("*").alias("n"), F.max(variant).alias("v"), F.count_if(F.col(stable)).alias("s"))
    return per.agg(F.count("*").alias("groups"), F.max("n").alias("largest"), F.max("v").alias("max_variant"), F.sum("s").alias("stable_rows"))


def line_runs(df: DataFrame, line: str, cell: str, values: list[str]) -> DataFrame:
    """line, run, first, last and values of each run of equal values; a line may be of any length."""
    return runs(df, [line], cell, values)


def domain_counts(df: DataFrame, kind: str, status: str, labels: list[str]) -> DataFrame:
    return df.groupBy(kind).agg(F.count("*").alias("domain"), *[F.count_if(F.col(status) == s).alias(s) for s in labels])


def slot_coverage(df: DataFrame, slot: str, reason: str, sampled: str, reasons: list[str]) -> DataFrame:
    """Per slot: declared, available (left out for no reason), sampled of those, and the number left out for each reason."""
    free = F.col(reason).isNull()
    return df.groupBy(slot).agg(F.count("*").alias("declared"), F.count_if(free).alias("available"), F.count_if(free & F.col(sampled)).alias("sampled"), *[F.count_if(F.col(reason) == r).alias(r) for r in reasons])


def slot_exclusions(df: DataFrame, slot: str, key: str, reason: str) -> DataFrame:
    """The keys that each slot leaves out, with the reason: a row each, as a slot may leave out any number."""
    return df.filter(F.col(reason).isNotNull()).select(slot, F.col(reason).alias("reason"), key)


def mount_coverage(df: DataFrame, key: str, slots: Column) -> DataFrame:
    """Of each entity: its assigned slots, whether it is populated (has slots at all), and whether none is assigned. ``slots`` is
    an array of flags, null for an entity that was not set up."""
    n = F.coalesce(F.size(F.filter(slots, lambda x: x)), F.lit(0))
    n = F.when(slots.isNull(), 0).otherwise(n)
    return df.select(key, n.alias("assigned"), slots.isNotNull().alias("populated"), (n == 0).alias("textureless"))


def mount_totals(coverage: DataFrame, domain: Column | int) -> DataFrame:
    """One row: entities, populated, textureless, bound slots, the domain's size, and whether all of the domain is populated. The
    size is a number, or an aggregate over ``coverage``."""
    size = domain if isinstance(domain, Column) else F.lit(domain)
    got = coverage.agg(F.coalesce(size, F.lit(0)).cast("long").alias("domain"), F.count("*").alias("entities"), F.count_if("populated").alias("populated"), F.count_if("textureless").alias("textureless"), F.coalesce(F.sum("assigned"), F.lit(0)).cast("long").alias("bound_slots"))
    complete = (F.col("entities") > 0) & (F.col("entities") == F.col("populated")) & (F.col("entities") == F.col("domain"))
    return got.select("entities", "populated", "textureless", "bound_slots", "domain", complete.alias("complete"))


def distinct_styles(df: DataFrame, key: str, style: str) -> DataFrame:
    """Sorted distinct styles of each key, none below 0, and 0 among them."""
    return df.groupBy(key).agg(F.array_sort(F.array_union(F.collect_set(F.greatest(F.lit(0), F.col(style))), F.array(F.lit(0)))).alias("styles"))


def first_per_key(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def domain_size_fallback(declared: Column, ids: Column) -> Column:
    """The declared size, else the largest id and 1, else 0."""
    return F.coalesce(declared, F.max(ids) + 1, F.lit(0))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def pair_counts(df: DataFrame, arr: str) -> DataFrame:
    return df.agg(F.count_if(F.size(arr) > 0).alias("entities"), F.coalesce(F.sum(F.size(arr)), F.lit(0)).cast("long").alias("elements"))


def error_kinds(df: DataFrame, kind: str, order: str, sample: str, n: int = 40) -> DataFrame:
    """Count and first sample of each kind, the ``n`` most frequent, with the number of all kinds."""
    kinds = df.groupBy(kind).agg(F.count("*").alias("n"), F.min_by(sample, order).alias("sample"))
    return kinds.orderBy(F.desc("n"), kind).limit(n).crossJoin(F.broadcast(kinds.agg(F.count("*").alias("kinds"))))


def stage_rollup(samples: DataFrame, stage: str, metrics: list[str], at: str | None = None) -> DataFrame:
    """Peaks of each stage and, with a null stage, of all; with ``at``, a timestamp, also the whole ``millis`` from first to last sample."""
    took = [] if at is None else [F.floor((F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))) / 1000).cast("long").alias("millis")]
    return samples.rollup(stage).agg(*[F.max(m).alias(f"peak_{m}") for m in metrics], *took)


# --- checks of objects -----------------------------------------------------------------------------------------------


def verify_objects(descriptors: DataFrame, measured: DataFrame, path: str = "path") -> DataFrame:
    """path, reason of descriptors that differ from what was measured; ``decoded_bytes`` counts where the descriptors have it, and
    encoded content that cannot be decoded has another size than any."""
    sized = "decoded_bytes" in descriptors.columns
    m = measured.select(path, F.col("sha").alias("m_sha"), F.col("bytes").alias("m_bytes"), *[F.col("decoded_bytes").alias("m_decoded")] * sized)
    both = descriptors.select(path, "sha", "bytes", *["decoded_bytes"] * sized).join(m, path, "left")
    reason = F.when(F.col("m_sha").isNull(), "missing").when(F.col("bytes") != F.col("m_bytes"), "bytes").when(F.col("sha") != F.col("m_sha"), "sha")
    if sized:
        reason = reason.when(F.col("decoded_bytes").isNotNull() & ~F.col("decoded_bytes").eqNullSafe(F.col("m_decoded")), "decoded bytes")
    return both.select(path, reason.alias("reason")).filter("reason IS NOT NULL")


def verify_bundle_membership(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """keys, reason of members that are missing, unexpected or repeated."""
    n = actual.groupBy(*keys).agg(F.count("*").alias("n"))
    both = expected.select(*keys).distinct().withColumn("wanted", F.lit(True)).join(n, keys, "full_outer")
    reason = F.when(F.col("n").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").when(F.col("n") > 1, "repeated")
    return both.select(*keys, reason.alias("reason")).filter("reason IS NOT NULL")
