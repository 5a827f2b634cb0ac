"""Gates: checks whose result is a table of (gate, key, reason). An empty table passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import public_path_allowlist
from ledgerloom.operators.tables import dedupe_objects


class GateError(ValueError):
    """Some gate has violations."""


def violations(gate: str, rows: DataFrame, key: Column, reason: Column | str) -> DataFrame:
    return rows.select(F.lit(gate).alias("gate"), key.cast("string").alias("key"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))


def gate_counts(mismatches: DataFrame, key: Column) -> DataFrame:
    text = F.concat(F.lit("declared "), F.col("declared").cast("string"), F.lit(", actual "), F.col("actual").cast("string"))
    return violations("counts", mismatches, key, text)


def gate_required_match(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Rows without a partner, or whose partner's count differs."""
    j = left.select(key, count).join(right.select(key, F.col(count).alias("__n"), F.lit(True).alias("__there")), key, "left")
    reason = F.when(F.col("__there").isNull(), "missing").when(~F.col(count).eqNullSafe(F.col("__n")), "count differs")
    return violations("required_match", j.withColumn("__r", reason).filter("__r IS NOT NULL"), F.col(key), F.col("__r"))


def gate_scope(scope: DataFrame, catalog: DataFrame, mode: str = "selection") -> DataFrame:
    """``scope``: one row (mode, source_count, selected_count, capable, bindings); counts must fit the catalog."""
    row = scope.crossJoin(F.broadcast(catalog.agg(F.count("*").alias("__n"))))
    checks = [
        (F.col("mode") != mode, "mode"),
        (F.col("source_count") < F.col("selected_count"), "selected more than there are"),
        (F.col("selected_count") != F.col("__n"), "selected count"),
        (~F.col("capable"), "capability"),
        (F.col("bindings") == 0, "no bindings"),
    ]
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(r)) for c, r in checks]))
    return violations("scope", row.select(F.explode(reasons).alias("__r")), F.lit("scope"), F.col("__r"))


def gate_mounts(coverage: DataFrame, domain: Column | int | None = None) -> DataFrame:
    """Every entity must be populated, and there must be as many as the domain has: a number, or an aggregate over ``coverage``."""
    size = domain if isinstance(domain, Column) else F.lit(domain).cast("long")
    got = coverage.agg(F.count("*").alias("n"), F.count_if("populated").alias("p"), size.alias("size"))
    bad = got.filter((F.col("n") == 0) | (F.col("n") != F.col("p")) | F.coalesce(F.col("n") != F.col("size"), F.lit(False)))
    return violations("mounts", bad, F.lit("mounts"), F.concat(F.col("p").cast("string"), F.lit(" of "), F.col("n").cast("string")))


def gate_objects(faults: DataFrame) -> DataFrame:
    """``faults``: path, reason of ``tables.verify_objects``."""
    return violations("objects", faults, F.col("path"), F.col("reason"))


def gate_coverage(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """``gaps``: places of a domain that nothing fills, as of ``joins.domain_completeness``."""
    return violations("coverage", gaps, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), "missing")


def gate_refs(dangling: DataFrame, key: str) -> DataFrame:
    """``dangling``: rows whose reference leads nowhere, as of ``joins.ref_integrity``."""
    return violations("refs", dangling, F.col(key), "dangling")


def gate_bundles(faults: DataFrame, keys: list[str]) -> DataFrame:
    """``faults``: keys, reason of ``tables.verify_bundle_membership``."""
    return violations("bundles", faults, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.col("reason"))


def gate_release(gates: list[DataFrame]) -> DataFrame:
    """All that is wrong with a release; ``gates`` are those of its counts, objects, references, coverage and bundles."""
    return reduce(lambda a, b: a.unionByName(b), gates)


def release_status(gates: DataFrame) -> DataFrame:
    """One row: ready, or incomplete with the number of violations."""
    return gates.agg(F.count("*").alias("violations")).select(F.when(F.col("violations") == 0, "ready").otherwise("incomplete").alias("status"), "violations")


def gate_approval(approved: DataFrame, recomputed: DataFrame, missing: DataFrame, approved_detail: DataFrame | None = None, detail: DataFrame | None = None) -> DataFrame:
    """An approved summary (name, value) must equal the recomputed one, and nothing may be missing. Where the approval describes a
    detail (one row: rows, bytes, digest), the detail as it is now must have the same rows, bytes and digest."""
    if approved_detail is not None:
        flat = lambda df: df.select(F.inline(F.array(*[F.struct(F.lit(f"detail {x}").alias("name"), F.col(x).cast("string").alias("value")) for x in ("rows", "bytes", "digest")])))
        approved = approved.select("name", F.col("value").cast("string")).unionByName(flat(approved_detail))
        now = flat(detail) if detail is not None else flat(approved_detail).limit(0)
        recomputed = recomputed.select("name", F.col("value").cast("string")).unionByName(now)
    both = approved.select("name", F.col("value").alias("a"), F.lit(True).alias("in_a")).join(recomputed.select("name", F.col("value").alias("b"), F.lit(True).alias("in_b")), "name", "full_outer")
    differs = both.filter((F.col("in_a").isNull()) | (F.col("in_b").isNull()) | ~F.col("a").eqNullSafe(F.col("b")))
    return violations("approval", differs, F.col("name"), "differs").unionByName(violations("approval", missing, F.col(missing.columns[0]), "missing"))


def publication_plan(objects: DataFrame, release: DataFrame, channel: DataFrame) -> DataFrame:
    """kind, path, sha, bytes of all to publish; no row at all if a path is not public or two objects share one."""
    distinct, conflicts = dedupe_objects(objects.select("path", "sha", "bytes"), "path")
    kinds = [(distinct, "object"), (release, "release"), (channel, "channel")]
    plan = reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(k).alias("kind"), "path", "sha", "bytes") for df, k in kinds])
    bad = plan.filter(~public_path_allowlist(F.col("path"))).agg(F.count("*").alias("bad")).crossJoin(conflicts.agg(F.count("*").alias("twice")))
    return plan.crossJoin(F.broadcast(bad)).filter("bad = 0 AND twice = 0").drop("bad", "twice")


def enforce(gates: DataFrame, shown: int = 20) -> None:
    """Raise if a gate has violations; only the first few reach the driver."""
    rows = gates.limit(shown).collect()
    if rows:
        raise GateError("; ".join(f"{r['gate']} {r['key']}: {r['reason']}" for r in rows))
