"""Row numbers, ranks, runs and running totals. A window over a whole table is never taken: long sequences are cut into
buckets, whose totals are summed first."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.stable import stable


def carried(df: DataFrame, partition: list[str], order: list[Column | str], value: Column, total: Callable[[Column | str], Column], both: Callable[[Column, Column], Column], name: str) -> DataFrame:
    """``name``: ``total`` (a sum, a maximum) of ``value`` from a family's first row to each row, however large a family is.

    Rows are ranged by family and order, so a large family is cut into several ranges; each range's total is carried on to the
    next ones of the family."""
    cut, keys = ranged(df.withColumn("__value", value), partition, order)
    here = Window.partitionBy("__part", *partition).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*partition).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("__part", *partition).agg(total("__value").alias("__total")).withColumn("__before", total("__total").over(earlier)).filter("__before IS NOT NULL")
    rows = at_ends(cut.withColumn(name, total("__value").over(here)), partition, ends, ["__before"])
    done = rows.withColumn(name, F.when(F.col("__before").isNull(), F.col(name)).otherwise(both(F.col(name), F.col("__before"))))
    return done.drop("__part", "__value", "__before", *keys)


def ranged(df: DataFrame, partition: list[str], order: list[Column | str]) -> tuple[DataFrame, list[str]]:
    """Rows ranged by family and order, with the number of their range as ``__part``; and the order's columns, to be dropped. A
    large family has several ranges, which follow on each other. Range bounds are sampled, so the ranged rows are kept."""
    keys = {f"__k{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    rows = df.withColumns(keys).repartitionByRange(*partition, *keys)
    return stable(rows.withColumn("__part", F.spark_partition_id())), list(keys)


def at_ends(rows: DataFrame, partition: list[str], told: DataFrame, names: list[str]) -> DataFrame:
    """Ranged rows with the columns ``names`` that ``told`` has for their range and family, null where it has none."""
    keys = ["__part", *partition]
    told = told.select(*[F.col(c).alias(f"__e{i}") for i, c in enumerate(keys)], *names)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__e{i}")) for i, c in enumerate(keys)])
    return rows.join(told, same, "left").drop(*[f"__e{i}" for i in range(len(keys))])


def neighbour(df: DataFrame, partition: list[str], order: list[Column | str], value: Column, name: str, ahead: bool = False) -> DataFrame:
    """``name``: a struct of the ``value`` of the row before in its family, or after it; null where there is none. Within a range a
    window finds it; the first row of a range gets it from the family's range before, of which one row each is told."""
    rows, keys = ranged(df.withColumn("__value", F.struct(value.alias("value"))), partition, order)
    near, edge = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    ends = rows.groupBy("__part", *partition).agg(edge("__value", F.struct(*keys)).alias("__edge"))
    ends = ends.withColumn("__over", near("__edge").over(Window.partitionBy(*partition).orderBy("__part"))).filter("__over IS NOT NULL")
    rows = rows.withColumn(name, near("__value").over(Window.partitionBy("__part", *partition).orderBy(*keys)))
    return at_ends(rows, partition, ends, ["__over"]).withColumn(name, F.coalesce(name, "__over")).drop("__over", "__value", "__part", *keys)


def runs(df: DataFrame, partition: list[str], order: str, values: list[str]) -> DataFrame:
    """The family, run (from 0), first, last and values of each run of equal values.

    A segmented scan: each range numbers its own runs and tells its first and last values and how many runs it has; a run that is
    open at a border and goes on behind it takes one number, so a range's runs start after those before, less the borders that a
    run crosses. Families of any length are cut into ranges."""
    rows, keys = ranged(df, partition, [order])
    v = F.struct(*values)
    here = Window.partitionBy("__part", *partition).orderBy(*keys)
    starts = F.when(F.lag(F.lit(1)).over(here).isNull() | v.eqNullSafe(F.lag(v).over(here)), 0).otherwise(1)
    rows = rows.withColumn("__starts", starts).withColumn("run", F.sum("__starts").over(here))
    at = F.struct(*keys)
    ends = rows.groupBy("__part", *partition).agg((F.sum("__starts") + 1).alias("__n"), F.min_by(v, at).alias("__first"), F.max_by(v, at).alias("__last"))
    line = Window.partitionBy(*partition).orderBy("__part")
    open_ = F.when(F.lag(F.lit(1)).over(line).isNotNull() & F.col("__first").eqNullSafe(F.lag("__last").over(line)), 1).otherwise(0)
    ends = ends.withColumn("__open", open_).withColumn("__base", F.sum(F.col("__n") - F.col("__open")).over(line) - F.col("__n"))
    rows = at_ends(rows, partition, ends, ["__base"]).withColumn("run", (F.col("run") + F.col("__base")).cast("long"))
    return rows.groupBy(*partition, "run", *values).agg(F.min(order).alias("first"), F.max(order).alias("last"))


def next_marked(df: DataFrame, partition: list[str], order: list[Column | str], mark: str, name: str) -> DataFrame:
    """``name``: the first ``mark`` that is not null, from each row on in its family's order, over range borders; null after the last."""
    rows, keys = ranged(df, partition, order)
    ends = rows.filter(F.col(mark).isNotNull()).groupBy("__part", *partition).agg(F.min_by(mark, F.struct(*keys)).alias("__edge"))
    # Ranges without a mark of the family have to learn of it too.
    ends = rows.select("__part", *partition).distinct().transform(lambda d: at_ends(d, partition, ends, ["__edge"]))
    # Both windows run backwards, as a frame that ends at the last row would be read again for each row.
    later = Window.partitionBy(*partition).orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__over", F.last("__edge", ignorenulls=True).over(later)).filter("__over IS NOT NULL")
    here = Window.partitionBy("__part", *partition).orderBy(*[F.desc(k) for k in keys]).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(name, F.last(mark, ignorenulls=True).over(here))
    return at_ends(rows, partition, ends, ["__over"]).withColumn(name, F.coalesce(name, "__over")).drop("__over", "__part", *keys)


def place_in_family(df: DataFrame, partition: list[str], order: list[Column | str], name: str) -> DataFrame:
    """1-based place of each row in its family's order."""
    return carried(df, partition, order, F.lit(1).cast("long"), F.sum, lambda x, y: x + y, name)


def row_shard(df: DataFrame, partition: list[str], order: list[Column | str], size: int = 256) -> DataFrame:
    """``shard``: the number of the run of ``size`` consecutive rows of a partition."""
    return place_in_family(df, partition, order, "__place").withColumn("shard", F.floor((F.col("__place") - 1) / size).cast("long")).drop("__place")


def global_position(df: DataFrame, order: list[Column | str], name: str = "pos") -> DataFrame:
    """0-based place in the order of a whole table: rows are ranged into partitions, counted, and numbered from there."""
    keys = [f"__k{i}" for i in range(len(order))]
    ranged = df.withColumns({k: F.col(c) if isinstance(c, str) else c for k, c in zip(keys, order, strict=True)})
    # Range bounds are sampled, so the ranged rows are made once and kept.
    ranged = stable(ranged.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    mine = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    totals = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    base = totals.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__base"))
    return ranged.withColumn(name, mine).join(base, "__part").withColumn(name, (F.col(name) + F.col("__base")).cast("long")).drop("__part", "__base", *keys)


def _priority(df: DataFrame, order: str, flags: list[Column]) -> DataFrame:
    return global_position(df, [*flags, order], "rank")


def priority_rank_any(df: DataFrame, order: str = "ord", paint: str = "paint") -> DataFrame:
    """Unpainted rows first, then input order."""
    return _priority(df, order, [F.col(paint) != 0])


def priority_rank_wall(df: DataFrame, order: str = "ord", paint: str = "paint", kind: str = "kind") -> DataFrame:
    """Unpainted rows first, then walls, then input order."""
    return _priority(df, order, [F.col(paint) != 0, F.col(kind) != "wall"])


def group_order(df: DataFrame, code: str = "code") -> DataFrame:
    """Place of a row in its colour: kind, unpainted first, type, variant, paint, input order. A colour may have any number of rows."""
    order = ["kind_code", F.col("paint") != 0, "type", "variant", "paint", "ord"]
    return place_in_family(df, [code], order, "place").withColumn("place", (F.col("place") - 1).cast("int"))


def run_boundaries(df: DataFrame, partition: str, order: str, values: list[str]) -> DataFrame:
    """``last``: whether the next row of the line has other values, or there is none. A line may be of any length."""
    v = F.struct(*values)
    rows = neighbour(df, [partition], [order], v, "__next", ahead=True)
    return rows.withColumn("last", F.col("__next").isNull() | ~v.eqNullSafe(F.col("__next.value"))).drop("__next")


def running_offsets(df: DataFrame, partition: str, order: str, size: str) -> DataFrame:
    """Exclusive and inclusive prefix sums."""
    return carried(df, [partition], [order], F.col(size), F.sum, lambda x, y: x + y, "end").withColumn("start", F.col("end") - F.col(size))


def strictly_increasing(df: DataFrame, partition: list[str], order: str, key: str) -> DataFrame:
    """Rows whose key does not come after the one before, in UTF-16 order: duplicates and disorder. A sequence, which is the whole
    table if ``partition`` is empty, may be of any length."""
    rows = neighbour(df, partition, [order], F.encode(F.col(key), "UTF-16BE"), "__before")
    return rows.filter(F.encode(F.col(key), "UTF-16BE") <= F.col("__before.value")).drop("__before")


def cumulative_peak(df: DataFrame, partition: str, order: str, metric: str) -> DataFrame:
    return carried(df, [partition], [order], F.col(metric), F.max, lambda x, y: F.greatest(x, y), "peak")


def ordered_rank(df: DataFrame, order: list[Column], partition: list[str] | None = None) -> DataFrame:
    """``rank`` in an order, from 1; of a whole table if no partition is given."""
    if partition:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("long"))
    return global_position(df, order, "rank").withColumn("rank", F.col("rank") + 1)


def top_n_with_total(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows, each with the number of all rows."""
    return df.orderBy(*order).limit(n).crossJoin(F.broadcast(df.agg(F.count("*").alias("total"))))
