"""Nearest colours with exact ties, and palette and run indexes over the colour cube."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.functions.scalars import bgr_rank, brick_address, kind_code, rgb_pack
from ledgerloom.operators.windows import global_position, group_order, next_marked, priority_rank_any, priority_rank_wall

#: The most candidates that a colour index can number, which is also what bounds a broadcast of them.
MAX_CANDIDATES = 65_534
RANK = 1 << 24


#: Colours are pruned by cells of a grid with sides of so many steps; a worker remembers the candidates of so many cells.
CELL, KNOWN_CELLS = 16, 1 << 14


class _Nearest:
    """The least (squared distance, rank), as one integer, among candidate points.

    Of a cell's colours the nearest point is no farther than the far side of some occupied cell, so points of cells whose near
    side is beyond the nearest such far side are left out; that is found once for each cell that has colours."""

    def __init__(self, points: np.ndarray, ranks: np.ndarray, bound: int):
        self.points, self.ranks, self.bound = points, ranks, bound
        self.cells, self.cell_of = np.unique(points // CELL, axis=0, return_inverse=True)
        self.known: dict[bytes, np.ndarray] = {}

    def near(self, cell: np.ndarray) -> np.ndarray:
        """Points that may be the nearest of a colour in ``cell``."""
        found = self.known.get(cell.tobytes())
        if found is None:
            gap = np.abs(self.cells - cell)
            least, most = ((np.maximum(gap - 1, 0) * CELL) ** 2).sum(1), (((gap + 1) * CELL) ** 2).sum(1)
            found = np.flatnonzero((least <= most.min())[self.cell_of.ravel()])
            if len(self.known) >= KNOWN_CELLS:
                self.known.clear()
            self.known[cell.tobytes()] = found
        return found

    def find(self, colours: np.ndarray) -> np.ndarray:
        different, which = np.unique(colours, axis=0, return_inverse=True)
        cells, cell_of = np.unique(different // CELL, axis=0, return_inverse=True)
        order = np.argsort(cell_of.ravel(), kind="stable")
        cuts = np.searchsorted(cell_of.ravel()[order], np.arange(len(cells) + 1))
        best = np.empty(len(different), np.int64)
        for i, cell in enumerate(cells):
            near = self.near(cell)
            points, ranks = self.points[near], self.ranks[near]
            mine = order[cuts[i] : cuts[i + 1]]
            for at in range(0, len(mine), width := max(1, (1 << 20) // len(near))):
                some = mine[at : at + width]
                d2 = sum((different[some, k][:, None] - points[:, k][None, :]) ** 2 for k in range(points.shape[1]))
                best[some] = (d2 * self.bound + ranks).min(1)
        return best[which.ravel()]


def nearest_assign(queries: DataFrame, candidates: DataFrame, axes: list[str], rank: str, rank_bound: int | None = None) -> DataFrame:
    """``rank`` and squared distance of each query's nearest candidate, ties to the smaller rank; no rows without a candidate.

    Distance and rank share one integer; ``rank_bound`` is over all ranks, and is read off them if not given. The candidates are
    checked to be at most MAX_CANDIDATES distinct points and sent to all workers; queries are not shuffled. Queries with a null
    coordinate have no nearest candidate and are left out."""
    points = candidates.groupBy(*axes).agg(F.min(rank).cast("long").alias("__rank"))
    n, low, high = points.agg(F.count("*"), F.min("__rank"), F.max("__rank")).first()
    if n > MAX_CANDIDATES:
        raise ValueError(f"more than {MAX_CANDIDATES} candidate colours")
    rank_bound = rank_bound or int(high or 0) + 1
    if n and not 0 <= low <= high < rank_bound:
        raise ValueError(f"ranks from {low} to {high} are not within 0 and {rank_bound}")
    if not n:
        return queries.limit(0).withColumns({"d2": F.lit(0).cast("long"), "rank": F.lit(0).cast("long")})
    table = np.array(points.select(*[F.col(a).cast("long") for a in axes], "__rank").collect(), dtype=np.int64).reshape(n, -1)
    sent = queries.sparkSession.sparkContext.broadcast((table[:, :-1], table[:, -1], rank_bound))

    @F.pandas_udf(LongType())
    def best(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        nearest = _Nearest(*sent.value)
        for columns in batches:
            yield pd.Series(nearest.find(np.column_stack([x.to_numpy(np.int64) for x in columns])))

    there = reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in axes])
    found = queries.filter(there).withColumn("__best", best(*[F.col(a).cast("long") for a in axes]))
    return found.withColumns({"d2": F.floor(F.col("__best") / rank_bound).cast("long"), "rank": (F.col("__best") % rank_bound).cast("long")}).drop("__best")


def stable_subset(df: DataFrame, flag: str, order: str) -> DataFrame:
    """Flagged rows with their 0-based position in input order."""
    return global_position(df.filter(F.col(flag)), [order], "position")


def _nearest_stable(queries: DataFrame, candidates: DataFrame, ranked) -> DataFrame:
    c = ranked(stable_subset(candidates, "stable", "ord").withColumnRenamed("ord", "__ord").withColumnRenamed("position", "ord"))
    found = nearest_assign(queries, c, ["r", "g", "b"], "rank")
    return found.join(c.select("rank", F.col("ord").alias("position")), "rank").drop("rank")


def nearest_any(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Position, among the stable candidates, of the nearest; ties to unpainted ones, then to input order."""
    return _nearest_stable(queries, candidates, priority_rank_any)


def nearest_wall_pref(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """As ``nearest_any``, but among equally painted ones walls come first."""
    return _nearest_stable(queries, candidates, priority_rank_wall)


def nearest_group(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """The colour code of the nearest group of candidates; ties to the smallest of (b, g, r)."""
    c = candidates.select("r", "g", "b").distinct().withColumn("rank", bgr_rank(F.col("r"), F.col("g"), F.col("b")))
    found = nearest_assign(queries, c, ["r", "g", "b"], "rank", RANK)
    byte = lambda n: F.shiftright("rank", n).bitwiseAND(F.lit(255)).cast("int")
    return found.withColumn("code", rgb_pack(byte(0), byte(8), byte(16))).drop("rank")


def color_groups(df: DataFrame) -> DataFrame:
    """code, members in order (kind, unpainted first, type, variant, paint, input order), their number."""
    key = F.struct(kind_code(F.col("kind")).alias("kind"), (F.col("paint") != 0).alias("painted"), "type", "variant", "paint", "ord")
    rows = df.select(rgb_pack(F.col("r"), F.col("g"), F.col("b")).alias("code"), key.alias("m"))
    return rows.groupBy("code").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["ord"]).alias("members"), F.count("*").alias("n"))


def color_members(df: DataFrame) -> DataFrame:
    """code, place, ord: the members of each colour as rows, for colours that have too many for an array."""
    rows = df.select(rgb_pack(F.col("r"), F.col("g"), F.col("b")).alias("code"), kind_code(F.col("kind")).alias("kind_code"), "paint", "type", "variant", "ord")
    return group_order(rows).select("code", "place", "ord")


def brick_palette(cells: DataFrame) -> DataFrame:
    """Per 8 x 8 x 8 brick of (r, g, b, label): palette, its size, encoding class 0 to 3 and payload bytes."""
    rows = cells.withColumn("a", brick_address(F.col("r"), F.col("g"), F.col("b")))
    out = rows.groupBy(F.col("a.brick").alias("brick")).agg(F.array_sort(F.collect_set("label")).alias("palette"))
    n = F.size("palette")
    kind = F.when(n == 1, 0).when(n <= 16, 1).when(n <= 256, 2).otherwise(3)
    size = F.when(n == 1, 2).when(n <= 16, 1 + 2 * n + 256).when(n <= 256, 2 + 2 * n + 512).otherwise(1024)
    return out.select("brick", "palette", n.alias("n"), kind.alias("encoding"), size.cast("long").alias("bytes"))


def brick_cells(cells: DataFrame, bricks: DataFrame) -> DataFrame:
    """brick, cell, index of each cell in its brick's palette."""
    rows = cells.withColumn("a", brick_address(F.col("r"), F.col("g"), F.col("b"))).select(F.col("a.brick").alias("brick"), F.col("a.cell").alias("cell"), "label")
    return rows.join(bricks.select("brick", "palette"), "brick").select("brick", "cell", (F.array_position("palette", F.col("label")) - 1).alias("index"))


def lookup_brick(queries: DataFrame, bricks: DataFrame, indexes: DataFrame) -> DataFrame:
    """The label of each query colour, through its brick's palette."""
    q = queries.withColumn("a", brick_address(F.col("r"), F.col("g"), F.col("b"))).withColumns({"brick": F.col("a.brick"), "cell": F.col("a.cell")}).drop("a")
    return q.join(indexes, ["brick", "cell"]).join(bricks.select("brick", "palette"), "brick").withColumn("label", F.element_at("palette", (F.col("index") + 1).cast("int"))).drop("index", "palette")


def lookup_runs(queries: DataFrame, runs: DataFrame, line: str, at: str, values: list[str]) -> DataFrame:
    """The first run of a query's line that ends at or after it: runs and queries are merged in one order per line."""
    r = runs.select(line, F.col("last").alias("__at"), F.struct("last", *values).alias("__run"), F.lit(1).alias("__side"))
    q = queries.select(line, F.col(at).alias("__at"), F.struct(*queries.columns).alias("__q"), F.lit(0).alias("__side"))
    both = r.unionByName(q, allowMissingColumns=True)
    # Queries come before a run that ends where they are; each takes the next run from there, also from a later range.
    found = next_marked(both, [line], ["__at", "__side"], "__run", "__next").filter("__side = 0")
    return found.select("__q.*", F.col("__next.last").alias("last"), *[F.col(f"__next.{v}").alias(v) for v in values])


def lower_envelope(f: np.ndarray, weight: int) -> np.ndarray:
    """For each row of ``f`` and place x the least of ``f[p] + weight * (x - p)^2`` over all places p.

    Each place has a parabola of one shape; a later one is below an earlier one from some x on. Places are taken in turn: those
    that the new one overtakes before they have come to the front are dropped, which makes the work linear in a row's length.
    All rows go through a place together."""
    rows, n = f.shape
    each = np.arange(rows)
    front = np.zeros((rows, n), np.int64)  # the places that come to the front, in order, and from where on
    since = np.zeros((rows, n), np.int64)
    top = np.zeros(rows, np.int64)
    for q in range(1, n):
        left, start = each, np.zeros(rows, np.int64)
        while len(left):
            p = front[left, top[left]]
            s = (f[left, q] - f[left, p] + weight * (q * q - p * p)) // (2 * weight * (q - p)) + 1
            overtakes = s <= since[left, top[left]]
            start[left] = np.where(overtakes, 0, s)
            top[left] -= overtakes
            left = left[overtakes & (top[left] >= 0)]
        # Without a place left the new one is in front from the start.
        used = each[start < n]
        top[used] += 1
        front[used, top[used]] = q
        since[used, top[used]] = start[used]
    out = np.empty_like(f)
    at = np.zeros(rows, np.int64)
    for x in range(n):
        ahead = np.minimum(at + 1, top)
        at = np.where((ahead > at) & (since[each, ahead] <= x), ahead, at)
        p = front[each, at]
        out[:, x] = f[each, p] + weight * (x - p) ** 2
    return out


#: A cube of 256^3 cells is worked on in slabs of so many planes.
SIDE, SLAB = 256, 16
#: A squared distance past any in the cube.
PAST = 3 * 255 * 255 + 1


def _planes(far: int, bound: int):
    """Within each plane of a slab along r: the least over b, then over g. One row for each (r, g), with its place along g."""

    def run(table: pa.Table) -> pa.Table:
        slab = table.column("slab")[0].as_py()
        seeds = table.filter(pc.is_valid(table.column("code")))
        code = seeds.column("code").to_numpy().astype(np.int64)
        f = np.full((SLAB, SIDE, SIDE), far, np.int64)
        f.ravel()[code - slab * SLAB * SIDE * SIDE] = seeds.column("best").to_numpy()
        some = np.flatnonzero((f < far).any((1, 2)))
        g = lower_envelope(f[some].reshape(-1, SIDE), bound).reshape(-1, SIDE, SIDE)
        g = lower_envelope(g.transpose(0, 2, 1).reshape(-1, SIDE), bound).reshape(-1, SIDE, SIDE)
        f[some] = g.transpose(0, 2, 1)
        r, at = np.divmod(np.arange(SLAB * SIDE), SIDE)
        best = pa.FixedSizeListArray.from_arrays(pa.array(f.ravel()), SIDE).cast(pa.list_(pa.int64()))
        return pa.table({"band": at // SLAB, "r": r + slab * SLAB, "g": at, "best": best})

    return run


def _along_r(bound: int):
    """All planes of a band along g: the least over r, as a row for each cell."""

    def run(table: pa.Table) -> pa.Table:
        band = table.column("band")[0].as_py()
        r, g = (table.column(c).to_numpy() for c in ("r", "g"))
        f = np.empty((SLAB, SIDE, SIDE), np.int64)  # g, b, r
        f[g - band * SLAB, :, r] = table.column("best").combine_chunks().flatten().to_numpy().reshape(-1, SIDE)
        best = lower_envelope(f.reshape(-1, SIDE), bound).ravel()
        g, b, r = np.indices(f.shape, np.int32)
        code = (r << 16) + ((g + band * SLAB) << 8) + b
        return pa.table({"code": code.ravel(), "d2": best // bound, "rank": best % bound})

    return run


def full_cube(candidates: DataFrame, rank: str, rank_bound: int | None = None) -> DataFrame:
    """(code, d2, rank) of all 2^24 cells, each with its nearest candidate, ties to the smaller rank.

    Distance and rank are one integer, of which lower envelopes are taken along b and g in slabs of planes, and then along r; the
    planes move once, as a row for each line of 256 cells. Without candidates the distance is past any.

    ``rank_bound`` is over all ranks, and is read off them if not given. A given one is the price of a step of distance: where
    ranks reach it, the least of ``d2 * rank_bound + rank`` is found all the same, and divided by it into ``d2`` and ``rank``."""
    spark = candidates.sparkSession
    low, high = candidates.agg(F.min(rank), F.max(rank)).first()
    most = int(high or 0)
    rank_bound = rank_bound or most + 1
    if low is not None and low < 0:
        raise ValueError(f"ranks begin at {low}, below 0")
    if PAST * rank_bound + most >= 1 << 62:
        raise ValueError(f"ranks up to {most} and distances do not fit one integer")
    far = PAST * rank_bound + most
    seeds = candidates.groupBy(rgb_pack(F.col("r"), F.col("g"), F.col("b")).cast("long").alias("code")).agg(F.min(rank).cast("long").alias("best"))
    slabs = spark.range(SIDE // SLAB).select(F.col("id").alias("slab"))
    both = seeds.select(F.floor(F.col("code") / (SLAB * SIDE * SIDE)).cast("long").alias("slab"), "code", "best").unionByName(slabs, allowMissingColumns=True)
    planes = both.groupBy("slab").applyInArrow(_planes(far, rank_bound), "band long, r long, g long, best array<bigint>")
    return planes.groupBy("band").applyInArrow(_along_r(rank_bound), "code int, d2 long, rank long")


def candidate_rows(df: DataFrame) -> Column:
    """The fixed order of a compact candidate row."""
    from ledgerloom.functions.scalars import compact_row

    return compact_row(kind_code(F.col("kind")), *[F.col(c) for c in ("type", "variant", "paint", "r", "g", "b", "stable")])
