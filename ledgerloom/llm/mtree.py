"""Exact top-k by inner product, through M-trees.

Vectors go to the region of their nearest routing object; regions that are large are
cut into slices, and each slice is an M-tree of its own, built once and kept in a
shared table: pages of entries, each entry with its covering radius, the greatest norm
below it and its distance to the page's parent. A query first searches a slice of its
nearest region, which bounds what can still matter; after that it goes only to regions
whose covering radius allows a better score. Batches of queries meet a tree together:
each query descends to its nearest leaf, then pages are taken best first, each once,
for those queries that it can still help. An entry whose stored parent distance proves
by the triangle inequality that it is too far is skipped before its distance is
computed. From a least distance d and norms |q| and t follows q.x <= (q^2 + t^2 - d^2) / 2.

Bounds are floating point with slack; results are exact integers. Equal vectors are
one entry that carries its ``k + 1`` smallest ids, which is all that a result can show.

Defined results: vectors that are null or hold null or non-finite components
take no part, and neither do null ids; an empty vector table or query set gives an
empty result; vectors meet only those of their own dimension, which may be 0; rows that share an id
are each a candidate and each a query, which leaves out itself alone; a score beyond 64
bits is ranked exactly and shown as the nearest long; further columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import save
from ledgerloom.llm.words import starts_of

PAGE, FAN = 128, 24
#: Routing objects that deal vectors to regions: at most so many, so that they can be broadcast.
ROUTING = 512


def _exponent(x: np.ndarray) -> int:
    return int(np.frexp(np.abs(x).max(initial=0.0))[1])


def exact_score(a: np.ndarray, b: np.ndarray, scale: int) -> int:
    """Inner product of vectors that hold multiples of 1 / ``scale``, in units of 1 / ``scale`` squared."""

    def whole(v: float) -> int:
        n, d = float(v).as_integer_ratio()
        return n * scale // d

    return sum(whole(x) * whole(y) for x, y in zip(a, b, strict=True))


class MTree:
    """Pages of entries over vectors of one dimension, which hold multiples of 1 / ``scale``."""

    def __init__(self, x: np.ndarray, scale: int = 1):
        self.raw, self.scale, self.computed = x, scale, 0
        self.exponent = _exponent(x)
        self.x = np.ldexp(x, -self.exponent)
        self.norm = np.sqrt((self.x**2).sum(1))
        pages: list[tuple] = []
        self._pages, self._random = pages, np.random.default_rng(11)
        self.root = self._build(np.arange(len(x)), 0)
        del self._pages, self._random
        size = starts_of(np.array([len(p[0]) for p in pages], np.int64))
        self.start = size
        self.entry, self.parent, self.radius, self.top, self.child = (np.concatenate([p[i] for p in pages]) for i in range(5))

    def _between(self, a: np.ndarray, b: int) -> np.ndarray:
        return np.sqrt(((self.x[a] - self.x[b]) ** 2).sum(1))

    def _build(self, at: np.ndarray, pivot: int) -> int:
        """The page over ``at`` whose parent is ``pivot``; pages are numbered from the leaves up."""
        pages = self._pages
        if len(at) <= PAGE:
            pages.append((at, self._between(at, pivot), np.zeros(len(at)), self.norm[at], np.full(len(at), -1)))
            return len(pages) - 1
        pivots = self._random.choice(at, FAN, replace=False)
        near = np.stack([self._between(at, p) for p in pivots])
        of = near.argmin(0)
        if np.bincount(of).max() > 0.9 * len(at):  # too even a distance: cut by distance to the first pivot
            rank = np.argsort(near[0], kind="stable")
            of = np.empty(len(at), np.int64)
            of[rank] = np.arange(len(at)) * FAN // len(at)
            pivots = np.array([at[of == i][0] for i in range(FAN)])
            near = np.stack([self._between(at, p) for p in pivots])
        used = [i for i in range(FAN) if (of == i).any()]
        groups, pivots = [at[of == i] for i in used], pivots[used]
        radius = np.array([near[i][of == i].max() for i in used])
        child = [self._build(g, p) for g, p in zip(groups, pivots, strict=True)]
        pages.append((pivots, self._between(pivots, pivot), radius, np.array([self.norm[g].max() for g in groups]), np.array(child)))
        return len(pages) - 1

    def search(self, q: np.ndarray, k: int, ids: list[list[int]], own: list[int | None], least: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
        """For each row of ``q`` its ``k`` best (-score, id), larger scores and then smaller ids first.

        ``own[i]`` is an id of which one row, with the query's very vector, is left out. Of scores under ``least[i]`` nothing needs to be found."""
        n = len(q)
        best: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        if not n or not len(self.x):
            return best
        far = _exponent(q)
        unit = np.ldexp(float(self.scale) ** 2, min(1000, self.exponent + far))
        y = np.ldexp(q, -far)
        norm = np.sqrt((y**2).sum(1))
        slack = 1e-9 * (1.0 + norm) ** 2
        whole = (norm.max() + 1e-9) * (self.norm.max() + 1e-9) * unit < 2.0**52  # then products are exact as they are
        ranged = self.exponent + far <= 900  # else no floor is kept, as scores may not fit a double
        floor = np.full(n, -np.inf) if least is None or not ranged else least / unit - 1e-9 * np.abs(least / unit)
        pages = len(self.start) - 1
        upper, dist = np.full((pages, n), -np.inf), np.zeros((pages, n))
        seen = np.zeros((pages, n), bool)
        upper[self.root] = np.inf
        # The root page's parent is the tree's first vector.
        dist[self.root] = np.sqrt(np.maximum(0, norm**2 + self.norm[0] ** 2 - 2 * (y @ self.x[0])))
        self.computed += n

        def visit(page: int, who: np.ndarray) -> None:
            seen[page, who] = True
            a, b = self.start[page], self.start[page + 1]
            entry, radius, top = self.entry[a:b], self.radius[a:b], self.top[a:b]
            gap = np.maximum(0, np.abs(dist[page, who][:, None] - self.parent[a:b]) - radius - 1e-9)
            may = (norm[who, None] ** 2 + top**2 - gap**2) / 2 >= (floor - slack)[who, None]
            if not may.any():
                return
            cols = np.flatnonzero(may.any(0))
            rows = np.flatnonzero(may.any(1))
            entry, who, may = entry[cols], who[rows], may[np.ix_(rows, cols)]
            self.computed += int(may.sum())
            if may.mean() > 0.2:
                s = y[who] @ self.x[entry].T
            else:
                s = np.full(may.shape, -np.inf)
                i, j = np.nonzero(may)
                s[i, j] = np.einsum("ij,ij->i", y[who[i]], self.x[entry[j]])
            if self.child[a] < 0:
                low = (floor - slack)[who]
                if len(entry) > k + 1:  # of a page at most the k + 1 best matter, and ties with them
                    low = np.maximum(low, np.partition(s, -(k + 1), axis=1)[:, -(k + 1)] - slack[who])
                i, j = np.nonzero((s >= low[:, None]) & may)
                for w, e, f in zip(who[i].tolist(), entry[j].tolist(), s[i, j].tolist(), strict=True):
                    score = round(f * unit) if whole else exact_score(q[w], self.raw[e], self.scale)
                    mine, skip = best[w], own[w]
                    if skip is not None and not np.array_equal(q[w], self.raw[e]):
                        skip = None
                    for d in ids[e]:
                        if d == skip:
                            skip = None
                            continue
                        if len(mine) == k and (-score, d) >= mine[-1]:
                            break
                        bisect.insort(mine, (-score, d))
                        del mine[k:]
                    if len(mine) == k and ranged:
                        floor[w] = max(floor[w], float(-mine[-1][0]) / unit)
            else:
                square = norm[who, None] ** 2
                d = np.sqrt(np.maximum(0, square + self.norm[entry] ** 2 - 2 * s))
                r = radius[cols]
                bound = np.minimum((square + top[cols] ** 2 - np.maximum(0, d - r - 1e-9) ** 2) / 2, s + norm[who, None] * r + slack[who, None])
                child = self.child[a:b][cols]
                upper[child[:, None], who] = np.where(may, bound, -np.inf).T
                dist[child[:, None], who] = np.where(may, d, 0).T

        # Each query's own descent to its nearest leaf gives a first floor.
        page = np.full(n, self.root)
        while True:
            for p in np.unique(page).tolist():
                who = np.flatnonzero((page == p) & ~seen[p])
                if len(who):
                    visit(p, who)
            inner = np.flatnonzero(self.child[self.start[page]] >= 0)
            if not len(inner):
                break
            for p in np.unique(page[inner]).tolist():
                who = inner[page[inner] == p]
                child = self.child[self.start[p] : self.start[p + 1]]
                near = np.where(np.isfinite(upper[child[:, None], who]), dist[child[:, None], who], np.inf)
                page[who] = child[near.argmin(0)]
        # Then pages best first: the page with the greatest bound of any query that waits for it.
        wait = [(-float(upper[self.root].max()), self.root)]
        while wait:
            _, p = heapq.heappop(wait)
            who = np.flatnonzero((upper[p] >= floor - slack) & ~seen[p])
            if len(who):
                visit(p, who)
            if self.child[self.start[p]] >= 0 and seen[p].any():
                for c in self.child[self.start[p] : self.start[p + 1]].tolist():
                    u = np.where(upper[c] >= floor - slack, upper[c], -np.inf).max()
                    if u > -np.inf:
                        heapq.heappush(wait, (-float(u), c))
        return best


def quantized(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, dim, v (little-endian doubles floor(scale * x) / scale) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("embedding")
            x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            length = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0), dtype=np.int64)
            first = starts_of(length)
            bad = starts_of((~np.isfinite(x)).astype(np.int64))
            keep = np.flatnonzero(np.asarray(col.is_valid()) & (bad[first[1:]] == bad[first[:-1]]) & np.asarray(b.column("vec_id").is_valid()))
            small = np.abs(x) < 2.0**52  # a larger number is whole already
            v = np.where(small, np.floor(scale * np.where(small, x, 0)) / scale, x).astype("<f8") + 0.0
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(keep)), pa.array(length[keep], pa.int32()), pa.array([v[first[i] : first[i + 1]].tobytes() for i in keep], pa.binary())], ["vec_id", "dim", "v"]
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, dim int, v binary")


def _few_ids(k: int):
    """Within a task, of each distinct vector the smallest ids only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[bytes, list[int]] = {}
            for d, v in zip(*(b.column(c).to_pylist() for c in ("vec_id", "v")), strict=True):
                known.setdefault(v, []).append(d)
            few = [sorted(x)[: k + 1] for x in known.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.binary()), pa.array(few, pa.list_(pa.int64()))], ["v", "ids"])

    return run


def _stacked(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension in a batch."""
    vs = column.to_pylist()
    size = np.fromiter(map(len, vs), np.int64, len(vs))
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, np.frombuffer(b"".join(vs[i] for i in at), "<f8").reshape(len(at), n // 8)


def _routing(rows: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension, the numbers and vectors of the routing objects."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at, x in _stacked(pa.array(rows, pa.binary())):
        out[x.shape[1]] = at, x
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    e = max(_exponent(x), _exponent(pivots))
    a, b = np.ldexp(x, -e), np.ldexp(pivots, -e)
    with np.errstate(over="ignore"):
        return np.ldexp(np.sqrt(np.maximum(0, (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * (a @ b.T))), e)


def _norms(x: np.ndarray) -> np.ndarray:
    return _distances(x, np.zeros((1, x.shape[1])))[:, 0]


def _dealt(routing):
    """Each vector's region (that of its nearest routing object; -1 where its dimension has none), distance to it and norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = routing.value
        for b in batches:
            dim, region, dist, norm = np.zeros(b.num_rows, np.int32), np.full(b.num_rows, -1, np.int32), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for at, x in _stacked(b.column("v")):
                dim[at], norm[at] = x.shape[1], _norms(x)
                if x.shape[1] in known:
                    number, pivots = known[x.shape[1]]
                    d = _distances(x, pivots)
                    near = d.argmin(1)
                    region[at], dist[at] = number[near], d[np.arange(len(at)), near]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dim), pa.array(region), pa.array(dist), pa.array(norm)], [*b.schema.names, "dim", "region", "dist", "norm"])

    return run


def _build_trees(scale: int):
    def run(table: pa.Table) -> pa.Table:
        vs = table.column("v").to_pylist()
        tree = MTree(np.frombuffer(b"".join(vs), "<f8").reshape(len(vs), len(vs[0]) // 8), scale)
        key = [table.column(c)[0].as_py() for c in ("dim", "region", "slice")]
        return pa.table([pa.array([x], t) for x, t in zip(key, (pa.int32(), pa.int32(), pa.int32()), strict=True)] + [pa.array([pickle.dumps((tree, table.column("ids").to_pylist()), 5)], pa.binary())], ["dim", "region", "slice", "tree"])

    return run


def _open_regions(routing, regions, k: int):
    """The regions in which a query can still find a better score than its ``low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, stats = routing.value, regions.value
        for b in batches:
            row, region = [np.arange(b.num_rows)], [np.full(b.num_rows, -1)]
            low = b.column("low").to_numpy(zero_copy_only=False).astype(float)
            low = np.where(np.isnan(low), -np.inf, low)
            for at, x in _stacked(b.column("v")):
                if x.shape[1] in known:
                    number, pivots = known[x.shape[1]]
                    radius, top = (np.array([stats.get(int(i), (0.0, -1.0))[j] for i in number]) for j in (0, 1))
                    d, norm = _distances(x, pivots), _norms(x)[:, None]
                    with np.errstate(over="ignore", invalid="ignore"):
                        size = norm**2 + top**2
                        upper = (size - np.maximum(0, d - radius) ** 2) / 2 + 1e-6 * size
                        i, j = np.nonzero(((upper >= low[at][:, None]) | ~np.isfinite(upper)) & (top >= 0))
                    row.append(at[i])
                    region.append(number[j])
            at = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in _QUERY], pa.array(np.concatenate(region), pa.int32())], [*_QUERY, "region"])

    return run


_QUERY = ["qid", "query_id", "m", "dim", "v", "low", "near", "mine"]
_LONGEST = 1 << 63


def _shown(score: int) -> tuple[int, str]:
    """A score as a long, and what ranks those beyond 64 bits (larger first)."""
    if -_LONGEST <= score < _LONGEST:
        return score, ""
    digits = str(abs(score))
    if score > 0:
        return _LONGEST - 1, f"{len(digits):05d}{digits}"
    return -_LONGEST, f"{99999 - len(digits):05d}" + "".join(str(9 - int(c)) for c in digits)


def _meet(k: int, scale: int):
    def run(trees: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["qid", "query_id", "m", "vec_id", "score", "beyond"]
        out: list[list] = [[] for _ in names]
        if trees.num_rows and asked.num_rows:
            tree, ids = pickle.loads(trees.column("tree")[0].as_py())
            for a in range(0, asked.num_rows, 2048):
                part = asked.slice(a, 2048)
                qid, own, m, low = (part.column(c).to_pylist() for c in ("qid", "query_id", "m", "low"))
                q = np.frombuffer(b"".join(part.column("v").to_pylist()), "<f8").reshape(len(qid), tree.x.shape[1])
                least = np.array([-np.inf if x is None else x for x in low]) * float(scale) ** 2
                for i, found in enumerate(tree.search(q, k, ids, own, least)):
                    for s, d in found:
                        for o, v in zip(out, (qid[i], own[i], m[i], d, *_shown(-s)), strict=True):
                            o.append(v)
        return pa.table([*[pa.array(o, pa.int64()) for o in out[:-1]], pa.array(out[-1], pa.string())], names)

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, part_rows: int = 16384, query_rows: int = 8192, routing: int = ROUTING) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of each row whose id is divisible by ``every``."""
    sc = vectors.sparkSession.sparkContext
    rows = quantized(vectors, scale)
    few = rows.mapInArrow(_few_ids(k), "v binary, ids array<long>").groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    n = max(1, min(routing, -(-vectors.count() // part_rows)))
    # The routing objects are the vectors with the smallest hashes; their number is bounded by ``routing``.
    objects = sc.broadcast(_routing([bytes(r.v) for r in rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(n).collect()]))
    dealt = save(few.mapInArrow(_dealt(objects), "v binary, ids array<long>, dim int, region int, dist double, norm double"), "dealt")
    totals = dealt.groupBy("dim", "region").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("slices"), F.max("dist").alias("radius"), F.max("norm").alias("top"))
    totals = save(totals, "regions")
    regions = sc.broadcast({r.region: (r.radius, r.top) for r in totals.filter("region >= 0").collect()})
    cut = dealt.select("dim", "region", "v", "ids").join(totals.select("dim", "region", "slices"), ["dim", "region"]).withColumn("slice", F.pmod(F.xxhash64("v"), F.col("slices")).cast("int"))
    trees = save(cut.select("dim", "region", "slice", "v", "ids").groupBy("dim", "region", "slice").applyInArrow(_build_trees(scale), "dim int, region int, slice int, tree binary"), "trees")

    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.count("*").alias("m"))
    queries = queries.select(F.col("vec_id").alias("query_id"), "m", "v").mapInArrow(_dealt(objects), "query_id long, m long, v binary, dim int, region int, dist double, norm double")
    queries = save(queries.select(F.monotonically_increasing_id().alias("qid"), "query_id", "m", "v", "dim", F.col("region").alias("near")), "queries")
    groups = max(1, -(-queries.count() // query_rows))

    def meet(asks: DataFrame) -> DataFrame:
        """Query batches of bounded size meet the trees that they ask; a tree is brought once a batch, and never built again."""
        asks = asks.withColumn("group", F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int"))
        key = ["dim", "region", "slice", "group"]
        wanted = asks.select(*[F.col(c).alias(f"w_{c}") for c in key]).distinct().join(trees, [F.col(f"w_{c}") == trees[c] for c in key[:3]])
        return wanted.select(*[f"w_{c}" for c in key], "tree").groupBy(*[f"w_{c}" for c in key]).cogroup(asks.groupBy(*key)).applyInArrow(_meet(k, scale), "qid long, query_id long, m long, vec_id long, score long, beyond string")

    places = totals.select("dim", "region", "slices")
    first = queries.withColumn("region", F.col("near")).join(places, ["dim", "region"]).withColumn("slice", F.pmod(F.xxhash64("qid"), F.col("slices")).cast("int"))
    near = save(meet(first.withColumn("low", F.lit(None).cast("double"))), "near")
    lows = near.groupBy("qid").agg(F.when((F.count("*") == k) & (F.min("score") > -_LONGEST), F.min("score").cast("double") / float(scale) ** 2).alias("low"))
    known = first.select("qid", "query_id", "m", "dim", "v", "near", F.col("slice").alias("mine")).join(lows, "qid", "left").select(*_QUERY)
    schema = "qid long, query_id long, m long, dim int, v binary, low double, near int, mine int, region int"
    more = known.mapInArrow(_open_regions(objects, regions, k), schema).join(places, ["dim", "region"])
    more = more.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).filter("NOT (region = near AND slice = mine)")
    found = near.unionByName(meet(more))
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).select("query_id", "rank", "vec_id", "score")
