"""MinHash near-duplicate classes.

Texts become sets of word shingles. Equal sets form one class at once, by a digest
of the whole set; classes then carry many universal hash minima. Bands of minima
give buckets; each bucket links its members to its smallest one, a byte of each
minimum verifies a pair, whole sets confirm it, and components are found by
alternating large-star and small-star. Members of a bucket that are still in
different components after that are compared with each other, in blocks, to which
their sets are brought; a pair is judged in the first bucket that it shares. So no
link inside a bucket is lost, and no group's pairs are ever written out.

Defined results: a null or wordless text has an empty set and is linked with
nothing; a null ``doc_id`` is kept and linked with nothing; rows that share a
``doc_id`` are judged each by its own text (two texts of the smallest id of a class
are then both kept, as ``kept`` speaks of ids); an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import save
from ledgerloom.llm.words import U64, hash_words, mix, slices, starts_of, texts_of
from ledgerloom.operators.windows import global_position

BANDS, ROWS = 32, 5
#: Of BANDS * ROWS minima, so many at least agree in their lowest byte; pairs at 0.8 fall below with chance 1e-6.
AGREE = 104
#: Members of a block, and shingles (8 bytes each) that its members hold together, about.
BLOCK, BLOCK_ITEMS = 1024, 1 << 22
BROADCAST_ROWS = 1_000_000


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer than ``k`` words make one shingle."""
    words = [t.lower().split() for t in texts]
    at = starts_of(np.fromiter(map(len, words), np.int64, len(words)))
    h = mix(hash_words([w for ws in words for w in ws])) if at[-1] else np.zeros(0, U64)
    n = max(0, len(h) - k + 1)
    rolled = np.zeros(n, U64)
    for i in range(k):
        rolled = mix(rolled + h[i : i + n]) + U64(i)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            v = np.full(1, b - a, U64)
            for i in range(a, b):
                v = mix(v + h[i : i + 1]) + U64(77)
            out.append(v)
        else:
            out.append(np.zeros(0, U64))
    return out


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(0, 2**63, n, dtype=np.int64).astype(U64) * U64(2) + U64(1), r.integers(0, 2**63, n, dtype=np.int64).astype(U64)


def minima(sets: list[np.ndarray], n_hash: int) -> np.ndarray:
    """Minima of ``n_hash`` universal hashes (multiply-add modulo 2^64, upper bits) of each non-empty set."""
    a, b = _constants(n_hash)
    out = np.zeros((len(sets), n_hash), U64)
    lo = 0
    while lo < len(sets):
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 32768):
            size += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        at = starts_of(np.fromiter(map(len, sets[lo:hi]), np.int64, hi - lo))[:-1]
        y = np.empty_like(x)
        for i in range(n_hash):
            np.multiply(x, a[i], out=y)
            y += b[i]
            out[lo:hi, i] = np.minimum.reduceat(y, at)
        lo = hi
    return out >> U64(16)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, digest of the set, band keys, one byte of each minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, BANDS + 1, dtype=U64))
        for whole in batches:
            for b in slices(whole, "text"):
                sets = shingle_sets(texts_of(b.column("text")), k)
                full = [i for i, s in enumerate(sets) if len(s)]
                m = minima([sets[i] for i in full], BANDS * ROWS)
                keys = np.zeros((len(full), BANDS), U64) + salt
                for r in range(ROWS):
                    keys = mix(keys ^ m[:, r::ROWS])
                low = (mix(m) & U64(255)).astype(np.uint8).view(np.int8)
                digest, bands, bytes_ = [None] * b.num_rows, [None] * b.num_rows, [None] * b.num_rows
                for j, i in enumerate(full):
                    digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    bands[i], bytes_[i] = keys[j].view(np.int64), low[j]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.list_(pa.int8()))],
                    ["doc_id", "n", "digest", "bands", "low"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, bands array<long>, low array<tinyint>")


def sets_of(docs: DataFrame, ids: DataFrame, few: bool, k: int) -> DataFrame:
    """(node, items) for the documents in ``ids``, which are broadcast only if they are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                sets = shingle_sets(texts_of(b.column("text")), k)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"])

    ids = ids.withColumnRenamed("node", "doc_id")
    found = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    return found.mapInArrow(run, "node long, items array<long>")


def confirm(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (u, v), of a written table, whose whole sets reach the similarity."""
    ids = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    sets = save(sets_of(docs, ids, 2 * pairs.count() <= BROADCAST_ROWS, k), "sets")
    both = pairs.select("u", "v").join(sets.select(F.col("node").alias("v"), F.col("items").alias("vs")), "v")
    both = both.join(sets.select(F.col("node").alias("u"), F.col("items").alias("us")), "u")
    same = F.size(F.array_intersect("us", "vs"))
    return both.filter(100 * same >= percent * (F.size("us") + F.size("vs") - same)).select("u", "v")


def _are_stars(e: DataFrame) -> bool:
    """Whether each node with a smaller neighbour has one only, which has none itself."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up > 0 AND down > 0)").limit(1).count()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge but the roots, by alternating large-star and small-star until all are stars."""
    e = save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(rounds):
        if _are_stars(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = save(small.distinct(), "edges")
    raise RuntimeError("components did not settle")


def _in_blocks(rest: DataFrame) -> DataFrame:
    """Slots cut a bucket of m members into blocks of bounded members and shingles; each pair of blocks is a unit of work of its own."""
    rest = rest.withColumn("slots", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("items") / BLOCK_ITEMS)).cast("int")).withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    rest = rest.select("key", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "node", "n", "root", "bands", "low")
    return _together(rest)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


_MEMBER = "key long, i int, j int, slot int, node long, n long, root long, bands array<long>, low array<tinyint>"
_NAMES = [x.split()[0] for x in _MEMBER.split(", ")]


def _matrix(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).flatten().to_numpy().reshape(b.num_rows, -1)


def _groups(batches: Iterator[pa.RecordBatch], items: bool) -> Iterator[list[tuple]]:
    """Runs of rows with one (key, i, j); at most two blocks each."""
    held: list[tuple] = []
    for b in batches:
        cols = [b.column(c).to_pylist() for c in _NAMES[:-2]]
        extra = [_matrix(b, "bands"), _matrix(b, "low")]
        if items:
            at = np.concatenate(([0], np.cumsum(b.column("items").value_lengths().to_numpy(zero_copy_only=False))))
            flat = b.column("items").flatten().to_numpy()
            extra.append([flat[x:y] for x, y in zip(at[:-1], at[1:], strict=True)])
        for row in zip(*cols, *extra, strict=True):
            if held and row[:3] != held[0][:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _candidates(rows: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a group that this group has to judge, best first: in different components, near enough by size and bytes, and
    with this bucket as the first that they share. Members of slot i meet those of slot j."""
    key, i, j = rows[0][:3]
    slot, n, root = (np.array([r[c] for r in rows]) for c in (3, 5, 6))
    bands, low = np.stack([r[7] for r in rows]), np.stack([r[8] for r in rows])
    side = np.flatnonzero(slot == j)
    us, vs, scores = [], [], []
    for x in np.flatnonzero(slot == i):
        ys = side[(root[side] != root[x]) & (100 * np.minimum(n[side], n[x]) >= percent * np.maximum(n[side], n[x]))]
        if i == j:
            ys = ys[ys > x]
        if len(ys):
            same = (low[ys] == low[x]).sum(1)
            ys, same = ys[same >= AGREE], same[same >= AGREE]
        if len(ys):
            mine = bands[x][(bands[ys] == bands[x]).argmax(1)] == key
            us.append(np.full(mine.sum(), x))
            vs.append(ys[mine])
            scores.append(same[mine])
    if not us:
        none = np.zeros(0, np.int64)
        return none, none, none
    u, v, score = np.concatenate(us), np.concatenate(vs), np.concatenate(scores)
    order = np.argsort(-score, kind="stable")
    return u[order], v[order], score[order]


def _with_candidates(percent: int):
    """The rows of groups that have candidate pairs, without the members that are in none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, False):
            if len(rows) > 1:
                u, v, _ = _candidates(rows, percent)
                if len(u):
                    cols = list(zip(*[rows[x] for x in np.union1d(u, v)], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(c, t) for c, t in zip(cols[:7], [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], pa.array(cols[7], pa.list_(pa.int64())), pa.array(cols[8], pa.list_(pa.int8()))],
                        _NAMES,
                    )

    return run


def _links_in_groups(percent: int):
    """Links confirmed on whole sets; a pair that earlier links of the group already join needs no look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, True):
            us, vs, above = [], [], {}

            def top(x: int) -> int:
                while above.get(x, x) != x:
                    x = above[x]
                return x

            for x, y in zip(*(z.tolist() for z in _candidates(rows, percent)[:2]), strict=True):
                a, b = top(rows[x][6]), top(rows[y][6])
                if a == b:
                    continue
                p, q = rows[x][9], rows[y][9]
                same = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * same >= percent * (len(p) + len(q) - same):
                    above[max(a, b)] = min(a, b)
                    us.append(rows[x][4])
                    vs.append(rows[y][4])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def _numbered(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """Where an id stands for more than one text, numbers in the order of the ids take its place, so that each text is a node."""
    sha = F.coalesce(F.sha2("text", 256), F.lit(""))
    docs = docs.withColumn("sha", sha)
    known = save(global_position(docs.filter("doc_id IS NOT NULL").select("doc_id", "sha").distinct(), ["doc_id", "sha"], "number"), "numbers")
    rows = save(docs.join(known, ["doc_id", "sha"], "left").select(F.col("number").alias("doc_id"), "text"), "numbered")
    found = near_duplicates(rows, shingle_words, percent).withColumnRenamed("doc_id", "number")
    found = found.join(known.select("number", "doc_id"), "number", "left").join(known.select(F.col("number").alias("component_id"), F.col("doc_id").alias("root")), "component_id", "left")
    return found.select("doc_id", "n_shingles", F.col("root").alias("component_id"), F.col("root").eqNullSafe(F.col("doc_id")).alias("kept"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sig = save(signatures(docs, shingle_words), "signatures")
    full = sig.filter("n > 0 AND doc_id IS NOT NULL")
    # All rows of a class hold the same n, bands and bytes, so any row's will do.
    classes = save(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("low").alias("low")), "classes")
    if classes.groupBy("node").count().filter("count > 1").limit(1).count():
        return _numbered(docs, shingle_words, percent)
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("items"), F.min(F.struct("node", "n")).alias("hub")).filter("m > 1")
    hubs = save(hubs.select("key", "m", "items", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    rows = save(keyed.join(hubs, "key"), "buckets")

    near = rows.filter("node <> hub").filter(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    pairs = near.select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    low = classes.select("node", "low")
    pairs = pairs.join(low.withColumnsRenamed({"node": "u", "low": "lu"}), "u").join(low.withColumnsRenamed({"node": "v", "low": "lv"}), "v")
    agree = F.aggregate(F.zip_with("lu", "lv", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    star = save(pairs.filter(agree >= AGREE).select("u", "v"), "pairs")
    links = save(confirm(star, docs, shingle_words, percent), "links")
    roots = components(links)

    # What buckets hold in different components still is judged in blocks.
    rooted = rows.select("key", "m", "items", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    rest = rooted.join(mixed, "key", "left_semi").join(classes.select("node", "bands", "low"), "node")
    rest = save(_in_blocks(rest).mapInArrow(_with_candidates(percent), _MEMBER), "members")
    ids = rest.select("node").distinct()
    sets = sets_of(docs, ids, rest.count() <= BROADCAST_ROWS, shingle_words)
    more = _together(rest.join(sets, "node").select(*_NAMES, "items")).mapInArrow(_links_in_groups(percent), "u long, v long")
    more = save(more, "more_links")
    if more.limit(1).count():
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    placed = classes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component_id"))
    out = sig.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    # Rows without a set join nothing; they are kept apart so that they do not meet in one task.
    full = out.filter("digest IS NOT NULL").join(placed, "digest").select("doc_id", "n_shingles", "component_id")
    out = full.unionByName(out.filter("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
