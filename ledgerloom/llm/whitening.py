"""Whitening of embeddings by polarisation: covariances from variances alone.

For every dimension and every pair's sum the exact squares of centred integers are
added up; half of what a sum's square has over those of its two parts is the pair's
covariance. Three passes over the rows give sums, squares, and the check that the
whitened components have the identity as covariance; each task sends one row for each
dimension or pair. Only those sums, whose number follows the dimensions and not the
rows, come to the driver, which assembles the matrix and takes its eigenvectors.

Values are centred before they are multiplied: task by task by the whole number
nearest the mean, and exactly by what is left of the mean, r = S - n*m, as the sum of
(n*z - r)^2 is n^2 * sum(z^2) - n * r^2 where z = x - m. Squares are kept as whole
numbers of any size (21-bit limbs in tasks, two decimal halves between them).

Defined results: vectors that are null, empty or hold a null or non-finite entry take
no part, nor do those with an entry of 2^50 or more, which has no long value; of
several lengths, the one that most vectors have is used (ties: the longer). A null
vec_id stays null; repeated rows count, and are returned, each; further columns are
ignored; an empty table gives no rows. Components number at most the dimensions; one
without variance cannot be scaled: its ``whitened`` is null, and ``identity_error`` is
that of the others, null if there are none. A ``deviation`` past 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import save

SCALE, SHIFT = 1024, 100_000
#: Entries below it have an ``x`` whose pair sums fit a long.
LARGEST = float(1 << 50)
#: Rows whose squares are added at once, and bits of a limb: their sums stay below 2^63.
ROWS, LIMB = 4096, 21
HALF = 10**18


class Fit(NamedTuple):
    """Rows, centre and remainder of each dimension, covariance of ``x``, and its eigenvalues (falling) and unit vectors (columns)."""

    n: int
    centre: np.ndarray
    rest: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


def usable(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and vector as doubles, of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    return rows.select(F.col(key).cast("long").alias("key"), v.alias("v")).filter((F.size("v") > 0) & F.forall("v", lambda x: F.abs(x) < LARGEST))


def whole_numbers(column: pa.Array, size: int) -> np.ndarray:
    """``x`` of vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def square_sums(s: np.ndarray) -> np.ndarray:
    """Exact sums of squares of each column of at most ``ROWS`` rows, as whole numbers of any size."""
    add = lambda a, b: np.einsum("ij,ij->j", a, b).astype(object)
    if np.abs(s).max(initial=0) < 1 << LIMB:
        return add(s, s)
    low, middle, high = s & ((1 << LIMB) - 1), (s >> LIMB) & ((1 << LIMB) - 1), s >> (2 * LIMB)
    parts = [add(low, low), 2 * add(low, middle), 2 * add(low, high) + add(middle, middle), 2 * add(middle, high), add(high, high)]
    return sum(p << (LIMB * k) for k, p in enumerate(parts))


def _rows(columns: list, totals: list[int], names: list[str]) -> pa.RecordBatch:
    """Whole numbers in two halves beside their keys."""
    halves = [divmod(int(t), HALF) for t in totals]
    numbers = [pa.array([Decimal(h[k]) for h in halves], pa.decimal128(38, 0)) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], *numbers], [*names, "high", "low"])


_HALVES = "high decimal(38,0), low decimal(38,0)"


def _summed(df: DataFrame, keys: list[str], *more) -> DataFrame:
    return df.groupBy(*keys).agg(*more, F.sum("high").alias("high"), F.sum("low").alias("low"))


def _number(row) -> int:
    return int(row.high) * HALF + int(row.low)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for b in batches:
        lengths = np.asarray(pc.list_value_length(b.column("v")))
        for size in np.unique(lengths).tolist():
            x = whole_numbers(b.column("v").filter(pa.array(lengths == size)), size)
            n, s = total.get(size, (0, 0))
            for at in range(0, len(x), ROWS):
                part = x[at : at + ROWS]
                s = s + ((part >> 31).sum(0).astype(object) << 31) + (part & ((1 << 31) - 1)).sum(0).astype(object)
            total[size] = [n + len(x), s]
    for size, (n, s) in total.items():
        yield _rows([[size] * size, range(size), [n] * size], list(s), ["size", "dim", "n"])


def _squares(size: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(size - i, dtype=object) for i in range(size)]
        for b in batches:
            z = whole_numbers(b.column("v"), size) - centre
            for at in range(0, len(z), ROWS):
                part = z[at : at + ROWS]
                for i in range(size):
                    s = part[:, i:].copy()
                    s[:, 1:] += part[:, i : i + 1]
                    total[i] = total[i] + square_sums(s)
        for i in range(size):
            yield _rows([[i] * (size - i), range(i, size)], list(total[i]), ["i", "j"])

    return run


def fit(vectors: DataFrame) -> Fit | None:
    """Covariance and eigenvectors of what ``usable`` gives; None if there are no vectors."""
    sums = save(_summed(vectors.mapInArrow(_sums, f"size long, dim long, n long, {_HALVES}"), ["size", "dim"], F.sum("n").alias("n")), "sums")
    most = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    n, size = most.n, most.size
    total = [_number(r) for r in sums.filter(F.col("size") == size).orderBy("dim").collect()]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    rest = [s - n * int(m) for s, m in zip(total, centre, strict=True)]
    pairs = _summed(vectors.filter(F.size("v") == size).mapInArrow(_squares(size, centre), f"i long, j long, {_HALVES}"), ["i", "j"])
    found = {(r.i, r.j): _number(r) for r in pairs.collect()}
    covariance = np.zeros((size, size))
    # n^3 times a variance: of a dimension (i, i), or of the sum of two dimensions.
    exact = {(i, j): n * n * q - n * (rest[i] + (rest[j] if j > i else 0)) ** 2 for (i, j), q in found.items()}
    for (i, j), q in exact.items():
        top, below = (2 * q, 2 * n**3) if i == j else (q - exact[i, i] - exact[j, j], 2 * n**3)
        covariance[i, j] = covariance[j, i] = top / below
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    sign = np.sign(vectors_[np.abs(vectors_).argmax(0), np.arange(size)])
    return Fit(n, centre, rest, covariance, values, vectors_ * sign)


def _projected(f: Fit, z: np.ndarray, used: int) -> np.ndarray:
    """The first ``used`` components of centred rows, scaled to variance 1."""
    mean = np.array([r / f.n for r in f.rest])
    return (z - mean) @ (f.vectors[:, :used] / np.sqrt(f.values[:used]))


def _deviations(f: Fit, z: np.ndarray) -> list[int]:
    """Sum over dimensions of (n*x - S)^2 of each row."""
    largest = f.n * (int(np.abs(z).max(initial=0)) + 1)
    if largest * largest * z.shape[1] < 1 << 62:
        y = f.n * z - np.array(f.rest, np.int64)
        return np.einsum("ij,ij->i", y, y).tolist()
    y = f.n * z.astype(object) - np.array(f.rest, dtype=object)
    return list((y * y).sum(1))


def whiten(rows: DataFrame, components: int = 8, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error of each vector and component."""
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    vectors = usable(rows, vector, key)
    f = fit(vectors)
    if f is None:
        return rows.sparkSession.createDataFrame([], schema)
    size = len(f.centre)
    vectors = vectors.filter(F.size("v") == size)
    count = min(components, size)
    used = int((f.values[:count] > size * np.finfo(float).eps * max(f.values[0], 0)).sum())

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column is 1, so that sums come with the products.
        total = np.zeros((used + 1, used + 1))
        for b in batches:
            w = _projected(f, whole_numbers(b.column("v"), size) - f.centre, used)
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        a, b = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()), pa.array(b.ravel()), pa.array(total.ravel())], ["a", "b", "total"])

    error = None
    if used:
        square = np.zeros((used + 1, used + 1))
        for r in vectors.mapInArrow(products, "a long, b long, total double").groupBy("a", "b").agg(F.sum("total").alias("total")).collect():
            square[r.a, r.b] = r.total
        mean = square[:used, used] / f.n
        error = float(np.abs(square[:used, :used] / f.n - np.outer(mean, mean) - np.eye(used)).max())
    trace = float(np.trace(f.covariance))
    explained = [float(e) / trace if trace > 0 else 0.0 for e in f.values[:count]]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                z = whole_numbers(b.column("v"), size) - f.centre
                w = np.full((len(z), count), np.nan)
                w[:, :used] = _projected(f, z, used)
                rows = len(z) * count
                deviations = pa.array([Decimal(d) if d < 10**38 else None for d in _deviations(f, z)], pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(len(z)), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("key").take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(z))),
                        pa.array(np.full(rows, f.n, np.int64)),
                        deviations.take(each),
                        pa.array(w.ravel(), from_pandas=True),
                        pa.array(np.tile(explained, len(z))),
                        pa.array([error] * rows, pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(out, schema)
