"""Whitening against whole-number brute force and an eigenvalue problem of its own."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import queries, whitening


def brute(vectors):
    """n, S, x of the vectors, and their covariance in fractions of whole numbers."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    return n, s, x, y, v


def held(spark, vectors, components, rows):
    """Every figure of a result against brute force over the vectors that take part."""
    n, s, x, y, v = brute([w for _, w in vectors])
    values = np.linalg.eigvalsh(v)[::-1]
    count = min(components, len(v))
    want = Counter((k, c, n, sum(a * a for a in r)) for (k, _), r in zip(vectors, y, strict=True) for c in range(1, count + 1))
    assert Counter((r["vec_id"], r["component"], r["n"], int(r["deviation"])) for r in rows) == want
    for c in range(1, count + 1):
        mine = [r for r in rows if r["component"] == c]
        assert len({r["explained"] for r in mine}) == 1
        assert mine[0]["explained"] == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9, abs=1e-12)
    return n, y, v, values


def test_query_on_a_small_table(spark):
    d = "/root/testdata/sf0.001"
    rows = queries.queries()["op11_whitening"](spark, d).collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    n, y, v, values = held(spark, vectors, 8, rows)
    _, unit = np.linalg.eigh(v)
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    for c in range(1, 9):
        want = np.array(y, dtype=float) / n @ unit[:, -c] / math.sqrt(values[c - 1])
        got = np.array([by[k, c] for k, _ in vectors])
        assert np.abs(got - np.sign(got @ want) * want).max() < 1e-8
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and 0 <= rows[0]["identity_error"] < 1e-9


def test_odd_rows(spark):
    """Null, short, broken and repeated vectors, entries of very different sizes, null ids and columns with clashing names."""
    r = np.random.default_rng(2)
    good = [(i, (r.normal(size=4) * [1, 10, 100, 1000]).tolist()) for i in range(40)]
    good += [good[0], (None, good[1][1]), (7, [0.0, -0.0, 1e-300, 3e4])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, float("nan"), 2.0, 3.0]), (54, [1.0, 2.0, float("-inf"), 3.0]), (55, [1.0, 2.0]), (56, [1e300, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(k, v, 5, "x", 1.0) for k, v in good + bad], "vec_id long, embedding array<double>, n int, component string, key double").repartition(3)
    rows = whitening.whiten(df, components=8).collect()
    held(spark, good, 8, rows)
    assert rows[0]["identity_error"] < 1e-4


def test_deviations_of_any_size(spark):
    """Past a long in the operator, past 38 digits null."""
    rows = whitening.whiten(spark.createDataFrame([(1, [2.0**20]), (2, [0.0]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == {1: (2**31) ** 2, 2: 2**60, 3: 2**60}
    rows = whitening.whiten(spark.createDataFrame([(i, [2.0**49 * (i < 100)]) for i in range(200)], "vec_id long, embedding array<double>")).collect()
    assert len(rows) == 200 and all(r["deviation"] is None for r in rows) and rows[0]["identity_error"] < 1e-9


def test_components_without_variance(spark):
    rows = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 5.0]), (2, [2.0, 4.0, 5.0]), (3, [4.0, 8.0, 5.0])], "vec_id long, embedding array<double>")).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in rows) and len(rows) == 9
    assert all(r["identity_error"] < 1e-9 for r in rows)
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in one] == [(None, 0.0, None, 0)] * 2


def test_empty_tables(spark):
    none = whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_square_sums_are_exact():
    r = np.random.default_rng(3)
    for bits in (5, 20, 22, 41, 44, 61):
        s = r.integers(-(1 << bits), 1 << bits, (50, 3))
        assert list(whitening.square_sums(s)) == [sum(int(a) ** 2 for a in s[:, k]) for k in range(3)]
