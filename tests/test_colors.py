"""Nearest colours and the whole cube against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import colors as C


def brute(points, ranks, colours, bound):
    d2 = ((colours[:, None, :] - points[None]) ** 2).sum(2)
    return (d2 * bound + ranks[None]).min(1)


@pytest.mark.parametrize("size", [1, 7, 400, 3000])
def test_nearest_by_cells(size):
    """Spread and clustered points, many ties, colours outside the cube."""
    r = np.random.default_rng(size)
    points = np.unique(np.vstack([r.integers(0, 256, (size, 3)), r.integers(100, 110, (size, 3))]), axis=0)
    ranks = r.permutation(len(points))
    colours = np.vstack([r.integers(0, 256, (500, 3)), points[:50], r.integers(-40, 400, (60, 3))])
    assert (C._Nearest(points, ranks, 65_536).find(colours) == brute(points, ranks, colours, 65_536)).all()


def test_nearest_rows(spark):
    """Null coordinates have no nearest; repeated and further columns stay; without candidates there are no rows."""
    q = spark.createDataFrame([(1, 10, 10, {"a": 1}), (1, 10, 10, {"a": 1}), (2, None, 3, None), (3, 200, 0, None)], "id int, r int, g int, m map<string,int>")
    k = spark.createDataFrame([(10, 12, 5), (10, 8, 4), (200, 0, 9), (200, 0, 7)], "r int, g int, rank int")
    got = C.nearest_assign(q, k, ["r", "g"], "rank")
    assert got.columns == ["id", "r", "g", "m", "d2", "rank"]
    assert sorted((x.id, x.d2, x.rank) for x in got.collect()) == [(1, 4, 4), (1, 4, 4), (3, 0, 7)]
    assert C.nearest_assign(q, k.limit(0), ["r", "g"], "rank").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lower_envelope():
    r = np.random.default_rng(1)
    for n, weight in ((1, 3), (2, 1), (17, 5), (64, 1000), (256, 65_536)):
        f = r.integers(0, weight * n * 4, (50, n))
        f[::3] = r.integers(0, 3, f[::3].shape) * weight  # plateaus and ties
        f[1::7] = 10**12  # no seed at all
        x = np.arange(n)
        want = (f[:, None, :] + weight * (x[:, None] - x[None, :]) ** 2).min(2)
        assert (C.lower_envelope(f, weight) == want).all()


def test_whole_cube(spark):
    """Random seeds, one cluster, an empty region and equal distances; every 509th cell by brute force, and all planes of one r."""
    r = np.random.default_rng(3)
    seeds = np.vstack([r.integers(0, 256, (40, 3)), r.integers(60, 64, (20, 3)), [[255, 255, 255], [255, 253, 255]]])
    ranks = r.permutation(len(seeds))
    df = spark.createDataFrame([(*map(int, s), int(k)) for s, k in zip(seeds, ranks, strict=True)], "r int, g int, b int, rank int")
    cube = C.full_cube(df, "rank")
    got = cube.filter("code % 509 = 0 OR shiftright(code, 16) = 255").toPandas()
    assert cube.count() == 1 << 24 == cube.select("code").distinct().count()
    code = got["code"].to_numpy(np.int64)
    best = brute(seeds, ranks, np.stack([code >> 16, code >> 8 & 255, code & 255], 1), 65_536)
    assert (got["d2"].to_numpy() * 65_536 + got["rank"].to_numpy() == best).all()


@pytest.mark.parametrize("given", [None, 65_536])
def test_whole_cube_of_many_ranks(spark, given):
    """Ranks past 65,536, by a bound read off them and by a given one that is smaller than they are."""
    r = np.random.default_rng(4)
    seeds = r.integers(0, 256, (300, 3))
    ranks = r.permutation(1_200_000)[: len(seeds)]
    df = spark.createDataFrame([(*map(int, s), int(k)) for s, k in zip(seeds, ranks, strict=True)], "r int, g int, b int, rank int")
    got = C.full_cube(df, "rank", given).filter("code % 1021 = 0").toPandas()
    code = got["code"].to_numpy(np.int64)
    bound = given or int(ranks.max()) + 1
    best = brute(seeds, ranks, np.stack([code >> 16, code >> 8 & 255, code & 255], 1), bound)
    assert (got["d2"].to_numpy() * bound + got["rank"].to_numpy() == best).all()
    assert got["rank"].max() < bound and (got["rank"].max() >= 65_536) == (given is None)


def test_ranks_out_of_bounds(spark):
    for low, high in ((-1, 5), (0, 1 << 60)):
        with pytest.raises(ValueError):
            C.full_cube(spark.createDataFrame([(0, 0, 0, low), (1, 1, 1, high)], "r int, g int, b int, rank long"), "rank")


def test_empty_cube(spark):
    none = C.full_cube(spark.createDataFrame([], "r int, g int, b int, rank int"), "rank")
    assert none.agg(F.count("*"), F.min("d2"), F.max("d2")).first()[:] == (1 << 24, 3 * 255 * 255 + 1, 3 * 255 * 255 + 1)
