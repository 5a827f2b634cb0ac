"""Reachability and longest paths against plain searches, and the number of jobs on long chains."""

import random

import pytest

from ledgerloom.operators import graphs as R


def graph(seed, nodes=60, edges=90, acyclic=True):
    r = random.Random(seed)
    out = set()
    while len(out) < edges:
        a, b = r.randrange(nodes), r.randrange(nodes)
        if acyclic and a < b or not acyclic and a != b:
            out.add((a, b))
    # Long chains hang on the graph, with a node beside each link, and one leads back in.
    at = nodes
    for start in (0, 3, nodes // 2):
        for _ in range(25):
            out.add((start, at))
            if r.random() < 0.3:
                out.add((at, at + 1000))
            start, at = at, at + 1
    if not acyclic:
        out.add((at - 1, 1))
    return sorted(out)


def search(edges, roots):
    """node: (hops, parent)."""
    hops, front = {r: 0 for r in roots}, set(roots)
    while front:
        front = {b for a, b in edges if a in front} - set(hops)
        hops |= dict.fromkeys(front, max(hops.values()) + 1)
    return {n: (h, min((a for a, b in edges if b == n and hops.get(a) == h - 1), default=None) if h else None) for n, h in hops.items()}


@pytest.mark.parametrize(("seed", "acyclic"), [(1, True), (2, False), (3, False)])
def test_reachability(spark, seed, acyclic):
    edges = graph(seed, acyclic=acyclic)
    roots = [0, 5, 5, 999_999]
    got = R.reachability(spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame([(x,) for x in roots], "node int"), shown=7)
    want = search(edges, roots)
    rows = got.collect()
    assert {r.node: (r.hops, r.parent) for r in rows} == want and len(rows) == len(want)
    for r in rows:
        way = [r.node]
        while want[way[0]][1] is not None:
            way.insert(0, want[way[0]][1])
        assert r.path == way[-7:]


@pytest.mark.parametrize(("seed", "acyclic"), [(1, True), (2, True), (3, False), (4, False)])
def test_longest_paths(spark, seed, acyclic):
    edges = graph(seed, acyclic=acyclic)
    r = random.Random(seed)
    weight = {n: r.randint(-3, 9) for e in edges for n in e} | {7777: 5}
    done, cyclic = R.longest_path_dag(spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame(list(weight.items()), "node int, weight int"))
    want = depths_of(edges, weight)
    assert {x.node: x.depth for x in done.collect()} == {n: d for n, d in want.items() if d is not None}
    assert {x.node for x in cyclic.collect()} == {n for n, d in want.items() if d is None}
    assert acyclic == all(d is not None for d in want.values())


def depths_of(edges, weight):
    """By peeling leaves."""
    out = {n: set() for n in weight}
    for a, b in edges:
        out[a].add(b)
    known = {}
    while ready := [n for n in out if n not in known and all(x in known for x in out[n])]:
        known |= {n: weight[n] + max((known[x] for x in out[n]), default=0) for n in ready}
    return {n: known.get(n) for n in out}


@pytest.fixture
def jobs(spark):
    """The number of jobs so far, without those that adaptive execution makes of shuffles, and broadcasts of small tables."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("counted", "")
    yield lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_chain_takes_few_jobs(spark, jobs):
    n = 100_000
    order = random.Random(1).sample(range(n), n)
    chain = spark.createDataFrame(list(zip(order, order[1:])), "src int, dst int").union(spark.createDataFrame([(-1, -2), (-2, -1), (-3, -1)], "src int, dst int"))
    weights = spark.range(-3, n).selectExpr("CAST(id AS INT) AS node", "2 AS weight")
    done, cyclic = R.longest_path_dag(chain, weights)
    depth = {r.node: r.depth for r in done.collect()}
    assert len(depth) == n and all(depth[x] == 2 * (n - i) for i, x in enumerate(order))
    assert {r.node for r in cyclic.collect()} == {-1, -2, -3}
    first = jobs()
    assert first <= 40
    got = {r.node: r.hops for r in R.reachability(chain, spark.createDataFrame([(order[0],)], "node int")).collect()}
    assert len(got) == n and all(got[x] == i for i, x in enumerate(order))
    assert jobs() - first <= 40
