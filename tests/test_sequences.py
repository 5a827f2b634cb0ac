"""Sequences, lines and runs that go over range borders, against plain loops over the rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import colors as C
from ledgerloom.operators import joins as J
from ledgerloom.operators import tables as A
from ledgerloom.operators import windows as W

c = F.col


@pytest.fixture
def cut(spark):
    """Small tables are cut into several ranges too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def cells_of(seed, size=900):
    """A hot line with a third of all cells and more, lines of one cell, a null line, and runs of very different lengths with nulls."""
    r = random.Random(seed)
    rows = []
    for line, n in [("hot", size), ("x", size // 2), ("y", 7), ("one", 1), (None, 40), *[(f"l{i}", 3) for i in range(20)]]:
        cell, value = 0, None
        for _ in range(n):
            if r.random() < (0.02 if line == "hot" else 0.4):
                value = r.choice(["a", "b", None])
            rows.append((line, cell, value, 0 if line == "hot" else r.randint(0, 1)))
            cell += r.choice((1, 1, 1, 5))
    r.shuffle(rows)
    return rows


def lines_of(rows):
    lines = {}
    for line, cell, *v in sorted(rows, key=lambda x: (str(x[0]), x[1])):
        lines.setdefault(line, []).append((cell, tuple(v)))
    return lines


def runs_of(rows):
    out = []
    for line, cells in lines_of(rows).items():
        run = -1
        for i, (cell, v) in enumerate(cells):
            if not i or v != cells[i - 1][1]:
                run += 1
                out.append([line, run, *v, cell, cell])
            out[-1][-1] = cell
    return sorted(map(tuple, out), key=str)


@pytest.fixture(params=[1, 2])
def cells(request, spark, cut):
    rows = cells_of(request.param)
    return rows, spark.createDataFrame(rows, "line string, cell int, a string, w int")


def test_a_hot_line_has_several_ranges(cells):
    kept, _ = W.ranged(cells[1], ["line"], ["cell"])
    assert kept.filter("line = 'hot'").select("__part").distinct().count() > 1


def test_runs(cells):
    rows, df = cells
    assert sorted(map(tuple, A.line_runs(df, "line", "cell", ["a", "w"]).select("line", "run", "a", "w", "first", "last").collect()), key=str) == runs_of(rows)


def test_a_run_over_several_ranges(spark, cut):
    df = spark.range(1000).select(F.lit("l").alias("line"), c("id").alias("cell"), F.when(c("id") >= 990, "z").otherwise("a").alias("a"))
    assert [tuple(r) for r in A.line_runs(df, "line", "cell", ["a"]).orderBy("run").collect()] == [("l", 0, "a", 0, 989), ("l", 1, "z", 990, 999)]


def test_boundaries(cells):
    rows, df = cells
    want = {(line, cell, i + 1 == len(x) or x[i + 1][1] != v) for line, x in lines_of(rows).items() for i, (cell, v) in enumerate(x)}
    got = W.run_boundaries(df, "line", "cell", ["a", "w"])
    assert got.columns == [*df.columns, "last"] and {(r.line, r.cell, r.last) for r in got.collect()} == want and got.count() == len(rows)


def test_lookups(spark, cells):
    """Each cell finds its run; cells between runs the next one; cells past the last run none."""
    rows, df = cells
    runs = runs_of(rows)
    asked = [(line, cell) for line in {r[0] for r in rows} for cell in range(0, 3000, 7)] + [("no line", 1)]
    got = C.lookup_runs(spark.createDataFrame(asked, "line string, cell int"), A.line_runs(df, "line", "cell", ["a", "w"]), "line", "cell", ["a", "w"]).collect()

    def find(line, cell):
        r = min((r for r in runs if r[0] == line and r[5] >= cell), key=lambda r: r[5], default=None)
        return (line, cell, r and r[5], r and r[2], r and r[3])

    assert sorted(map(tuple, got), key=str) == sorted((find(*x) for x in asked), key=str)


def test_neighbours_of_a_whole_table(spark, cut):
    df = spark.createDataFrame([(i, f"v{i}" if i % 3 else None) for i in random.Random(1).sample(range(500), 500)], "n int, v string")
    got = W.neighbour(df, [], ["n"], c("v"), "near").collect()
    assert len(got) == 500 and all((r.near is None) == (r.n == 0) and (r.n == 0 or r.near.value == (f"v{r.n - 1}" if (r.n - 1) % 3 else None)) for r in got)
    assert W.neighbour(df.limit(0), [], ["n"], c("v"), "near").count() == 0


def windows_in(df):
    return re.findall(r"Window \[[^\n]*", df._jdf.queryExecution().optimizedPlan().toString())


SEQUENCE = [("Armor_1", None), ("Item_1", None), ("Tiles_3", None)]


@pytest.mark.parametrize(
    ("keys", "declared", "reasons"),
    [
        (["Armor_1", "Item_1", "Tiles_3"], 3, []),
        (["Armor_1", "Tiles_3"], 3, ["row count"]),
        (["Armor_1", "Item_1", "Tiles_3"], 2, ["row count"]),
        (["Armor_1", "Armor_1"], 2, ["duplicate"]),
        (["Item_1", "Armor_1"], 2, ["out of order"]),
        (["Item_1", "Missing"], 2, ["unknown"]),
        (["Armor_1", ""], 2, ["invalid", ]),
        (["Armor_1", None], 2, ["invalid"]),
        ([], 0, ["declared count"]),
        (["Armor_1"], 4, ["declared count"]),
        (["Item_1", "item_1"], 2, ["unknown"]),
    ],
)
def test_selections(spark, keys, declared, reasons):
    catalog = spark.createDataFrame(SEQUENCE, "key string, width int")
    chosen, bad = J.select_sequence(catalog, spark.createDataFrame(list(enumerate(keys)), "place int, key string"), "key", "place", declared)
    assert sorted(r.reason for r in bad.collect()) == reasons
    assert {r.key for r in chosen.collect()} == set(keys) & {k for k, _ in SEQUENCE}


def test_a_long_sequence_in_utf16_order(spark, cut):
    """Keys beyond the first plane come before those at its end; no window is taken over the sequence."""
    keys = sorted({chr(random.Random(7).randint(0xE000, 0xE0FF) + i % 200) for i in range(60)} | {chr(0x10000 + i) for i in range(60)} | {f"k{i:04d}" for i in range(800)}, key=lambda k: k.encode("utf-16-be"))
    df = spark.createDataFrame(list(enumerate(keys)), "place int, key string")
    assert W.strictly_increasing(df, [], "place", "key").count() == 0
    wrong = [k for i, k in enumerate(keys) if i % 100 != 50]
    for at in (120, 500, 501):
        wrong.insert(at, wrong[at - 1] if at == 500 else keys[0])
    df = spark.createDataFrame(list(enumerate(wrong)), "place int, key string")
    bad = W.strictly_increasing(df, [], "place", "key")
    assert {r.place for r in bad.collect()} == {i for i in range(1, len(wrong)) if wrong[i].encode("utf-16-be") <= wrong[i - 1].encode("utf-16-be")}
    rows, _ = W.ranged(df, [], ["place"])
    assert rows.select("__part").distinct().count() > 1
    assert all("__part" in w for w in windows_in(bad))
