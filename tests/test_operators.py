"""Golden rows and mutations: each gate and each trap that the test tables do not show."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.operators import colors as C
from ledgerloom.operators import diffs as D
from ledgerloom.operators import gates as G
from ledgerloom.operators import graphs as R
from ledgerloom.operators import joins as J
from ledgerloom.operators import tables as A
from ledgerloom.operators import windows as W
from ledgerloom.plans.views import gzipped
from ledgerloom.sources import files as I
from ledgerloom.streaming import ingest

c = F.col


def rows(df, *names):
    return sorted((tuple(r[n] for n in (names or df.columns)) for r in df.collect()), key=str)


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(c("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("path", "reason"),
    [
        ("a/b.txt", None), ("", "unsafe"), (None, "unsafe"), ("/a", "unsafe"), ("a\\b", "unsafe"), ("c:x", "unsafe"), ("x" * 601, "unsafe"), ("a\x01b", "control"), ("a//b", "nonportable"),
        ("../a", "nonportable"), ("a/./b", "nonportable"), ("a.", "nonportable"), ("a /b", "nonportable"), ("a/" + "y" * 201, "nonportable"), ("con", "reserved"), ("a/LPT1.txt", "reserved"),
        ("com0", None), ("console/x", None), ("a/nul.tar.gz", "reserved"), ("é" * 101 + "/b", "nonportable"), ("aux/..", "reserved"),
    ],
)
def test_paths(spark, path, reason):
    assert one(spark, path, S.valid_relative_path) == reason


@pytest.mark.parametrize(
    ("path", "ok"),
    [
        ("channels/stable.json", True), ("channels/other.json", False), (f"releases/{'a' * 64}.json", True), (f"releases/{'A' * 64}.json", False), (f"objects/ab/ab{'0' * 62}.png", True),
        (f"objects/ac/ab{'0' * 62}.png", False), (f"objects/ab/ab{'0' * 62}.exe", False), (f"objects/ab/ab{'0' * 62}.json.gz", True), (f"objects/ab/ab{'0' * 62}.png\n", False), (None, False),
    ],
)
def test_public_paths(spark, path, ok):
    assert one(spark, path, S.public_path_allowlist) is ok


def test_canonical_json(spark):
    same = one(spark, '{"b":1,"a":{"d":[1,2],"c":"x"}}', S.canonical_json)
    assert same == '{"a":{"c":"x","d":[1,2]},"b":1}'
    assert one(spark, '{"a":1}', S.row_hash) == one(spark, '{"a": 1.0}', S.row_hash) != one(spark, '{"a":"1"}', S.row_hash)
    assert one(spark, '{"m":18446744073709551615}', S.canonical_json) == '{"m":18446744073709551615}'


@pytest.mark.parametrize(
    ("line", "error", "ident"),
    [('{"id":1}', None, "1"), ('{"id":"1"}', None, '"1"'), ('{"id":null}', None, "null"), ('{"a":1}', "no id", None), ('{"id":1} true', "not one object", None), ('{"id":1},2', "not one object", None), ("[1]", "not one object", None), ('{"id":1,"id":2}', "not one object", None), ("", "not one object", None)],
)
def test_strict_rows(spark, line, error, ident):
    got = I.parse_rows(spark.createDataFrame([(line,)], "value string"), "f").select("id", "error").first()
    assert (got["id"], got["error"]) == (ident, error)


def test_rows_of_a_family(spark, tmp_path):
    (tmp_path / "f.ndjson").write_text('{"id":1}\n{"id":2}\n{"a":1}\n')
    got = I.scan_ndjson_strict(spark, str(tmp_path / "f.ndjson"), "f", expected=2)
    assert rows(got, "id", "error") == [("1", None), ("2", None), (None, "count is 3"), (None, "no id")]


def test_ordered_detail(spark, tmp_path):
    df = spark.createDataFrame([("10", "x"), ("9", None), ('"a"', "z"), ("-1", "w")], "id string, v string")
    got = I.write_ordered_detail(df, S.order_numeric_first(c("id")), str(tmp_path / "d")).first()
    text = "".join(p.read_text() for p in sorted((tmp_path / "d").glob("part-*")))
    assert [json.loads(x)["id"] for x in text.splitlines()] == ["-1", "9", "10", '"a"'] and got["rows"] == 4 and got["bytes"] == len(text)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.ndjson").write_text('{"id":1}\n{"x":1}\n')
    ingest.append_available(ingest.stream_rows(spark, str(tmp_path / "in"), "f"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id", "error") == [("1", None), (None, "no id")]


def test_orders(spark):
    keys = ["\U00010000", "", "a"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r.k for r in df.orderBy(*S.order_utf16(c("k"))).collect()] == ["a", "\U00010000", ""]
    assert [r.k for r in df.orderBy(*S.order_bytes(c("k"))).collect()] == ["a", "", "\U00010000"]
    ids = spark.createDataFrame([(x,) for x in ["10", "9", " 8", '"z"', "99999999999999999999", "-3", "1.5"]], "k string")
    assert [r.k for r in ids.orderBy(*S.order_numeric_first(c("k"))).collect()] == ["-3", "9", "10", " 8", '"z"', "1.5", "99999999999999999999"]
    bad = spark.createDataFrame([(1, "a"), (2, "\U00010000"), (3, ""), (4, ""), (5, "b")], "n int, k string").withColumn("g", F.lit(0))
    assert [r.n for r in W.strictly_increasing(bad, ["g"], "n", "k").orderBy("n").collect()] == [4, 5]


def test_diff_tells_absent_from_null(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "k"), (3, "z", "k")], "id int, v string, w string")
    b = spark.createDataFrame([(1, "x", None), (2, "Y", None), (4, "n", "k")], "id int, v string, w string")
    assert rows(D.diff_rows(a, b, ["id"])) == [(2, "changed"), (3, "removed"), (4, "added")]
    assert rows(D.diff_fields(a, b, ["id"]), "id", "field", "before", "after") == [(2, "v", "y", "Y"), (2, "w", "k", None)]
    gone = D.diff_fields(a, b.drop("w"), ["id"])
    assert (1, "w", None, None, True, False) in rows(gone, "id", "field", "before", "after", "in_base", "in_cand")
    assert D.diff_rows(a, a, ["id"]).count() == 0


def test_aliases(spark):
    df = spark.createDataFrame([(1, None), (5, 1), (9, 5), (7, 8), (8, 7), (20, 19), (30, 20), (6, 6)], "id int, to int")
    got = {r["id"]: (r["root"], r["status"]) for r in R.alias_chain(df, "id", "to").collect()}
    assert got[1] == (1, "ok") and got[5] == (1, "ok") and got[9] == (1, "ok")
    assert got[7][1] == "not decreasing" and got[8][1] == "not decreasing" and got[6][1] == "not decreasing"
    assert got[20][1] == "outside domain" and got[30][1] == "outside domain"


def test_graphs_with_cycles(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (5, 4)], "src int, dst int")
    assert rows(R.reachability(e, spark.createDataFrame([(1,)], "node int"))) == [(1, 0, None), (2, 1, 1), (3, 2, 2), (4, 3, 3)]
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)], "src int, dst int")
    got = {r["node"]: (r["hops"], r["parent"], r["path"]) for r in R.reachability(chain, spark.createDataFrame([(0,)], "node int"), shown=12).collect()}
    assert len(got) == 21 and got[20] == (20, 19, list(range(9, 21))) and got[3] == (3, 2, [0, 1, 2, 3])
    done, cycle = R.longest_path_dag(e, spark.createDataFrame([(i, i) for i in range(1, 6)], "node int, weight int"))
    assert rows(done) == [(4, 4), (5, 9)] and rows(cycle) == [(1,), (2,), (3,)]


def test_gates_report_one_fault_each(spark):
    items = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, n int")
    side = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "id int, n int")
    assert rows(G.gate_required_match(items, side, "id", "n"), "key", "reason") == [("2", "count differs")]
    assert rows(G.gate_required_match(items, side.filter("id <> 1"), "id", "n"), "key", "reason") == [("1", "missing"), ("2", "count differs")]
    catalog = spark.createDataFrame([("a",), ("b",)], "key string")
    scope = spark.createDataFrame([("selection", 5, 2, True, 1)], "mode string, source_count int, selected_count int, capable boolean, bindings int")
    assert G.gate_scope(scope, catalog).count() == 0
    for change, reason in (({"mode": F.lit("x")}, "mode"), ({"selected_count": F.lit(3)}, "selected count"), ({"capable": F.lit(False)}, "capability"), ({"bindings": F.lit(0)}, "no bindings"), ({"source_count": F.lit(1)}, "selected more than there are")):
        assert rows(G.gate_scope(scope.withColumns(change), catalog), "reason") == [(reason,)]
    good = spark.createDataFrame([("a", 1), ("b", 2)], "name string, value int")
    none = spark.createDataFrame([], "key string")
    assert G.gate_approval(good, good, none).count() == 0
    assert rows(G.gate_approval(good, good.filter("name = 'a'"), none), "key") == [("b",)]
    assert rows(G.gate_approval(good, good, spark.createDataFrame([("o",)], "key string")), "key", "reason") == [("o", "missing")]
    cover = spark.createDataFrame([(1, True), (2, True)], "id int, populated boolean")
    assert G.gate_mounts(cover, 2).count() == 0 and G.gate_mounts(cover, 3).count() == 1 and G.gate_mounts(cover.filter("id > 5")).count() == 1
    G.enforce(G.gate_mounts(cover))
    with pytest.raises(G.GateError):
        G.enforce(G.gate_mounts(cover, 3))


def test_publication_is_all_or_nothing(spark):
    sha = "ab" + "0" * 62
    obj = spark.createDataFrame([(f"objects/ab/{sha}.bin", sha, 3), (f"objects/ab/{sha}.bin", sha, 3)], "path string, sha string, bytes long")
    rel = spark.createDataFrame([(f"releases/{sha}.json", sha, 1)], "path string, sha string, bytes long")
    chan = spark.createDataFrame([("channels/stable.json", sha, 1)], "path string, sha string, bytes long")
    assert G.publication_plan(obj, rel, chan).count() == 3
    assert G.publication_plan(obj.union(spark.createDataFrame([("private/x", sha, 3)], obj.schema)), rel, chan).count() == 0
    assert G.publication_plan(obj.union(spark.createDataFrame([(f"objects/ab/{sha}.bin", sha, 4)], obj.schema)), rel, chan).count() == 0


def test_full_cube_slab(spark):
    seeds = [(0, 0, 0, 3), (255, 255, 255, 1), (10, 20, 30, 0), (12, 20, 30, 2), (200, 0, 100, 4)]
    df = spark.createDataFrame(seeds, "r int, g int, b int, rank int")
    got = C.full_cube(df, "rank").filter(F.shiftright("code", 16) == 11).collect()
    assert len(got) == 65536
    for x in got[::37]:
        r, g, b = x["code"] >> 16, x["code"] >> 8 & 255, x["code"] & 255
        assert (x["d2"], x["rank"]) == min(((r - p) ** 2 + (g - q) ** 2 + (b - s) ** 2, k) for p, q, s, k in seeds)


def test_nearest_rejects_too_many(spark):
    q = spark.createDataFrame([(1, 1, 1)], "r int, g int, b int")
    many = spark.range(C.MAX_CANDIDATES + 1).selectExpr("id as r", "0 as g", "0 as b", "id as rank")
    with pytest.raises(ValueError, match="more than"):
        C.nearest_assign(q, many, ["r", "g", "b"], "rank")


def test_small_ones(spark):
    m = spark.createDataFrame([(1, {"a": "x", "b": None})], "id int, m map<string,string>")
    p = J.promote_fields(m, "m", ["b", "z"]).first()
    assert (p["b"], p["b_there"], p["z"], p["z_there"], p["m"]) == (None, True, None, False, {"a": "x"})
    hit, none = J.prefix_select(spark.createDataFrame([("Item_1",), ("x",)], "k string"), "k", ["ITEM", "zz"])
    assert rows(hit) == [("Item_1",)] and rows(none) == [("zz",)]
    assert rows(A.dup_ids(spark.createDataFrame([("A",), ("a",), ("b",)], "k string"), ["k"], ci=True)) == [("a", 2)]
    assert rows(J.path_parent_conflict(spark.createDataFrame([("a/b",), ("A",), ("ab/c",), ("x/y/z",), ("x/Y",)], "p string"), "p")) == [("a",), ("x/y",)]
    o, bad = A.dedupe_objects(spark.createDataFrame([("p", 1), ("p", 1), ("q", 1), ("q", 2)], "path string, n int"), "path")
    assert rows(o) == [("p", 1)] and rows(bad) == [("q", 2)]
    enc = A.dictionary_encode(spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, 3, "b"), (2, 1, None)], "part int, pos int, v string"), "part", "pos", "v", limit=2)
    assert rows(enc, "part", "pos", "index") == [(1, 1, 0), (1, 2, 1), (1, 3, 0), (2, 1, 0)]
    lits = spark.createDataFrame([("Item_1",), ("item_",), ("it",), ("none",)], "lit string")
    keys = spark.createDataFrame([("Item_1",), ("Item_10",), ("other",)], "key string")
    assert rows(J.prefix_match(lits, keys, "lit", "key")) == [("Item_1", "Item_1"), ("it", "Item_1"), ("it", "Item_10"), ("item_", "Item_1"), ("item_", "Item_10"), ("none", None)]
    assert rows(J.required_families(spark.createDataFrame([("a", 1), ("b", 0)], "family string, rows int"), ["a", "b", "d"])) == [("b",), ("d",)]
    assert one(spark, ["b", "a"], S.sorted_unique_array, "array<string>") is False and one(spark, ["a", "b"], S.sorted_unique_array, "array<string>") is True
    assert [one(spark, x, S.canonical_decimal_string) for x in ("0", "10", "01", "-1", "", None)] == [True, True, False, False, False, False]


def test_global_position_of_many_ties(spark):
    df = spark.range(1000).withColumn("k", c("id") % 3)
    got = [r["pos"] for r in W.global_position(df, ["k", "id"]).orderBy("k", "id").collect()]
    assert got == list(range(1000))


def test_json_refs_at_any_depth(spark):
    deep = '{"assetId":"low"}'
    for _ in range(12):
        deep = '{"x":[' + deep + "]}"
    df = spark.createDataFrame([(1, deep), (2, '{"assetId":"top"}')], "id long, raw string").select("id", F.parse_json("raw").alias("v"))
    got = R.json_walk_refs(df, "id", "v", "assetId").select("id", "ref").collect()
    assert sorted(map(tuple, got)) == [(1, "low"), (2, "top")]


def test_rules_too_deep_are_an_error(spark):
    text = '{"kind":"a"}'
    for _ in range(9):
        text = f'{{"kind":"b","children":[{text}]}}'
    df = spark.createDataFrame([(1, text)], "id int, t string").selectExpr("id", "parse_json(t) AS v")
    with pytest.raises(ValueError):
        R.flatten_rule_tree(df, "id", "v")
    assert R.flatten_rule_tree(df, "id", "v", max_depth=9).count() == 10


def test_running_totals_of_large_families(spark):
    """A family that is cut into several ranges has the same places, sums and peaks as one window over it."""
    import random

    r = random.Random(7)
    data = [(r.choice(["a", "a", "a", "b", None]), i, r.randint(0, 99)) for i in range(3000)]
    df = spark.createDataFrame(data, "f string, o int, v int").repartition(5)
    sums, peaks, places = {}, {}, {}
    want_sum, want_peak, want_shard = [], [], []
    for f, o, v in data:
        sums[f], peaks[f], places[f] = sums.get(f, 0) + v, max(peaks.get(f, 0), v), places.get(f, 0) + 1
        want_sum.append((o, sums[f], sums[f] - v))
        want_peak.append((o, peaks[f]))
        want_shard.append((o, (places[f] - 1) // 7))
    assert rows(W.running_offsets(df, "f", "o", "v"), "o", "end", "start") == sorted(want_sum, key=str)
    assert rows(W.cumulative_peak(df, "f", "o", "v"), "o", "peak") == sorted(want_peak, key=str)
    assert rows(W.row_shard(df, ["f"], ["o"], 7), "o", "shard") == sorted(want_shard, key=str)


def test_ranks_out_of_bounds_are_an_error(spark):
    q = spark.createDataFrame([(1, 2, 3)], "r int, g int, b int")
    k = spark.createDataFrame([(1, 2, 4, 70_000)], "r int, g int, b int, rank int")
    with pytest.raises(ValueError):
        C.nearest_assign(q, k, ["r", "g", "b"], "rank", 65_536)
    assert rows(C.nearest_assign(q, k, ["r", "g", "b"], "rank"), "rank", "d2") == [(70_000, 1)]


def test_digest_levels_follow_the_count(spark):
    """With small buckets there are more levels; the digest still depends on the lines alone."""
    df = spark.createDataFrame([(f"p{i}", f"line {i}") for i in range(600)], "p string, line string")
    a = A.tree_digest(df, "p", F.col("line"), bucket_rows=1).first()["digest"]
    assert a == A.tree_digest(df.repartition(7), "p", F.col("line"), bucket_rows=1).first()["digest"]
    assert a != A.tree_digest(df.filter("p <> 'p5'"), "p", F.col("line"), bucket_rows=1).first()["digest"]


def test_gzip_content_is_measured_decoded(spark):
    import gzip
    import hashlib

    good = gzip.compress(b"a" * 3_000_000)
    data = [(1, good), (2, good + gzip.compress(b"b")), (3, good[:-9]), (4, b"plain"), (5, None), (6, gzip.compress(b""))]
    df = spark.createDataFrame(data, "path int, content binary")
    got = {r["path"]: r["decoded_bytes"] for r in I.measure_objects(df).collect()}
    assert got == {1: 3_000_000, 2: 3_000_001, 3: None, 4: None, 5: None, 6: 0}
    digest = df.filter("path = 2").select(I.gzip_measure("content")["sha"]).first()[0]
    assert digest == hashlib.sha256(b"a" * 3_000_000 + b"b").hexdigest()
    described = I.measure_objects(df.filter("path <> 5"))
    assert rows(A.verify_objects(described.withColumn("decoded_bytes", F.coalesce("decoded_bytes", F.lit(0))), described)) == [(3, "decoded bytes"), (4, "decoded bytes")]
    text = spark.createDataFrame([("x",), (None,)], "t string").select(gzipped("t").alias("content"))
    assert sorted((r[0] for r in text.select(I.gzip_measure("content")["bytes"]).collect()), key=str) == [1, None]


def test_sequence_digest_follows_order_and_lines(spark):
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def brute(lines, chunk):
        level, lines = 0, list(lines)
        while len(lines) > 1 or level < 2:
            lines, level = [sha("\n".join(lines[i : i + chunk])) for i in range(0, len(lines), chunk)], level + 1
            if not lines:
                return sha("")
        return lines[0]

    for n, chunk in ((0, 4), (1, 4), (4, 4), (5, 4), (70, 4)):
        df = spark.range(n).select("id", F.concat(F.lit("line "), F.col("id").cast("string")).alias("x"))
        assert A.sequence_digest(df, ["id"], F.col("x"), chunk).first()[0] == brute([f"line {i}" for i in range(n)], chunk)
    turned = A.sequence_digest(df, [-F.col("id")], F.col("x"), 4).first()[0]
    assert turned == brute([f"line {i}" for i in reversed(range(70))], 4)


def test_enrichment_without_bindings_and_with_ui_tooltips(spark):
    items = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "id int, name string, required int")
    research = spark.createDataFrame([(1, 5, "p1"), (2, 5, "p2")], "id int, required int, persistent_id string")
    tips = spark.createDataFrame([(1, "t")], "id int, tooltip string")
    ui = spark.createDataFrame([(2, "u")], "id int, ui_tooltip string")
    index, detail, bad = J.enrich_items(items, research, tips, None, ui)
    assert rows(index, "id", "asset") == [(1, "Item_1"), (2, "Item_2")] and bad.count() == 0
    assert {r["id"]: (r["tooltip"], r["ui_tooltip"]) for r in detail.collect()} == {1: ("t", None), 2: (None, "u")}
    bound = spark.createDataFrame([(1, "x")], "id int, asset string")
    index, detail, bad = J.enrich_items(items, research, tips, bound)
    assert rows(index, "id", "asset") == [(1, "x")] and rows(bad) == [(2, "no binding")]
    assert detail.first()["ui_tooltip"] is None


def test_identities_differ_are_absent_or_revoked(spark):
    data = [("a", "s", "1"), ("a", "t", "1"), ("b", "s", "1"), ("b", "t", "2"), ("c", "s", "9"), ("c", "t", None), ("d", "s", "7"), ("d", "t", "7")]
    df = spark.createDataFrame(data, "attr string, source string, value string")
    barred = spark.createDataFrame([("7",), ("2",)], "v string")
    want = [("b", "differ", "s=1,t=2"), ("b", "revoked", "s=1,t=2"), ("c", "absent", "s=9,t="), ("d", "revoked", "s=7,t=7")]
    assert rows(J.identity_reconcile(df, "attr", "source", "value", barred)) == want
    assert rows(J.identity_reconcile(df, "attr", "source", "value"), "attr") == [("b",), ("c",)]


def test_approval_of_a_detail(spark, tmp_path):
    df = spark.createDataFrame([("1", "added"), ("2", "removed")], "id string, change string")
    order = S.order_numeric_first(c("id"))
    summary, none = spark.createDataFrame([("added", 1)], "name string, value int"), spark.createDataFrame([], "key string")
    given = I.write_ordered_detail(df, order, str(tmp_path / "a"))
    same = I.write_ordered_detail(df.repartition(3), order, str(tmp_path / "b"))
    other = I.write_ordered_detail(df.replace({"added": "ADDED"}), order, str(tmp_path / "c"))
    more = I.write_ordered_detail(df.union(df.limit(1)), order, str(tmp_path / "d"))
    assert G.gate_approval(summary, summary, none, given, same).count() == 0
    assert rows(G.gate_approval(summary, summary, none, given, other), "key") == [("detail digest",)]
    assert rows(G.gate_approval(summary, summary, none, given, more), "key") == [("detail bytes",), ("detail digest",), ("detail rows",)]
    assert G.gate_approval(summary, summary, none, given).count() == 3


def test_mount_totals_and_slots(spark):
    df = spark.createDataFrame([(0, [True, False]), (1, []), (2, None)], "id int, s array<boolean>")
    cover = A.mount_coverage(df, "id", c("s"))
    assert rows(cover) == [(0, 1, True, False), (1, 0, True, True), (2, 0, False, True)]
    assert tuple(A.mount_totals(cover, 3).first()) == (3, 2, 2, 1, 3, False)
    assert A.mount_totals(cover.filter("populated"), 2).first()["complete"]
    assert A.mount_totals(cover.limit(0), 0).first()["complete"] is False


def test_objects_leave_their_batch_one_at_a_time():
    """The functions on gzip content take Arrow batches as they are, and give the same bytes and sizes for odd ones."""
    import gzip

    import pyarrow as pa

    from ledgerloom.plans.views import gzipped

    made = gzipped.func(pa.array(["é", None, ""]))
    assert made.type == pa.binary() and made.to_pylist() == [gzip.compress("é".encode(), mtime=0), None, gzip.compress(b"", mtime=0)]
    odd = pa.array([*made.to_pylist(), made[0].as_py()[:-3], b"plain", b""])
    assert [x["bytes"] for x in I.gzip_measure.func(odd).to_pylist()] == [2, None, 0, None, None, 0]
