"""Reference graphs and nested values, by loops over DataFrames that end on data, not on a fixed depth; chains are contracted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerloom.plans.stable import saved, stable


def alias_chain(df: DataFrame, id: str, copy_of: str, rounds: int = 64) -> DataFrame:
    """id, root, status of each row: links are followed to their root by doubling. A link that does not go to a smaller id, or
    leaves the table, is a fault, as is every row whose chain meets one."""
    a = df.select(F.col(id).alias("id"), F.col(copy_of).alias("to"))
    there = a.select(F.col("id").alias("to")).distinct().withColumn("known", F.lit(True))
    a = a.join(there, "to", "left")
    bad = F.when(F.col("to") >= F.col("id"), "not decreasing").when(F.col("known").isNull(), "outside domain")
    a = a.select("id", "to", F.when(F.col("to").isNotNull(), bad).alias("fault"))
    # A fault ends a chain; what points to it inherits it.
    state = stable(a.select("id", F.when(F.col("to").isNull() | F.col("fault").isNotNull(), F.col("id")).otherwise(F.col("to")).alias("root"), "fault"))
    for _ in range(rounds):
        up = state.select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("fault").alias("next_fault"))
        joined = state.join(up, "root", "left")
        state = stable(joined.select("id", F.coalesce("next", "root").alias("root"), F.coalesce("fault", "next_fault").alias("fault"), (F.col("next") != F.col("root")).alias("moved")))
        moved = state.filter("moved").limit(1).count()
        state = state.drop("moved")
        if not moved:
            break
    return state.select("id", "root", F.coalesce("fault", F.lit("ok")).alias("status"))


def _counts(df: DataFrame, **counts: Column) -> Row:
    return df.agg(*[x.alias(k) for k, x in counts.items()]).first()


def _followed(state: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows (node, to, ...) with each link followed once more where ``to`` has a row too; ``steps`` give the other columns from
    those of the row and, as ``up_...``, of the one it points to. ``moved`` tells whether there was one."""
    up = state.select(*[F.col(c).alias(f"up_{c}") for c in state.columns])
    met = state.join(up, F.col("to") == F.col("up_node"), "left")
    there = F.col("up_node").isNotNull()
    to = F.when(there, F.col("up_to")).otherwise(F.col("to")).alias("to")
    return met.select("node", to, *[F.when(there, x).otherwise(F.col(c)).alias(c) for c, x in steps.items()], there.alias("moved"))


def follow(links: DataFrame, steps: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Chains of links (node, to, ...) followed to their ends, and the nodes whose links never end.

    By doubling: three times a round, links are replaced by those that they lead to, so a chain of n links takes log8(n) rounds. A
    link that still moves once all could have been passed is on a cycle, or leads to one."""
    state, reached = saved(links), 1
    n = state.count()
    while True:
        for _ in range(3):
            state = _followed(state.select(*links.columns), steps)
        state = saved(state)
        reached *= 8
        if reached > 8 * n or not _counts(state, n=F.count_if("moved"))["n"]:
            break
    return state.filter("NOT moved").drop("moved"), state.filter("moved").select("node")


def _paths(found: DataFrame, shown: int) -> DataFrame:
    """node and ``path``: the last ``shown`` nodes on the way to it, by doubling along the parents."""
    state, size = found.select("node", F.col("parent").alias("to"), F.array("node").alias("path")), 1
    while size < shown:
        up = state.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("path").alias("before"))
        state = state.join(up, "to", "left").select("node", F.col("next").alias("to"), F.when(F.col("before").isNull(), F.col("path")).otherwise(F.concat("before", "path")).alias("path"))
        state, size = saved(state), 2 * size
    return state.select("node", F.when(F.size("path") > shown, F.slice("path", -shown, shown)).otherwise(F.col("path")).alias("path"))


def reachability(edges: DataFrame, roots: DataFrame, src: str = "src", dst: str = "dst", shown: int = 0) -> DataFrame:
    """node, hops, parent of each node that a root leads to, over any number of hops; the parent is the smallest of those one hop
    nearer. With ``shown``, also ``path``: the last so many nodes on the way, the node itself included.

    A node that one edge leads to is as far as that edge's source and a hop, so chains and trees of such nodes are contracted onto
    where they start; distances are then settled, hop by hop of what is left, between roots and nodes where ways meet."""
    first = roots.select(F.col(roots.columns[0]).alias("node")).distinct()
    kind = first.schema["node"].dataType
    e = saved(edges.select(F.col(src).cast(kind).alias("src"), F.col(dst).cast(kind).alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL").distinct())
    into = e.groupBy("dst").agg(F.count("*").alias("n"), F.min("src").alias("src"))
    single = into.filter("n = 1").join(first.withColumnRenamed("node", "dst"), "dst", "left_anti").select(F.col("dst").alias("node"), F.col("src").alias("to"), F.lit(1).cast("long").alias("off"))
    held, _ = follow(single, {"off": F.col("off") + F.col("up_off")})
    held = saved(held)  # (node, to: where its chain starts, off: hops from there)
    # Edges into roots and meeting points, from the starts of their sources' chains.
    ends = e.join(single.select(F.col("node").alias("dst")), "dst", "left_anti")
    ends = ends.join(held.select(F.col("node").alias("src"), "to", "off"), "src", "left")
    jumps = saved(ends.groupBy(F.coalesce("to", "src").alias("src"), "dst").agg((F.min(F.coalesce("off", F.lit(0).cast("long"))) + 1).alias("far")))
    known = first.select("node", F.lit(0).cast("long").alias("hops"))
    front = known
    while True:
        ahead = jumps.join(front.select(F.col("node").alias("src"), "hops"), "src").groupBy(F.col("dst").alias("node")).agg(F.min(F.col("hops") + F.col("far")).alias("nearer"))
        both = known.join(ahead, "node", "full_outer")
        better = F.col("nearer").isNotNull() & (F.col("hops").isNull() | (F.col("nearer") < F.col("hops")))
        known = saved(both.select("node", F.least("hops", "nearer").alias("hops"), better.alias("better")))
        front, known = known.filter("better").select("node", "hops"), known.select("node", "hops")
        if not _counts(front, n=F.count("*"))["n"]:
            break
    inner = held.join(known.select(F.col("node").alias("to"), "hops"), "to").select("node", (F.col("hops") + F.col("off")).alias("hops"))
    reached = saved(known.unionByName(inner))
    near = e.join(reached.select(F.col("node").alias("src"), F.col("hops").alias("before")), "src").join(reached.select(F.col("node").alias("dst"), "hops"), "dst").filter("before + 1 = hops")
    parents = near.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
    out = reached.join(parents, "node", "left").select("node", F.col("hops").cast("int").alias("hops"), F.when(F.col("hops") > 0, F.col("parent")).alias("parent"))
    if not shown:
        return out
    out = saved(out)
    return out.join(_paths(out, shown), "node")


def longest_path_dag(edges: DataFrame, weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, depth): the largest sum of weights from a node down, itself included; and the nodes on or above a cycle.

    Each round settles the nodes all of whose edges lead to settled ones. A node with one edge left has the depth
    max(a, b + depth of where it leads), from what has been settled below it; such functions combine, so where a quarter of the
    nodes or more are like that, chains of them are followed to their ends by doubling, set aside, and settled last. What never
    settles leads to a cycle."""
    best = lambda x, y: F.greatest(x, y)  # noqa: E731  the larger of the two that are not null
    live = weights.select("node", F.col("weight").cast("long").alias("weight"), F.lit(None).cast("long").alias("below"))
    e = saved(edges.select("src", "dst").distinct().join(weights.select(F.col("node").alias("src")), "src", "left_semi").join(weights.select(F.col("node").alias("dst")), "dst", "left_semi").withColumn("far", F.lit(0).cast("long")))
    done: list[DataFrame] = []
    aside: list[DataFrame] = []
    while True:
        out = e.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("edges"), F.min("dst").alias("to"), F.min("far").alias("far"))
        state = live.join(out, "node", "left").withColumn("depth", F.when(F.col("edges").isNull(), F.col("weight") + F.coalesce("below", F.lit(0).cast("long"))))
        state = saved(state)
        n = _counts(state, all=F.count("*"), settled=F.count("depth"), single=F.count_if(F.col("edges") == 1))
        done.append(state.filter("depth IS NOT NULL").select("node", "depth"))
        if 4 * n["single"] >= n["all"] - n["settled"] > 0:
            links = state.filter("edges = 1").select("node", "to", (F.col("weight") + F.col("below")).alias("a"), (F.col("weight") + F.col("far")).alias("b"))
            ended, _ = follow(links, {"a": best(F.col("a"), F.col("b") + F.col("up_a")), "b": F.col("b") + F.col("up_b")})
            ended = saved(ended)
            aside.append(ended)
            gone = state.filter("depth IS NULL").join(ended.select("node"), "node", "left_anti")
            # Edges into a chain lead to its end, and may end in the chain's own best.
            e = e.join(ended.select(F.col("node").alias("src")), "src", "left_anti").join(ended.select(F.col("node").alias("dst"), "to", "a", "b"), "dst", "left")
            e = e.select("src", F.coalesce("to", "dst").alias("dst"), (F.col("far") + F.coalesce("b", F.lit(0).cast("long"))).alias("far"), (F.col("far") + F.col("a")).alias("own"))
            progress = n["settled"] + ended.count()
        else:
            gone, e, progress = state.filter("depth IS NULL"), e.withColumn("own", F.lit(None).cast("long")), n["settled"]
        if not progress:
            break
        e = saved(e.join(state.filter("depth IS NOT NULL").select(F.col("node").alias("dst"), "depth"), "dst", "left"))
        below = e.groupBy(F.col("src").alias("node")).agg(F.max(best(F.col("own"), F.col("far") + F.col("depth"))).alias("more"))
        live = gone.join(below, "node", "left").select("node", "weight", best(F.col("below"), F.col("more")).alias("below"))
        e = e.filter("depth IS NULL").groupBy("src", "dst").agg(F.max("far").alias("far"))
    settled = reduce(DataFrame.union, done)
    for ended in reversed(aside):
        up = ended.join(settled.select(F.col("node").alias("to"), "depth"), "to").select("node", best(F.col("a"), F.col("b") + F.col("depth")).alias("depth"))
        settled = saved(settled.union(up))
    return settled, weights.select("node").distinct().join(settled, "node", "left_anti")


def json_walk_refs(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Every text under the key ``name`` at any depth of a variant column, through objects and arrays."""
    level = df.select(F.col(key).alias("k"), F.col(value).alias("v"))
    found = None
    while True:
        one = df.sparkSession.sql("SELECT k, e.key AS name, e.value AS v FROM {level}, LATERAL variant_explode_outer(v) AS e WHERE e.pos IS NOT NULL", level=level)
        hit = one.filter(F.col("name") == name).select(F.col("k").alias(key), F.variant_get("v", "$", "string").alias("ref")).filter("ref IS NOT NULL") if name else one
        found = hit if found is None else found.unionByName(hit)
        level = stable(one.filter(F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")).select("k", "v"))
        if not level.limit(1).count():
            return found


def flatten_rule_tree(df: DataFrame, key: str, value: str, kind: str = "kind", children: str = "children", max_depth: int = 8, fields: dict[str, str] | None = None) -> DataFrame:
    """key, depth, kind of each rule of a nested tree, and ``fields`` (name: type) of it; a rule's ``children`` are rules. A rule
    below ``max_depth`` is an error."""
    level = df.select(F.col(key).alias("k"), F.col(value).alias("v"))
    out, depth = None, 0
    while True:
        row = level.select(F.col("k").alias(key), F.lit(depth).alias("depth"), F.variant_get("v", f"$.{kind}", "string").alias("kind"), *[F.variant_get("v", f"$.{f}", t).alias(f) for f, t in (fields or {}).items()])
        out = row if out is None else out.union(row)
        level = stable(level.select("k", F.explode(F.variant_get("v", f"$.{children}", "array<variant>")).alias("v")))
        if not level.limit(1).count():
            return out
        depth += 1
        if depth > max_depth:
            raise ValueError(f"rules are nested more than {max_depth} deep")


def rule_summary(flat: DataFrame, key: str, conditional: list[str]) -> DataFrame:
    """Per key: number of rules, sorted distinct kinds, and whether one is conditional."""
    return flat.groupBy(key).agg(F.count("*").alias("rules"), F.array_sort(F.collect_set("kind")).alias("kinds"), F.bool_or(F.coalesce(F.col("kind").isin(conditional), F.lit(False))).alias("conditional"))


def rule_requirements(flat: DataFrame, key: str, tracker: str = "tracker", subject: str = "subject", count: str = "count") -> DataFrame:
    """key, tracker, subject, count: what each rule with a tracker asks for, the largest count where rules ask for the same."""
    return flat.filter(F.col(tracker).isNotNull()).groupBy(key, tracker, subject).agg(F.max(count).alias(count))


def slots_of(text: Column) -> Column:
    """``slots`` of a JSON row as array<struct<assigned, assetId>>."""
    return F.from_json(text, "struct<slots:array<struct<assigned:boolean,assetId:string>>>")["slots"]
