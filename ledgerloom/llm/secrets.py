"""Secret scans through a trigram index, with DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived: every match must
hold one alternative of each clause, and an alternative holds when all its trigrams
do. Postings (trigram, document) of the rules' trigrams are intersected to find the
candidates of each rule; only these are searched with the pattern. A rule without
mandatory trigrams is searched in every text.

Defined results: a null text is an empty one and has no spans; rows that share a
``doc_id`` share candidates and are searched each; a null ``doc_id`` is searched by
every rule; an empty table gives an empty result; further columns, of any name, stay
as they are, but a column with the name of the result gives way to it.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import save

BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern (read alike by Java and Python), and the least length of a group of a match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    #: The same matches as after ``least``, where the pattern alone can say so.
    exact: str = ""


#: The base rules come first, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # Matches of the next two are whole runs, so the least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def trigram_query(pattern: str, widest: int = 12) -> list[set[frozenset[str]]]:
    """Clauses, all of which must hold; each is a set of alternatives; an alternative is a set of lower-case trigrams."""
    clauses: list[set[frozenset[str]]] = []

    def flush(known: set[str]) -> None:
        if known and all(len(s) >= 3 for s in known):
            clauses.append({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in known})

    def walk(items, known: set[str]) -> set[str]:
        """``known``: all strings that can stand just before; the result is that after ``items``."""
        for op, arg in items:
            more: set[str] | None = None
            if op is rc.LITERAL:
                more = {chr(arg).lower()}
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= widest:
                more = {chr(v).lower() for _, v in arg}
            elif op is rc.SUBPATTERN:
                known = walk(arg[3], known)
                continue
            elif op is rc.BRANCH:
                ends = [exact(x) for x in arg[1]]
                more = set().union(*ends) if all(x is not None for x in ends) else None
            elif op is rc.MAX_REPEAT and arg[:2] == (0, 1):
                x = exact(arg[2])
                more = {"", *x} if x is not None else None
            if more is not None and len(known) * len(more) <= widest:
                known = {a + b for a in known for b in more}
            else:
                flush(known)
                known = more if more is not None else {""}
        return known

    def exact(items) -> set[str] | None:
        out = {""}
        for op, arg in items:
            if op is rc.LITERAL:
                more = {chr(arg).lower()}
            elif op is rc.MAX_REPEAT and arg[:2] == (0, 1) and (x := exact(arg[2])) is not None:
                more = {"", *x}
            elif op is rc.BRANCH and None not in (xs := [exact(y) for y in arg[1]]):
                more = set().union(*xs)
            elif op is rc.SUBPATTERN and (x := exact(arg[3])) is not None:
                more = x
            else:
                return None
            out = {a + b for a in out for b in more}
            if len(out) > widest:
                return None
        return out

    flush(walk(rp.parse(pattern), {""}))
    return clauses


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id), once each, of those trigrams that stand in a text, in either case."""
    lower = F.array(F.lower(F.coalesce("text", F.lit(""))))
    found = F.transform(lower, lambda t: F.array_compact(F.array(*[F.when(F.contains(t, F.lit(g)), F.lit(g)) for g in trigrams])))[0]
    return docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, mask): bit i is set where rule i may match; rules without mandatory trigrams have no bit."""
    spark = docs.sparkSession
    terms = []
    clauses = {}
    for r, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        clauses[r] = len(query)
        for c, alternatives in enumerate(query):
            for a, grams in enumerate(sorted(map(sorted, alternatives))):
                terms += [(g, r, c, a, len(grams)) for g in grams]
    wanted = sorted({t[0] for t in terms})
    if not wanted:
        return spark.createDataFrame([], "doc_id long, mask long")
    index = save(postings(docs, wanted), "postings")
    terms = spark.createDataFrame(terms, "trigram string, rule int, clause int, alternative int, need int")
    met = index.join(F.broadcast(terms), "trigram").groupBy("doc_id", "rule", "clause", "alternative").agg(F.count("*").alias("n"), F.first("need").alias("need")).filter("n = need")
    met = met.groupBy("doc_id", "rule").agg(F.count_distinct("clause").alias("clauses"))
    whole = reduce(lambda x, y: x | y, [(F.col("rule") == r) & (F.col("clauses") == n) for r, n in clauses.items() if n])
    return met.filter(whole).groupBy("doc_id").agg(F.sum(F.expr("shiftleft(1L, rule)")).cast("long").alias("mask"))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums, or the like, of an array of longs that are 0 or more; ``combine(x, 0)`` is x.

    The array is cut into about as many chunks as a chunk has values, as each step of ``aggregate`` copies what it carries."""
    none = F.array().cast("array<bigint>")

    def along(xs: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("last"), none.alias("out"))

        def step(s: Column, x: Column) -> Column:
            v = combine(x, s["last"])
            return F.struct(v.alias("last"), F.concat(s["out"], F.array(v)).alias("out"))

        return F.aggregate(xs, zero, step, lambda s: s["out"])

    def chunked(xs: Column) -> Column:
        def with_size(c: Column) -> Column:
            chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / c).cast("int")), lambda k: along(F.slice(xs, k * c + 1, c)))

            def shifted(inner: Column) -> Column:
                ends = along(F.transform(inner, lambda x: F.element_at(x, -1)))
                before = F.concat(F.array(F.lit(0).cast("long")), ends)
                return F.flatten(F.zip_with(inner, F.slice(before, 1, F.size(inner)), lambda xs, b: F.transform(xs, lambda x: combine(x, b))))

            return bind(chunks, shifted)

        return F.when(F.size(xs) == 0, none).otherwise(bind(F.ceil(F.sqrt(F.size(xs))).cast("int"), with_size))

    return bind(values, chunked)


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """array<struct<start, kind, end>> of a rule's matches that are long enough; code points, end exclusive."""
    pattern = F.lit(rule.exact or rule.pattern)
    empty = F.array().cast(_SPANS)

    def place(t: Column) -> Column:
        found = F.regexp_extract_all(t, pattern, F.lit(0))
        between = F.split(t, rule.exact or rule.pattern, -1)
        part = [F.regexp_extract_all(t, pattern, F.lit(rule.group)).alias("part")] if rule.group else []

        def spans(m: Column) -> Column:
            steps = F.zip_with(F.slice(m["between"], 1, F.size(m["found"])), m["found"], lambda b, x: (F.length(b) + F.length(x)).cast("long"))
            made = F.zip_with(
                running(steps, lambda x, y: x + y),
                F.arrays_zip(m["found"].alias("m"), m["part" if rule.group else "found"].alias("g")),
                lambda e, x: F.when(F.length(x["g"]) >= rule.least, F.struct((e - F.length(x["m"])).alias("start"), F.lit(number).alias("kind"), e.alias("end"))),
            )
            return F.filter(made, lambda x: x.isNotNull()).cast(_SPANS)

        return bind(F.struct(found.alias("found"), between.alias("between"), *part), spans)

    return F.when(F.regexp_like(text, pattern), place(text)).otherwise(empty)


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores after it where ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """All columns of ``docs`` and ``name``, the spans sorted by start and kind; a column of that name gives way to it."""
    docs = docs.drop(name)
    key, bits = unused(docs, "candidate"), unused(docs, "mask")
    may = save(candidates(docs.select("doc_id", "text"), rules), "candidates").select(F.col("doc_id").alias(key), F.col("mask").alias(bits))
    few = may.count() <= BROADCAST_ROWS
    joined = docs.join(F.broadcast(may) if few else may, docs["doc_id"] == may[key], "left").drop(key)
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(F.coalesce(F.col(bits), F.lit(0).cast("long")))
    empty = F.array().cast(_SPANS)
    parts = []
    for r, rule in enumerate(rules):
        found = rule_spans(text, rule, r)
        parts.append(F.when(mask.bitwiseAND(F.lit(1 << r)) != 0, found).otherwise(empty) if trigram_query(rule.pattern) else found)
    return joined.withColumn(name, F.array_sort(F.concat(*parts))).drop(bits)


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    found = find_secrets(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).drop("text")
    # The spans are computed once, below the columns that read them.
    s = F.col("spans")
    count = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long")
    base = F.filter(s, lambda x: x["kind"] < len(BASE_RULES))
    return found.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)], F.sha2(_listed(base, RULES), 256).alias("base_sha256"), _listed(s, RULES).alias("spans"))


_CHUNK = 4096


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span, or run of overlapping spans, replaced by ``mark``; all other columns stay, whatever their names."""
    name = unused(docs, "spans")
    found = find_secrets(docs, name=name)
    t, spans = F.col("text"), F.col(name)

    def piece(chunks: Column, a: Column, b: Column) -> Column:
        """Code points a to b of the text, from its chunks, so that no piece reads the whole text."""
        i, j = F.floor(a / _CHUNK).cast("int"), F.floor((b - 1) / _CHUNK).cast("int")
        at = (a % _CHUNK + 1).cast("int")
        inside = F.substring(chunks[i], at, (b - a).cast("int"))
        across = F.concat(F.substring(chunks[i], at, F.lit(_CHUNK)), F.array_join(F.slice(chunks, i + 2, j - i - 1), ""), F.substring(chunks[j], F.lit(1), (b - j * _CHUNK).cast("int")))
        return F.when(b <= a, F.lit("")).when(i == j, inside).otherwise(across)

    def clean(chunks: Column) -> Column:
        reach = running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))

        def joined(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0).cast("long")), ends)
            parts = F.zip_with(spans, F.slice(before, 1, F.size(ends)), lambda s, a: F.when(s["start"] >= a, F.concat(piece(chunks, a, s["start"]), F.lit(mark))).otherwise(F.lit("")))
            return F.concat(F.array_join(parts, ""), piece(chunks, F.element_at(ends, -1), F.length(t).cast("long")))

        return bind(reach, joined)

    whole = bind(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)), clean)
    return found.withColumn("text", F.when(F.size(spans) > 0, whole).otherwise(t)).select(*docs.columns)
