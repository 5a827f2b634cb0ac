"""The pipeline's stages against brute force, each on its own input."""

import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline as cp
from ledgerloom.llm import quality, secrets
from ledgerloom.llm.queries import table, tokenizer_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    named = dict(cp.STAGES)
    assert list(named) == ["quality rules", "near-duplicates", "repeated passages", "secret scans", "packing"]
    one = named["quality rules"](spark, docs, SMALL).cache()
    assert one.columns == docs.columns
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, table(spark, SMALL, "labels")).collect()}
    assert set(texts(one)) == {d for d, k in verdict.items() if k} and texts(one).items() <= texts(docs).items()

    two = named["near-duplicates"](spark, one, SMALL).cache()
    assert two.columns == docs.columns
    before = texts(one)
    sets, root = {d: shingles(t) for d, t in before.items()}, {d: d for d in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(texts(two)) == {d for d in ids if find(d) == d}

    three = named["repeated passages"](spark, two, SMALL).cache()
    assert three.columns == docs.columns
    least, before, after = {}, texts(two), texts(three)
    for d, t in before.items():
        b = t.encode()
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(least.get(b[i : i + 50], d), d)
    for d, t in before.items():
        b, gone = t.encode(), set()
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < d:
                gone.update(range(i, i + 50))
        out, at = [], 0
        for ch in t:
            n = len(ch.encode())
            out.append("" if all(k in gone for k in range(at, at + n)) else ch)
            at += n
        assert after[d] == "".join(out)
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect())

    four = named["secret scans"](spark, three, SMALL).cache()
    assert four.columns == docs.columns and set(texts(four)) == set(after)
    for d, t in texts(four).items():
        spans = [m for r in secrets.RULES for m in re.finditer(r.pattern, after[d], re.ASCII) if len(m[r.group]) >= r.least]
        assert (t != after[d]) == bool(spans) and all(m[0] not in t for m in spans)

    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    pieces = defaultdict(int)
    fill = Counter()
    for r in named["packing"](spark, four, SMALL).collect():
        pieces[r["doc_id"]] += r["length"]
        fill[r["sequence_id"]] += r["length"]
    assert pieces == {d: len(lib.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(four).items()}
    assert sorted(fill) == list(range(len(fill))) and all(fill[i] == 2048 for i in range(len(fill) - 1))


def test_run_is_the_stages_in_turn(spark):
    got = cp.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert np.all([r["length"] > 0 for r in got.collect()])


CLASHING = {
    "number": "1", "sha": "'x'", "row": "doc_id", "block": "2", "rows": "array(1)", "part": "3", "data": "binary('d')", "m": "map('a', doc_id)", "v": "parse_json('[1]')", "t": "timestamp '2024-01-01 00:00:00'", "deep": "named_struct('q', map('k', array(1)))",
}


def test_stages_with_odd_rows(odd_docs, no_docs, spark):
    """Columns of all types under the names that operators use themselves, with repeated ids and without; what stays is unchanged."""
    odd = odd_docs.selectExpr("doc_id", "text", "component_id", "spans", *[f"{x} AS {k}" for k, x in CLASHING.items()])
    unique = odd.filter("doc_id > 0").dropDuplicates(["doc_id"])
    shown = [*odd.columns[2:11], "to_json(m)", "to_json(v)", "CAST(t AS STRING)", "to_json(deep)"]
    for docs in (odd, unique, no_docs.selectExpr("doc_id", "text", "component_id", "spans", *[f"{x} AS {k}" for k, x in CLASHING.items()])):
        before = Counter((r["doc_id"], str(r)) for r in docs.selectExpr("doc_id", *shown).collect())
        texts_before = Counter(map(tuple, docs.select("doc_id", "text").collect()))
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns and [f.dataType.typeName() for f in out.schema] == [f.dataType.typeName() for f in docs.schema], name
            after = Counter((r["doc_id"], str(r)) for r in out.selectExpr("doc_id", *shown).collect())
            assert after == before if name in ("repeated passages", "secret scans") else after <= before, name
            if name in ("quality rules", "near-duplicates"):
                kept = Counter(map(tuple, out.select("doc_id", "text").collect()))
                assert kept <= texts_before and (not before or kept), name
        pieces = cp.STAGES[-1][1](spark, docs, SMALL).groupBy("doc_id").count().count()
        assert pieces == len({d for d, *_ in before})


def test_character_counts_follow_the_text(spark):
    """``n_chars`` is counted anew where it is a column, and not added where it is none."""
    docs = spark.createDataFrame([(1, "x" * 60 + " a", 7), (2, "x" * 60 + " b", 7), (3, None, 7)], "doc_id long, text string, n_chars int")
    for name in ("repeated passages", "secret scans"):
        stage = dict(cp.STAGES)[name]
        out = stage(spark, docs, SMALL)
        assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
        assert stage(spark, docs.drop("n_chars"), SMALL).columns == ["doc_id", "text"]


def test_near_duplicates_are_dropped_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, b + " more"), (None, a), (None, a), (5, None), (5, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(cp.STAGES)["near-duplicates"](spark, docs, SMALL)
    assert out.columns == docs.columns
    want = [(1, a), (2, b), (3, c), (None, a), (None, a), (5, None), (5, "")]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(want)
