"""The language model, toxicity, token counts and top-k search against brute force or held-out rows."""

import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import classlm, counts, mtree, toxicity
from ledgerloom.llm.queries import table, tokenizer_path

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["odd", "small"])
def docs(request, spark, odd_docs):
    return odd_docs if request.param == "odd" else table(spark, SMALL, "documents")


def test_class_lm_base_figures(docs):
    rows = [(r["doc_id"], [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")), None]) for r in docs.select("doc_id", "text").collect()]
    out = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    seen = Counter(w for d, ws in rows if not out(d) for w in ws)
    n, v = sum(seen.values()), len(seen)
    want = Counter((d, out(d), len(ws), sum(seen[w] > 0 for w in ws), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), 5)) for d, ws in rows)
    got = classlm.class_lm_scores(docs, part_bytes=1 << 16).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_class_lm_score_by_brute_force(docs):
    """Counts, transitions, emissions and scores anew from the words' classes; both scores sum to one over known words and one unknown."""
    import pyarrow as pa

    rows = [(r["doc_id"], [*(w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))), b""]) for r in docs.select("doc_id", "text").collect()]
    model = classlm.train_classes(docs.select(docs["doc_id"].cast("long"), "text"), 7, 2, classlm.CLASSES, classlm.HEAD, 50, classlm.GAIN, 1 << 16)
    told = {(r["block"], r["part"]): r["data"] for r in model.answers.filter("kind = 1").collect()}
    of = {}
    for r in model.blocks.toArrow().to_pylist():
        one = pa.Table.from_pylist([r], schema=model.blocks.limit(0).toArrow().schema)
        t = classlm.Tokens(one, model.parts)
        for part, a, b in t.parts:
            of.update(zip(t.hash[a:b].tolist(), told[r["block"], part], strict=True))
    cls = {w: of[int(h)] for w in {w for _, ws in rows for w in ws} for h in classlm.hash_words([w])}
    train = [ws for d, ws in rows if not classlm.held_out(d, 7, 2)]
    count = Counter(w for ws in train for w in ws)
    m = Counter((cls[v], cls[w]) for ws in train for v, w in zip([b"", *ws], ws))
    tokens, kinds = Counter(cls[w] for ws in train for w in ws), Counter(cls[w] for w in count)
    before = Counter()
    for (a, _), n in m.items():
        before[a] += n
    once, twice = (sum(n == k for n in count.values()) for k in (1, 2))
    d = {c: 0.0 if c == 0 else min(0.9, max(0.1, once / (once + 2 * twice))) for c in tokens}
    total = sum(tokens.values())
    move = lambda a, c: tokens[c] / total if a is None else (m[a, c] + classlm.STRENGTH * tokens[c] / total) / (before[a] + classlm.STRENGTH)
    emit = lambda w: (count[w] - d[cls[w]]) / tokens[cls[w]]
    unknown = lambda a: sum(move(a, c) * d[c] * kinds[c] / tokens[c] for c in tokens)
    for a in (None, 0, cls[max(count, key=count.get)]):
        assert math.isclose(sum(move(a, cls[w]) * emit(w) for w in count) + unknown(a), 1, rel_tol=1e-9)
    want = Counter()
    for doc, ws in rows:
        score, a = 0.0, 0
        for w in ws:
            score += math.log10(move(a, cls[w]) * emit(w) if count[w] else unknown(a))
            a = cls[w] if count[w] else None
        want[doc, round(score, 4)] += 1
    got = classlm.class_lm_scores(docs, part_bytes=1 << 16).collect()
    assert Counter((r["doc_id"], round(r["score"], 4)) for r in got) == want
    assert all(x <= y for x, y in zip(model.rises, model.rises[1:-1]))


def test_class_lm_beats_the_base_on_held_out_rows(spark):
    got = classlm.class_lm_scores(table(spark, MORE, "documents")).filter("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert got[0] > 0.85 * got[1]


def test_exchange_finds_the_two_sides():
    """Words that alternate between two sets end in two classes."""
    r = np.random.default_rng(4)
    pairs = np.zeros((22, 22))
    side = [0, *[1 + i % 2 for i in range(20)]]
    for _ in range(20000):
        a, b = r.integers(1, 21, 2)
        if side[a] != side[b]:
            pairs[a, b] += 1
    of = classlm.exchange(pairs, 0, 3)
    assert of[0] == 0 and len({of[i] for i in range(1, 21, 2)}) == 1 and len({of[i] for i in range(2, 21, 2)}) == 1 and of[1] != of[2]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, MORE, "documents"), table(spark, MORE, "labels")
    got = toxicity.toxicity(docs, labels.filter("doc_id % 3 <> 0"))
    got = got.join(labels.filter("doc_id % 3 = 0").selectExpr("doc_id", "toxic AS label"), "doc_id").collect()
    assert all(0 <= r["severity"] <= 1 and r["toxic"] == (r["p_toxic"] >= 0.5) for r in got)
    assert np.mean([r["toxic"] for r in got if r["label"] == 0]) < 0.05
    assert np.mean([r["toxic"] for r in got if r["label"] == 1]) > 0.6


def test_cumulative_link_recovers_grades():
    r = np.random.default_rng(6)
    n, f = 3000, 30
    w = r.normal(size=f)
    x = r.random((n, f)) < 0.3
    z = x @ w + r.logistic(size=n) * 0.3
    grade = np.searchsorted(np.quantile(z, [0.5, 0.7, 0.9]), z)
    doc, feature = np.nonzero(x)
    m = toxicity.CumulativeLink.fit(doc, feature, np.ones(len(doc)), grade, rounds=300, decay=1e-5)
    assert (np.diff(m.cuts) > 0).all()
    severity = m.above(np.bincount(doc, weights=m.weights[feature], minlength=n)).sum(1)
    assert np.corrcoef(severity, grade)[0, 1] > 0.85


def test_toxicity_by_brute_force(docs, spark):
    """Severities of all rows from the trained weights, one word at a time; three grades and so two thresholds."""
    labels = spark.createDataFrame([(i, (0, 0, 1, 3)[i % 4]) for i in range(300)] + [(2, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, 8000)
    assert model.values.tolist() == [0, 1, 3] and len(model.link.cuts) == 2 and (np.diff(model.link.cuts) > 0).all()
    want = Counter()
    number = lambda w, n: int((toxicity.mix(toxicity.hash_words([w]) + np.uint64(n)) & np.uint64((1 << toxicity.BITS) - 1))[0])
    for r in docs.select("doc_id", "text").collect():
        bare = [w.lower().strip(toxicity._STRIP) for w in (r["text"] or "").encode().split()]
        counts_ = Counter(number(w[: n or None], n) for w in bare for n in (0, *toxicity.BEGINNINGS))
        z = sum(float(model.link.weights[f]) * math.log1p(c) for f, c in counts_.items())
        above = [1 / (1 + math.exp(min(40, max(-40, c - z)))) for c in model.link.cuts]
        p = [1 - above[0], above[0] - above[1], above[1]]
        want[r["doc_id"], round(p[1] + 3 * p[2], 4), round(above[0], 4)] += 1
    got = toxicity.toxicity(docs, labels).collect()
    assert Counter((r["doc_id"], round(r["severity"], 4), round(r["p_toxic"], 4)) for r in got) == want
    again = toxicity.toxicity(docs.repartition(7), labels).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got), "the sample does not depend on the rows' order"


def test_toxicity_odd_rows(odd_docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(odd_docs, labels).count() == odd_docs.count()
    assert {r["severity"] for r in toxicity.toxicity(odd_docs, labels.filter("toxic = 0")).collect()} == {0.0}


def test_token_counts(docs):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    pieces = counts.read_pieces(tokenizer_path("piece_bpe_32k.model"))
    t = Tokenizer(models.Unigram(pieces, 0, False))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex("[ \\t-\\r]+"), "removed"), pre_tokenizers.Metaspace(prepend_scheme="always", split=False)])
    want = Counter((r["doc_id"], len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.select("doc_id", "text").collect())
    got = Counter((r["doc_id"], r["n_tokens"]) for r in counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model")).collect())
    assert got == want


def test_token_counts_with_ties():
    from tokenizers import Tokenizer, models

    r = np.random.default_rng(8)
    pieces = [("<unk>", 0.0)] + [(p, -float(s)) for p, s in (("▁", 1), ("a", 2), ("b", 2), ("ab", 4), ("ba", 4), ("aab", 5), ("bb", 3), ("▁a", 3))]
    lib, own = Tokenizer(models.Unigram(pieces, 0, False)), counts.UnigramCounter(pieces)
    for _ in range(500):
        w = "▁" + "".join(r.choice(list("aabbx"), r.integers(1, 12)))
        assert own.count_word(w) == len(lib.encode(w, add_special_tokens=False).ids), w


def brute_top(rows, k):
    x = [(d, [math.floor(256 * Fraction(c)) for c in v]) for d, v in rows if d is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = Counter()
    for i, (q, v) in enumerate(x):
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), d) for j, (d, w) in enumerate(x) if j != i and len(w) == len(v))[:k]
            out.update((q, r, d, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, d) in enumerate(best, 1))
    return out


def test_top_k_small(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, MORE, "embeddings").collect()]
    want = brute_top(rows, 5)
    for part in (60, 16384):
        assert Counter(tuple(r) for r in mtree.top_k(table(spark, MORE, "embeddings"), part_rows=part, query_rows=4).collect()) == want


def test_top_k_odd_rows(spark):
    r = np.random.default_rng(9)
    rows = [(i, [float(x) for x in r.integers(-2, 3, 4) / 4], "x") for i in range(160)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], "y") for i in range(160, 260)]
    rows += [(300, None, "z"), (301, [1.0, None, 0.0, 0.0], "z"), (302, [float("nan"), 1.0, 1.0, 1.0], "z"), (303, [float("inf")] * 4, "z"), (None, [1.0] * 4, "z")]
    rows += [(350, [], "z"), (351, [], "z"), (400, [1.0, 1.0], "z"), (0, rows[0][1], "again"), (0, rows[0][1], "again"), (50, [0.25, -0.5, 0.0, 1.0], "other vector")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    for part, routing in ((30, 512), (1000, 512), (20, 2)):
        assert Counter(tuple(x) for x in mtree.top_k(df, part_rows=part, query_rows=2, routing=routing).collect()) == brute_top([x[:2] for x in rows], 5)
    assert mtree.top_k(df.limit(0)).count() == 0
    assert mtree.top_k(df.filter("vec_id = 1")).count() == 0


@pytest.mark.parametrize("size", [9e6, 3e15, 1e30, 1e300])
def test_top_k_large_components(spark, size):
    """Scores are exact integers; beyond 64 bits they are ranked exactly and shown as the nearest long."""
    r = np.random.default_rng(12)
    rows = [(i, [float(x) for x in r.normal(size=3) * size]) for i in range(120)] + [(200, [1.7e308, 1.0, 2.0]), (201, [0.5, 9e6, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(x) for x in mtree.top_k(df, part_rows=40).collect()) == brute_top(rows, 5)


def test_m_tree_skips_and_stays_exact():
    r = np.random.default_rng(10)
    centre = r.normal(size=(30, 16)) * 400
    x = np.floor(centre[r.integers(0, 30, 4000)] + r.normal(size=(4000, 16)) * 8)
    tree = mtree.MTree(x)
    got = tree.search(x[:40], 5, [[j] for j in range(len(x))], list(range(40)))
    scores = x[:40].astype(int) @ x.astype(int).T
    for i in range(40):
        assert got[i] == sorted((-int(s), j) for j, s in enumerate(scores[i]) if j != i)[:5]
    assert tree.computed < 0.1 * 40 * len(x)


def test_regions_are_skipped(spark):
    """With vectors in groups, queries ask few of the trees."""
    r = np.random.default_rng(13)
    centre = r.normal(size=(20, 8)) * 10
    rows = [(i, [float(x) for x in centre[i % 20] + r.normal(size=8) * 0.05]) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = spark.sparkContext.accumulator(0)
    real = mtree._meet

    def counted(k, scale):
        run = real(k, scale)

        def meet(trees, asks):
            asked.add(asks.num_rows)
            return run(trees, asks)

        return meet

    mtree._meet = counted
    try:
        got = mtree.top_k(df, part_rows=100).collect()
    finally:
        mtree._meet = real
    assert Counter(map(tuple, got)) == brute_top(rows, 5)
    assert asked.value < 0.5 * 40 * 20


def test_computed_distances_on_the_given_vectors(spark):
    """The given vectors are nearly orthogonal: what the tree can skip of them is little, and it computes each distance once at most."""
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").collect()
    x = np.floor(256 * np.array([r["embedding"] for r in rows], float)) / 256
    at = [i for i, r in enumerate(rows) if r["vec_id"] % 50 == 0]
    tree = mtree.MTree(x, 256)
    tree.search(x[at], 5, [[r["vec_id"]] for r in rows], [rows[i]["vec_id"] for i in at])
    assert tree.computed <= len(at) * (1.05 * len(x) + 1)


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for df in (classlm.class_lm_scores(no_docs), toxicity.toxicity(no_docs, labels), counts.token_counts(no_docs, tokenizer_path("piece_bpe_32k.model"))):
        assert df.count() == 0
