"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import spelling
from ledgerloom.llm.queries import queries, table

SMALL = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_counts(rows, shortest=5, least=3):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            if len(run) >= shortest:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= least}


def brute_near(words):
    """By words with one letter left out, or hidden."""
    by = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i] + "?" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                by[w, i] |= {w, w[:i] + w[i + 1 :]}
    near = defaultdict(set)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(rows):
    words = brute_counts(rows)
    near, form = brute_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = Counter()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, n, len(near[w]), words.get(form[w])] += 1
    return out


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_query_on_a_small_table(spark):
    got = queries()["op13_spelling_variants"](spark, SMALL)
    assert got.columns == COLUMNS
    want = brute(rows_of(table(spark, SMALL, "documents")))
    assert Counter(map(tuple, got.collect())) == want
    assert any(k[1] for k in want) and any(k[2] not in (k[0], k[1]) for k in want)


@pytest.mark.parametrize("sizes", [{"CELL": 20, "LEAF": 4, "VISITORS": 30, "HELD": 50, "PIECE": 40}, {"CELL": 200, "SAMPLE": 9}])
def test_small_cells_change_no_result(spark, sizes, monkeypatch):
    """Many cells, split cells, small leaves, texts read in pieces."""
    for k, v in sizes.items():
        monkeypatch.setattr(spelling, k, v)
    docs = table(spark, SMALL, "documents").filter("doc_id < 120")
    assert Counter(map(tuple, spelling.spelling_variants(docs).collect())) == brute(rows_of(docs))


def test_odd_rows(spark, odd_docs, no_docs):
    """Null, empty and long texts, null ids, repeated rows, words of one letter, anagrams, letters past z, signs between them."""
    r = random.Random(3)
    more = ["a" * 2000 + " " + "a" * 1999, "ÀÿÉ×÷ß" * 2 + " éàçöü éàçöu", " ".join("".join(r.sample("abcdefg", 7)) for _ in range(400)), "Hello hello HELLO hallo hallo hallo hullo", None, ""]
    extra = spark.createDataFrame([(t, i, "c", "s", 1, 7) for t in more for i in (None, 1, 1, 2)], odd_docs.schema)
    docs = odd_docs.unionByName(extra).withColumnRenamed("n", "n").withColumnRenamed("spans", "word")
    assert Counter(map(tuple, spelling.spelling_variants(docs).collect())) == brute(rows_of(docs))
    assert spelling.spelling_variants(no_docs).count() == 0


def test_one_edit_and_its_bounds():
    """Pairs one edit apart are at most two apart in letter counts, as in their signatures; order decides the rest."""
    r = random.Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.choice((6, 7)))) for _ in range(600)})
    near = brute_near(set(words))
    by = {k: [w for w in words if len(w) == k] for k in (6, 7)}
    found = Counter()
    for a in by.values():
        for b in by.values():
            for v, w in spelling.near_pairs(a, b, most=500):
                found.update((b[x], a[y]) for x, y in zip(v, w, strict=True))
    assert found == Counter((a, b) for a in words for b in near[a])
    counts = spelling.letter_counts(words)
    sign = spelling.signatures(counts)
    i, j = np.random.default_rng(1).integers(0, len(words), (2, 5000))
    assert (np.bitwise_count(sign[i] ^ sign[j]) <= np.abs(counts[i] - counts[j]).sum(1)).all()


def test_boxes_out_of_reach_hold_no_near_word():
    r = np.random.default_rng(2)
    counts = r.poisson(0.6, (900, spelling.PLACES)).astype(np.int32)
    tree = spelling.grow(counts, np.arange(900), 10)
    for up, down in ((1, 1), (1, 0), (0, 1), (0, 0)):
        met = np.zeros((900, 900), bool)
        for leaf, rows in spelling.reach(tree, counts, up, down):
            met[np.ix_(rows, leaf)] = True
        more, less = np.maximum(counts[None] - counts[:, None], 0).sum(2), np.maximum(counts[:, None] - counts[None], 0).sum(2)
        assert met[(more <= up) & (less <= down)].all()
        assert met.mean() < 0.5


def test_long_chains_have_one_root(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w30")]
    assert {tuple(r) for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()} == {(w, "w37") for w, _ in rows}
