"""Operators on texts against brute force, on odd rows and on a small table."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import bpe, neardup, packing, quality, secrets, suffixes
from ledgerloom.llm.queries import table, tokenizer_path

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["odd", "small"])
def docs(request, spark, odd_docs):
    return odd_docs if request.param == "odd" else table(spark, SMALL, "documents")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def as_counter(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_quality_base_figures(docs, spark):
    def base(text):
        t = text or ""
        w = WORD.findall(t)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed

    got = quality.quality_rules(docs, table(spark, SMALL, "labels"), train_docs=60).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *[r[n] for n in names]) for r in got) == Counter((d, *base(t)) for d, t in rows_of(docs))
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_line_labels_agree_with_all_paths():
    r = np.random.default_rng(1)
    crf = quality.LineCRF(r.normal(size=(quality.N_FEATURES, 2)), r.normal(size=(2, 2)))
    for n in range(1, 9):
        ids = r.integers(0, quality.N_FEATURES, (n, 4)).astype(np.int32)
        e = crf.weights[ids].sum(1)
        score = lambda p: sum(e[i, x] for i, x in enumerate(p)) + sum(crf.moves[a, b] for a, b in zip(p, p[1:]))
        best = max(((k >> np.arange(n)) & 1 for k in range(2**n)), key=score)
        assert list(crf.decode(ids, np.zeros(n, int))) == list(best)


def line_features(text):
    """Words and feature numbers of each line with a word, read off one line at a time."""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    out, at, known = [], 0, set()
    for line in text.split("\n"):
        w = WORD.findall(line)
        if not w:
            continue
        chars = sum(map(len, w))
        value = {k: sum(x in v for x in line.encode()) / chars for k, v in quality._CLASSES.items()}
        value["words"], value["wordlen"], value["seen"] = len(w), chars / len(w), line in known
        value["repeats"] = sum(k in hit for k in range(at, at + len(w))) / len(w)
        value["echo"] = sum(a == b for a, b in zip(w, w[1:])) / len(w)
        value["notice"] = bool(re.search("(?<![a-z0-9\x80-\U0010ffff])(" + "|".join(x.decode() for x in quality._NOTICE) + ")(?![a-z0-9\x80-\U0010ffff])", re.sub("[A-Z]", lambda m: m[0].lower(), line)))
        out.append((len(w), [0, *[quality._OFFSETS[k] + sum(value[k] >= x for x in bands) for k, bands in quality._BANDS.items()]]))
        at += len(w)
        known.add(line)
    return out


def test_quality_verdicts_by_brute_force(docs, spark):
    """``kept`` and ``content_words`` of every row, from the trained weights, with lines read and decoded one at a time."""
    labels = table(spark, SMALL, "labels")
    crf = quality.train(docs, labels, 60)
    want = Counter()
    for d, t in rows_of(docs):
        lines, score, back = line_features(t or ""), None, []
        for _, ids in lines:
            e = crf.weights[ids].sum(0)
            if score is None:
                score = list(e)
            else:
                back.append([max((1, 0), key=lambda a: score[a] + crf.moves[a, b]) for b in (0, 1)])  # noqa: B023
                score = [score[back[-1][b]] + crf.moves[back[-1][b], b] + e[b] for b in (0, 1)]
        label = [max((1, 0), key=lambda a: score[a])] if lines else []  # noqa: B023
        for step in reversed(back):
            label.append(step[label[-1]])
        content = sum(n for (n, _), x in zip(lines, reversed(label), strict=True) if x)
        words = sum(n for n, _ in lines)
        want[d, content, content >= 0.5 * words] += 1
    got = quality.quality_rules(docs, labels, train_docs=60).collect()
    assert Counter((r["doc_id"], r["content_words"], r["content_words"] >= 0.5 * r["n_words"]) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"] and r["content_words"] >= 0.5 * r["n_words"]) for r in got)


def test_quality_verdicts_hold_out(spark):
    d = "/root/testdata/sf0.01"
    got = quality.quality_rules(table(spark, d, "documents"), table(spark, d, "labels"), train_docs=200)
    got = got.join(table(spark, d, "labels"), "doc_id").filter("NOT base_failed").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_lines_of_one_text_get_mixed_labels(spark):
    """Menus and decorated lines set between the two halves of good texts are boilerplate; the prose round them is content."""
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    crf = quality.train(docs, labels, 200)
    texts = [r["text"] for r in docs.join(labels.filter("quality = 1"), "doc_id").orderBy("doc_id").collect() if 6 <= len(r["text"].split("\n")) <= 40 and len(set(r["text"].split("\n"))) == len(r["text"].split("\n"))][:60]
    menu = ["Home | Products | Login | Cart | *** | Help", "# Search $$$ | <<< | About & Jobs | ###", "** Sign in ** | Menu | >>> | Next & Last |"]
    right = total = mixed = 0
    for t in texts:
        lines = t.split("\n")
        half = len(lines) // 2
        _, doc, _, ids = quality.measure(["\n".join([*lines[:half], *menu, *lines[half:]]).encode()])
        label = crf.decode(ids, doc)
        want = np.array([1] * half + [0] * 3 + [1] * (len(lines) - half))
        right, total, mixed = right + (label == want).sum(), total + len(want), mixed + (0 < label.sum() < len(label))
    assert len(texts) > 20 and mixed > 0.9 * len(texts) and right > 0.9 * total, (len(texts), mixed, right, total)


def test_marginals_agree_with_all_paths():
    r = np.random.default_rng(4)
    crf = quality.LineCRF(r.normal(size=(quality.N_FEATURES, 2)), r.normal(size=(2, 2)))
    doc = np.repeat([0, 1, 2, 3], [1, 4, 7, 2])
    ids = r.integers(0, quality.N_FEATURES, (len(doc), 3)).astype(np.int32)
    p, q = crf.marginals(ids, doc)
    e, row = crf.weights[ids].sum(1), 0
    for k in range(4):
        at = np.flatnonzero(doc == k)
        paths = [(z >> np.arange(len(at))) & 1 for z in range(2 ** len(at))]
        weight = np.exp([sum(e[i, x] for i, x in zip(at, z)) + sum(crf.moves[a, b] for a, b in zip(z, z[1:])) for z in paths])
        weight /= weight.sum()
        for j, i in enumerate(at):
            assert np.isclose(p[i, 1], sum(w for w, z in zip(weight, paths) if z[j]))
            if j:
                assert np.isclose(q[row, 1, 0], sum(w for w, z in zip(weight, paths) if z[j - 1] == 1 and z[j] == 0))
                row += 1


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, k):
    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    rows = rows_of(docs)
    sets = {d: shingles(t) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = Counter((d, len(shingles(t)), None if d is None else find(d), d is None or find(d) == d) for d, t in rows)
    assert as_counter(neardup.near_duplicates(docs, k, 80), "doc_id", "n_shingles", "component_id", "kept") == want


def test_two_texts_of_one_id_are_two_nodes(spark):
    """Texts 5a and 7a are near, as are 3 and 7b; the classes do not merge through the id 7."""
    a, b = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    rows = [(5, a), (7, a + " tail"), (3, b), (7, b + " tail"), (7, "a text of its own"), (7, a + " tail"), (None, a), (9, None)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter(map(tuple, got)) == Counter([(5, 59, 5, True), (7, 60, 5, False), (3, 59, 3, True), (7, 60, 3, False), (7, 4, 7, True), (7, 60, 5, False), (None, 59, None, True), (9, 0, 9, True)])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 30)] + [(70, 71), (71, 70)]
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(101, 141), 100), **dict.fromkeys(range(6, 30), 5), 71: 70}


def test_members_of_one_bucket_in_other_components_meet():
    """Blocks judge what the bucket's smallest member did not link, in the first bucket that a pair shares, once connected no more."""
    import pyarrow as pa

    n, sets = neardup.BANDS * neardup.ROWS, {10: range(50), 11: range(100, 150), 12: range(102, 151), 13: range(103, 150), 20: range(9), 21: range(9)}
    rows = [(7, 0, 0, 0, d, len(sets[d]), d) for d in (10, 11, 12, 13)] + [(8, 0, 1, 0, 20, 9, 20), (8, 0, 1, 1, 21, 9, 21), (9, 0, 0, 0, 11, 50, 11), (9, 0, 0, 0, 12, 49, 12)]
    bands = [[8 if d in (20, 21) else 7, 9 if d in (11, 12) else d] + [1000 * d + k for k in range(neardup.BANDS - 2)] for _, _, _, _, d, _, _ in rows]
    low = [[1 if d == 10 else 2] * n for _, _, _, _, d, _, _ in rows]
    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)]
    batch = pa.RecordBatch.from_arrays([*cols, pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.list_(pa.int8()))], neardup._NAMES)
    kept = list(neardup._with_candidates(80)([batch]))
    assert [b.column("node").to_pylist() for b in kept] == [[11, 12, 13], [20, 21]]
    full = [pa.RecordBatch.from_arrays([*b.columns, pa.array([list(sets[d]) for d in b.column("node").to_pylist()], pa.list_(pa.int64()))], [*neardup._NAMES, "items"]) for b in kept]
    out = [(u, v) for b in neardup._links_in_groups(80)(iter(full)) for u, v in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert out == [(11, 12), (11, 13), (20, 21)]


@pytest.mark.parametrize("span", [50, 25])
def test_repeated_passages(docs, span):
    rows = rows_of(docs)
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - span + 1) if d is not None else ():
            s = b[i : i + span]
            least[s] = min(least.get(s, d), d)
    want = Counter()
    for d, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - span + 1) if d is not None else ():
            if least[b[i : i + span]] < d:
                mark[i : i + span] = b"\x01" * span
        spans = len([x for x in bytes(mark).split(b"\x00") if x])
        want[d, len(b), sum(mark), spans, hashlib.sha256(bytes(c for c, m in zip(b, mark) if not m)).hexdigest()] += 1
    assert as_counter(suffixes.repeat_digests(docs, span), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_transform_groups_equal_strings():
    r = np.random.default_rng(2)
    for _ in range(60):
        span = int(r.integers(2, 7))
        frags = list({bytes(r.choice(list(b"ab"), r.integers(span, span + 9)).astype(np.uint8)) for _ in range(r.integers(1, 30))})
        seen = defaultdict(set)
        f, s, g = suffixes.transform(frags, span)
        for a, b, c in zip(f, s, g, strict=True):
            seen[c].add(frags[a][b : b + span])
        assert all(len(x) == 1 for x in seen.values()) and len({next(iter(x)) for x in seen.values()}) == len(seen)
        assert len(f) == sum(len(x) - span + 1 for x in frags)


def test_a_repeat_that_no_partition_answers(spark):
    same = "A passage of more than fifty bytes that two documents of one block share."
    rows = spark.createDataFrame([(1, same), (2, same)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffixes.repeat_digests(rows, 50).collect()}
    assert got == {1: (0, 0), 2: (len(same), 1)}


def test_no_partition_holds_a_hot_anchor(spark):
    r = np.random.default_rng(3)
    passage = "".join(r.choice(list("abcdefghij"), 80))
    rows = [(i, "".join(r.choice(list("klmnopqrst"), 60)) + passage + "".join(r.choice(list("uvwxyz"), 60))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def largest(hot):
        held = Counter()
        for x in suffixes.ask_blocks(docs, 50, part_bytes=1 << 10, hot=hot)[2].collect():
            held[x["part"]] += x["kind"] == 1 and int(np.frombuffer(x["data"], "<i8", 1)[0])
        return max(held.values())

    whole, dealt = largest(1 << 60), largest(64)
    assert whole > 1500 and dealt < 600, (whole, dealt)
    names = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    got = suffixes.repeat_digests(docs, 50, hot=64).collect()
    assert as_counter(suffixes.repeat_digests(docs, 50), *names) == Counter(tuple(x[n] for n in names) for x in got)
    assert all((x["n_removed"] >= 80) == (x["doc_id"] > 0) for x in got)


@pytest.mark.parametrize("hot", [0, 2])
def test_hot_anchors_change_no_result(docs, hot):
    names = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    assert as_counter(suffixes.repeat_digests(docs, 50, hot=hot), *names) == as_counter(suffixes.repeat_digests(docs, 50), *names)


def test_cut_texts_keep_whole_characters(spark):
    same = "é" * 40
    rows = [(1, f"a{same}b", "k"), (2, f"c{same}d", "k"), (3, None, "k")]
    out = {r["doc_id"]: r["text"] for r in suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 50).collect()}
    assert out == {1: rows[0][1], 2: "cd", 3: None}


def test_cut_texts_keep_their_rows_and_columns(odd_docs):
    """Columns with clashing names stay; rows with one id and two texts do not count against each other."""
    want = Counter(tuple(r[c] for c in odd_docs.columns if c != "text") for r in odd_docs.collect())
    got = suffixes.remove_repeats(odd_docs, 50)
    assert got.schema == odd_docs.schema and Counter(tuple(r[c] for c in odd_docs.columns if c != "text") for r in got.collect()) == want
    same = "One passage of more than fifty bytes that stands in three rows of two documents."
    rows = odd_docs.sparkSession.createDataFrame([(1, f"a {same}"), (1, f"b {same}"), (2, f"c {same}")], "doc_id long, text string")
    assert sorted(r["text"] for r in suffixes.remove_repeats(rows, 50).collect()) == [f"a {same}", f"b {same}", "c"]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_codec(docs):
    t = library()
    want = Counter()
    for d, x in rows_of(docs):
        ids = t.encode(x or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    path = tokenizer_path()
    assert as_counter(bpe.bpe_digests(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    two = bpe.decode_documents(bpe.encode_documents(docs, path), path).collect()
    assert Counter((r["doc_id"], r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest()) for r in two) == want


def test_bpe_words_by_the_library():
    t, m = library(), bpe.word_bpe(tokenizer_path())
    r = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzetaoinsrhéüß!?-0123456789")
    for _ in range(4000):
        w = "".join(r.choice(letters, r.integers(1, 25)))
        assert np.frombuffer(m.encode(w.encode()), "<u4").tolist() == t.encode(w, add_special_tokens=False).ids, w


def test_packing(docs):
    t = library()
    want = defaultdict(list)
    for d, x in rows_of(docs):
        want[d].append([*t.encode(x or "", add_special_tokens=False).ids, 1])
    got = packing.pack(docs, tokenizer_path(), 64).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0 for r in got)
    by_place = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in by_place:
        assert r["sequence_id"] * 64 + r["offset"] == at and r["offset"] + r["length"] <= 64
        at += r["length"]
    stream, i = [int(x) for r in by_place for x in np.frombuffer(r["ids"], "<u4")], 0
    left = {d: sorted(v) for d, v in want.items()}
    while i < len(stream):
        d, n = by_place[0]["doc_id"], by_place[0]["doc_tokens"]
        assert by_place[0]["start"] == 0
        left[d].remove(stream[i : i + n])
        i += n
        while by_place and n > 0:
            n -= by_place[0]["length"]
            by_place.pop(0)
    assert not any(left.values())


def brute_spans(text):
    out = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secret_scan(docs):
    want = Counter()
    show = lambda s: ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in s)
    for d, t in rows_of(docs):
        s = brute_spans(t)
        base = [x for x in s if x[1] < 3]
        want[d, *[sum(x[1] == k for x in base) for k in range(3)], hashlib.sha256(show(base).encode()).hexdigest(), show(s)] += 1
    assert as_counter(secrets.secret_report(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans") == want


def test_redaction(docs):
    want = Counter()
    for d, t in rows_of(docs):
        if t is not None:
            out, at = "", 0
            for a, _, b in brute_spans(t):
                out += t[at:a] + ("[SECRET]" if a >= at else "")
                at = max(at, b)
            t = out + t[at:]
        want[d, t] += 1
    assert as_counter(secrets.redact(docs), "doc_id", "text") == want


def test_redaction_keeps_clashing_columns(spark):
    rows = [(1, "my password = hunter2hunter2hunter2 x", 5, "m", "c"), (1, "clean", 6, "n", "d"), (None, "token: 0123456789abcdef01", 7, None, "e")]
    out = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, spans int, mask string, candidate string"))
    assert out.columns == ["doc_id", "text", "spans", "mask", "candidate"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[2]) == [(1, "my [SECRET] x", 5, "m", "c"), (1, "clean", 6, "n", "d"), (None, "[SECRET]", 7, None, "e")]


def test_a_long_text_with_many_secrets(spark):
    """100,000 hexadecimal words in one text, with overlaps and characters of more than one byte."""
    text = " ".join(f"é{i:016x}" if i % 3 else f"token: {i:016x}" for i in range(100_000))
    docs = spark.createDataFrame([(1, text, 0)], "doc_id long, text string, spans int")
    want = brute_spans(text)
    begin = time.time()
    got = secrets.find_secrets(docs).first()["spans"]
    assert [tuple(x) for x in got] == want
    out, at = [], 0
    for a, _, b in want:
        out.append(text[at:a] + "[SECRET]" if a >= at else "")
        at = max(at, b)
    assert secrets.redact(docs).first()["text"] == "".join(out) + text[at:]
    assert time.time() - begin < 60


def test_trigram_queries():
    q = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert q["hex"] == [] and q["access"] == [{frozenset(["aki", "kia"])}]
    assert q["assign"] == [{frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")}]
    assert {frozenset(["ghp", "hp_"])} <= q["github"][0]


def test_shared_tables_are_dropped_on_request(spark):
    from ledgerloom.llm import store

    held = dict(store._FOLDERS), dict(store._TABLES)
    store._FOLDERS.clear(), store._TABLES.clear()
    try:
        suffixes.repeat_digests(spark.createDataFrame([(1, "one text")], "doc_id long, text string"), 50).collect()
        tables, folders = ([x for xs in held_.values() for x in xs] for held_ in (store._TABLES, store._FOLDERS))
        there = [Path(f.removeprefix("file://")) for f in folders]
        assert tables and any(f.exists() for f in there)
        store.drop_tables(spark)
        assert not any(f.exists() for f in there) and not any(spark.catalog.tableExists(t) for t in tables)
    finally:
        for kept, mine in zip(held, (store._FOLDERS, store._TABLES), strict=True):
            mine.update(kept)


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    path = tokenizer_path()
    for df in (quality.quality_rules(no_docs, labels), neardup.near_duplicates(no_docs), suffixes.repeat_digests(no_docs), bpe.bpe_digests(no_docs, path), packing.pack(no_docs, path), secrets.secret_report(no_docs), secrets.redact(no_docs)):
        assert df.count() == 0
