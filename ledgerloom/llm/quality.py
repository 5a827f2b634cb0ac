"""Quality rules: a linear-chain conditional random field labels lines.

Each line of a document is content or boilerplate. A chain CRF over small binary
line features is decoded by Viterbi; a document is kept when enough of its words
stand in content lines.

The labels speak of documents, so the lines' own labels are hidden and found in turns
with the model, on a bounded number of labelled documents (``train_docs``), whole
texts. At the start lines of good documents are content, but for those that three or
more of the sampled documents share and that read as a notice; lines of bad ones are
boilerplate, but for those that also stand in good ones. A model of single lines and
then the chain relabel lines, the surest first, as far as each document's label lets
them: a good one keeps ``content_share`` of its words in content lines, a bad one
does not. So sequences are mixed, and moves between the labels are learned from them.

Defined results: a null text is an empty one and fails the base rules; repeated
rows get the same verdict each; of rows that share a labelled id one trains; columns
beyond the named ones are ignored; an empty table gives an empty result; with no
labelled rows every line is content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import U64, hash_words, slices, starts_of, texts_of

WINDOW = 8
#: Features of a line, each in bands; a band is one binary feature.
_BANDS = {
    "symbols": (0.001, 0.01, 0.03, 0.1),
    "upper": (0.001, 0.05, 0.3, 0.6),
    "digits": (0.001, 0.03, 0.15),
    "marks": (0.001, 0.01, 0.04, 0.1),
    "stops": (0.001, 0.01, 0.04),
    "words": (1.0, 5.0, 15.0, 60.0),
    "wordlen": (3.0, 4.5, 7.0, 12.0),
    "repeats": (0.001, 0.2, 0.6),
    "echo": (0.001, 0.1, 0.5),
    "seen": (0.5,),
    "notice": (0.5,),
}
_OFFSETS = dict(zip(_BANDS, np.cumsum([1, *[len(v) + 1 for v in _BANDS.values()]])[:-1], strict=True))
N_FEATURES = 1 + sum(len(v) + 1 for v in _BANDS.values())
_CLASSES = {"symbols": b"#*$%&|<>", "digits": b"0123456789", "marks": b"!?{}[]()_=+~^\\/@", "stops": b".,;:", "upper": bytes(range(65, 91))}
#: Words that notices are made of; a line that holds one reads as a notice.
_NOTICE = (b"license", b"licensed", b"licence", b"copyright", b"cookie", b"cookies", b"rights", b"reserved", b"privacy", b"subscribe", b"login", b"menu", b"advertisement")
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(chars)] = 1
    return out


def repeated_words(h: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Marks words that lie in a window found twice or more in their own document."""
    mark = np.zeros(len(h) + 1, np.int32)
    n = len(h) - window + 1
    if n > 0:
        key = np.zeros(n, U64)
        for k in range(window):
            key = key * U64(0x9E3779B97F4A7C15) + h[k : k + n]
        key ^= (doc[:n].astype(U64) + U64(1)) * U64(0xD6E8FEB86659FD93)
        at = np.flatnonzero(doc[:n] == doc[window - 1 :])
        twice = at[pd.Series(key[at]).duplicated(keep=False).to_numpy()]
        np.add.at(mark, twice, 1)
        np.add.at(mark, twice + window, -1)
    return np.cumsum(mark[:-1]) > 0


def _named(lower: bytes) -> np.ndarray:
    """Where the words of ``_NOTICE`` stand in lower-case text."""
    out = []
    for w in _NOTICE:
        at = lower.find(w)
        while at >= 0:
            if not any(c.isalnum() or c >= b"\x80" for c in (lower[at - 1 : at] if at else b"", lower[at + len(w) : at + len(w) + 1])):
                out.append(at)
            at = lower.find(w, at + len(w))
    return np.array(out, np.int64)


def measure(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base figures of each document; then, for lines with a word: document, words, feature ids.

    A line reads as a notice if one of ``_NOTICE`` stands in it, in either case, with no letter or digit beside it."""
    n = len(texts)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    first = starts_of(np.fromiter((len(t) + 1 for t in texts), np.int64, n))[:-1]
    ends = np.flatnonzero(buf == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    line_doc = np.searchsorted(first, begins, side="right") - 1
    space = _SPACE[buf]
    word_at = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    word_line = np.searchsorted(begins, word_at, side="right") - 1
    word_doc = line_doc[word_line]

    def per_line(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, begins).astype(np.int64)

    chars = per_line((~space & ((buf & 0xC0) != 0x80)).astype(np.int32))
    counts = {k: per_line(_lut(v)[buf]) for k, v in _CLASSES.items()}
    words = np.bincount(word_line, minlength=len(begins))
    h = hash_words([w for t in texts for w in t.split()])
    notice = np.zeros(len(begins), bool)
    notice[np.searchsorted(begins, _named(buf.tobytes().lower()), side="right") - 1] = True
    rep = repeated_words(h, word_doc)
    echo = np.zeros(len(h), bool)
    if len(h) > 1:
        echo[1:] = (h[1:] == h[:-1]) & (word_line[1:] == word_line[:-1])
    seen = np.zeros(len(begins), np.int32)
    dup = np.zeros(n, np.int64)
    at = 0
    for d, t in enumerate(texts):
        lines = t.split(b"\n")
        if len(lines) > 1:
            known: set[bytes] = set()
            for i, line in enumerate(lines, at):
                if words[i]:
                    if line in known:
                        seen[i] = 1
                        dup[d] += 1
                    else:
                        known.add(line)
        at += len(lines)

    def per_doc(x: np.ndarray) -> np.ndarray:
        return np.bincount(line_doc, weights=x, minlength=n).astype(np.int64)

    rep_line = np.bincount(word_line, weights=rep, minlength=len(begins))
    figures = {
        "n_words": per_doc(words),
        "word_chars": per_doc(chars),
        "n_symbols": per_doc(counts["symbols"]),
        "n_dup_lines": dup,
        "n_repeat_words": per_doc(rep_line),
    }
    keep = words > 0
    w, c = words[keep], np.maximum(1, chars[keep])
    values = {k: v[keep] / c for k, v in counts.items()}
    values |= {"words": w, "wordlen": c / w, "repeats": rep_line[keep] / w, "echo": np.bincount(word_line, weights=echo, minlength=len(begins))[keep] / w, "seen": seen[keep], "notice": notice[keep]}
    ids = np.zeros((len(w), 1 + len(_BANDS)), np.int32)
    for i, (k, bands) in enumerate(_BANDS.items(), 1):
        ids[:, i] = _OFFSETS[k] + np.digitize(values[k], bands)
    return figures, line_doc[keep], w, ids


class LineCRF:
    """Two labels (0 boilerplate, 1 content), binary features, first-order chain."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @classmethod
    def fit(cls, ids: np.ndarray, doc: np.ndarray, gold: np.ndarray, weight: np.ndarray, start: LineCRF | None = None, chain: bool = True, rounds: int = 60, decay: float = 1e-3) -> LineCRF:
        """Gradient ascent on the conditional likelihood of the lines' labels; lines are sorted by document.

        Without ``chain`` the moves stay as they are, and each line is for itself."""
        w, t = (np.zeros((N_FEATURES, 2)), np.zeros((2, 2))) if start is None else (start.weights.copy(), start.moves.copy())
        w[0, 1] += 1e-3 * (start is None)
        if not len(ids):
            return cls(w, t)
        model = cls(w, t)
        scale = weight / weight.sum()
        pair = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        each = np.arange(len(ids))
        flat, wide = ids.ravel(), ids.shape[1]
        m, v = [np.zeros_like(w), np.zeros_like(t)], [np.zeros_like(w), np.zeros_like(t)]
        for step in range(1, rounds + 1):
            p, q = model.marginals(ids, doc)
            g = -p
            g[each, gold] += 1
            g *= scale[:, None]
            gw = np.stack([np.bincount(flat, weights=np.repeat(g[:, c], wide), minlength=N_FEATURES) for c in (0, 1)], 1) - decay * w
            gt = -decay * t - np.einsum("iab,i->ab", q, scale[pair])
            np.add.at(gt, (gold[pair - 1], gold[pair]), scale[pair])
            for i, (x, grad) in enumerate(((w, gw), (t, gt))[: 1 + chain]):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.99 * v[i] + 0.01 * grad * grad
                x += 0.15 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
        return model

    def marginals(self, ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label) of each line, and P(label before, label) of each line that is not its document's first.

        Messages are running products of 2 x 2 matrices, formed by doubling; a document's first line forgets what was before."""
        n = len(ids)
        e = self.weights[ids].sum(1)
        e = np.exp(e - e.max(1, keepdims=True))
        new = np.ones(n, bool)
        new[1:] = doc[1:] != doc[:-1]
        a = np.exp(self.moves)[None] * e[:, None, :]
        a[new] = e[new][:, None, :]
        longest = int(np.diff(np.append(np.flatnonzero(new), n)).max())

        def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out = np.empty_like(x)
            for i in (0, 1):
                for j in (0, 1):
                    out[:, i, j] = x[:, i, 0] * y[:, 0, j] + x[:, i, 1] * y[:, 1, j]
            return out / out.sum((1, 2), keepdims=True)

        before, after = a.copy(), a.copy()
        d = 1
        while d < longest:
            before[d:] = times(before[:-d], before[d:])
            after[:-d] = times(after[:-d], after[d:])
            d *= 2
        alpha = before[:, 0, :] / before[:, 0, :].sum(1, keepdims=True)
        beta = np.ones((n, 2))
        beta[:-1] = after[1:].sum(2)
        beta[:-1][new[1:]] = 1.0
        p = alpha * beta
        pair = np.flatnonzero(~new)
        q = alpha[pair - 1][:, :, None] * a[pair] * beta[pair][:, None, :]
        return p / p.sum(1, keepdims=True), q / q.sum((1, 2), keepdims=True)

    def decode(self, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Viterbi labels of lines that are sorted by document; ties go to content."""
        n = len(ids)
        if not n:
            return np.zeros(0, np.int8)
        e = self.weights[ids].sum(1)
        d, moves = (e[:, 1] - e[:, 0]).tolist(), self.moves
        t00, t01, t10, t11 = moves[0, 0], moves[0, 1], moves[1, 0], moves[1, 1]
        new = np.concatenate(([True], doc[1:] != doc[:-1])).tolist()
        from0, from1 = [0] * n, [0] * n
        s0 = s1 = 0.0
        for i in range(n):
            if new[i]:
                s0, s1 = 0.0, d[i]
                continue
            if s1 + t10 >= s0 + t00:
                from0[i], x0 = 1, s1 + t10
            else:
                x0 = s0 + t00
            if s1 + t11 >= s0 + t01:
                from1[i], x1 = 1, s1 + t11
            else:
                x1 = s0 + t01
            s0, s1 = 0.0, x1 - x0 + d[i]
            d[i] = s1
        out, label = [0] * n, 0
        for i in range(n - 1, -1, -1):
            if i == n - 1 or new[i + 1]:
                label = 1 if d[i] >= 0 else 0
            out[i] = label
            label = from1[i] if label else from0[i]
        return np.array(out, np.int8)


def relabel(p: np.ndarray, doc: np.ndarray, good: np.ndarray, words: np.ndarray, content_share: float) -> np.ndarray:
    """The likelier label of each line, the surest first, as far as its document's label lets lines go against it."""
    against = np.where(good[doc], p < 0.5, p >= 0.5)
    order = np.lexsort((np.where(good[doc], p, -p), doc))
    size = np.bincount(doc, weights=words, minlength=len(good))
    mine = np.where(against, words, 0)[order]
    before = np.cumsum(mine)
    base = starts_of(np.bincount(doc, minlength=len(good)))[:-1]
    before -= np.concatenate(([0], before))[base][doc[order]]
    room = np.where(good, (1 - content_share) * size, content_share * size - 1)[doc[order]]
    out = good[doc].astype(np.int64)
    go = order[against[order] & (before <= room)]
    out[go] = 1 - out[go]
    return out


def fit_hidden(ids: np.ndarray, doc: np.ndarray, words: np.ndarray, line: np.ndarray, good: np.ndarray, content_share: float, turns: int = 3) -> tuple[LineCRF, np.ndarray]:
    """The chain and the lines' labels, from documents' labels; ``line`` has the lines' hashes."""
    if not len(ids):
        return LineCRF.fit(ids, doc, np.zeros(0, np.int64), np.zeros(0)), np.zeros(0, np.int64)
    once = np.unique(np.stack((line, doc.astype(U64))), axis=1)[0]
    kinds, sharing = np.unique(once, return_counts=True)
    shared = sharing[np.searchsorted(kinds, line)] >= 3
    notice = ids[:, 1 + list(_BANDS).index("notice")] == _OFFSETS["notice"] + 1
    in_good = np.isin(line, line[good[doc]])
    seed = np.where(good[doc], np.where(shared & notice, 0.0, 1.0), np.where(in_good, 1.0, 0.0))
    gold = relabel(seed, doc, good, words, content_share)
    share = np.bincount(good.astype(np.int64), minlength=2) / len(good)
    weight = 0.5 / np.maximum(share[good[doc].astype(np.int64)], 1e-9)
    model = LineCRF.fit(ids, doc, gold, weight, chain=False)
    for _ in range(turns):
        p = model.marginals(ids, doc)[0][:, 1]
        gold = relabel(np.where(shared & notice, np.minimum(p, 0.25), p), doc, good, words, content_share)
        model = LineCRF.fit(ids, doc, gold, weight, model)
    return model, gold


def train(docs: DataFrame, labels: DataFrame | None, train_docs: int = 1500, content_share: float = 0.5) -> LineCRF:
    """Fit on the ``train_docs`` labelled ids with the smallest hashes; whole texts, one row of each id."""
    none = np.zeros((0, 1 + len(_BANDS)), np.int32)
    if labels is None:
        return fit_hidden(none, *[np.zeros(0, np.int64)] * 3, np.zeros(0, bool), content_share)[0]
    # The sample is drawn from the labels alone; its size bounds what is broadcast.
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                texts = texts_of(b.column("text"))
                _, doc, words, ids = measure(texts)
                line = hash_words([x for t in texts for x in t.split(b"\n") if x.split()])
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                parts = [[x[i:j].astype(k).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)] for x, k in ((ids, "<i4"), (words, "<i8"), (line, "<u8"))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality").cast(pa.int64()), *[pa.array(x, pa.binary()) for x in parts]], ["doc_id", "quality", "ids", "words", "line"])

    got = sorted(rows.mapInArrow(features, "doc_id long, quality long, ids binary, words binary, line binary").collect(), key=lambda r: r.doc_id)
    n = [len(r.words) // 8 for r in got]
    ids, words, line = (np.frombuffer(b"".join(r[k] for r in got), t) for k, t in (("ids", "<i4"), ("words", "<i8"), ("line", "<u8")))
    good = np.array([r.quality > 0 for r in got], bool)
    return fit_hidden(ids.reshape(-1, none.shape[1]), np.repeat(np.arange(len(got)), n), words, line, good, content_share)[0]


def _judgement(docs: DataFrame, labels: DataFrame | None, train_docs: int, content_share: float):
    """A function from the rows' texts to their figures and verdicts."""
    crf = train(docs, labels, train_docs, content_share)
    weights, moves = crf.weights, crf.moves

    def judge(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        x, doc, words, ids = measure(texts_of(b.column("text")))
        label = LineCRF(weights, moves).decode(ids, doc)
        x["content_words"] = np.bincount(doc, weights=words * label, minlength=b.num_rows).astype(np.int64)
        x["base_failed"] = (x["n_words"] < 20) | (100 * x["n_repeat_words"] > 30 * x["n_words"])
        x["kept"] = ~x["base_failed"] & (x["content_words"] >= content_share * x["n_words"])
        return x

    return judge


def quality_rules(docs: DataFrame, labels: DataFrame | None, train_docs: int = 1500, content_share: float = 0.5) -> DataFrame:
    """doc_id, base figures, content_words, base_failed, kept; one row for each row of ``docs``."""
    judge = _judgement(docs, labels, train_docs, content_share)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                x = judge(b)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(x[k]) for k in names]], ["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in names[:6]) + ", base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_quality(docs: DataFrame, labels: DataFrame | None, train_docs: int = 1500, content_share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    judge = _judgement(docs, labels, train_docs, content_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                yield b.filter(pa.array(judge(b)["kept"]))

    return docs.mapInArrow(run, docs.schema)
