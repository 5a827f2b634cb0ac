"""Toxicity by cumulative-link (proportional-odds) ordinal regression.

The distinct values of the ``toxic`` label, in order, are the grades: K values give
K - 1 thresholds, and labels that say only 0 or 1 give one. Grades share one weight
for each sparse text feature (hashed words and word beginnings); ordered thresholds
separate them, and the result is the expected grade. The model is fit on a bounded
number of labelled ids, the ``train_docs`` with the smallest hashes, in order of their
ids and with whole texts; near copies in the sample count once.

Defined results: a null text is an empty one; repeated rows get the same values; an
id with several labels has its greatest, and of rows that share a labelled id one
trains; with fewer than two grades in the sample every document has the one grade, or
0 without any; more than ``MOST_GRADES`` grades are an error; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import U64, hash_words, mix, slices, starts_of, texts_of

BITS, MOST_GRADES = 20, 64
_STRIP = b".,;:!?\"'()[]{}*#$%&|<>-_"
#: Lengths of word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, log(1 + count)) triples sorted by document."""
    words: list[bytes] = []
    size = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.lower().split()
        size[i] = len(w)
        words += w
    if not words:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float)
    codes, uniques = pd.factorize(hash_words(words))
    at = np.zeros(len(uniques), np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]
    bare = [words[i].strip(_STRIP) for i in at]
    mask = U64((1 << BITS) - 1)
    kinds = [mix(hash_words(bare)) & mask]
    for n in BEGINNINGS:
        kinds.append(mix(hash_words([w[:n] for w in bare]) + U64(n)) & mask)
    doc = np.repeat(np.arange(len(texts)), size)
    pair = np.concatenate([(doc.astype(U64) << U64(BITS)) | k[codes] for k in kinds])
    pair, count = np.unique(pair, return_counts=True)
    return (pair >> U64(BITS)).astype(np.int64), (pair & mask).astype(np.int64), np.log1p(count)


class CumulativeLink:
    """P(grade <= j) = 1 / (1 + exp(w x - cut_j)), cuts in rising order."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    @classmethod
    def fit(cls, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, rounds: int = 300, decay: float = 1e-4, rate: float = 0.05) -> CumulativeLink:
        used, col = np.unique(feature, return_inverse=True)
        n, grades = len(grade), int(grade.max()) + 1
        w = np.zeros(len(used))
        raw = np.array([2.0, *[0.0] * (grades - 2)])  # the first cut, then logs of the gaps
        moment = [np.zeros(len(w)), np.zeros(len(raw))], [np.zeros(len(w)), np.zeros(len(raw))]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        share = np.bincount(grade, minlength=grades) / n
        each = 1 / np.sqrt(np.maximum(share[grade], 1e-3))
        each /= each.sum()
        for step in range(1, rounds + 1):
            gaps = np.exp(raw[1:])
            cuts = raw[0] + np.concatenate(([0.0], np.cumsum(gaps)))
            z = np.bincount(doc, weights=w[col] * value, minlength=n)
            below = np.hstack((np.zeros((n, 1)), sigmoid(cuts - z[:, None]), np.ones((n, 1))))
            hi, lo = below[np.arange(n), grade + 1], below[np.arange(n), grade]
            p = np.maximum(hi - lo, 1e-9)
            dhi, dlo = hi * (1 - hi) / p * each, lo * (1 - lo) / p * each
            gz = -(dhi - dlo)
            gc = np.zeros(grades + 1)
            np.add.at(gc, grade + 1, dhi)
            np.add.at(gc, grade, -dlo)
            gc = gc[1:grades]
            graw = np.concatenate(([gc.sum()], [gc[i + 1 :].sum() * g for i, g in enumerate(gaps)]))
            gw = np.bincount(col, weights=gz[doc] * value, minlength=len(w)) - decay * w
            for i, (x, g) in enumerate(((w, gw), (raw, graw))):
                moment[0][i][:] = 0.9 * moment[0][i] + 0.1 * g
                moment[1][i][:] = 0.99 * moment[1][i] + 0.01 * g * g
                x += rate * (moment[0][i] / (1 - 0.9**step)) / (np.sqrt(moment[1][i] / (1 - 0.99**step)) + 1e-6)
        weights = np.zeros(1 << BITS, np.float32)
        weights[used] = w
        return cls(weights, raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:])))))

    def above(self, z: np.ndarray) -> np.ndarray:
        """P(grade > j) for each cut."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - z[:, None], -40, 40)))


def originals(doc: np.ndarray, feature: np.ndarray, n: int, bands: int = 4, rows: int = 4) -> np.ndarray:
    """Whether a sampled document is the first of its near copies, by banded minima of its features; documents are in order of ids.

    Copies of one toxic document would otherwise make all its words look toxic."""
    there, at = np.unique(doc, return_index=True)
    out = np.ones(n, bool)
    if not len(at):
        return out
    low = np.stack([np.minimum.reduceat(mix(feature.astype(U64) + U64((i + 1) << 32)), at) for i in range(bands * rows)], 1)
    seen: set[tuple] = set()
    for d, m in zip(there.tolist(), low.tolist(), strict=True):
        keys = [(b, *m[b * rows : (b + 1) * rows]) for b in range(bands)]
        out[d] = not any(k in seen for k in keys)
        seen.update(keys)
    return out


def telling(doc: np.ndarray, feature: np.ndarray, toxic: np.ndarray, least: float = 8.0) -> np.ndarray:
    """Features in three documents or more that go with toxicity: twice the rate, and a chi-square of ``least`` or more."""
    size = 1 << BITS
    n_t, n_c = float(toxic.sum()), float((~toxic).sum())
    a, b = (np.bincount(feature[x[doc]], minlength=size).astype(float) for x in (toxic, ~toxic))
    c, d, n = n_t - a, n_c - b, n_t + n_c
    chi = n * np.maximum(np.abs(a * d - b * c) - n / 2, 0) ** 2 / np.maximum(1, (a + b) * (c + d) * n_t * n_c)
    return (a + b >= 3) & (a * n_c > 2 * b * n_t) & (chi > least)


class Severity(NamedTuple):
    """The model, if there are two grades or more, and the grades' values in order."""

    link: CumulativeLink | None
    values: np.ndarray

    def chances(self, z: np.ndarray) -> np.ndarray:
        """P(grade) for each grade of the documents whose features sum to ``z``."""
        above = self.link.above(z) if self.link is not None else np.zeros((len(z), 0))
        return -np.diff(np.hstack((np.ones((len(z), 1)), above, np.zeros((len(z), 1)))), axis=1)


def train(docs: DataFrame, labels: DataFrame, train_docs: int) -> Severity:
    # The sample is drawn from the labels alone; its size bounds what is broadcast.
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("double")).alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                doc, feature, value = features(texts_of(b.column("text")))
                cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
                data = [feature[x:y].astype("<u4").tobytes() + value[x:y].astype("<f4").tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(data, pa.binary())], ["doc_id", "toxic", "data"])

    got = sorted(rows.mapInArrow(run, "doc_id long, toxic double, data binary").collect(), key=lambda r: r.doc_id)
    n = [len(r.data) // 8 for r in got]
    none = np.zeros(0)
    doc = np.repeat(np.arange(len(got)), n)
    feature = np.concatenate([none, *[np.frombuffer(r.data, "<u4", k) for r, k in zip(got, n, strict=True)]]).astype(np.int64)
    value = np.concatenate([none, *[np.frombuffer(r.data, "<f4", k, 4 * k) for r, k in zip(got, n, strict=True)]])
    return fit(doc, feature, value, np.array([r.toxic for r in got], float))


def fit(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray) -> Severity:
    first = originals(doc, feature, len(label))
    here = first[doc]
    number = np.cumsum(first) - 1
    doc, feature, value = number[doc[here]], feature[here], value[here]
    values, grade = np.unique(label[first], return_inverse=True)
    if len(values) > MOST_GRADES:
        raise ValueError(f"{len(values)} distinct labels are no grades; {MOST_GRADES} at most")
    if len(values) < 2:
        return Severity(None, values if len(values) else np.zeros(1))
    told = telling(doc, feature, grade > 0)[feature]
    return Severity(CumulativeLink.fit(doc[told], feature[told], value[told], grade), values)


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = 8000) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (chance of a grade over the lowest), grade (the likeliest), toxic; one row for each
    row of ``docs``."""
    model = train(docs, labels, train_docs)
    sc = docs.sparkSession.sparkContext
    # One weight for each of 2^BITS features: a fixed 4 MB.
    shared = sc.broadcast((None if model.link is None else (model.link.weights, model.link.cuts), model.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link, values = shared.value
        known = Severity(CumulativeLink(*link) if link is not None else None, values)
        for whole in batches:
            for b in slices(whole, "text"):
                z = np.zeros(b.num_rows)
                if link is not None:
                    doc, feature, value = features(texts_of(b.column("text")))
                    z = np.bincount(doc, weights=known.link.weights[feature] * value, minlength=b.num_rows)
                p = known.chances(z)
                toxic = 1 - p[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(p @ values), pa.array(toxic), pa.array(values[p.argmax(1)].astype(np.int32)), pa.array(toxic >= 0.5)],
                    ["doc_id", "severity", "p_toxic", "grade", "toxic"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
