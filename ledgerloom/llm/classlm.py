"""Class-based bigrams: P(w | v) = P(class of w | class of v) * P(w | class of w).

Words are clustered by exchange. The ``head`` most frequent words are exchanged one at
a time, on exact corpus-wide bigram counts, until no move helps; that seeds the
classes. From there on all words are exchanged in batches: each moves to the class
that its own neighbours make likeliest under the corpus-wide class counts, everything
is counted anew, and a further batch follows for as long as the likelihood of the
training tokens rises by ``gain`` of itself; a batch that lowers it is not taken.
Texts are cut into words once; each block then asks hash partitions with its merged
counts and gets answers in the same order, so nothing about a word is left out.

Transitions are smoothed by the classes' shares; emissions by absolute discounting,
whose mass goes to unknown words, and after an unknown word the shares hold. All
unknown words are one outcome, as they are in the base score, so both sum to one over
the known words and that outcome.

Defined results: a null text is an empty one and is its end token alone; a null
``doc_id`` trains; repeated rows count each; with no training rows every token is
unknown and the score is the base score; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.blocks import write_packed
from ledgerloom.llm.store import save
from ledgerloom.llm.words import U64, hash_words, starts_of, texts_of

CLASSES, HEAD, STRENGTH = 48, 400, 20.0
#: Batches go on while each raises the likelihood by this part of itself.
GAIN = 1e-3
#: Class 0 holds the end token alone; the class after the others is "not clustered yet".
_NAMES = ["block", "kind", "part", "data"]
_SCHEMA = "block long, kind int, part int, data binary"


def held_out(doc_id: int | None, modulus: int, remainder: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], _NAMES)


def _cut_words(modulus: int, remainder: int):
    """A block's ids, held-out marks, tokens of each row, and tokens as numbers of its distinct words, sorted by hash."""

    def pack(rows: pa.RecordBatch) -> list[pa.Array]:
        words: list[bytes] = []
        size = []
        for t in texts_of(rows.column("text")):
            w = t.lower().split()
            words += w
            words.append(b"")
            size.append(len(w) + 1)
        codes, uniques = pd.factorize(hash_words(words) if words else np.zeros(0, U64))
        order = np.argsort(uniques)
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        out = np.array([held_out(d, modulus, remainder) for d in rows.column("doc_id").to_pylist()], "u1")
        ids = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("doc_id"))
        return [ids, *[pa.array([x], pa.binary()) for x in (out.tobytes(), np.array(size, "<i8").tobytes(), rank[codes].tobytes(), uniques[order].astype("<u8").tobytes())]]

    return pack


_PACKED = T.StructType([T.StructField("doc_id", T.ArrayType(T.LongType())), *[T.StructField(c, T.BinaryType()) for c in ("held_out", "size", "token", "hash")]])


class Tokens:
    """A block's tokens as numbers of its distinct words, which are sorted by hash and so by partition."""

    def __init__(self, row: pa.Table, parts: int):
        self.doc_id = row.column("doc_id").combine_chunks().flatten()
        out, size, self.token, self.hash = (np.frombuffer(row.column(c)[0].as_py(), t) for c, t in (("held_out", "u1"), ("size", "<i8"), ("token", "<u4"), ("hash", "<u8")))
        self.token = self.token.astype(np.int64)
        self.first = starts_of(size)
        self.held_out = out.astype(bool)
        self.train = np.repeat(~self.held_out, size)
        part = (((self.hash >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(part, prepend=-1))
        #: (partition, from, to) of the block's words.
        self.parts = list(zip(part[at].tolist(), at.tolist(), np.append(at, len(part))[1:].tolist(), strict=True))
        self.counts = np.bincount(self.token[self.train], minlength=len(self.hash))

    def before(self, values: np.ndarray, start: int) -> np.ndarray:
        """Each token's predecessor's value; the first of a document follows an end token."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first[:-1]] = start
        return out

    def answers(self, table: pa.Table, kind: int, dtype: str) -> np.ndarray:
        got = {p: d for k, p, d in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "data")), strict=True) if k == kind}
        return np.concatenate([np.frombuffer(got[p], dtype) for p, _, _ in self.parts]) if self.parts else np.zeros(0, dtype)


def _ask_counts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(i, 1)])
                t = Tokens(one, parts)
                block = one.column("block")[0].as_py()
                rows = [(block, 0, p, t.hash[a:b].tobytes() + t.counts[a:b].astype("<u4").tobytes()) for p, a, b in t.parts]
                yield from _table(rows).to_batches()

    return run


def _count(head: int):
    """To each block the corpus counts of its words; to all, the totals and the partition's most frequent words."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        got = [(np.frombuffer(d, "<u8", len(d) // 12), np.frombuffer(d, "<u4", len(d) // 12, len(d) // 12 * 8)) for d in table.column("data").to_pylist()]
        codes, uniques = pd.factorize(np.concatenate([h for h, _ in got]))
        total = np.bincount(codes, weights=np.concatenate([n for _, n in got]), minlength=len(uniques)).astype("<i8")
        at = starts_of(np.array([len(h) for h, _ in got]))
        rows = [(b, 0, part, total[codes[x:y]].tobytes()) for b, x, y in zip(table.column("block").to_pylist(), at[:-1], at[1:], strict=True)]
        known = total[total > 0]
        rows.append((None, 2, part, np.array([known.sum(), len(known), (known == 1).sum(), (known == 2).sum()], "<i8").tobytes()))
        top = np.lexsort((uniques, -total))[:head]
        rows.append((None, 3, part, uniques[top].astype("<u8").tobytes() + total[top].tobytes()))
        return _table(rows)

    return run


def _pair_counts(parts: int, words: np.ndarray):
    """Bigram counts among the frequent words; all others count as one further word. One row a task and first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(words) + 1
        order = np.argsort(words)
        total = np.zeros((n, n), np.int64)
        end = int(np.flatnonzero(words == hash_words([b""])[0])[0]) if len(words) else 0
        for batch in batches:
            for i in range(batch.num_rows):
                t = Tokens(pa.Table.from_batches([batch.slice(i, 1)]), parts)
                at = np.minimum(np.searchsorted(words[order], t.hash), n - 2)
                number = np.where(words[order][at] == t.hash, order[at], n - 1)[t.token]
                total += np.bincount((t.before(number, end) * n + number)[t.train], minlength=n * n).reshape(n, n)
        rows = [(None, 4, a, total[a].astype("<i8").tobytes()) for a in range(n) if total[a].any()]
        yield from _table(rows).to_batches()

    return run


def _class_pairs(parts: int, classes: int):
    """Bigram counts of classes, with words and tokens of each class; one row for each block and first class."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        t = Tokens(blocks, parts)
        c = t.answers(answers, 1, "u1").astype(np.int64)[t.token]
        n = classes + 1
        total = np.bincount((t.before(c, 0) * n + c)[t.train], minlength=n * n).reshape(n, n)
        return _table([(None, 4, a, total[a].astype("<i8").tobytes()) for a in range(n) if total[a].any()])

    return run


def _summed(rows: DataFrame) -> DataFrame:
    """Vectors of counts summed by ``part``, first by groups of about 4,096 blocks, so that no group grows with the input past
    millions of blocks."""

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(d, "<i8") for d in table.column("data").to_pylist()], axis=0)
        return _table([(None, 0, table.column("part")[0].as_py(), total.astype("<i8").tobytes())])

    rows = rows.withColumn("group", F.shiftright(F.xxhash64("block", "data"), 52))
    return rows.groupBy("part", "group").applyInArrow(add, _SCHEMA).groupBy("part").applyInArrow(add, _SCHEMA)


def _matrix(rows: DataFrame, n: int) -> np.ndarray:
    """Rows of counts summed by their first index; the result is bounded by the number of classes or frequent words."""
    out = np.zeros((n, n), np.int64)
    for r in _summed(rows.filter("kind = 4")).collect():
        out[r.part] = np.frombuffer(r.data, "<i8")
    return out


def _total(rows: DataFrame, kind: int, n: int) -> np.ndarray:
    got = _summed(rows.filter(F.col("kind") == kind).withColumn("part", F.lit(0))).collect()
    return np.frombuffer(got[0].data, "<i8") if got else np.zeros(n, np.int64)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, end: int, classes: int, rounds: int = 100) -> np.ndarray:
    """Classes 1.. of words numbered by falling frequency, from exact bigram counts; the last number stands for all other words.

    Each word in turn goes to the class with the best likelihood of the class bigrams; it stops when a round moves none, or none
    but those that gains lost in rounding move to and fro."""
    n = len(pairs) - 1
    of = np.array([1 + i % (classes - 1) for i in range(n)] + [classes])
    if n:
        of[end] = 0
    size = classes + 1
    m = np.zeros((size, size))
    np.add.at(m, (of[:, None], of[None, :]), pairs)
    for _ in range(rounds):
        moved = 0
        for w in range(n):
            if w == end:
                continue
            own = pairs[w, w]
            nxt = np.bincount(of, weights=pairs[w], minlength=size)
            prv = np.bincount(of, weights=pairs[:, w], minlength=size)
            nxt[of[w]] -= own
            prv[of[w]] -= own
            m[of[w]] -= nxt
            m[:, of[w]] -= prv
            m[of[w], of[w]] -= own
            row, col, diag = m.sum(1), m.sum(0), np.diag(m)
            gain = (_xlogx(m + nxt) - _xlogx(m)).sum(1) + (_xlogx(m + prv[:, None]) - _xlogx(m)).sum(0)
            gain += _xlogx(diag + nxt + prv + own) - _xlogx(diag + nxt) - _xlogx(diag + prv) + _xlogx(diag)
            gain -= _xlogx(row + nxt.sum() + own) - _xlogx(row) + _xlogx(col + prv.sum() + own) - _xlogx(col)
            best = 1 + int(np.argmax(gain[1:classes]))
            if gain[best] <= gain[of[w]] + 1e-9 * abs(gain[best]):
                best = of[w]
            moved += best != of[w]
            of[w] = best
            m[best] += nxt
            m[:, best] += prv
            m[best, best] += own
        if not moved:
            break
    return of[:n]


def _contexts(parts: int, words: np.ndarray | None, of: np.ndarray | None, classes: int):
    """To the partitions, for each distinct word of a block the classes of its neighbours in training rows."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        t = Tokens(blocks, parts)
        if words is None:
            c = t.answers(answers, 1, "u1").astype(np.int64)
        else:
            order = np.argsort(words)
            at = np.minimum(np.searchsorted(words[order], t.hash), len(words) - 1)
            c = np.where(words[order][at] == t.hash, of[order[at]], classes)
        c = c[t.token]
        left = t.before(c, 0)
        right = np.zeros_like(c)
        right[:-1] = c[1:]
        right[t.first[1:] - 1] = -1
        n, train = classes + 1, t.train
        code = np.concatenate(((t.token * 2 * n + left)[train], (t.token * 2 * n + n + right)[train & (right >= 0)]))
        code, count = np.unique(code, return_counts=True)
        word, what = code // (2 * n), (code % (2 * n)).astype("u1")
        entries = np.bincount(word, minlength=len(t.hash)).astype("u1")
        at = np.searchsorted(word, np.array([a for _, a, _ in t.parts] + [len(t.hash)]))
        block = blocks.column("block")[0].as_py()
        rows = []
        for (p, a, b), x, y in zip(t.parts, at[:-1], at[1:], strict=True):
            rows.append((block, 7, p, np.array([b - a], "<i8").tobytes() + t.hash[a:b].tobytes() + entries[a:b].tobytes() + what[x:y].tobytes() + count[x:y].astype("<u4").tobytes()))
        return _table(rows)

    return run


def _assign(m: np.ndarray, classes: int):
    """Each word to the class that its neighbours make likeliest under the class counts; the end token keeps class 0."""

    def run(table: pa.Table) -> pa.Table:
        part, n = table.column("part")[0].as_py(), classes + 1
        end = hash_words([b""])[0]
        hashes, entries, what, count = [], [], [], []
        for d in table.column("data").to_pylist():
            k = int(np.frombuffer(d, "<i8", 1)[0])
            hashes.append(np.frombuffer(d, "<u8", k, 8))
            e = np.frombuffer(d, "u1", k, 8 + 8 * k)
            s = int(e.sum(dtype=np.int64))
            entries.append(e)
            what.append(np.frombuffer(d, "u1", s, 8 + 9 * k))
            count.append(np.frombuffer(d, "<u4", s, 8 + 9 * k + s))
        codes, uniques = pd.factorize(np.concatenate(hashes))
        word = np.repeat(codes, np.concatenate(entries))
        what, count = np.concatenate(what).astype(np.int64), np.concatenate(count)
        p = (m + 0.5) / (m.sum(1, keepdims=True) + 0.5 * n)
        size = m.sum(0) + 1.0
        # Scores of the classes 1.. by neighbours before (p[c, b]) and after (p[b, c]).
        logs = np.log(np.vstack((p[:, 1:classes], p.T[:, 1:classes])))
        best = np.zeros(len(uniques), "u1")
        step = 20_000
        order = np.argsort(word, kind="stable")
        word, what, count = word[order], what[order], count[order]
        for a in range(0, len(uniques), step):
            x, y = np.searchsorted(word, (a, a + step))
            k = min(step, len(uniques) - a)
            seen = np.bincount((word[x:y] - a) * 2 * n + what[x:y], weights=count[x:y], minlength=k * 2 * n).reshape(k, 2 * n)
            score = seen @ logs - seen[:, :n].sum(1, keepdims=True) * np.log(size[1:classes])
            best[a : a + k] = 1 + np.argmax(score, 1)
        best[uniques == end] = 0
        at = starts_of(np.array([len(h) for h in hashes]))
        trained = np.bincount(word, minlength=len(uniques)) > 0
        sizes = (None, 6, part, np.bincount(best[trained], minlength=n).astype("<i8").tobytes())
        return _table([sizes] + [(b, 1, part, best[codes[x:y]].tobytes()) for b, x, y in zip(table.column("block").to_pylist(), at[:-1], at[1:], strict=True)])

    return run


def _score(parts: int, totals: tuple[int, int, float], m: np.ndarray | None, sizes: np.ndarray | None, classes: int):
    tokens, types, discount = totals

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        t = Tokens(blocks, parts)
        count = t.answers(answers, 0, "<i8")
        doc = np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
        base = np.log10((count + 1) / (tokens + types + 1))
        add = lambda x: np.bincount(doc, weights=x, minlength=len(t.first) - 1)
        known = count > 0
        base_score = add(base[t.token])
        score = base_score
        if m is not None and tokens:
            c = t.answers(answers, 1, "u1").astype(np.int64)
            of_class = m.sum(0).astype(float)
            share = of_class / of_class.sum()
            move = (m + STRENGTH * share) / (m.sum(1, keepdims=True) + STRENGTH)
            move = np.vstack((move, share))
            d = np.full(classes + 1, discount)
            d[0] = 0.0
            with np.errstate(divide="ignore"):
                unknown = np.log10(np.maximum(move @ (d * sizes / np.maximum(of_class, 1)), 1e-300))
                emit = np.where(known, np.log10(np.maximum(count - d[c], 1e-9) / np.maximum(of_class[c], 1)), 0.0)
                move = np.log10(np.maximum(move, 1e-300))
            state = np.where(known, c, classes + 1)[t.token]
            before = t.before(state, 0)
            ok = known[t.token]
            score = add(np.where(ok, move[before, np.where(ok, state, 0)] + emit[t.token], unknown[before]))
        n = np.diff(t.first)
        cols = [t.doc_id, pa.array(t.held_out), pa.array(n), pa.array(add(known[t.token]).astype(np.int64)), pa.array(np.full(len(n), tokens)), pa.array(base_score), pa.array(score), pa.array(10 ** (-score / n))]
        return pa.table(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return run


def likelihood(m: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, and of words in their classes but for what no clustering changes."""
    return float(_xlogx(m).sum() - _xlogx(m.sum(0)).sum() - _xlogx(m.sum(1)).sum())


class ClassModel(NamedTuple):
    blocks: DataFrame
    parts: int
    totals: tuple[int, int, float]
    #: Counts (kind 0) and classes (kind 1) of each block's words, by partition.
    answers: DataFrame
    moves: np.ndarray | None
    sizes: np.ndarray | None
    #: The likelihood after each batch.
    rises: list[float]


def train_classes(docs: DataFrame, modulus: int, remainder: int, classes: int, head: int, passes: int, gain: float, part_bytes: int) -> ClassModel:
    blocks, total = write_packed(docs, _cut_words(modulus, remainder), _PACKED)
    parts = max(8, min(1 << 30, -(-total // part_bytes)))
    counted = save(blocks.mapInArrow(_ask_counts(parts), _SCHEMA).groupBy("part").applyInArrow(_count(head), _SCHEMA), "counts")
    counts = counted.filter("kind = 0")
    tokens, types, once, twice = (int(x) for x in _total(counted, 2, 4))
    discount = once / (once + 2 * twice) if once else 0.5
    totals = (tokens, types, min(0.9, max(0.1, discount)))
    if not tokens:
        return ClassModel(blocks, parts, totals, counts, None, None, [])
    grouped = blocks.groupBy("block")

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d in b.column("data").to_pylist():
                k = len(d) // 16
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(d, "<i8", k)), pa.array(np.frombuffer(d, "<i8", k, 8 * k))], ["word", "n"])

    best = counted.filter("kind = 3").select("data").mapInArrow(top, "word long, n long").filter("n > 0").orderBy(F.desc("n"), "word").limit(head).collect()
    end = hash_words([b""])[0]
    words = np.array([r.word for r in best], np.int64).view(U64)
    if end not in words:
        words = np.append(words, end)
    at_end = int(np.flatnonzero(words == end)[0])
    pairs = _matrix(blocks.mapInArrow(_pair_counts(parts, words), _SCHEMA), len(words) + 1)
    of = exchange(pairs.astype(float), at_end, classes)
    n = classes + 1
    m = np.zeros((n, n))
    full = np.append(of, classes)
    np.add.at(m, (full[:, None], full[None, :]), pairs)
    taken: tuple[DataFrame, np.ndarray, np.ndarray] | None = None
    rises: list[float] = []
    for i in range(passes):
        known = counts if taken is None else taken[0]
        asked = grouped.cogroup(known.groupBy("block")).applyInArrow(_contexts(parts, *((words, of) if taken is None else (None, None)), classes), _SCHEMA)
        told = save(asked.groupBy("part").applyInArrow(_assign(m, classes), _SCHEMA), f"classes_{i}")
        assigned = told.filter("kind = 1")
        # Distinct training words of each class, and bigrams of classes.
        sizes = _total(told, 6, n).astype(float)
        new = _matrix(grouped.cogroup(assigned.groupBy("block")).applyInArrow(_class_pairs(parts, classes), _SCHEMA), n).astype(float)
        rises.append(likelihood(new))
        if len(rises) > 1 and rises[-1] < rises[-2]:
            break
        taken, m = (assigned, new, sizes), new
        if len(rises) > 1 and rises[-1] - rises[-2] < gain * abs(rises[-2]):
            break
    return ClassModel(blocks, parts, totals, counts.union(taken[0]), taken[1], taken[2], rises)


def class_lm_scores(
    docs: DataFrame, modulus: int = 7, remainder: int = 2, classes: int = CLASSES, head: int = HEAD, passes: int = 50, gain: float = GAIN, part_bytes: int = 4 << 20
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of each row.

    Rows whose crc32 of the id, modulo ``modulus``, is ``remainder`` are held out from all counts."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    model = train_classes(docs, modulus, remainder, classes, head, passes, gain, part_bytes)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    score = _score(model.parts, model.totals, model.moves, model.sizes, classes)
    return model.blocks.groupBy("block").cogroup(model.answers.groupBy("block")).applyInArrow(score, schema)
