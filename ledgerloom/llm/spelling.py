"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One edit moves the vector of a word's letter counts by at most two in L1: an inserted
or deleted letter by one, a replaced one up in one place and down in another. So words
are searched per pair of lengths: a word looks among those of its own length (one up,
one down), of one more (one up) and of one less (one down).

Words of a length are dealt to cells, the leaves of a k-d tree whose cuts come from a
bounded sample of words; the cuts decide balance alone. A word goes to each cell whose
box is within reach, in one partition with the cell's own words. There a further tree
with small leaves is searched for all visitors at once, boxes out of reach are cut off,
what is left of a leaf is compared by letter-count signatures, and then letter by
letter. Each task sends one row for each visitor that it found near words for.

A word's root is reached by doubling: a form occurs at least twice as often as its
word, so chains are short.

Defined results: a null or empty text has no words; a null doc_id counts as an empty
string in the checksum; repeated rows count each; texts of any length are cut between
words and counted whole; further columns are ignored; an empty table gives no rows.
Words with the same letters fall into one cell, however many; cells that the sample
shows to be large, or much visited, are split by hash on both sides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import save
from ledgerloom.llm.words import starts_of, texts_of

LETTERS = "a-zÀ-ÿ"
#: Places of a letter-count vector: a to z, and all other letters dealt to six.
PLACES, OTHERS = 32, 6
#: Words that decide the cells' cuts; words of a cell; visitors of a part of a cell; words of a leaf.
SAMPLE, CELL, VISITORS, LEAF = 50_000, 16_384, 400_000, 64
#: Words counted by a task before it sends them on, and characters of a text that are read at once.
HELD, PIECE = 200_000, 1 << 20

_PLACE = np.array([b - 97 if 97 <= b < 123 else PLACES - OTHERS + b % OTHERS for b in range(256)], np.int64)


def _pieces(text: str, gap: re.Pattern) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        m = gap.search(text, at + PIECE)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, modulus: int = 97) -> DataFrame:
    """word, n of the words that occur ``least`` times: runs of letters, A to Z in lower case, of which a checksum picks some to lose a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shorter runs give no word, with or without a lost letter.
        find, gap = re.compile(f"[{LETTERS}]{{{shortest},}}").findall, re.compile(f"[^{LETTERS}]")
        total: Counter[str] = Counter()
        send = lambda: pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text")), strict=True):
                start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                runs: Counter[str] = Counter()
                for piece in _pieces(text.lower().decode(), gap):
                    runs.update(find(piece))
                for word, n in runs.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % modulus == 0:
                        p = h % len(word)
                        word = word[:p] + word[p + 1 :]
                        if len(word) < shortest:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield send()
                    total.clear()
        if total:
            yield send()

    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def letter_counts(words: list[str]) -> np.ndarray:
    """One vector of ``PLACES`` counts for each word."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    flat = np.repeat(np.arange(len(words)) * PLACES, n) + _PLACE[codes]
    return np.bincount(flat, minlength=len(words) * PLACES).reshape(-1, PLACES).astype(np.int32)


def signatures(counts: np.ndarray) -> np.ndarray:
    """Two bits a place, so that the bits in which two words differ are at most their L1 distance."""
    bits = np.where(counts > 1, 3, counts).astype(np.uint64)
    return np.bitwise_or.reduce(bits << (np.arange(PLACES, dtype=np.uint64) * np.uint64(2)), axis=1)


class Node(NamedTuple):
    """A cut of a k-d tree, words with at most ``cut`` of a letter to the left; or a leaf with its members or number."""

    place: int
    cut: int
    left: Node | None
    right: Node | None
    leaf: np.ndarray | int | None


def grow(counts: np.ndarray, members: np.ndarray, size: int) -> Node:
    """A tree over ``members`` with leaves of at most ``size``, or of words that have the same letters."""
    if len(members) > size:
        mine = counts[members]
        place = int(mine.var(axis=0).argmax())
        column = mine[:, place]
        if column.min() < column.max():
            cut = min(int(np.median(column)), int(column.max()) - 1)
            low = column <= cut
            return Node(place, cut, grow(counts, members[low], size), grow(counts, members[~low], size), None)
    return Node(-1, 0, None, None, members)


def reach(tree: Node, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray | int, np.ndarray]]:
    """Each leaf with the rows of ``counts`` that may get into its box by ``up`` letters more and ``down`` fewer."""
    n = len(counts)
    none = np.zeros(n, np.int32)
    box = {}  # by place: the least and the most letters
    stack = [(tree, np.arange(n), none, none, box)]
    while stack:
        node, rows, lack, excess, box = stack.pop()
        if node.left is None:
            yield node.leaf, rows
            continue
        low, high = box.get(node.place, (0, 1 << 30))
        mine = counts[rows, node.place]
        over = excess - np.maximum(mine - high, 0) + np.maximum(mine - node.cut, 0)
        under = lack - np.maximum(low - mine, 0) + np.maximum(node.cut + 1 - mine, 0)
        for child, keep, a, b, sides in ((node.left, over <= down, lack, over, (low, node.cut)), (node.right, under <= up, under, excess, (node.cut + 1, high))):
            if keep.any():
                stack.append((child, rows[keep], a[keep], b[keep], box | {node.place: sides}))


class Cells:
    """Trees by length, whose leaves are numbered, and into how many parts each cell's words and visitors are split."""

    def __init__(self, sizes: dict[int, int], sample: list[str]):
        self.trees: dict[int, Node] = {}
        self.count = 0
        by: dict[int, list[str]] = {k: [] for k in sizes}
        for w in sample:
            by[len(w)].append(w)
        for k, words in sorted(by.items()):
            leaf = max(8, len(words) * CELL // max(1, sizes[k]))
            self.trees[k] = self._numbered(grow(letter_counts(words), np.arange(len(words)), leaf))
        share = sum(sizes.values()) / max(1, len(sample))
        homes, visits = np.zeros(self.count), np.zeros(self.count)
        for k, words in by.items():
            for step, cell, rows in self.visits(k, letter_counts(words), also_home=True):
                (homes if step is None else visits)[cell] += len(rows) * share
        self.word_parts = np.maximum(1, np.ceil(homes / (2 * CELL))).astype(np.int64)
        self.visitor_parts = np.maximum(1, np.ceil(visits / VISITORS)).astype(np.int64)

    def _numbered(self, node: Node) -> Node:
        if node.left is None:
            self.count += 1
            return node._replace(leaf=self.count - 1)
        return node._replace(left=self._numbered(node.left), right=self._numbered(node.right))

    def visits(self, length: int, counts: np.ndarray, also_home: bool = False) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(step in length, cell, rows) for words of one length; the step is None for the cell that a word belongs to."""
        for step, up, down in ((0, 1, 1), (1, 1, 0), (-1, 0, 1), *[(None, 0, 0)] * also_home):
            tree = self.trees.get(length + (step or 0))
            if tree is not None:
                for cell, rows in reach(tree, counts, up, down):
                    yield step, cell, rows


def _deal(cells: Cells):
    """Each word to its cell (home), and as a visitor to all cells within reach; to every part that may hold the other side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            salt = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
                for step, cell, rows in cells.visits(length, letter_counts([words[i] for i in mine]), also_home=True):
                    at, home = mine[rows], step is None
                    sides = int(cells.word_parts[cell]), int(cells.visitor_parts[cell])
                    own = salt[at] % sides[0 if home else 1]
                    for other in range(sides[1 if home else 0]):
                        part = own * sides[1] + other if home else other * sides[1] + own
                        found.append((np.full(len(at), cell), part, np.full(len(at), home), at))
                cell, part, home, at = (np.concatenate(x) for x in zip(*found, strict=True))
                some = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part), pa.array(home.astype(bool)), some.column("word"), some.column("n")], ["cell", "part", "home", "word", "n"])

    return run


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters are exactly one edit apart; ``b`` has as many letters as ``a`` or one more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= a.shape[1]


def near_pairs(words: list[str], visitors: list[str], most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visitor, word) numbers of pairs one edit apart; ``words`` have one length, ``visitors`` another one at most one off."""
    step = len(words[0]) - len(visitors[0])
    counts, theirs = letter_counts(words), letter_counts(visitors)
    sign, their_sign = signatures(counts), signatures(theirs)
    letters, their_letters = _letters(words), _letters(visitors)
    for leaf, rows in reach(grow(counts, np.arange(len(words)), LEAF), theirs, int(step >= 0), int(step <= 0)):
        width = max(1, most // len(leaf))
        for at in range(0, len(rows), width):
            some = rows[at : at + width]
            v, w = np.nonzero(np.bitwise_count(their_sign[some][:, None] ^ sign[leaf][None, :]) <= (2 if step == 0 else 1))
            v, w = some[v], leaf[w]
            if len(v):
                right = one_edit(letters[w], their_letters[v]) if step < 0 else one_edit(their_letters[v], letters[w])
                yield v[right], w[right]


def _search(table: pa.Table) -> pa.Table:
    """Of each visitor of a cell: how many of the cell's words are near, and the most frequent one."""
    home = np.asarray(table.column("home"))
    words, n = table.column("word").to_pylist(), np.asarray(table.column("n"))
    # In order of preference: the most frequent first, then the smallest.
    mine = sorted(np.flatnonzero(home).tolist(), key=lambda i: (-n[i], words[i]))
    resident = [words[i] for i in mine]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out: list[list] = [[], [], [], []]
    if resident:
        for step in (-1, 0, 1):
            there = np.flatnonzero(~home & (lengths == len(resident[0]) + step))
            visitors = [words[i] for i in there]
            total, best = np.zeros(len(visitors), np.int64), np.full(len(visitors), len(resident))
            if visitors:
                for v, w in near_pairs(resident, visitors):
                    total += np.bincount(v, minlength=len(visitors))
                    np.minimum.at(best, v, w)
            for v in np.flatnonzero(total).tolist():
                w = mine[best[v]]
                for column, x in zip(out, (visitors[v], int(total[v]), -int(n[w]), words[w]), strict=True):
                    column.append(x)
    return pa.table([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "near", "less", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best of the words that have a near one; ``words`` is a table that can be read again."""
    sizes = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    sample = [r.word for r in words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").collect()]
    dealt = words.mapInArrow(_deal(Cells(sizes, sample)), "cell long, part long, home boolean, word string, n long")
    found = dealt.groupBy("cell", "part").applyInArrow(_search, "word string, near long, less long, best string")
    out = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("less", "best")).alias("x"))
    return out.select("word", "n_near", (-F.col("x.less")).alias("best_n"), F.col("x.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows (word, form): the last form of each chain. Forms occur twice as often as their words, so chains, and the
    rounds of doubling, end."""
    state = save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = save(state.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not state.filter("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, modulus: int = 97, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word; the form is its most frequent near word, if ``ratio`` times as frequent."""
    words = save(word_counts(docs, shortest, least, modulus), "words")
    near = words.join(near_words(words), "word", "left")
    good = F.col("best_n") >= ratio * F.col("n")
    table = save(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")), "near")
    last = roots(table.filter("form IS NOT NULL"))
    return table.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

