"""Repeated passages, by a column-wise Burrows-Wheeler transform of many fragments.

Every ``span``-byte string has one anchor, the least-hashed ``ANCHOR``-byte string in
it, so equal strings have equal anchors. Blocks ask hash partitions which anchors
stand in more than one document; around those the text is cut into fragments, each
all the strings of one anchor. The fragments of a partition, merged to distinct
ones, go through the construction: each round puts one further symbol in front of
every fragment, finds the new suffixes' places from the transform so far, and
carries the transform and the common prefixes forward in one sequential pass.
At the end suffixes whose common prefix reaches ``span`` are equal strings, and the
smallest document of each group is known. An anchor with one distinct fragment has
nothing to be sorted against and stays out of the rounds. The number of partitions
follows the input, and an anchor with more than ``HOT`` fragments is not kept
together: its strings are dealt one by one, by a hash of the whole string, to
partitions of their own, where equal strings meet without a transform. So no
partition's arrays grow with one passage; what it is asked does, by a row for each
block that holds the passage. The arrays take the place of the external files, and
Spark's shuffle files hold the fragments.

Defined results: a null text is an empty one; a null ``doc_id`` takes no part and
loses nothing; rows that share a ``doc_id`` do not count against each other; texts
shorter than ``span`` lose nothing; an empty table gives an empty result;
``remove_repeats`` keeps further columns, of any name and type, as they are; texts of
any length are worked on whole, a longer one than a block's bytes in a block of its own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.blocks import as_declared, nullable, rows_of, write_blocks
from ledgerloom.llm.store import save
from ledgerloom.llm.words import U64, mix, starts_of, texts_of

ANCHOR = 24
END = 255
#: Fragments of one anchor (at most 1.2 MB at span 50) above which its strings are dealt one by one.
HOT = 1 << 14
_MOST = (1 << 16) - 1
#: Bits that tell anchors of one partition apart; the rest of a key is the partition's number.
_TAG = U64(34)
_MOST_PARTS = 1 << 30
_LUT = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_CHUNK = 1 << 16


def anchor_hashes(buf: np.ndarray) -> np.ndarray:
    """Hashes of all ``ANCHOR``-byte strings, by doubling."""
    k = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5), U64(0xD6E8FEB86659FD93))
    h1 = _LUT[buf]
    h2 = h1[:-1] * k[0] + h1[1:]
    h4 = h2[:-2] * k[1] + h2[2:]
    h8 = h4[:-4] * k[2] + h4[4:]
    h16 = h8[:-8] * k[3] + h8[8:]
    return mix(h16[:-8] * k[4] + h8[16:])


def runs_of(buf: np.ndarray, first: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings with one anchor: document, first string, number of strings, anchor hash.

    ``first`` has the documents' offsets and the total; equal strings get the same anchor, the leftmost of equals."""
    none = np.zeros(0, np.int64)
    if len(buf) < span:
        return none, none, none, none.view(U64)
    w = span - ANCHOR + 1
    low = U64((1 << 26) - 1)
    args, hashes = [], []
    for a in range(0, len(buf) - span + 1, _CHUNK):
        part = buf[a : a + _CHUNK + span - 1]
        h = anchor_hashes(part)
        x = (h & ~low) | np.arange(len(h), dtype=U64)
        step = 1
        m = x
        while 2 * step <= w:
            m = np.minimum(m[:-step], m[step:])
            step *= 2
        if step < w:
            m = np.minimum(m[: len(m) - (w - step)], m[w - step :])
        at = (m & low).astype(np.int64)
        args.append(at + a)
        hashes.append(h[at])
    arg, h = np.concatenate(args), np.concatenate(hashes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(arg)]
    good = np.arange(len(arg)) + span <= first[doc + 1]
    new = np.ones(len(arg), bool)
    new[1:] = (arg[1:] != arg[:-1]) | (doc[1:] != doc[:-1]) | ~good[:-1]
    at = np.flatnonzero(good & new)
    ends = np.flatnonzero(good & np.concatenate((new[1:] | ~good[1:], [True])))
    # The least of many hashes is small; mixed once more it deals anchors evenly.
    return doc[at], at, ends - at + 1, mix(h[at])


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


def _key(h: np.ndarray, parts: int) -> np.ndarray:
    """What partitions know of an anchor: its partition and ``_TAG`` bits. More than one anchor to a key only adds work."""
    return (part_of(h, parts).astype(U64) << _TAG) | (mix(h) >> (U64(64) - _TAG))


def _runs_by_part(key: np.ndarray) -> list[tuple[int, int, int]]:
    """(partition, from, to) of sorted keys, for the partitions that have any."""
    part = (key >> _TAG).astype(np.int64)
    at = np.flatnonzero(np.diff(part, prepend=-1))
    return list(zip(part[at].tolist(), at.tolist(), np.append(at, len(part))[1:].tolist(), strict=True))


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _pack40(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes() + (x >> U64(32)).astype(np.uint8).tobytes()


def _unpack40(b: bytes) -> np.ndarray:
    n = len(b) // 5
    return np.frombuffer(b, "<u4", n).astype(U64) | (np.frombuffer(b, np.uint8, n, 4 * n).astype(U64) << U64(32))


class Block:
    """A block's documents in order of their ids; documents without an id take no part."""

    def __init__(self, rows: pa.RecordBatch):
        self.rows, self.texts = rows, texts_of(rows.column("text"))
        ids = rows.column("doc_id").to_pylist()
        self.order = sorted((i for i, x in enumerate(ids) if x is not None), key=lambda i: ids[i])
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        self.raw = b"".join([self.texts[i] for i in self.order])
        self.first = starts_of(np.fromiter((len(self.texts[i]) for i in self.order), np.int64, len(self.order)))

    def runs(self, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return runs_of(np.frombuffer(self.raw, np.uint8), self.first, span)


def _pack_places(part: np.ndarray, at: np.ndarray, n: np.ndarray, which: np.ndarray) -> bytes:
    """Places, by partition: first string, number of strings, and number among the distinct fragments that went there."""
    order = np.argsort(part, kind="stable")
    parts, count = np.unique(part, return_counts=True)
    wide = len(which) and int(which.max()) >> 16 > 0
    head = np.array([len(parts), len(part), wide], "<i8").tobytes() + parts.astype("<i4").tobytes() + count.astype("<u4").tobytes()
    return head + at[order].astype("<u4").tobytes() + n[order].astype("<u1").tobytes() + which[order].astype("<u4" if wide else "<u2").tobytes()


def _places(data: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    m, k, wide = np.frombuffer(data, "<i8", 3).tolist()
    parts, count = np.frombuffer(data, "<i4", m, 24), np.frombuffer(data, "<u4", m, 24 + 4 * m)
    a = 24 + 8 * m
    at, n, which = (x.astype(np.int64) for x in (np.frombuffer(data, "<u4", k, a), np.frombuffer(data, "<u1", k, a + 4 * k), np.frombuffer(data, "<u4" if wide else "<u2", k, a + 5 * k)))
    cuts = starts_of(count.astype(np.int64)).tolist()
    for p, x, y in zip(parts.tolist(), cuts[:-1], cuts[1:], strict=True):
        yield p, at[x:y], n[x:y], which[x:y]


def fragments(b: Block, flagged: np.ndarray, hot: np.ndarray, parts: int, span: int) -> tuple[bytes, dict[int, tuple[list[bytes], list[int], list[int]]]]:
    """Places of the pieces with a flagged anchor; and for each partition the distinct fragments, the first document of each and
    a part of its anchor's key. A piece is a run, or one string of a run if its anchor is hot."""
    doc, at, n, h = b.runs(span)
    key = _key(h, parts)
    use = np.flatnonzero(_among(key, flagged))
    single = _among(key[use], hot)
    reps = np.where(single, n[use], 1)
    run, single = np.repeat(use, reps), np.repeat(single, reps)
    at = at[run] + np.arange(len(run)) - np.repeat(starts_of(reps)[:-1], reps)
    size = np.where(single, 1, n[run])
    part, which = np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
    sent: dict[int, tuple[list[bytes], list[int], list[int]]] = {}
    known: dict[int, dict[bytes, int]] = {}
    raw, stop, owner, tag = b.raw, at + size + span - 1, b.ids[doc[run]], key[run] & U64((1 << 32) - 1)
    for i, (p, x, start, end, d, t) in enumerate(zip((key[run] >> _TAG).tolist(), single.tolist(), at.tolist(), stop.tolist(), owner.tolist(), tag.tolist(), strict=True)):
        f = raw[start:end]
        if x:
            p = parts + (zlib.crc32(f) * parts >> 32)
        mine = known.get(p)
        if mine is None:
            mine, sent[p] = known.setdefault(p, {}), ([], [], [])
        k = mine.get(f)
        if k is None:
            k = mine[f] = len(mine)
            for o, v in zip(sent[p], (f, d, t), strict=True):
                o.append(v)
        part[i], which[i] = p, k
    return _pack_places(part, at, size, which), sent


def _symbol_places(symbols: np.ndarray, at: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where places ``at``, rising, that hold ``symbols`` stand in ``order``, which lists places by symbol and then place."""
    group = np.argsort(symbols, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(symbols[group], prepend=-1)), len(group))
    out = np.empty(len(at), np.int64)
    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        mine = group[x:y]
        lo, hi = first[symbols[mine[0]]], first[symbols[mine[0]] + 1]
        out[mine] = lo + np.searchsorted(order[lo:hi], at[mine]) + x + np.arange(y - x)
    return out


def transform(frags: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct fragments: each ``span``-byte string's fragment, start in it, and group of equal strings."""
    m = len(frags)
    none = np.zeros(0, np.int64)
    if not m:
        return none, none, none
    size = np.fromiter(map(len, frags), np.int64, m)
    data = np.frombuffer(b"".join(frags), np.uint8)
    end = np.cumsum(size)
    # Round 0: the empty suffixes, in order of the fragments, each preceded by its fragment's last symbol.
    bwt = data[end - 1].copy()
    lcp = np.zeros(m + 1, np.uint8)
    at, live = np.arange(m), np.arange(m)
    # The places by symbol: entry k is the place whose suffix, with its symbol in front, is suffix m + k.
    order = np.argsort(bwt, kind="stable").astype(np.int32)
    k = np.empty(m, np.int64)
    k[order] = np.arange(m)
    first = np.append(0, np.cumsum(np.bincount(bwt, minlength=256)))
    for j in range(int(size.max())):
        n = len(bwt)
        c = bwt[at]
        # The neighbours in the pile are the places before and after that hold the same symbol; the common prefix grows by it.
        same = k > first[c]
        cut = np.empty(2 * len(at), np.int64)
        cut[0::2], cut[1::2] = np.where(same, order[np.maximum(k - 1, 0)] + 1, at), at + 1
        down = np.where(same, np.minimum(np.minimum.reduceat(lcp, cut)[0::2], span - 1) + 1, 0)
        up_at = np.flatnonzero(k + 1 < first[c.astype(np.int64) + 1])
        if len(up_at):
            cut = np.empty(2 * len(up_at), np.int64)
            cut[0::2], cut[1::2] = at[up_at] + 1, order[k[up_at] + 1] + 1
            up = np.minimum(np.minimum.reduceat(lcp, cut)[0::2], span - 1) + 1
        # The sequential pass: old entries keep their order, new ones stand at their places between them.
        new = m + k
        old = np.ones(n + len(k), bool)
        old[new] = False
        left = size[live] - j - 2
        symbol = np.where(left >= 0, data[np.maximum(end[live] - j - 2, 0)], END).astype(np.uint8)
        new_bwt = np.empty(n + len(k), np.uint8)
        new_bwt[old] = bwt
        new_bwt[new] = symbol
        new_lcp = np.zeros(n + len(k) + 1, np.uint8)
        new_lcp[:-1][old] = lcp[:-1]
        new_lcp[new] = down
        if len(up_at):
            new_lcp[new[up_at] + 1] = up
        order = np.flatnonzero(old).astype(np.int32)[order]
        going = np.flatnonzero(left >= 0)
        going = going[np.argsort(k[going])]
        at, live, c = new[going], live[going], symbol[going]
        k = _symbol_places(c, at, order, first)
        old = np.ones(len(order) + len(k), bool)
        old[k] = False
        new_order = np.empty(len(old), np.int32)
        new_order[old] = order
        new_order[k] = at
        bwt, lcp, order = new_bwt, new_lcp, new_order
        first = first + np.append(0, np.cumsum(np.bincount(c, minlength=256)))
    follow = np.zeros(len(bwt), np.int32)
    follow[order] = m + np.arange(len(order), dtype=np.int32)
    group = np.cumsum(lcp[:-1] < span, dtype=np.int32)
    at, live = np.arange(m), np.arange(m)
    out_f, out_s, out_g = [], [], []
    for j in range(1, int(size.max()) + 1):
        still = size[live] >= j
        at, live = follow[at[still]], live[still]
        if j >= span:
            out_f.append(live)
            out_s.append(size[live] - j)
            out_g.append(group[at])
    if not out_f:
        return none, none, none
    return np.concatenate(out_f), np.concatenate(out_s), np.concatenate(out_g)


def smallest_documents(frags: list[bytes], docs: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document of each string of each fragment, fragment by fragment; and the fragments' offsets in that."""
    f, s, g = transform(frags, span)
    first = starts_of(np.fromiter((len(x) - span + 1 for x in frags), np.int64, len(frags)))
    least = np.full(int(g.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, g, docs[f])
    out = np.zeros(first[-1], np.int64)
    out[first[f] + s] = least[g]
    return out, first


_ROW = ["block", "kind", "part", "data"]
_SCHEMA = "block long, kind int, part int, data binary"


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], _ROW)


def _ask_anchors(parts: int, span: int):
    """Each block's distinct anchors by partition, with a bit for those in more than one of its documents, and the number of
    distinct fragments for those with more than one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(i, 1)])
                b = Block(rows_of(one))
                doc, place, n, h = b.runs(span)
                key = _key(h, parts)
                owner = b.ids[doc] if len(doc) else np.zeros(0, np.int64)
                order = np.lexsort((owner, key))
                key, owner = key[order], owner[order]
                head = np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1]))
                at = np.flatnonzero(head)
                tail = np.concatenate((at[1:], [len(key)])).astype(np.int64) - 1
                many = owner[at] != owner[tail[: len(at)]]
                count = np.ones(len(at), np.int64)
                begin, stop = place[order], (place + n + span - 1)[order]
                for g in np.flatnonzero(tail[: len(at)] > at).tolist():
                    x, y = at[g], tail[g] + 1
                    count[g] = len({b.raw[s:e] for s, e in zip(begin[x:y].tolist(), stop[x:y].tolist(), strict=True)})
                key = key[at]
                block = one.column("block")[0].as_py()
                low = key & ((U64(1) << _TAG) - U64(1))
                rows = [(block, 0, p, _pack_counts(low[x:y], many[x:y], count[x:y])) for p, x, y in _runs_by_part(key)]
                yield from _rows(rows).to_batches()

    return run


def _pack_counts(key: np.ndarray, many: np.ndarray, count: np.ndarray) -> bytes:
    more = np.flatnonzero(count > 1)
    n = np.array([len(key)], "<u4").tobytes()
    return n + _pack40(key) + np.packbits(many).tobytes() + more.astype("<u4").tobytes() + np.minimum(count[more], _MOST).astype("<u2").tobytes()


def _anchor_counts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    bits, rest = 4 + 5 * n, 4 + 5 * n + (n + 7) // 8
    m = (len(data) - rest) // 6
    count = np.ones(n, np.int64)
    count[np.frombuffer(data, "<u4", m, rest)] = np.frombuffer(data, "<u2", m, rest + 4 * m)
    return _unpack40(data[4:bits]), np.unpackbits(np.frombuffer(data, np.uint8, rest - bits, bits), count=n).astype(bool), count


def _shared_anchors(hot: int):
    """To each block, those of its anchors that stand in more than one document anywhere (kind 0), and which of them have more
    than ``hot`` fragments, equal ones counted once a block (kind 2)."""

    def run(table: pa.Table) -> pa.Table:
        blocks, part = table.column("block").to_pylist(), table.column("part")[0].as_py()
        got = [_anchor_counts(x) for x in table.column("data").to_pylist()]
        key, many, count = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.argsort(key, kind="stable")
        s = key[order]
        same = s[1:] == s[:-1]
        hit = many[order].copy()
        hit[1:] |= same
        hit[:-1] |= same
        head = np.flatnonzero(np.concatenate(([True], ~same)))
        total = np.repeat(np.add.reduceat(count[order], head), np.diff(np.append(head, len(s))))
        flag, large = np.zeros(len(key), bool), np.zeros(len(key), bool)
        flag[order], large[order] = hit, hit & (total > hot)
        rows = []
        at = starts_of(np.fromiter((len(x[0]) for x in got), np.int64, len(got)))
        for b, (x, y) in zip(blocks, zip(at[:-1], at[1:], strict=True), strict=True):
            for kind, pick in ((0, flag[x:y]), (2, large[x:y])):
                if pick.any():
                    rows.append((b, kind, part, _pack40(key[x:y][pick])))
        return _rows(rows)

    return run


def _flagged(rows: pa.Table, kind: int = 0) -> np.ndarray:
    got = [_unpack40(d) | (U64(p) << _TAG) for k, p, d in zip(*(rows.column(c).to_pylist() for c in ("kind", "part", "data")), strict=True) if k == kind]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, U64)


def _cut_fragments(parts: int, span: int):
    """Fragments for the partitions (kind 1); and for the block itself its places (kind 3), dealt to negative partitions, which
    hand them on, so that no later step hashes the text again."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows or not answers.num_rows:
            return _rows([])
        places, sent = fragments(Block(rows_of(blocks)), _flagged(answers), _flagged(answers, 2), parts, span)
        number = blocks.column("block")[0].as_py()
        rows = [(number, 3, -1 - (zlib.crc32(str(number).encode()) * parts >> 32), places)]
        for p, (f, d, t) in sent.items():
            n = np.array([len(f)], "<i8").tobytes()
            rows.append((number, 1, p, n + np.fromiter(map(len, f), "<u1", len(f)).tobytes() + np.array(t, "<u4").tobytes() + np.array(d, "<i8").tobytes() + b"".join(f)))
        return _rows(rows)

    return run


def _least_documents(frags: list[bytes], least: np.ndarray, tags: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``smallest_documents``; fragments that are alone with their anchor equal no others and need no rounds."""
    first = starts_of(np.fromiter((len(x) - span + 1 for x in frags), np.int64, len(frags)))
    doc = np.repeat(least, np.diff(first))
    _, at, count = np.unique(tags, return_inverse=True, return_counts=True)
    more = np.flatnonzero(count[at] > 1)
    if len(more):
        got, begin = smallest_documents([frags[i] for i in more.tolist()], least[more], span)
        doc[np.repeat(first[more] - begin[:-1], np.diff(begin)) + np.arange(len(got))] = got
    return doc, first


def _judge_fragments(parts: int, span: int):
    """Merge a partition's fragments, transform them, and tell each block where a smaller document has its strings. Partitions
    from ``parts`` on hold single strings, which are merged already; negative ones hand places on."""

    def run(table: pa.Table) -> pa.Table:
        blocks, part = table.column("block").to_pylist(), table.column("part")[0].as_py()
        if part < 0:
            return table.select(_ROW)
        known: dict[bytes, int] = {}
        least: list[int] = []
        tags: list[int] = []
        asked = []
        for data in table.column("data").to_pylist():
            n = int(np.frombuffer(data, "<i8", 1)[0])
            size = np.frombuffer(data, "<u1", n, 8)
            tag = np.frombuffer(data, "<u4", n, 8 + n)
            docs = np.frombuffer(data, "<i8", n, 8 + 5 * n)
            at = starts_of(size.astype(np.int64)) + 8 + 13 * n
            which = np.zeros(n, np.int64)
            for i, (x, y, d, t) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), docs.tolist(), tag.tolist(), strict=True)):
                f = data[x:y]
                k = known.get(f)
                if k is None:
                    k = known[f] = len(least)
                    least.append(d)
                    tags.append(t)
                elif d < least[k]:
                    least[k] = d
                which[i] = k
            asked.append((which, docs))
        frags = list(known)
        del known, table
        if part < parts:
            doc, first = _least_documents(frags, np.array(least, np.int64), np.array(tags, np.int64), span)
        else:
            doc, first = np.array(least, np.int64), np.arange(len(frags) + 1)
        head = np.ones(len(doc), bool)
        head[1:] = doc[1:] != doc[:-1]
        head[first[:-1]] = True
        start = np.flatnonzero(head)
        length = np.diff(np.append(start, len(doc)))
        run_first = np.searchsorted(start, first)
        smallest = np.minimum.reduceat(doc, first[:-1])
        rows = []
        for b, (which, docs) in zip(blocks, asked, strict=True):
            tell = (smallest[which] < docs).astype(np.int64)
            n = (run_first[which + 1] - run_first[which]) * tell
            pick = np.repeat(run_first[which] - starts_of(n)[:-1], n) + np.arange(n.sum())
            if len(pick):
                rows.append((b, 1, part, np.array([len(which)], "<i8").tobytes() + n.astype("<u1").tobytes() + length[pick].astype("<u1").tobytes() + doc[start[pick]].astype("<i8").tobytes()))
        return _rows(rows)

    return run


def _apply(span: int, columns: list[str], finish: Callable[[pa.RecordBatch, list[np.ndarray | None], list[bytes]], pa.RecordBatch]):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(rows_of(blocks))
        mask = np.zeros(len(b.raw) + 1, np.int32)
        got = list(zip(*(answers.column(c).to_pylist() for c in ("kind", "part", "data")), strict=True))
        told = {p: d for k, p, d in got if k == 1}
        for data in (d for k, _, d in got if k == 3):
            for p, place, size, k in _places(data):
                owner = b.ids[np.searchsorted(b.first, place, side="right") - 1]
                _, head = np.unique(k, return_index=True)
                size, docs = size[head], owner[head]
                # Fragments of which nothing was told have their first document here as the smallest.
                n, length, doc = np.zeros(len(size), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if p in told:
                    data, m = told[p], len(size)
                    n = np.frombuffer(data, "<u1", m, 8).astype(np.int64)
                    length = np.frombuffer(data, "<u1", n.sum(), 8 + m).astype(np.int64)
                    doc = np.frombuffer(data, "<i8", n.sum(), 8 + m + n.sum())
                silent = n == 0
                n2 = np.where(silent, 1, n)
                at = starts_of(n2)
                l2, d2 = np.zeros(at[-1], np.int64), np.zeros(at[-1], np.int64)
                l2[at[:-1][silent]], d2[at[:-1][silent]] = size[silent], docs[silent]
                full = np.ones(at[-1], bool)
                full[at[:-1][silent]] = False
                l2[full], d2[full] = length, doc
                begin = starts_of(l2)[:-1] - np.repeat(starts_of(size)[:-1], n2)
                reps = n2[k]
                pick = np.repeat(at[:-1][k] - starts_of(reps)[:-1], reps) + np.arange(reps.sum())
                gone = d2[pick] < np.repeat(owner, reps)
                x = np.repeat(place, reps)[gone] + begin[pick][gone]
                np.add.at(mask, x, 1)
                np.add.at(mask, x + l2[pick][gone] + span - 1, -1)
        gone = np.cumsum(mask[:-1]) > 0
        marks: list[np.ndarray | None] = [None] * len(b.texts)
        for j, i in enumerate(b.order):
            g = gone[b.first[j] : b.first[j + 1]]
            marks[i] = g if g.any() else None
        return pa.Table.from_batches([finish(b.rows.select(columns), marks, b.texts)])

    return run


def ask_blocks(docs: DataFrame, span: int, part_bytes: int = 2 << 20, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Blocks, their anchors that are shared, the fragments by partition, and the number of partitions."""
    blocks, total = write_blocks(docs)
    parts = max(8, min(_MOST_PARTS, -(-total // part_bytes)))
    asked = blocks.mapInArrow(_ask_anchors(parts, span), _SCHEMA)
    flagged = save(asked.groupBy("part").applyInArrow(_shared_anchors(hot), _SCHEMA), "anchors")
    cut = blocks.groupBy("block").cogroup(flagged.groupBy("block")).applyInArrow(_cut_fragments(parts, span), _SCHEMA)
    return blocks, flagged, cut, parts


def without_repeats(docs: DataFrame, span: int, finish: Callable, schema: T.StructType, hot: int = HOT) -> DataFrame:
    """Rows of ``docs`` after ``finish(rows, marks, texts)``; a mark has True for each byte that a smaller document repeats."""
    if not ANCHOR < span <= 128:
        raise ValueError("span must be over the anchor's length and 128 at most")
    blocks, _, cut, parts = ask_blocks(docs, span, hot=hot)
    told = save(cut.groupBy("part").applyInArrow(_judge_fragments(parts, span), _SCHEMA), "repeats")
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_apply(span, docs.columns, finish), schema)


def repeat_digests(docs: DataFrame, span: int = 50, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row."""

    def finish(rows: pa.RecordBatch, marks: list, texts: list[bytes]) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for mark, t in zip(marks, texts, strict=True):
            kept, gone, spans = t, 0, 0
            if mark is not None:
                kept = np.frombuffer(t, np.uint8)[~mark].tobytes()
                gone, spans = int(mark.sum()), int(mark[0]) + int(np.count_nonzero(mark[1:] & ~mark[:-1]))
            for o, v in zip(out, (len(t), gone, spans, hashlib.sha256(kept).hexdigest()), strict=True):
                o.append(v)
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), *[pa.array(o, pa.int64()) for o in out[:3]], pa.array(out[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return without_repeats(docs, span, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", hot)


def remove_repeats(docs: DataFrame, span: int = 50) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; a character goes only if all its bytes do. Null texts and further
    columns, of any type and name, stay as they are; every column may be null afterwards."""
    schema = nullable(docs.schema)
    at = docs.columns.index("text")

    def finish(rows: pa.RecordBatch, marks: list, texts: list[bytes]) -> pa.RecordBatch:
        out = rows.column("text").to_pylist()
        for i, (mark, t) in enumerate(zip(marks, texts, strict=True)):
            if mark is not None:
                b = np.frombuffer(t, np.uint8)
                lead = np.flatnonzero((b & 0xC0) != 0x80)
                whole = np.logical_and.reduceat(mark, lead)
                out[i] = b[~np.repeat(whole, np.diff(np.append(lead, len(b))))].tobytes().decode()
        columns = list(rows.columns)
        columns[at] = pa.array(out, pa.string())
        return pa.RecordBatch.from_arrays(as_declared(columns, schema), rows.schema.names)

    return without_repeats(docs, span, finish, schema)
