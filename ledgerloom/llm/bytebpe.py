"""Byte-level BPE by DuckDB's recursive queries, one database in each worker.

Texts are split by the tokenizer's pattern, and each new word goes into a recursive
query as rows of (word, position, token), bytes at first. In each round neighbouring
rows of a word join the table of pairs that make a token, the leftmost pair of the
least rank is contracted, and a word that has none left is done. A worker remembers
words, so a query sees only new ones. Decoding joins rows of (position, id) with the
vocabulary and aggregates in order.

A word of many bytes would take as many rounds over all its rows. It is encoded in
windows that overlap by half, as words of their own: ids are right if every two
neighbours are those of some right encoding, so two windows are joined at a token that
both have in the same place. Where they share none, that word's windows are doubled.

Ranks are read from a file given by path: a base64 token and its rank on each line.

Defined results: a null text is an empty one and has no ids; repeated rows, and a null
doc_id, are encoded alike and stay; further columns are ignored; an empty table gives
an empty result. Texts of any length are worked on in pieces of about a megabyte; a
text without white space is one piece, and its words are cut as above.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import slices, starts_of, texts_of

#: Words remembered by a worker, about 200 bytes each, and the longest of them in characters; more only costs a new start of the memory.
REMEMBERED, LONGEST = 1_000_000, 64
#: Bytes of a piece of a text, of the pieces worked on together, of the words in one query, and of a long word's first windows.
PIECE, TOGETHER, ASKED, WINDOW = 1 << 20, 4 << 20, 1 << 20, 256

#: Keys are a word's number and the position in it. The least of (rank, position, bytes of the left token) is the leftmost pair of
#: least rank; the row after that many bytes goes.
_ENCODE = """
WITH RECURSIVE s AS (
  SELECT (word << 32) | position AS k, token, false AS done FROM symbols
  UNION ALL (
    WITH live AS (SELECT k, token FROM s WHERE NOT done),
    pairs AS (SELECT k, lead(k) OVER o AS after, (token << 20) | lead(token) OVER o AS pair FROM live WINDOW o AS (ORDER BY k)),
    least AS (SELECT k >> 32 AS word, min((m.rank << 43) | ((p.k & 4294967295) << 11) | (after - k)) AS best FROM pairs p JOIN merges m USING (pair) WHERE after >> 32 = k >> 32 GROUP BY ALL),
    chosen AS (SELECT word, (word << 32) | ((best >> 11) & 4294967295) AS first, best & 2047 AS size, best >> 43 AS rank FROM least)
    SELECT l.k, CASE WHEN l.k = c.first THEN c.rank ELSE l.token END, c.word IS NULL
    FROM live l LEFT JOIN chosen c ON l.k >> 32 = c.word WHERE l.k IS DISTINCT FROM c.first + c.size))
SELECT k >> 32 AS word, k & 4294967295 AS position, token FROM s WHERE done ORDER BY k"""

_DECODE = "SELECT string_agg(v.symbols, '' ORDER BY t.position) FROM ids t JOIN vocabulary v USING (id)"

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class ByteBPE:
    """Ranks with a database of the pairs that merge and of each token's bytes, as characters up to 255."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.words_in = ranks, regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        if max(ranks.values()) >= 1 << 20 or max(map(len, ranks)) >= 1 << 11:
            raise ValueError("ranks must be below 2^20, and tokens shorter than 2^11 bytes")
        pairs = [(ranks[t[:k]] << 20 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(t) for t in ranks]
        # A worker's database is in memory, takes one thread, and writes no files.
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        merges = pa.table({"pair": [p for p, _ in pairs], "rank": [r for _, r in pairs]})  # noqa: F841  found by the query
        vocabulary = pa.table({"id": list(ranks.values()), "symbols": [t.decode("latin-1") for t in ranks]})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT pair, rank FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT id, symbols FROM vocabulary")
        self.words: dict[str, bytes] = {}

    def _fixpoints(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tokens of each word and where they start."""
        out = []
        for a, b in _grouped([len(w) for w in words], ASKED):
            some = words[a:b]
            n = np.fromiter(map(len, some), np.int64, len(some))
            at = starts_of(n)
            symbols = pa.table({"word": np.repeat(np.arange(len(some)), n), "position": np.arange(at[-1]) - np.repeat(at[:-1], n), "token": self.single[np.frombuffer(b"".join(some), np.uint8)]})  # noqa: F841
            got = self.db.execute(_ENCODE).fetchnumpy()
            cuts = np.searchsorted(got["word"], np.arange(len(some) + 1))
            out += [(got["token"][x:y], got["position"][x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _long(self, word: bytes, size: int = WINDOW) -> np.ndarray:
        """Tokens of a word of any length, by windows that are joined at common tokens."""
        while True:
            at = range(0, max(1, len(word) - size // 2), size // 2)
            found = self._fixpoints([word[i : i + size] for i in at])
            tokens, starts = list(found[0][0]), list(found[0][1])
            for begin, (t, s) in zip(at[1:], found[1:], strict=True):
                mine = {(int(x) + begin, int(y)): k for k, (x, y) in enumerate(zip(s, t, strict=True))}
                k = len(tokens) - 1
                while k >= 0 and starts[k] >= begin and (starts[k], tokens[k]) not in mine:
                    k -= 1
                if k < 0 or starts[k] < begin:
                    break
                there = mine[starts[k], tokens[k]]
                del tokens[k:], starts[k:]
                tokens += t[there:].tolist()
                starts += (s[there:] + begin).tolist()
            else:
                return np.array(tokens, np.int64)
            size *= 2

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered, as little-endian 32-bit integers."""
        found: dict[str, bytes] = {}
        new = []
        for w in words:
            b = w.encode()
            rank = self.ranks.get(b)
            if rank is not None:
                found[w] = np.uint32(rank).astype("<u4").tobytes()
            elif len(b) > WINDOW:
                found[w] = self._long(b).astype("<u4").tobytes()
            else:
                new.append((w, b))
        for (w, _), (tokens, _) in zip(new, self._fixpoints([b for _, b in new]), strict=True):
            found[w] = tokens.astype("<u4").tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.words_in(t) for t in texts]
        if len(self.words) > REMEMBERED:
            self.words = {}
        known = [list(map(self.words.get, ws)) for ws in split]
        new = self._learn({w for ws, ids in zip(split, known, strict=True) if None in ids for w, i in zip(ws, ids, strict=True) if i is None})
        self.words.update((w, i) for w, i in new.items() if len(w) <= LONGEST)
        return [b"".join([new[w] if i is None else i for w, i in zip(ws, ids, strict=True)] if None in ids else ids) for ws, ids in zip(split, known, strict=True)]

    def decode(self, each: list[np.ndarray]) -> list[bytes]:
        """Bytes of each sequence of ids."""
        flat = np.concatenate([np.zeros(0, np.int64), *each]).astype(np.int64)
        ids = pa.table({"position": np.arange(len(flat)), "id": flat})  # noqa: F841
        whole = (self.db.execute(_DECODE).fetchone()[0] or "").encode("latin-1")
        at = starts_of(self.size[flat])[starts_of(np.fromiter(map(len, each), np.int64, len(each)))]
        return [whole[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _grouped(sizes: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that have about ``budget`` together, or are one."""
    a, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > budget:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def pieces_of(text: str) -> list[str]:
    """A text cut before spaces that begin a word, into pieces of about ``PIECE`` characters."""
    cuts = [0]
    while len(text) - cuts[-1] > PIECE:
        m = _SAFE_SPACE.search(text, cuts[-1] + PIECE)
        if m is None:
            break
        cuts.append(m.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One model for each worker; the file is part of the installed tokenizer package."""
    return ByteBPE(read_ranks(path), pattern)


def _encoded(batch: pa.RecordBatch, model: ByteBPE) -> Iterator[list[tuple[int, bytes]]]:
    """(row, ids) of the pieces of a batch's texts in order, so many at a time as make ``TOGETHER``."""
    rows, pieces, size = [], [], 0
    for row, t in enumerate(texts_of(batch.column("text"))):
        for p in pieces_of(t.decode()):
            rows.append(row)
            pieces.append(p)
            size += len(p)
            if size >= TOGETHER:
                yield list(zip(rows, model.encode(pieces), strict=True))
                rows, pieces, size = [], [], 0
    if rows:
        yield list(zip(rows, model.encode(pieces), strict=True))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(path, pattern)
        for whole in batches:
            for b in slices(whole, "text", TOGETHER):
                ids: list[list[bytes]] = [[] for _ in range(b.num_rows)]
                for some in _encoded(b, model):
                    for row, i in some:
                        ids[row].append(i)
                joined = [b"".join(i) for i in ids]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(i) // 4 for i in joined], pa.int64()), pa.array(joined, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded bytes of each row of ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(path, pattern)
        for whole in batches:
            for b in slices(whole, "ids", TOGETHER):
                out = model.decode([np.frombuffer(i or b"", "<u4") for i in b.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def byte_bpe_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the decoded bytes; both steps run in one pass over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(path, pattern)
        for whole in batches:
            for b in slices(whole, "text", TOGETHER):
                n, coded, plain = [0] * b.num_rows, [hashlib.sha256() for _ in range(b.num_rows)], [hashlib.sha256() for _ in range(b.num_rows)]
                for some in _encoded(b, model):
                    for (row, ids), text in zip(some, model.decode([np.frombuffer(i, "<u4") for _, i in some]), strict=True):
                        n[row] += len(ids) // 4
                        coded[row].update(ids)
                        plain[row].update(text)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), *[pa.array([h.hexdigest() for h in hs], pa.string()) for hs in (coded, plain)]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
