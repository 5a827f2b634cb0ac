"""Concatenate and cut: documents become windows of a fixed number of tokens.

Pass one encodes each row once, into a shared table that also holds the number of
tokens before it in its partition. Prefix sums over the partitions' totals then
give each partition's place in the whole stream. Pass two cuts every document at
the window boundaries; a piece is a boundary record of what lies in which window.
Only the partition totals, one row for each partition, meet in one place.

Defined results: a null text is an empty one and is its end token alone; repeated
rows are packed each; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import WordBPE, packed_ids
from ledgerloom.llm.store import save
from ledgerloom.llm.words import slices, texts_of


#: Partition totals are broadcast up to so many partitions.
BROADCAST_ROWS = 500_000


class LibraryEncoder(WordBPE):
    """The same words, each new one encoded by the tokenizers library's own model."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        from ledgerloom.llm.bpe import byte_symbols

        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.shown = dict(enumerate(byte_symbols()))
        import json

        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        self.special = self.added(j)
        self.split_by(next(p["pattern"]["Regex"] for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.cut = self.cutter(self.special)
        self.forget()

    def word_ids(self, word: str) -> list[int]:
        # Printable ASCII stands for itself.
        shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.shown)
        return [t.id for t in self.tokenize(shown)]


@lru_cache(maxsize=1)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """part, before (tokens before the row in its partition), doc_id, n, ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, before = library_encoder(path), TaskContext.get().partitionId(), 0
        end = packed_ids([end_id])
        for whole in batches:
            for b in slices(whole, "text"):
                ids = [x + end for x in model.encode_all(texts_of(b.column("text")))]
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), pa.array(at), b.column("doc_id"), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "before", "doc_id", "n", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "part long, before long, doc_id long, n long, ids binary")


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids."""
    rows = save(tokenized(docs, path, end_id), "tokens")
    totals = rows.groupBy("part").agg(F.sum("n").alias("tokens"))
    # One row a partition of the input, whose number is bounded by the scheduler; summed in order of the partitions.
    base = totals.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("base"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        for whole in batches:
            for b in slices(whole, "ids"):
                out: list[list] = [[] for _ in names]
                for doc, n, at, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "at", "ids")), strict=True):
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        size = min(n - start, window - offset)
                        piece = ids[4 * start : 4 * (start + size)]
                        for o, v in zip(out, (doc, start, size, zlib.crc32(piece), n, sequence, offset, piece), strict=True):
                            o.append(v)
                        start += size
                yield pa.RecordBatch.from_arrays([*[pa.array(o, pa.int64()) for o in out[:-1]], pa.array(out[-1], pa.binary())], names)

    few = totals.count() <= BROADCAST_ROWS
    placed = rows.join(F.broadcast(base) if few else base, "part").select("doc_id", "n", (F.col("base") + F.col("before")).alias("at"), "ids")
    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
