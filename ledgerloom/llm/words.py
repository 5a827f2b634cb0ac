"""Vectorised text helpers that run inside tasks on a batch of documents.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``, which is
what ``bytes.split()`` returns; ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x ^= x >> U64(27)
    x *= _M2
    x ^= x >> U64(31)
    return x


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hashes of words."""
    a = np.empty(len(words), dtype=object)
    a[:] = words
    return pd.util.hash_array(a, categorize=False)


def slices(batch: pa.RecordBatch, text: str, budget: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that each part holds about ``budget`` bytes of text."""
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0), dtype=np.int64)
    part = np.cumsum(size) // budget
    cuts = np.flatnonzero(np.diff(part)) + 1 if len(part) else []
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def texts_of(column: pa.Array) -> list[bytes]:
    """Whole texts in UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums with the total at the end."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
