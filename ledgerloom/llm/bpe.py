"""BPE encoding by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary lists all matches in a word; the
longest match at a position is tried first, and a token is accepted only if it is
compatible with the one before, that is if the pair encodes to itself. A token
that fails gives way to its longest proper prefix token, and a dead end steps
back; positions found to be dead are never tried again, so the work is linear.

The vocabulary file's path is a parameter. Files of the kind used here lower-case
after NFC, split with one pattern and mark the last symbol of a word.

Defined results: a null text is an empty one and has no ids; repeated rows are
encoded alike; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.words import slices, starts_of, texts_of

#: Words remembered by a worker, and pairs of tokens; more only costs a new start of the memory.
REMEMBERED, PAIRS = 300_000, 500_000


def read_file(spark: SparkSession, path: str) -> str:
    """A vocabulary file's text, read on the driver: the tokenizer package puts it on every machine."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


#: Words are short forms, letters, single numbers and runs of other signs; texts split by this are cut as arrays.
BY_KINDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Of each code point: 0 for white space, 1 for a letter, 2 for a number, 3 for other signs."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(len(every), 3, np.uint8)
    for kind, pattern in enumerate((r"\s+", r"\p{L}+", r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def words_by_kind(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``BY_KINDS`` finds them, and the place of each text's first one, with their number at the end."""
    # White space parts the texts, and lets short forms look two signs ahead.
    code = np.frombuffer("\n\n\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    kind = kinds()[code]
    start = kind != 0
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    # A short form begins with the quote that begins a run of signs; what letters follow it are a word of their own.
    quote = np.flatnonzero(start & (code == ord("'")))
    one, two = code[quote + 1], code[quote + 2]
    short = [quote[np.isin(one, [ord(c) for c in "stmd"])], quote[np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")])]]
    for length, at in enumerate(short, 2):
        start[at + 1] = False
        start[at + length] |= kind[at + length] != 0
    place = np.flatnonzero(start)
    first = np.searchsorted(place, starts_of(np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))))
    kept = code[kind != 0]
    data = kept.tobytes().decode("utf-32-le").encode()
    width = np.ones(len(kept), np.uint8)
    for bound in (0x7F, 0x7FF, 0xFFFF):
        width += kept > bound
    offsets = np.append(starts_of(width)[np.flatnonzero(start[kind != 0])], len(data))
    return pa.Array.from_buffers(pa.large_string(), len(place), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), first


class WordBPE:
    """A word-level BPE vocabulary whose merged tokens are numbered in merge order."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = self.added(j)
        self.strings = {i: s for s, i in (vocab | self.special).items()}
        shown = byte_symbols()
        # One character stands for each symbol: a byte, or a byte that ends a word.
        self.inner = {s: chr(b) for b, s in enumerate(shown)}
        self.last = {s: chr(b + 512) for b, s in enumerate(shown)}
        self.to_inner = [chr(b) for b in range(256)]
        self.end_of = {chr(b): chr(b + 512) for b in range(256)}
        packed = {self._pack(s): i for s, i in vocab.items()}
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for a, b in merges:
            joined = vocab[(a[: -len(self.suffix)] if self.suffix and a.endswith(self.suffix) else a) + b]
            self.pairs[vocab[a], vocab[b]] = joined
            self.parts[joined] = (vocab[a], vocab[b])
        merged = [vocab[a + b] for a, b in merges]
        if merged != sorted(merged) or len(set(merged)) != len(merged):
            raise ValueError("merged tokens must be numbered in merge order")
        self.length = {i: len(p) for p, i in packed.items()}
        self.automaton = ahocorasick.Automaton()
        for p, i in packed.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        for p, i in packed.items():
            for n in range(len(p) - 1, 0, -1):
                if p[:n] in packed:
                    self.shorter[i] = packed[p[:n]]
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        split = next(p["pattern"]["Regex"] for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split_by(split)
        self.cut = self.cutter(self.special)
        self.forget()

    def split_by(self, pattern: str) -> None:
        self.words_in, self.by_kinds = regex.compile(pattern).findall, pattern == BY_KINDS

    @staticmethod
    def added(j: dict) -> dict[str, int]:
        special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        if any(s.split() != [s] for s in special):
            raise ValueError("added tokens must not hold white space")
        return special

    @staticmethod
    def cutter(special: dict[str, int]) -> regex.Pattern | None:
        return regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def _pack(self, s: str) -> str:
        if self.suffix and s.endswith(self.suffix) and s != self.suffix:
            s = s[: -len(self.suffix)]
            return "".join(self.inner[c] for c in s[:-1]) + self.last[s[-1]]
        return "".join(self.inner[c] for c in s)

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` side by side stay as they are: undoing merges, latest first, no pair across joins sooner."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        if len(self.fits) > PAIRS:
            self.fits.clear()
        x, y, bound, ok = a, b, 1 << 60, True
        while True:
            joined = self.pairs.get((x, y))
            if joined is not None and joined < bound:
                ok = False
                break
            # Of the two, the token merged later is opened; on the right one the earlier merge wins ties.
            if x > y and x in self.parts:
                bound, x = x, self.parts[x][1]
            elif y in self.parts:
                bound, y = y + 1, self.parts[y][0]
            elif x in self.parts:
                bound, x = x, self.parts[x][1]
            else:
                break
        self.fits[a, b] = ok
        return ok

    def encode_symbols(self, s: str) -> list[int]:
        """Ids of one word in packed symbols."""
        n = len(s)
        longest = [-1] * n
        length = self.length
        for end, token in self.automaton.iter(s):
            longest[end + 1 - length[token]] = token
        if longest[0] >= 0 and length[longest[0]] == n:
            return [longest[0]]
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        shorter, compatible = self.shorter, self.compatible
        while pos < n:
            while token >= 0:
                end = pos + length[token]
                if alive[end] and (not out or compatible(out[-1], token)):
                    break
                token = shorter.get(token, -1)
            if token >= 0:
                out.append(token)
                pos = end
                token = longest[pos] if pos < n else -1
            else:
                if not out:
                    raise ValueError("a symbol is not in the vocabulary")
                alive[pos] = 0
                token = out.pop()
                pos -= length[token]
        return out

    def word_ids(self, word: str) -> list[int]:
        b = word.encode()
        s = b.decode("latin-1")
        return self.encode_symbols(s[:-1] + self.end_of[s[-1]] if self.suffix else s)

    def forget(self) -> None:
        """A new memory: the place of each word, and where its ids end among those of all words."""
        self.words: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def make_room(self) -> None:
        if len(self.words) >= REMEMBERED or len(self.ids) >= 8 * REMEMBERED:
            self.forget()

    def place(self, word: str) -> int:
        at = self.words.get(word)
        if at is None:
            self.ids.extend(self.word_ids(word))
            self.ends.append(len(self.ids))
            at = self.words[word] = len(self.words)
        return at

    @staticmethod
    def normal(s: str) -> str:
        s = unicodedata.normalize("NFC", s)
        return "".join(c.lower() for c in s) if "Σ" in s else s.lower()

    def _plain(self, s: str) -> bytes:
        at = [self.place(w) for w in self.words_in(self.normal(s))]
        return b"".join(self.ids[self.ends[i] : self.ends[i + 1]].tobytes() for i in at)

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers."""
        self.make_room()
        s = text.decode()
        out, at = [], 0
        for m in self.cut.finditer(s) if self.cut is not None else ():
            out += [self._plain(s[at : m.start()]), packed_ids([self.special[m[0]]])]
            at = m.end()
        return b"".join([*out, self._plain(s[at:])])

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts. Those without added tokens are cut into words together, and each different word is looked up once."""
        self.make_room()
        shown = [t.decode() for t in texts]
        apart = {i for i, s in enumerate(shown) if not self.by_kinds or any(t in s for t in self.special)}
        words, first = words_by_kind(["" if i in apart else self.normal(s) for i, s in enumerate(shown)])
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        places = list(map(self.words.get, different))
        for i, at in enumerate(places):
            if at is None:
                places[i] = self.place(different[i])
        ids, ends = np.array(self.ids, np.uint32), np.array(self.ends, np.int64)
        which = np.array(places, np.int64)[coded.indices.to_numpy()]
        n = ends[which + 1] - ends[which]
        to = starts_of(n)
        ids = ids[np.repeat(ends[which] - to[:-1], n) + np.arange(to[-1])].astype("<u4")
        of = to[first]
        return [self.encode(t) if i in apart else ids[a:b].tobytes() for i, (t, a, b) in enumerate(zip(texts, of[:-1], of[1:], strict=True))]

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All token strings in UTF-8, each with a space before it, and their offsets by id."""
        if not hasattr(self, "_table"):
            parts = [(" " + self.strings.get(i, "")).encode() for i in range(max(self.strings) + 1)]
            self._table = np.frombuffer(b"".join(parts), np.uint8), starts_of(np.fromiter(map(len, parts), np.int64, len(parts)))
        return self._table

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by a space, as a decoder without further rules gives them."""
        if not len(ids):
            return b""
        data, offset = self.table
        start, size = offset[ids], offset[ids.astype(np.int64) + 1] - offset[ids]
        at = starts_of(size)
        return data[np.repeat(start - at[:-1], size) + np.arange(at[-1])][1:].tobytes()


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    """One model for each worker; the file is part of the installed tokenizer package."""
    with open(path, encoding="utf-8") as f:
        return WordBPE(f.read())


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(path)
        for whole in batches:
            for b in slices(whole, "text"):
                ids = model.encode_all(texts_of(b.column("text")))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded text of each row of ``encode_documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(path)
        for whole in batches:
            for b in slices(whole, "ids"):
                out = [model.decode(np.frombuffer(x, "<u4")) for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary()).cast(pa.string())], [*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, encoded.select("doc_id", "n_tokens", "ids").schema.add("decoded", "string"))


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and of the decoded text; both steps run in one pass over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(path)
        for whole in batches:
            for b in slices(whole, "text"):
                n, a, d = [], [], []
                for ids in model.encode_all(texts_of(b.column("text"))):
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    d.append(hashlib.sha256(model.decode(np.frombuffer(ids, "<u4"))).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
