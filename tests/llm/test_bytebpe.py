"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
import struct
from collections import Counter

import numpy as np
import pytest
import tiktoken

from ledgerloom.llm import bytebpe
from ledgerloom.llm.queries import queries, table, tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ranks = bytebpe.read_ranks(path)
    return path, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model(library):
    return bytebpe.byte_bpe(*library[:2])


def want(encoding, text):
    ids = encoding.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(encoding.decode_bytes(ids)).hexdigest()


def test_digests_of_odd_rows(odd_docs, library):
    got = bytebpe.byte_bpe_digests(odd_docs, *library[:2]).collect()
    rows = odd_docs.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == Counter((r["doc_id"], *want(library[2], r["text"])) for r in rows)


def test_query_on_a_small_table(spark, library):
    got = queries()["op12_byte_bpe"](spark, SMALL).collect()
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter((r["doc_id"], *want(library[2], r["text"])) for r in rows)


def test_round_trip(spark, odd_docs, no_docs, library):
    back = bytebpe.decode_documents(bytebpe.encode_documents(odd_docs, *library[:2]), *library[:2]).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in back) == Counter((r["doc_id"], r["text"] or "") for r in odd_docs.select("doc_id", "text").collect())
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in back)
    assert bytebpe.byte_bpe_digests(no_docs, *library[:2]).count() == 0
    none = bytebpe.encode_documents(no_docs, *library[:2])
    assert bytebpe.decode_documents(none, *library[:2]).count() == 0


def test_random_texts(model, library):
    """White space of all kinds at the edges of runs, contractions, and letters of many scripts."""
    r = random.Random(9)
    bits = [" ", "  ", "\n", "\t ", "\x1c", "\x85", "\xa0", "　", "a", "the", "don't", "'s", "12", "é", "日本語", "!!", "🙂", "‍", "ß", "_", "Straße"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    for t, ids in zip(texts, model.encode(texts), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == library[2].encode_ordinary(t), t


def test_long_words(model, library):
    """Words past one window, of many letters or of one, with and without tokens in common."""
    r = random.Random(11)
    letters = "etaoinshrdlu"
    words = ["".join(r.choice(letters) for _ in range(n)) for n in (257, 300, 511, 1000, 5000)]
    words += ["q" * 5000, "a" * 777, "abc" * 900, "日本語テキスト" * 300, "ÃÂ" * 700, "-" * 3001, "=" * 513, " " * 4000, "\n" * 999, "z" * 258 + "y" * 300]
    words += ["".join(r.choice("ab") for _ in range(3000)), "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(800))]
    for w, ids in zip(words, model.encode(words), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == library[2].encode_ordinary(w), w[:20]


def test_windows_without_a_common_token_are_doubled(library):
    """With tokens of three bytes and a window that is no multiple of three, the ends of a run differ in phase."""
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257}
    small = bytebpe.ByteBPE(ranks, library[1])
    whole = tiktoken.Encoding("own", pat_str=library[1], mergeable_ranks=ranks, special_tokens={})
    for n in (255, 256, 257, 700, 1001):
        assert list(np.frombuffer(small.encode(["a" * n])[0], "<u4")) == whole.encode_ordinary("a" * n)
    # A pair that only meets at one end: no token of two windows agrees, up to the whole word.
    ranks = {bytes([b]): b for b in range(256)}
    t = b"ab"
    for k in range(9):
        ranks[t], t = 256 + k, t + t
    small = bytebpe.ByteBPE(ranks, library[1])
    whole = tiktoken.Encoding("own", pat_str=library[1], mergeable_ranks=ranks, special_tokens={})
    for text in ("ab" * 1000, "b" + "ab" * 999, "ab" * 300 + "c" + "ab" * 300):
        assert list(np.frombuffer(small.encode([text])[0], "<u4")) == whole.encode_ordinary(text)


def test_pieces_of_long_texts(monkeypatch, library):
    monkeypatch.setattr(bytebpe, "PIECE", 7)
    texts = ["a bb  ccc dd\n eeee f ggg hhhh iiii", "x" * 100, " lead and  trail ", "ab　 cd ef gh ij kl mn"]
    assert all("".join(bytebpe.pieces_of(t)) == t for t in texts) and len(bytebpe.pieces_of(texts[0])) > 2
    model = bytebpe.byte_bpe(*library[:2])
    for t in texts:
        assert list(np.frombuffer(b"".join(model.encode(bytebpe.pieces_of(t))), "<u4")) == library[2].encode_ordinary(t)
