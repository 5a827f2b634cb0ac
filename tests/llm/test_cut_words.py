"""Texts that are cut into words as arrays, and words remembered as places, against the pattern and the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex

from ledgerloom.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["'", "'", "'", *"sStTmdrevl", "re", "ll", " ", "\n", "\x1c", "\x85", " ", "7", "٣", "½", "é", "é", "Σ", "ς", "İ", "ß", "日", "𝔘", "#", "…", "_", "\x01", "<|endoftext|>", "<|"]


def texts(n):
    r = random.Random(n)
    return ["", "'", "''", "'s", "a'", *("".join(r.choices(SIGNS, k=r.randint(0, 40))) for _ in range(n))]


def test_words_by_kind():
    """All short forms and their likes, scripts and white space, each text apart."""
    find = regex.compile(bpe.BY_KINDS).findall
    some = [bpe.WordBPE.normal(t) for t in texts(3000)]
    words, first = bpe.words_by_kind(some)
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == [find(t) for t in some]
    assert [len(bpe.words_by_kind(x)[0]) for x in ([], [""], ["", " "])] == [0, 0, 0]


@pytest.mark.parametrize("model", [bpe.WordBPE(open(PATH, encoding="utf-8").read()), packing.LibraryEncoder(PATH)], ids=["own", "library"])
def test_many_texts_at_once(model, monkeypatch):
    """Ids of all texts are the library's, also where the memory is full again and again; another pattern takes the slow way."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(bpe, "REMEMBERED", 200)
    some = [t for t in texts(600) if "Σ" not in t]
    want = [library.encode(t, add_special_tokens=False).ids for t in some]
    for by_kinds in (True, False):
        model.by_kinds = by_kinds
        for at in range(0, len(some), 50):
            got = model.encode_all([t.encode() for t in some[at : at + 50]])
            assert [list(np.frombuffer(x, "<u4")) if x else [] for x in got] == want[at : at + 50]
            assert len(model.words) < 2000
