"""Token counts of words of any length."""

import random
import tracemalloc

import pytest

from ledgerloom.llm import counts
from ledgerloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def pieces():
    return counts.read_pieces(tokenizer_path("piece_bpe_32k.model"))


def test_counts_do_not_depend_on_what_is_kept(pieces, monkeypatch):
    from tokenizers import Tokenizer, models

    library = Tokenizer(models.Unigram(pieces, 0, False))
    monkeypatch.setattr(counts, "KEPT", 1)
    few = counts.UnigramCounter(pieces)
    r = random.Random(4)
    words = ["".join(r.choice("etaoinshr日本é🙂") for _ in range(r.randint(1, 400))) for _ in range(60)] + ["q" * 900, "🙂" * 300, "the" * 200]
    for w in words:
        assert few.count_word(counts.MARK + w) == len(library.encode(counts.MARK + w, add_special_tokens=False).ids), w[:20]


def test_memory_does_not_follow_the_word(pieces):
    counter = counts.UnigramCounter(pieces)
    word = "日本語のabc" * 100_000
    tracemalloc.start()
    n = counter.count_word(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 100_000 and peak < 4e6, peak
