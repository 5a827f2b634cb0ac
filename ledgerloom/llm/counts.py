"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton lists the vocabulary's matches that end at each character;
dynamic programming carries the best score and the number of pieces. Of equal scores
the longest piece stays, as in the tokenizers library's unigram model: candidates
come by rising start and only a better score replaces one. A character that is no
piece costs the least score less 10, and neighbouring ones count as one piece.

Pieces and scores are read from a piece file given by path. A text's words, which
are runs without ASCII white space, are encoded each with the word mark before it.

Defined results: a null text is an empty one and has no tokens; repeated rows, and a
null doc_id, count alike and stay; texts and words of any length are counted whole; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import slices, texts_of

MARK, UNKNOWN_COST, REMEMBERED = "▁", 10.0, 400_000
#: Places of a word whose scores are kept besides those that a piece may begin at.
KEPT = 1 << 12


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores as stored, without control and byte pieces; the unknown piece is first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
    return [("<unk>", 0.0), *[(model.id_to_piece(i), model.get_score(i)) for i in plain]]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.unknown = min(s for _, s in pieces) - UNKNOWN_COST
        self.automaton = ahocorasick.Automaton()
        for i, (p, s) in enumerate(pieces):
            if i:
                self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.longest = max((len(p) for p, _ in pieces[1:]), default=1)
        self.kept = KEPT + self.longest
        self.words: dict[bytes, int] = {}

    def count_word(self, s: str) -> int:
        """Pieces of the best path over ``s``. Matches are read as the automaton gives them, by their ends; scores are kept no
        farther back than the longest piece, so memory does not follow the word's length."""
        best, pieces, odd, base = [0.0], [0], [False], 0
        unknown, matches = self.unknown, self.automaton.iter(s)
        end, match = next(matches, (-1, None))
        for e in range(1, len(s) + 1):
            found = []
            while end == e - 1:
                found.append(match)
                end, match = next(matches, (-1, None))
            if len(found) > 1:
                found.sort(reverse=True)
            top, start, single, lone = None, -1, False, False
            for size, score in found:
                single = single or size == 1
                x = score + best[e - size - base]
                if top is None or x > top:
                    top, start = x, e - size
            if not single:
                x = unknown + best[e - 1 - base]
                if top is None or x > top:
                    top, start, lone = x, e - 1, True
            best.append(top)
            odd.append(lone)
            pieces.append(pieces[start - base] + (0 if lone and odd[start - base] else 1))
            if len(best) > self.kept:
                gone = len(best) - self.longest
                del best[:gone], pieces[:gone], odd[:gone]
                base += gone
        return pieces[-1]

    def count(self, text: bytes) -> int:
        known, total = self.words, 0
        for w in text.split():
            n = known.get(w)
            if n is None:
                n = self.count_word(MARK + w.decode())
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(w) <= 64:
                    known[w] = n
            total += n
        return total


@lru_cache(maxsize=2)
def unigram_counter(path: str) -> UnigramCounter:
    return UnigramCounter(read_pieces(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = unigram_counter(path)
        for whole in batches:
            for b in slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([counter.count(t) for t in texts_of(b.column("text"))], pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long")
