"""Counting the pieces of a unigram tokenizer without building them.

An Aho-Corasick automaton enumerates all vocabulary pieces that end at each
character. Dynamic programming over the characters carries the best score and
the number of pieces on the way to it. Ties go as in the tokenizers: a later
candidate replaces an earlier one only with a higher score, and candidates come
by their start, so the longest piece wins. A character that no piece covers
costs the lowest score less ten, and counts as its UTF-8 bytes.

No piece goes on with a space mark after another character, so a text falls
into words that can be counted one by one; counts of words seen are kept.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedpulse.llm.arrow import added

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 300_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model file, with the scores in the file.

    A unigram model's scores are log probabilities. A BPE model's, as ``op8`` reads them for want of
    another file, are its merges' ranks below zero: best is then the segmentation whose ranks sum up
    highest, which prefers few and early merged pieces and is no tokenizer's own count.
    """
    import sentencepiece  # noqa: PLC0415

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.vocab_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Counter(dict):
    """For each word, its number of pieces and best score; missing ones are counted."""

    def __init__(self, vocabulary: tuple[tuple[str, float], ...]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        crossing = any(SPACE in piece.lstrip(SPACE) for piece, _ in vocabulary)
        self.cut = None if crossing else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def words(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        return self.cut(marked) if self.cut else [marked] * bool(marked)

    def __missing__(self, word: str) -> tuple[int, float]:
        out = self.viterbi(word)
        if len(self) < KEPT_WORDS:
            self[word] = out
        return out

    def viterbi(self, word: str) -> tuple[int, float]:
        """Pieces on the best way, and its score."""
        n = len(word)
        if not n:
            return 0, 0.0
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        done = 0

        def alone(end: int, best: float | None, count: int) -> None:
            """The last character by itself as unknown, unless a piece has it."""
            score = scores[end - 1] + self.unknown
            if best is None or score > best:
                best, count = score, counts[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            scores[end], counts[end] = best, count

        at, found = -1, []
        ends = self.automaton.iter(word)
        for end, piece in ends:
            if end != at:
                if found:
                    self._step(at + 1, found, scores, counts, alone)
                for skipped in range(max(done, at + 1) + 1, end + 1):
                    alone(skipped, None, 0)
                at, found, done = end, [], end
            found.append(piece)
        if found:
            self._step(at + 1, found, scores, counts, alone)
        for skipped in range(at + 2, n + 1):
            alone(skipped, None, 0)
        return counts[n], scores[n]

    @staticmethod
    def _step(end: int, found: list[tuple[int, float]], scores, counts, alone) -> None:
        best, count, single = None, 0, False
        found.sort(reverse=True)
        for length, score in found:
            single = single or length == 1
            candidate = scores[end - length] + score
            if best is None or candidate > best:
                best, count = candidate, counts[end - length] + 1
        if single:
            scores[end], counts[end] = best, count
        else:
            alone(end, best, count)

    def count(self, text: str) -> tuple[int, float]:
        pairs = [self[w] for w in self.words(text)]
        return sum(p[0] for p in pairs), float(sum(p[1] for p in pairs))


@lru_cache(maxsize=2)
def counter(vocabulary: tuple[tuple[str, float], ...]) -> Counter:
    """One per worker and vocabulary."""
    return Counter(vocabulary)


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``best_score`` of every whole text.

    A space mark goes before the text and replaces its spaces; nothing else is
    normalised. Null and empty texts have no tokens and score 0. Repeated rows come back row by
    row, an empty table empty. Columns that clash with the new ones give way to them. The vocabulary, of bounded size,
    goes to the executors as a broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary))

    def make(texts: list[bytes]) -> list[pa.Array]:
        tool = counter(sent.value)
        rows = [tool.count(t.decode("utf-8", "replace")) for t in texts]
        return [
            pa.array(np.array([r[0] for r in rows], dtype=np.int64)),
            pa.array(np.array([r[1] for r in rows], dtype=np.float64)),
        ]

    return added(docs, text, "n_tokens long, best_score double", make)
