"""Token counts of a unigram vocabulary by a count-only Viterbi.

An Aho-Corasick automaton lists every vocabulary match of a word; dynamic programming over its
characters carries the best score and the number of pieces, and no piece is ever built. The tie
rules are those of the tokenizers library's unigram model: scores are added in double precision
from left to right; of equal scores the match that starts first (the longest) stays; a character
without a match of its own may be unknown at the lowest score less ten, tried last; neighbouring
unknowns are one piece, which counts its bytes where the vocabulary has byte pieces.

Texts are cut at spaces as that library's metaspace splitting does, so counts of words add up and
are remembered.

Defined results: a null or empty text has no tokens; repeated rows each give a row; an empty table
gives no rows. Only the named columns are read, so other columns may have any name. A task holds one
Arrow batch and a cache of a fixed number of words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import str_texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 400_000


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, in id order, and the id of the unknown piece, of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids], model.unk_id()


class UnigramCounter:
    """Counts pieces of texts under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unk_id: int, byte_fallback: bool = True):
        self.score_of = {}
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.score_of[piece] = score
                self.automaton.add_word(piece, (len(piece), score, i == unk_id))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.bytes_known = byte_fallback and all(f"<0x{b:02X}>" in self.score_of for b in range(256))
        self.singles = {piece for piece in self.score_of if len(piece) == 1}
        self.unk_piece = vocabulary[unk_id][0]
        self.words: dict[str, int] = {}

    def _run(self, text: str) -> int:
        """Pieces of a run of unknown characters."""
        if not text or text in self.score_of:
            return bool(text)
        return len(text.encode()) if self.bytes_known else 1

    def count_word(self, text: str) -> int:
        """Pieces on the best path. Where every character is a piece of its own, nothing is
        unknown, and matches are taken as the automaton lists them: by end, longest first."""
        if not self.singles.issuperset(text) or self.unk_piece in text:
            return self.count_with_unknowns(text)
        score, pieces = [0.0, *[-math.inf] * len(text)], [0] * (len(text) + 1)
        for end, (size, own, _) in self.automaton.iter(text):
            value = own + score[end + 1 - size]
            if value > score[end + 1]:
                score[end + 1] = value
                pieces[end + 1] = pieces[end + 1 - size] + 1
        return pieces[-1]

    def count_with_unknowns(self, text: str) -> int:
        """Pieces on the best path. Nodes hold the score, the pieces before the open run of
        unknowns, and where that run starts (or the node itself)."""
        n = len(text)
        matches: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        single = bytearray(n + 1)
        for end, match in self.automaton.iter(text):
            matches[end + 1].append(match)
            if match[0] == 1:
                single[end] = 1
        score, pieces, run = [0.0] * (n + 1), [0] * (n + 1), list(range(n + 1))
        for end in range(1, n + 1):
            # Longest first: it starts first, and an equal score does not replace it.
            options = sorted(matches[end], reverse=True) if len(matches[end]) > 1 else matches[end]
            best = None
            for size, own, is_unknown in options:
                value = own + score[end - size]
                if best is None or value > best[0]:
                    best = value, size, is_unknown
            if not single[end - 1]:
                value = self.unknown + score[end - 1]
                if best is None or value > best[0]:
                    best = value, 1, True
            value, size, is_unknown = best
            start = end - size
            score[end] = value
            if is_unknown:
                pieces[end], run[end] = pieces[start], run[start]
            else:
                pieces[end] = pieces[start] + self._run(text[run[start] : start]) + 1
        return pieces[n] + self._run(text[run[n] :])

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.replace(SPACE, " ").split(" ")
        total = self.count_word(SPACE + first) if first else 0
        words = self.words
        for word in rest:
            known = words.get(word)
            if known is None:
                if len(words) >= CACHE_WORDS:
                    words.clear()
                known = words[word] = self.count_word(SPACE + word)
            total += known
        return total


@lru_cache(maxsize=2)
def counter(path: str, byte_fallback: bool) -> UnigramCounter:
    return UnigramCounter(*read_vocabulary(path), byte_fallback)


def count_tokens(
    docs: DataFrame,
    path: str,
    byte_fallback: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_chars (code points) and chars_per_token (null without tokens)."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path, byte_fallback)
        for batch in batches:
            texts = list(str_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([counts.count(t) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["doc_id", "n_tokens", "n_chars"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = slim.mapInArrow(count, f"doc_id {kind}, n_tokens long, n_chars long")
    return counted.withColumn("chars_per_token", F.expr("try_divide(n_chars, n_tokens)"))
