"""Byte-level BPE encoding and decoding from a rank file.

A text is cut by the split pattern, and each piece is encoded on its own. The automaton runs over
the bytes of a piece mapped to Latin-1 and lists every vocabulary match; the encoder takes the
longest match, steps back when two neighbouring tokens could not stand beside each other in a
merge result, and remembers that answer per pair. A sequence in which all neighbours are
compatible is the merge result, and each failure closes one position for good, so the work is
linear in the piece.

Defined results: a null text is empty and has no tokens; strings of special tokens are ordinary
text; repeated rows are encoded as often as they occur; an empty table gives no rows. Only the
named columns are read, so other columns may have any name. Memory per task is one Arrow batch
and caches of a fixed number of entries."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import str_texts

NEVER = 1 << 40
#: Remembered words; as many of those before them are kept as long as they are used.
CACHE_WORDS = 200_000
CACHE_PAIRS = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a space, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], below: int = NEVER) -> list[bytes]:
    """Merges as defined: again and again the leftmost pair of lowest rank. Quadratic; used to
    take vocabulary entries apart and as the yardstick in tests."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min(
            (ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
        )
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class BytePairCodec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        halves: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merge(token, ranks, below=rank)
                if len(parts) != 2:
                    continue  # no merge reaches it; only a whole piece can be it
                halves[rank] = ranks[parts[0]], ranks[parts[1]]
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.shorter = {rank: self._prefix(token) for token, rank in ranks.items()}
        self.right_edge = {r: self._edge(r, halves, 1) for r in self.bytes_of}
        self.left_edge = {r: self._edge(r, halves, 0) for r in self.bytes_of}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.unsafe = regex.compile(r"\s (?:\s|\Z)").search

    def _prefix(self, token: bytes) -> int:
        """The longest match that is a shorter beginning of a token, -1 for a single byte."""
        text = token.decode("latin-1")
        for end in range(len(text) - 1, 0, -1):
            match = self.automaton.get(text[:end], None)
            if match is not None:
                return match[0]
        return -1

    @staticmethod
    def _edge(token: int, halves: dict[int, tuple[int, int]], side: int) -> list[tuple[int, int]]:
        """The tokens that stood at one edge of a token while it was built, each with the rank of
        the merge that consumed it."""
        edge = [(token, NEVER)]
        while token in halves:
            part = halves[token][side]
            edge.append((part, token))
            token = part
        return edge

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives these two tokens again: no merge across the
        border may come before the merges that build the two sides. Of equal ranks, the leftmost
        merge is first."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        answer = True
        for a, a_gone in self.right_edge[left]:
            for b, b_gone in self.left_edge[right]:
                across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
                if across is not None and across < a_gone and across <= b_gone:
                    answer = False
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = answer
        return answer

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        # Matches come by their end, so the last one kept for a start is its longest.
        longest = [-1] * len(piece)
        for end, (rank, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank
        size, shorter, known = self.size, self.shorter, self.pairs.get
        stack: list[int] = []
        closed: set[int] = set()
        at = 0
        while at < len(piece):
            rank = longest[at]
            while rank >= 0:
                end = at + size[rank]
                if end not in closed:
                    if not stack:
                        break
                    fits = known((stack[-1], rank))
                    if fits is None:
                        fits = self.compatible(stack[-1], rank)
                    if fits:
                        break
                rank = shorter[rank]
            if rank >= 0:
                stack.append(rank)
                at = end
            else:
                closed.add(at)
                at -= size[stack.pop()]
        return stack

    def _encode_cut(self, text: str) -> tuple[int, ...]:
        ids: list[int] = []
        for piece in self.pieces(text):
            ids += self.encode_piece(piece.encode())
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Token ids of a text. The pattern never matches across a space that touches something
        else than white space on one side, so such texts are cut at spaces and the ids of each
        word are remembered; other texts go through the pattern as a whole."""
        if self.unsafe(text):
            return list(self._encode_cut(text))
        first, *rest = text.split(" ")
        ids = list(self._encode_cut(first))
        words = self.words
        for word in rest:
            known = words.get(word)
            if known is None:
                known = self.older.get(word)
                if known is None:
                    known = self._encode_cut(" " + word)
                if len(words) >= CACHE_WORDS:
                    self.older, self.words = words, {}
                    words = self.words
                words[word] = known
            ids += known
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> BytePairCodec:
    """One per worker process; the rank file is installed on every machine."""
    return BytePairCodec(read_ranks(path), pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, ids array<int>."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [np.array(bpe.encode(t), np.int32) for t in str_texts(some.column("text"))]
                offsets = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate(ids))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), lists], names=["doc_id", "ids"]
                )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(
    encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """doc_id, decoded binary; null ids decode to nothing."""
    slim = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [bpe.decode(x or []) for x in some.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(texts, pa.binary())],
                    names=["doc_id", "decoded"],
                )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(decode, f"doc_id {kind}, decoded binary")


def encode_digests(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256. The digests
    are taken where the ids are made, so the ids themselves never leave the task."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        decimal = {rank: str(rank) for rank in bpe.bytes_of}.__getitem__
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for t in str_texts(batch.column("text")):
                ids = bpe.encode(t)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
