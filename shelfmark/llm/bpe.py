"""Byte-level BPE as a monoid: encodings of halves are joined, decodings are concatenated.

Why a join is right: a sequence of tokens is the encoding of its bytes exactly if each two neighbours
are (each pair of neighbours is what their own bytes encode to). Two encodings meet in one place only;
if the tokens there are such a pair, the concatenation is the encoding. If not, a window around the
border is encoded anew and grows until its outermost tokens are such pairs with their neighbours outside.
Then all neighbours are, inside, outside and across, and the tokens outside cannot change any more.
"""

from __future__ import annotations

import base64
import heapq
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, functions as F

# Words a worker remembers, and each of pieces, parts of pieces, windows and pairs. With the lengths below that bounds the
# bytes: some 200 a word, 500 at most, and 300 at most of the others. Words save the search for pieces, so they are more.
WORDS = 1 << 18
REMEMBERED = 1 << 18
# Parts of pieces up to this many bytes are remembered.
SHORT = 12
# Windows up to this many bytes are merged by plain search, longer ones with a heap.
PLAIN = 64
# Tokens a leaf of the decoding tree joins at once.
LEAF = 4096


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Remembered:
    """A bounded dictionary. What was not asked for while the last half of it came in is forgotten.

    Entries are put into ``new``; once that holds half of them, it becomes ``old`` and what was old goes.
    """

    def __init__(self, most: int):
        self.half = most // 2
        self.new: dict = {}
        self.old: dict = {}

    def aged(self, key):
        """The value of a key that ``new`` has not; None if it is forgotten."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.half:
            self.new, self.old = {}, self.new
        self.new[key] = value


class Vocabulary:
    """Ranks of a byte-level vocabulary in tiktoken's format, and the pattern that cuts texts to pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.after_blank = regex.compile(r"\s\x20")
        self.words = Remembered(WORDS)  # words to packed tokens
        self.pieces, self.parts, self.windows, self.pairs = (Remembered(REMEMBERED) for _ in range(4))

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a window: the neighbours of lowest joint rank merge first, the leftmost of equals."""
        if len(data) > PLAIN:
            return self._merge_long(data)
        ranks = self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        joint = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
        while joint:
            best, at = None, -1
            for i, rank in enumerate(joint):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = ranks.get(parts[at - 1] + parts[at])
            if at < len(joint):
                joint[at] = ranks.get(parts[at] + parts[at + 1])
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same merges over a linked list of parts, the next one taken from a heap."""
        ranks, size = self.ranks, len(data)
        ends, after, before = list(range(1, size + 1)), list(range(1, size + 1)), list(range(-1, size - 1))
        alive = [True] * size
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, end = heapq.heappop(heap)
            right = after[left] if alive[left] else size
            if right >= size or ends[right] != end:
                continue
            ends[left], alive[right], after[left] = end, False, after[right]
            if after[left] < size:
                before[after[left]] = left
            for a in (before[left], left):
                b = after[a] if a >= 0 else size
                if b < size and (r := ranks.get(data[a:ends[b]])) is not None:
                    heapq.heappush(heap, (r, a, ends[b]))
        return [ranks[data[i:ends[i]]] for i in range(size) if alive[i]]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are next to each other."""
        pair = left << 32 | right
        known = self.pairs.new.get(pair)
        if known is None:
            known = self.pairs.aged(pair)
        if known is None:
            known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs.put(pair, known)
        return known

    def window(self, data: bytes) -> list[int]:
        """``merge`` that remembers short windows: borders of syllables and endings come again and again."""
        if len(data) > SHORT:
            return self.merge(data)
        known = self.windows.new.get(data)
        if known is None:
            known = self.windows.aged(data)
        if known is None:
            known = self.merge(data)
            self.windows.put(data, known)
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded texts put together."""
        if not left or not right or self.neighbours(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self.window(b"".join(map(self.tokens.__getitem__, left[-a:] + right[:b])))
            held_left = a == len(left) or self.neighbours(left[-a - 1], window[0])
            held_right = b == len(right) or self.neighbours(window[-1], right[b])
            if held_left and held_right:
                return left[:-a] + window + right[b:]
            if not held_left:
                a = min(2 * a, len(left))
            if not held_right:
                b = min(2 * b, len(right))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one piece by halves; a piece that is a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self._halves(data)

    def _halves(self, data: bytes) -> list[int]:
        """Encoding by a tree of halves; lists it returns are shared and never changed."""
        known = self.parts.new.get(data)
        if known is None:
            known = self.parts.aged(data)
        if known is not None:
            return known
        if len(data) < 2:
            return [self.ranks[data]] if data else []
        middle = len(data) // 2
        ids = self.join(self._halves(data[:middle]), self._halves(data[middle:]))
        if len(data) <= SHORT:
            self.parts.put(data, ids)
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.new.get(piece)
        if ids is None:
            ids = self.pieces.aged(piece)
        if ids is None:
            ids = packed(self.encode_bytes(piece.encode("utf-8", "replace")))
            if len(piece) <= PLAIN:
                self.pieces.put(piece, ids)
        return ids

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def encode(self, text: str | None) -> bytes:
        """Tokens of a text as little-endian unsigned 32-bit numbers; none for null.

        A blank after something that is no white space always begins a piece, so a text without white
        space before a blank is cut at its blanks first, and words are looked up whole.
        """
        if not text:
            return b""
        if self.after_blank.search(text):
            return self._cut(text)
        words = text.split(" ")
        known = self.words
        out = list(map(known.new.get, words))
        out[0] = self._cut(words[0])
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    word = words[i]
                    ids = known.aged(word)
                    if ids is None:
                        ids = self._cut(" " + word)
                        if len(word) <= PLAIN:
                            known.put(word, ids)
                    out[i] = ids
        return b"".join(out)

    def decode(self, ids: bytes | None) -> bytes:
        """Bytes of packed tokens, concatenated up a tree; none for null."""
        return self._decode(np.frombuffer(ids or b"", "<u4"))

    def _decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self._decode(ids[:middle]) + self._decode(ids[middle:])


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per worker process, as loading takes longer than a small batch."""
    return Vocabulary(path, pattern)


def encoded(text: Column | str, path: str, pattern: str) -> Column:
    """Tokens of a text as binary: little-endian unsigned 32-bit ids, empty for null and empty texts.

    Characters that UTF-8 cannot hold become question marks. A text of any length is one tree per piece, so
    time grows with n log n also where a piece is the whole text.
    """
    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path, pattern)
        for texts in batches:
            yield pd.Series([vocab.encode(t) for t in texts], dtype=object)

    return encode(text)


def round_trip(text: Column | str, path: str, pattern: str) -> Column:
    """Struct ``(ids, decoded)`` of a text: its tokens as of :func:`encoded`, and the bytes these decode to.

    One function, so that a task has one Python worker with one set of remembered words. Decoding sees the packed
    tokens alone.
    """
    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path, pattern)
        for texts in batches:
            ids = [vocab.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [vocab.decode(x) for x in ids]}, dtype=object)

    return both(text)


def decoded(ids: Column | str, path: str, pattern: str) -> Column:
    """The bytes of tokens packed by ``encoded``; empty for null."""
    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path, pattern)
        for tokens in batches:
            yield pd.Series([vocab.decode(x) for x in tokens], dtype=object)

    return decode(ids)
