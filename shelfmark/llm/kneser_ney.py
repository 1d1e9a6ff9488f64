"""A modified Kneser-Ney model, interpolated, of any order, over sorted arrays of word numbers.

Words are 64-bit hashes; a first count numbers them by falling powers of two of their counts, so that frequent ones have
small numbers. Tasks count n-grams of the highest order in large chunks and deal them by their last word but one, which
is that of all their shorter forms as well: a second task per shard merges them, drops the first word time and again, and
so has each shorter n-gram whole, with its count and the number of words before it. Only for frequent words but one the
n-grams are dealt by two words, and their pairs are summed up with the numbers of words before single words.

A shard is written as flat files to the shared folder: for each length the words that come before known ones, and those
that follow them, both as lists of a parent, so that an n-gram takes the few bytes of its last word and its counts.
Workers map these files and look up queries shard by shard, so the model need not fit a worker's memory and only pages
that are asked for are read.

One start stands before each text; n-grams that begin with it keep their plain count on each level, as nothing
can come before them. A model of order n also answers each lower order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import new_path
from .common import words_of
from .files import map_file, write_file

# Tokens a task counts or scores at once.
CHUNK = 3_000_000
LOOKUP = 1_000_000
# Tokens of a shard of n-grams. Each lookup opens all shards, so they should be large.
SHARD = 8_000_000
SHARDS = 32
ORDER = 3
# Words of so many tokens are dealt with the word before them.
FREQUENT = 1 << 21
# Lists of more followers have their sums beside them.
SHORT = 16
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
# Numbers that are no words of the vocabulary. Nothing comes before a start.
NOTHING, START, UNKNOWN, FIRST_WORD = 0, 1, 2, 3
# Powers of two that a count can have.
POWERS = 64
ODD, FIRST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text and one end."""
    words = words_of(text)
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def history_of(tokens: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """The tokens one, two, ... places before each token: a start before the first of each text, nothing before that."""
    out, last, mark = [], tokens, START
    for _ in range(order - 1):
        before = np.empty_like(tokens)
        before[1:] = last[:-1]
        before[starts] = mark
        out.append(before)
        last, mark = before, NOTHING
    return out


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(31))) * FIRST + right
    mixed = (mixed ^ (mixed >> np.uint64(29))) * ODD
    return mixed ^ (mixed >> np.uint64(32))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows begins."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _runs(heads: np.ndarray, size: int) -> np.ndarray:
    """Sizes of the runs that begin there."""
    return np.diff(np.append(heads, size))


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of one type, equal bytes of all numbers beside each other."""
    if not len(columns[0]):
        return b""
    planes = [np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T) for c in columns]
    return pa.compress(b"".join(p.tobytes() for p in planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str, size: int, width: int) -> list[np.ndarray]:
    if not size:
        return [np.empty(0, kind)] * width
    item = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, width * size * item, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.T).view(kind).ravel() for p in planes.reshape(width, item, size)]


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences, undone by a running sum of the same type."""
    return np.diff(values, prepend=values.dtype.type(0))


def _write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Arrays of whole numbers, each from a multiple of eight bytes on, after their number, widths and lengths."""
    head = np.array([len(arrays), *(n for a in arrays for n in (a.dtype.itemsize, len(a)))], np.uint64)
    write_file(folder, name, [x for a in (head, *arrays) for x in (a.tobytes(), b"\0" * (-a.nbytes % 8))])


def _read_arrays(folder: str, name: str) -> list[np.ndarray]:
    whole = np.asarray(map_file(folder, name, "u1"))  # parts of plain arrays cost less
    number = int(whole[:8].view(np.uint64)[0])
    head = whole[8:8 + 16 * number].view(np.uint64).tolist()
    out, at = [], 8 + 16 * number
    for width, size in zip(head[::2], head[1::2]):
        out.append(whole[at:at + width * size].view(f"u{width}"))
        at += -(-width * size // 8) * 8
    return out


def _least(values: np.ndarray) -> np.ndarray:
    """In the narrowest type that holds all."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _small(values: np.ndarray) -> list[np.ndarray]:
    """A byte a value; values from 255 on stand in lists of places and values."""
    large = np.flatnonzero(values >= 255)
    return [np.minimum(values, 255).astype(np.uint8), large.astype(np.uint64), values[large].astype(np.uint64)]


def _values(small: np.ndarray, places: np.ndarray, large: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = small[at].astype(np.int64)
    above = np.flatnonzero(found == 255)
    if len(above):
        found[above] = large[np.searchsorted(places, at[above].astype(np.uint64))]
    return found


def _kinds(counts: np.ndarray) -> Iterator[np.ndarray]:
    """Of each count: itself, and whether it is one, two or more."""
    yield counts
    for kind in (counts == 1, counts == 2, counts > 2):
        yield kind.astype(np.int64)


def _levels(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == n).sum()) for n in (1, 2, 3, 4)]


class Lists:
    """Lists of words by parent, sorted, with values of each entry and sums over the longer lists."""

    BASE = 6

    @classmethod
    def write(cls, folder: str, name: str, sizes: np.ndarray, words: np.ndarray, *values: np.ndarray) -> None:
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        base = starts[::1 << cls.BASE]
        rest = starts - np.repeat(base, 1 << cls.BASE)[:len(starts)]
        high = words >> np.uint32(16)
        long = np.flatnonzero(sizes > SHORT)
        sums = []
        for v in values:
            for kind in _kinds(v.astype(np.int64)):
                total = np.concatenate(([0], np.cumsum(kind)))
                sums.append((total[starts[long + 1]] - total[starts[long]]).astype(np.uint64))
        _write_arrays(folder, name, [
            base.astype(np.uint64), _least(rest), words.astype(np.uint16),
            _least(high), long.astype(np.uint64), *sums,
            *(x for v in values for x in _small(v)),
        ])

    def __init__(self, folder: str, name: str, width: int):
        self.base, self.rest, self.low, self.high, self.long, *more = _read_arrays(folder, name)
        self.sums, more = more[:4 * width], more[4 * width:]
        self.values = [more[i:i + 3] for i in range(0, 3 * width, 3)]

    def _starts(self, parents: np.ndarray) -> np.ndarray:
        return self.base[parents >> self.BASE].astype(np.int64) + self.rest[parents].astype(np.int64)

    def _words(self, at: np.ndarray) -> np.ndarray:
        return self.low[at] | (self.high[at].astype(np.uint32) << np.uint32(16))

    def find(self, parents: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Places of words in the lists of their parents; -1 for unknown words and for parents of -1."""
        out = np.full(len(parents), -1)
        asked = np.flatnonzero(parents >= 0)
        low, end = self._starts(parents[asked]), self._starts(parents[asked] + 1)
        some = low < end
        asked, low, high = asked[some], low[some], end[some] - 1
        words = words[asked]
        # The last entry at or below the word, if there is one.
        while len(asked):
            middle = (low + high + 1) >> 1
            above = self._words(middle) > words
            high = np.where(above, middle - 1, high)
            low = np.where(above, low, middle)
            done = low >= high  # which stays so
            if 2 * np.count_nonzero(done) >= len(done):
                own = low[done]
                right = self._words(own) == words[done]
                out[asked[done][right]] = own[right]
                left = ~done
                asked, low, high, words = asked[left], low[left], high[left], words[left]
        return out

    def value(self, kind: int, at: np.ndarray) -> np.ndarray:
        """Values of places, 0 for -1."""
        out = np.zeros(len(at), np.int64)
        known = np.flatnonzero(at >= 0)
        out[known] = _values(*self.values[kind], at[known])
        return out

    def totals(self, parents: np.ndarray) -> list[list[np.ndarray]]:
        """For each kind of value its sum over the lists, and how many are one, two and more; 0 for parents of -1."""
        out = [[np.zeros(len(parents), np.int64) for _ in range(4)] for _ in self.values]
        asked = np.flatnonzero(parents >= 0)
        start = self._starts(parents[asked])
        size = self._starts(parents[asked] + 1) - start
        large = size > SHORT
        at = np.searchsorted(self.long, parents[asked[large]].astype(np.uint64))
        short = (size > 0) & ~large
        start, size, own = start[short], size[short], asked[short]
        ends = np.cumsum(size)
        places = np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        for kind, sums in enumerate(out):
            for i, total in enumerate(sums):
                total[asked[large]] = self.sums[4 * kind + i][at]
            if len(own):
                for total, k in zip(sums, _kinds(_values(*self.values[kind], places))):
                    total[own] = np.add.reduceat(k, ends - size)
        return out


@dataclass
class Numbers:
    """Numbers of words: by falling power of two of the count, then by shard, then by hash."""

    folder: str
    sizes: np.ndarray  # shards x powers (falling): words

    def __post_init__(self):
        shards, powers = self.sizes.shape
        flat = self.sizes.T.ravel()
        self.starts = FIRST_WORD + np.cumsum(flat) - flat  # by power, then shard
        self.local = np.cumsum(self.sizes, axis=1) - self.sizes  # rank at which a power begins in its shard
        self.shards = shards
        filled = np.flatnonzero(flat)
        self.filled, self.filled_starts = filled, self.starts[filled]

    def frequent(self, count: int) -> int:
        """The first number of words that occur less often than this power of two."""
        return FIRST_WORD + int(self.sizes[:, :POWERS - (count.bit_length() - 1)].sum())

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of distinct hashes, and their shards and ranks there (-1 for unknown words)."""
        shard = (hashes % np.uint64(self.shards)).astype(np.int64)
        rank, number = np.full(len(hashes), -1), np.full(len(hashes), UNKNOWN, np.uint32)
        for s, asked in _by(shard):
            if not self.sizes[s].sum():
                continue
            keys, ranks = _read_arrays(self.folder, f"words-{s}")
            at = np.minimum(np.searchsorted(keys, hashes[asked]), len(keys) - 1)
            known = keys[at] == hashes[asked]
            found = ranks[at[known]].astype(np.int64)
            power = np.searchsorted(self.local[s], found, "right") - 1
            rank[asked[known]] = found
            number[asked[known]] = self.starts[power * self.shards + s] + found - self.local[s][power]
        return number, shard, rank

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shards of words and their ranks there."""
        at = self.filled[np.searchsorted(self.filled_starts, numbers, "right") - 1]
        power, shard = np.divmod(at, self.shards)
        return shard, numbers - self.starts[at] + self.local[shard, power]


def _by(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the places that have them, in order."""
    place = np.argsort(shard.astype(np.uint16 if len(shard) and shard.max() < 1 << 16 else np.int64), kind="stable")
    heads = _heads(shard[place])
    for a, n in zip(heads, _runs(heads, len(place))):
        yield int(shard[place[a]]), place[a:a + n]


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for frame in batches:
        for text in frame["text"]:
            held.append(token_hashes(text))
            size += len(held[-1])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


WORDS = "shard long, size long, words binary, counts binary"
SIZES = "shard long, tokens long, sizes array<long>"
COUNTS = "shard long, size long, grams binary, counts binary"
SUMS = "shard long, size long, words binary, befores binary, pairs long, grams binary, counts binary"
STATS = "kind string, word long, stats array<long>"


def _count_words(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _chunks(batches):
            words, counts = np.unique(np.concatenate(texts), return_counts=True)
            yield pd.DataFrame([
                (s, len(at), _packed([_steps(words[at])]), _packed([counts[at].astype(np.uint32)]))
                for s, at in _by((words % np.uint64(shards)).astype(np.int64))
            ], columns=["shard", "size", "words", "counts"])

    return run


def _merge_words(folder: str):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        words = np.concatenate([np.cumsum(_unpacked(w, "u8", n, 1)[0]) for w, n in zip(frame["words"], frame["size"])])
        counts = np.concatenate([_unpacked(c, "u4", n, 1)[0] for c, n in zip(frame["counts"], frame["size"])])
        place = np.argsort(words, kind="stable")
        words = words[place]
        heads = _heads(words)
        words, counts = words[heads], np.add.reduceat(counts[place].astype(np.int64), heads)
        power = POWERS - np.frexp(counts.astype(float))[1]  # falling
        place = np.argsort(power, kind="stable")
        ranks = np.empty(len(words), np.uint32)
        ranks[place] = np.arange(len(words), dtype=np.uint32)
        _write_arrays(folder, f"words-{number}", [words, ranks])
        _write_arrays(folder, f"counts-{number}", _small(counts[place]))
        sizes = np.bincount(power, minlength=POWERS).tolist()
        return pd.DataFrame({"shard": [number], "tokens": [int(counts.sum())], "sizes": [sizes]})

    return run


def _shard_of(columns: list[np.ndarray], shards: int, frequent: int) -> np.ndarray:
    """Shards of n-grams by their last word but one, those of frequent ones by one more; columns are nearest first, then the word."""
    own, more = columns[0].astype(np.uint64), columns[1].astype(np.uint64)
    often = (own >= FIRST_WORD) & (own < frequent)
    return (_mixed(own, np.where(often, more, 0).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _sorted_grams(columns: list[np.ndarray], *first: np.ndarray) -> np.ndarray:
    """The order of rows by the given column, then by columns in turn, of which two are compared at a time."""
    keys = [a.astype(np.uint64) << np.uint64(32) | b for a, b in zip(columns[::2], columns[1::2])]
    return np.lexsort([*([columns[-1]] if len(columns) % 2 else []), *keys[::-1], *first])


def _distinct_grams(numbers: np.ndarray, word: np.ndarray, starts: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted columns of the n-grams of texts, nearest history first, and their counts; words are places in the numbers."""
    own, place = np.unique(np.concatenate((np.array([NOTHING, START], np.uint32), numbers)), return_inverse=True)
    columns = history_of(tokens := place[2:][word].astype(np.uint32), starts, order) + [tokens]
    bits = len(own).bit_length()
    if bits * order > 64:
        place = _sorted_grams(columns)
        columns = [c[place] for c in columns]
        heads = _heads(*columns)
        return [own[c[heads]] for c in columns], _runs(heads, len(place)).astype(np.uint32)
    # Whole n-grams fit a number of places among the words at hand, in the same order.
    grams = np.zeros(len(tokens), np.uint64)
    for c in columns:
        grams <<= np.uint64(bits)
        grams |= c
    grams.sort()
    heads = _heads(grams)
    found, mask = grams[heads], np.uint64((1 << bits) - 1)
    return [own[found >> np.uint64(bits * i) & mask] for i in reversed(range(order))], _runs(heads, len(grams)).astype(np.uint32)


def _count_grams(numbers: Numbers, shards: int, order: int, frequent: int):
    """Rows ``(shard, size, grams, counts)``: each a chunk's distinct n-grams of a shard, sorted, as columns of words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _chunks(batches):
            starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
            words, word = np.unique(np.concatenate(texts), return_inverse=True)
            columns, counts = _distinct_grams(numbers.of(words)[0], word, starts, order)
            yield pd.DataFrame([
                (s, len(at), _packed([*(_steps(c[at]) for c in columns[:2]), *(c[at] for c in columns[2:])]), _packed([counts[at]]))
                for s, at in _by(_shard_of(columns, shards, frequent))
            ], columns=["shard", "size", "grams", "counts"])

    return run


def _frequent(words: np.ndarray, frequent: int) -> np.ndarray:
    return (words >= FIRST_WORD) & (words < frequent)


def _merge_grams(folder: str, numbers: Numbers, order: int, frequent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number, held = int(frame["shard"].iloc[0]), []
        for size, grams in zip(frame["size"], frame["grams"]):
            columns = _unpacked(grams, "u4", size, order)
            held.append([*(np.cumsum(c, dtype=np.uint32) for c in columns[:2]), *columns[2:]])
        columns = [np.concatenate([chunk.pop(0) for chunk in held]) for _ in range(order)]
        del held
        counts = np.concatenate([_unpacked(c, "u4", n, 1)[0] for c, n in zip(frame["counts"], frame["size"])]).astype(np.int64)
        rows, levels, nodes = [], [], {}
        for length in range(order, 1, -1):
            place = _sorted_grams(columns)
            for i, c in enumerate(columns):
                columns[i] = c[place]
            counts, heads = counts[place], _heads(*columns)
            counts = np.add.reduceat(counts, heads)
            # Chunks may hold an n-gram each; of shorter ones each row is a word before them.
            befores = _runs(heads, len(place))
            del place
            columns = [c[heads] for c in columns]
            *history, words = columns
            real = history[-1] != NOTHING
            values = [counts] if length == order else [counts, np.where(history[-1] == START, counts, befores)]
            own = np.ones(len(words), bool)
            if length == 2:
                often = _frequent(history[0], frequent)
                own = ~often
                rows += _dealt_words(numbers, words[own])
                rows += _dealt_pairs(numbers, words[often], history[0][often], [v[often] for v in values])
            known = [h[real] for h in history]
            heads = _heads(*known)
            nodes[length - 1] = [h[heads] for h in known]
            sizes = np.add.reduceat(own[real].astype(np.int64), heads) if len(heads) else heads
            own &= real
            values = [v[own] for v in values]
            Lists.write(folder, f"next{length - 1}-{number}", sizes, words[own], *values)
            levels += [n for v in values for n in _levels(v)]
            columns = [*history[:-1], words]
        keys = []
        for depth in range(1, order):
            parent = np.zeros(len(nodes[depth][0]), np.int64)
            for at, h in enumerate(nodes[depth]):
                own = parent.astype(np.uint64) << np.uint64(32) | h
                if at < depth - 1:
                    parent = np.searchsorted(keys[at], own)
            sizes = np.bincount(parent, minlength=len(keys[-1]) if keys else 1)
            Lists.write(folder, f"before{depth}-{number}", sizes, nodes[depth][-1])
            keys.append(own)
        rows.append((-1, len(levels), b"", _packed([np.array(levels, np.uint64)]), 0, b"", b""))
        return pd.DataFrame(rows, columns=["shard", "size", "words", "befores", "pairs", "grams", "counts"])

    return run


def _dealt_words(numbers: Numbers, words: np.ndarray) -> list[tuple]:
    """For the shard of each word in how many rows it is."""
    words, befores = np.unique(words, return_counts=True)
    shard, rank = numbers.places(words)
    return [
        (s, len(at), _packed([_steps(rank[at].astype(np.uint32))]), _packed([befores[at].astype(np.uint32)]), 0, b"", b"")
        for s, at in _by(shard)
    ]


def _dealt_pairs(numbers: Numbers, words: np.ndarray, before: np.ndarray, values: list[np.ndarray]) -> list[tuple]:
    shard = numbers.places(words)[0]
    return [
        (s, 0, b"", b"", len(at), _packed([_steps(before[at]), words[at]]), _packed([v[at].astype(np.uint64) for v in values]))
        for s, at in _by(shard)
    ]


def _merge_sums(folder: str, numbers: Numbers, order: int):
    kinds = 1 if order == 2 else 2

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["shard"].iloc[0])
        if number < 0:
            stats = sum(_unpacked(x, "u8", n, 1)[0].astype(np.int64) for x, n in zip(frame["befores"], frame["size"]))
            return pd.DataFrame({"kind": ["levels"], "word": [-1], "stats": [stats.tolist()]})
        befores = np.zeros(int(numbers.sizes[number].sum()), np.int64)
        for size, ranks, found in zip(frame["size"], frame["words"], frame["befores"]):
            befores[np.cumsum(_unpacked(ranks, "u4", size, 1)[0], dtype=np.uint32)] += _unpacked(found, "u4", size, 1)[0]
        # Pairs of frequent words and these, from all shards.
        held = [_unpacked(x, "u4", n, 2) for x, n in zip(frame["grams"], frame["pairs"])]
        before = np.concatenate([np.cumsum(b, dtype=np.uint32) for b, _ in held])
        words = np.concatenate([w for _, w in held])
        values = [np.concatenate(v).astype(np.int64) for v in zip(*(_unpacked(x, "u8", n, kinds) for x, n in zip(frame["counts"], frame["pairs"])))]
        place = _sorted_grams([before, words])
        before, words = before[place], words[place]
        heads = _heads(before, words)
        values = [np.add.reduceat(v[place], heads) if len(heads) else v for v in values]
        before, words = before[heads], words[heads]
        np.add.at(befores, numbers.places(words)[1], 1)
        heads = _heads(before)
        Lists.write(folder, f"often-{number}", np.array([len(heads)]), before[heads])
        Lists.write(folder, f"pairs-{number}", _runs(heads, len(before)), words, *values)
        _write_arrays(folder, f"befores-{number}", _small(befores))
        levels = [0] * (4 * (2 * order - 3) - 4 * kinds) + [n for v in values for n in _levels(v)]
        stats = [("words", -1, [int(befores.sum()), *_levels(befores), int((befores >= 3).sum())]), ("levels", -1, levels)]
        if len(heads):
            sums = np.stack([np.add.reduceat(k, heads) for v in values for k in _kinds(v)], axis=1)
            stats += [("pairs", int(w), s) for w, s in zip(before[heads], sums.tolist())]
        return pd.DataFrame(stats, columns=["kind", "word", "stats"])

    return run


def discounts(levels: list[int]) -> tuple[float, float, float]:
    """Three discounts from the numbers of counts 1 to 4; a plain half, one, one and a half where some are missing."""
    n1, n2, n3, n4 = levels
    if min(levels) < 1:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), float(i)) for i, d in enumerate(found, 1))


def _off(steps: tuple[float, float, float], counts: np.ndarray) -> np.ndarray:
    return np.array((0.0, *steps))[np.minimum(counts, 3)]


def _shares(steps: tuple[float, float, float], totals: list[np.ndarray], run: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Discounted shares of counts in the sums of their runs, and what is left for the lower order."""
    total, one, two, more = totals
    sure = np.maximum(total, 1)
    back = np.where(total > 0, (steps[0] * one + steps[1] * two + steps[2] * more) / sure, 1.0)
    return np.stack([np.maximum(seen - _off(steps, seen), 0) / sure[run], back[run]])


@dataclass
class KneserNeyModel:
    folder: str
    numbers: Numbers
    shards: int
    order: int
    frequent: int  # the first number of words that are not frequent
    tokens: int  # in training
    vocabulary: int  # distinct tokens
    pairs: int  # distinct pairs
    plain: dict[int, tuple[float, float, float]]  # discounts of counts, by length
    after: dict[int, tuple[float, float, float]]  # discounts of numbers of words before, by length
    spare: float  # share of the lowest order that goes to all words alike
    sums: np.ndarray  # of frequent words: number, then sums over the pairs they begin

    def _words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, shards, counts and numbers of words before of distinct words."""
        number, shard, rank = self.numbers.of(hashes)
        out = [np.zeros(len(hashes), np.int64) for _ in range(2)]
        known = np.flatnonzero(rank >= 0)
        for s, at in _by(shard[known]):
            asked = known[at]
            for name, values in zip(("counts", "befores"), out):
                values[asked] = _values(*_read_arrays(self.folder, f"{name}-{s}"), rank[asked])
        return number, shard, *out

    def _discounts(self, length: int) -> list[tuple[float, float, float]]:
        return [self.plain[length], *([self.after[length]] if length < self.order else [])]

    def _grams(self, shard: int, columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        """Shares of n-grams of each length from two on, by kind of count."""
        node, words = np.zeros(len(columns[0]), np.int64), columns[-1]
        for depth, before in enumerate(columns[:-1], 1):
            kinds = self._discounts(depth + 1)
            heads = _heads(node, before)
            found = Lists(self.folder, f"before{depth}-{shard}", 0).find(node[heads], before[heads])
            run = np.repeat(np.arange(len(heads)), _runs(heads, len(before)))
            node = found[run]
            after = Lists(self.folder, f"next{depth}-{shard}", len(kinds))
            at = after.find(node, words)
            yield [_shares(steps, totals, run, after.value(i, at)) for i, (steps, totals) in enumerate(zip(kinds, after.totals(found)))]

    def _pairs(self, shard: int, before: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
        """Shares of pairs of frequent words and words of a shard, by kind of count."""
        kinds = self._discounts(2)
        node = Lists(self.folder, f"often-{shard}", 0).find(np.zeros(len(before), np.int64), before)
        after = Lists(self.folder, f"pairs-{shard}", len(kinds))
        at = after.find(node, words)
        run = np.searchsorted(self.sums[0], before)
        return [_shares(steps, self.sums[1 + 4 * i:5 + 4 * i], run, after.value(i, at)) for i, steps in enumerate(kinds)]

    def probabilities(self, tokens: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Of each token after those before it, by the model of each order from two on, and how often it occurs in training."""
        words, word = np.unique(tokens, return_inverse=True)
        number, home, count, befores = self._words(words)
        low = np.maximum(befores - _off(self.after[1], befores), 0) / max(self.pairs, 1) + self.spare / (self.vocabulary + 1)
        numbers = number[word]
        columns = [*history_of(numbers, starts, self.order), numbers]
        shares = [np.empty((len(self._discounts(n)), 2, len(tokens))) for n in range(2, self.order + 1)]
        for own in shares:  # of shards that no training text has
            own[:, 0], own[:, 1] = 0, 1
        place = _sorted_grams(columns[:2])
        if self.tokens:
            for shard, at in _by(_shard_of(columns, self.shards, self.frequent)[place]):
                rows = place[at]
                try:
                    for own, found in zip(shares, self._grams(shard, [c[rows] for c in columns])):
                        own[:, :, rows] = found
                except FileNotFoundError:
                    continue
            often = np.flatnonzero(_frequent(columns[0], self.frequent))
            for shard, at in _by(home[word[often]]):
                rows = often[at]
                shares[0][:, :, rows] = self._pairs(shard, columns[0][rows], numbers[rows])
        last, out = low[word], []
        for own in shares:
            out.append(own[0, 0] + own[0, 1] * last)
            last = own[-1, 0] + own[-1, 1] * last
        return out, count[word]

    @property
    def scores(self) -> list[str]:
        """Names of the scores: of bigrams, then of each higher order."""
        return ["score", *(f"score_{n}" for n in range(3, self.order + 1))]

    def score(self, texts: list[np.ndarray]) -> pd.DataFrame:
        """``(n_tokens, n_known, base_score, score, score_3, ...)`` of texts given as token hashes."""
        tokens = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        chances, count = self.probabilities(tokens, starts)
        base = np.log10((count + 1) / (self.tokens + 1 * (self.vocabulary + 1)))
        return pd.DataFrame({
            "n_tokens": sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts),
        } | {name: np.add.reduceat(np.log10(chance), starts) for name, chance in zip(self.scores, chances)})


def train(docs: DataFrame, text: str = "text", shards: int | None = None, order: int = ORDER) -> KneserNeyModel:
    """Count all given documents. Null and empty texts are one end each; without documents all is unknown.

    They are read twice, to number the words and to count. ``shards`` are those of the words.
    """
    if order < 2:
        raise ValueError("the order is two at least")
    spark = docs.sparkSession
    shards = shards or max(SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    folder = new_path(spark, "grams")
    texts = docs.select(F.col(text).alias("text"))
    # One row of a few numbers for each shard.
    counted = texts.mapInPandas(_count_words(shards), WORDS).groupBy("shard").applyInPandas(_merge_words(folder), SIZES).collect()
    sizes = np.zeros((shards, POWERS), np.int64)
    for r in counted:
        sizes[r["shard"]] = r["sizes"]
    tokens, vocabulary = sum(r["tokens"] for r in counted), int(sizes.sum())
    numbers = Numbers(folder, sizes)
    frequent = numbers.frequent(FREQUENT)
    parts = max(shards, -(-tokens // SHARD))
    grams = texts.mapInPandas(_count_grams(numbers, parts, order, frequent), COUNTS)
    sums = grams.groupBy("shard").applyInPandas(_merge_grams(folder, numbers, order, frequent), SUMS)
    merged = sums.groupBy("shard").applyInPandas(_merge_sums(folder, numbers, order), STATS)
    # One row of a few numbers for each kind and frequent word.
    size = 4 * max(2 * order - 3, 8)
    total = F.array(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)) for i in range(size)])
    found = merged.groupBy("kind", "word").agg(total.alias("stats")).collect()
    stats = {r["kind"]: [int(x) for x in r["stats"]] for r in found if r["kind"] != "pairs"}
    often = np.array(sorted((r["word"], *r["stats"][:8]) for r in found if r["kind"] == "pairs"), np.int64).reshape(-1, 9).T
    pairs, *low, three = stats.get("words", [0] * size)[:6]
    steps = stats.get("levels", [0] * size)
    plain, after = {}, {1: discounts(low)}
    for length in range(order, 1, -1):
        plain[length], steps = discounts(steps[:4]), steps[4:]
        if length < order:
            after[length], steps = discounts(steps[:4]), steps[4:]
    spare = (after[1][0] * low[0] + after[1][1] * low[1] + after[1][2] * three) / pairs if pairs else 1.0
    return KneserNeyModel(folder, numbers, parts, order, frequent, tokens, vocabulary, pairs, plain, after, spare, often)


def scored(docs: DataFrame, model: KneserNeyModel, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(doc, n_tokens, n_known, base_score, score, score_3, ...)`` for every row; ``doc`` is a struct of the columns to carry.

    Scores are log10 probabilities of the whole text and its end: ``score`` of bigrams, ``score_3`` of trigrams.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in carry or docs.columns]).alias("doc"), F.col(text).alias("text"))
    schema = T.StructType([
        rows.schema["doc"], *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")],
        *[T.StructField(c, T.DoubleType()) for c in ("base_score", *model.scores)],
    ])

    def run(batches: Iterator) -> Iterator:
        held, texts, size = [], [], 0
        for batch in batches:
            held.append(batch.column("doc"))
            own = [token_hashes(t) for t in batch.column("text").to_pylist()]
            texts += own
            size += sum(map(len, own))
            if size >= LOOKUP:
                yield from answer(held, texts)
                held, texts, size = [], [], 0
        if texts:
            yield from answer(held, texts)

    def answer(held: list, texts: list[np.ndarray]) -> Iterator:
        found = model.score(texts)
        at = 0
        for docs_ in held:
            own = found.iloc[at:at + len(docs_)]
            at += len(docs_)
            yield pa.RecordBatch.from_arrays(
                [docs_, *(pa.array(own[c].to_numpy()) for c in own.columns)], ["doc", *own.columns]
            )

    return rows.mapInArrow(run, schema)


def perplexity(score: Column | str, n_tokens: Column | str) -> Column:
    score, n_tokens = (F.col(c) if isinstance(c, str) else c for c in (score, n_tokens))
    return F.pow(F.lit(10.0), -score / n_tokens)
