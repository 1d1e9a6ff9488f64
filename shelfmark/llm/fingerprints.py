"""Document fingerprints by consistent weighted sampling.

A document is a bag of words: a word's weight is how often it occurs. For each of ``SAMPLES`` places
every word draws two gamma and one uniform variate that follow from the word alone; they turn its weight
into a quantised weight and a cost, and the word of least cost is the sample, together with its
quantised weight. Two documents have the same sample with probability sum(min weights) / sum(max
weights), the generalised Jaccard similarity, so the share of equal samples estimates it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import words_of

SAMPLES = 128
# Words (with their weights) a worker keeps the costs of: 256 MB.
REMEMBERED = 1 << 18
SEED = 7
# Words looked up at a time, and words whose costs are worked out at a time.
BLOCK, PART = 8192, 64
EMPTY = "0" * (4 * SAMPLES)
# A factor that spreads the numbers of consecutive draws over 64 bits, and two mixing factors (fixed values of a
# public mixer).
STEP, FIRST, SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Mixes in place."""
    part = x >> np.uint64(30)
    x ^= part
    x *= FIRST
    np.right_shift(x, np.uint64(27), out=part)
    x ^= part
    x *= SECOND
    np.right_shift(x, np.uint64(31), out=part)
    x ^= part
    return x


def costs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Costs of words, words x places, as doubles whose lowest 16 bits are the sample's own bits.

    The least number so tells the least cost and its sample at once; costs that agree in all other bits
    are ordered by the sample, so the order of words has no say.
    """
    draws = np.arange(1, 5 * SAMPLES // 2 + 1, dtype=np.uint64) * STEP
    halves = mixed(hashes[:, None] + draws[None, :]).astype("<u8").view("<u4").reshape(len(hashes), 5, SAMPLES)
    # Uniform variates of 23 bits, exact in single precision and never 0 or 1.
    u = ((halves >> np.uint32(9)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -23)
    # The sum of two exponential variates is a gamma variate of shape 2.
    r, c, beta = -np.log(u[:, 0] * u[:, 1]), -np.log(u[:, 2] * u[:, 3]), u[:, 4]
    level = np.floor(np.log(weights.astype(np.float32))[:, None] / r + beta)
    cost = (np.log(c) - r * (level - beta) - r).astype(float)
    # Its low bits tell a word and its quantised weight from others.
    sample = (halves[:, 4] ^ (level.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA77)
    return ((cost.view(np.uint64) & ~np.uint64(0xFFFF)) | (sample >> np.uint32(16))).view(float)


class Sampler:
    """Least-cost samples of documents, with the costs of the words used most at hand.

    Words with weights are found by their hashes, many at a time, in an open table four times as large as what is kept.
    """

    def __init__(self):
        self.costs = np.empty((REMEMBERED, SAMPLES))
        self.keys = np.zeros(REMEMBERED, np.uint64)
        self.used = np.zeros(REMEMBERED, np.int64)  # how often, halved when words are forgotten
        self.free = np.arange(REMEMBERED)
        self.table = np.full(4 * REMEMBERED, -1, np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of keys, -1 of unknown ones."""
        slots = (keys % np.uint64(len(self.table))).astype(np.int64)
        rows = self.table[slots]
        open_ = np.flatnonzero((rows >= 0) & (self.keys[rows] != keys))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.table)
            rows[open_] = self.table[slots[open_]]
            open_ = open_[(rows[open_] >= 0) & (self.keys[rows[open_]] != keys[open_])]
        return rows

    def _enter(self, rows: np.ndarray) -> None:
        """Put rows, whose keys differ, into the table."""
        slots = (self.keys[rows] % np.uint64(len(self.table))).astype(np.int64)
        while len(rows):
            vacant = self.table[slots] < 0
            self.table[slots[vacant]] = rows[vacant]
            open_ = self.table[slots] != rows
            rows, slots = rows[open_], (slots[open_] + 1) % len(self.table)

    def _make_room(self, size: int) -> None:
        """Forget the words used least, so that ``size`` and a quarter of all can be entered."""
        self.used[self.free] = -1
        self.free = np.argsort(self.used, kind="stable")[:max(size, REMEMBERED // 4)]
        self.used //= 2
        kept = np.ones(REMEMBERED, bool)
        kept[self.free] = False
        self.table[:] = -1
        self._enter(np.flatnonzero(kept).astype(np.int32))

    def _rows(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows of the costs of at most ``REMEMBERED`` words."""
        keys = hashes + weights.astype(np.uint64) * STEP
        rows = self._find(keys)
        np.add.at(self.used, rows[rows >= 0], 1)
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows
        new, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
        if len(new) > len(self.free):
            # Found words stay, as they are many uses ahead of all others.
            found = np.unique(rows[rows >= 0])
            self.used[found] += 1 << 62
            self._make_room(len(new))
            self.used[found] -= 1 << 61
        own, self.free = self.free[:len(new)], self.free[len(new):]
        first = missing[first]
        for at in range(0, len(new), PART):
            part = first[at:at + PART]
            self.costs[own[at:at + PART]] = costs(hashes[part], weights[part])
        self.keys[own], self.used[own] = new, 1
        self._enter(own.astype(np.int32))
        rows[missing] = own[back]
        return rows

    def _samples(self, bags: list[Counter]) -> list[str]:
        ends = np.cumsum([len(bag) for bag in bags]).tolist()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(bags), repeat(SEED)), np.uint64, ends[-1])
        weights = np.fromiter(chain.from_iterable(bag.values() for bag in bags), float, ends[-1])
        least, bag = np.full((len(bags), SAMPLES), np.inf), 0
        block = min(BLOCK, REMEMBERED)
        for top in range(0, ends[-1], block):
            rows = self._rows(hashes[top:top + block], weights[top:top + block])
            at = 0
            while at < len(rows):
                end = min(ends[bag] - top, len(rows))
                if end > at:
                    least[bag] = np.minimum(least[bag], self.costs.take(rows[at:end], axis=0).min(axis=0))
                at = end
                if ends[bag] - top == end:
                    bag += 1
        digits = (least.view(np.uint64) & np.uint64(0xFFFF)).astype(">u2").tobytes().hex()
        size = len(EMPTY)
        return [digits[i * size:(i + 1) * size] if bag else EMPTY for i, bag in enumerate(bags)]

    def fingerprint(self, words: list[bytes]) -> str:
        """``SAMPLES`` samples of 16 bits as hex digits; all zeros without words."""
        return self._samples([Counter(words)])[0]

    def fingerprints(self, texts: Iterable[str | None]) -> list[str]:
        """Fingerprints of texts, with the words of many looked up at once."""
        out, bags, size = [], [], 0
        for text in texts:
            bags.append(Counter(words_of(text)))
            size += len(bags[-1])
            if size >= BLOCK:
                out += self._samples(bags)
                bags, size = [], 0
        return out + self._samples(bags) if bags else out


_SAMPLER: list[Sampler] = []


def sampler() -> Sampler:
    """One per worker process."""
    if not _SAMPLER:
        _SAMPLER.append(Sampler())
    return _SAMPLER[0]


def likeness(left: str, right: str) -> float:
    """Share of equal samples, the estimate of the generalised Jaccard similarity."""
    a, b = (np.frombuffer(bytes.fromhex(x), ">u2") for x in (left, right))
    return float((a == b).mean())


def fingerprints(text: Column | str) -> Column:
    """Fingerprint of a whole text; of a null, empty or blank one all zeros, which are alike to each other only."""
    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sampler()
        for texts in batches:
            yield pd.Series(own.fingerprints(texts), dtype=object)

    return of(text)


def in_descending_order(docs: DataFrame, ident: str, text: str, ranges: int | None = None) -> DataFrame:
    """Rows ``(id, text, range, last)``, ids as text, dealt by ranges of ids, sorted by range and descending id within.

    Each range ends in one more row (``last``): the first document of the range that follows, the
    first of all after the lowest range. Nulls come after all ids; rows with equal ids follow by the hash of their text.
    Bounds are quantiles of ids over all documents; texts are exchanged once.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(ident).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    points = sorted(set(rows.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    bounds = F.array(*[F.lit(float(p)) for p in points]) if points else F.array().cast("array<double>")
    # Number of bounds at or below the id; descending ids have descending ranges; nulls the last.
    range_ = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(bounds, lambda p: p <= F.col("id").cast("double")))
    )
    dealt = rows.withColumn("range", range_).withColumn("last", F.lit(False))
    first = F.max(F.struct("id", F.xxhash64("text").alias("hash")))
    heads = dealt.select("range", "id", "text").groupBy("range").agg(first.alias("head")).select("range", "head.*")
    heads = cut_lineage(heads, "heads")
    follows = {r["range"]: None for r in heads.select("range").collect()}  # one number for each range
    order = sorted(follows, reverse=True)
    after = {r: order[i - 1] for i, r in enumerate(order)}  # the range whose end a head closes
    table = spark.createDataFrame([(r, after[r]) for r in order], "head_range int, closes int")  # empty for no rows
    marks = heads.join(table, F.col("range") == F.col("head_range")).select(
        F.col("id").alias("head_id"), F.col("hash").alias("head_hash"), "closes"
    )
    # One row of three numbers for each range: the join must not deal out all texts for their sake.
    closing = dealt.join(
        F.broadcast(marks), F.col("id").eqNullSafe(F.col("head_id")) & (F.xxhash64("text") == F.col("head_hash"))
    ).dropDuplicates(["closes"]).select("id", "text", F.col("closes").alias("range"), F.lit(True).alias("last"))
    both = dealt.select("id", "text", "range", "last").unionByName(closing)
    ordered = both.repartition(F.col("range")).sortWithinPartitions(
        "range", F.col("last"), F.col("id").desc_nulls_last(), F.xxhash64("text").desc()
    )
    return ordered.select(F.col("id").cast("string").alias("id"), "text", "range", "last")


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document with the next one, in rows as ``in_descending_order`` deals them."""
    held = None  # the document that waits for its successor: (id, range, text, fingerprint)
    own = sampler()
    for frame in batches:
        pairs, texts = [], []  # pairs: the document before, its edited text, the place of this one in texts
        before = held and held[:3]
        for id_, text, range_, last in zip(frame["id"], frame["text"], frame["range"], frame["last"]):
            if before is not None and before[1] == range_:
                edited = edited_text(before[2], text)
                pairs.append((before, edited, len(texts)))
                texts.append(edited)
            texts.append(text)
            before = None if last else (id_, range_, text)
        prints = own.fingerprints(texts)
        out = []
        for (id_, _, text), edited, at in pairs:
            first = prints[at - 1] if at else held[3]
            out.append((
                id_, text, edited, first, prints[at], likeness(first, prints[at]), likeness(first, prints[at + 1]),
            ))
        if texts:
            held = before and (*before, prints[-1])
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)


COLUMNS = ["doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_neighbours(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document, its text with the second half taken from the next document, and how alike they are.

    ``(doc_id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next)``. The next document
    is that of the next smaller id, after the last the first again; a single document follows itself.
    """
    rows = in_descending_order(docs, ident, text)
    pairs = rows.mapInPandas(
        _pairs, "doc_id string, text string, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return pairs.withColumn("doc_id", F.col("doc_id").cast(docs.schema[ident].dataType))
