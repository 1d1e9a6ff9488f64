"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints are 64-bit sums of signs over word shingles. Distinct fingerprints are dealt by pairs of
equal bit blocks (with more blocks than allowed differences, some blocks agree), and each deal is
searched by an index: fingerprints sorted by Gray rank are the leaves, upper nodes hold the bits all
their leaves share, and a walk over pairs of nodes adds up the differing shared bits. A pair of nodes
is dropped as a whole once that sum exceeds the limit, and taken as a whole once the bits that are
left could not exceed it any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.membership import spread
from ..session import cut_lineage
from .common import fresh, merged_labels, sorted_groups, words_of
from .components import connected_components

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Bit blocks; two of the six agree where four bits differ at most.
BLOCKS = 6
# Distinct fingerprints one task compares for one key; more are dealt again as pairs of chunks.
GROUP = 4096
FANOUT = 8
# Pairs of nodes that one step of the walk opens.
STEP = 8192
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED, block: int = 1 << 16) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ``size`` words, in blocks; shorter texts are one shingle."""
    if not words:
        return
    size = min(size, len(words))
    for at in range(0, len(words) - size + 1, block):
        part = words[at:at + block + size - 1]
        joined = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        ends = (starts + lengths)[size - 1:].tolist()
        shingles = [joined[a:b] for a, b in zip(starts.tolist(), ends)]
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(shingles))


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of a text as a signed 64-bit number; 0 without words."""
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(words_of(text), size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    set_ = np.packbits(2 * counts > total, bitorder="little")
    return int(set_.view("<i8")[0])


def fingerprints(text: Column | str, size: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, size) for t in texts], dtype="int64")

    return of(text)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place of a 64-bit pattern in the Gray sequence: neighbours in that order differ in few bits."""
    rank = bits.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Levels of nodes over fingerprints sorted by (group, Gray rank).

    ``levels[0]`` are the leaves. A node has the pattern of the bits all its leaves share (``mask``),
    its children ``first .. first + count - 1`` one level below and its leaves ``low .. high - 1``.
    """

    def __init__(self, groups: np.ndarray, prints: np.ndarray):
        size = len(prints)
        at = np.arange(size)
        zero, one = np.zeros(size, np.int64), np.ones(size, np.int64)
        self.levels = [dict(mask=np.full(size, ALL), bits=prints, first=at, count=zero, low=at, high=at + 1)]
        every, some, low, high = prints, prints, at, at + 1
        while len(groups):
            new = np.concatenate(([True], groups[1:] != groups[:-1]))
            begins = np.flatnonzero(new)
            if len(begins) == len(groups):
                break
            inside = np.arange(len(groups)) - np.repeat(begins, np.diff(np.append(begins, len(groups))))
            heads = np.flatnonzero(inside % FANOUT == 0)
            every, some = np.bitwise_and.reduceat(every, heads), np.bitwise_or.reduceat(some, heads)
            counts = np.diff(np.append(heads, len(groups)))
            low, high, groups = low[heads], high[heads + counts - 1], groups[heads]
            mask = ~(every ^ some)
            self.levels.append(dict(mask=mask, bits=every & mask, first=heads, count=counts, low=low, high=high))

    def labels(self, limit: int) -> np.ndarray:
        """Smallest leaf reachable by links of ``limit`` differing bits at most, group by group."""
        size = len(self.levels[0]["bits"])
        labels = np.arange(size)
        top = len(self.levels) - 1
        if not top:
            return labels
        roots = np.arange(len(self.levels[top]["bits"]))
        nothing = np.zeros(len(roots), np.uint64)
        todo = [(top, roots, roots, np.zeros(len(roots), np.int64), nothing)]
        slots = np.arange(FANOUT)
        while todo:
            level, a, b, sums, known = todo.pop()
            if len(a) > STEP:
                todo.append((level, a[STEP:], b[STEP:], sums[STEP:], known[STEP:]))
                a, b, sums, known = a[:STEP], b[:STEP], sums[:STEP], known[:STEP]
            node, child = self.levels[level], self.levels[level - 1]
            i = node["first"][a][:, None, None] + slots[None, :, None]
            j = node["first"][b][:, None, None] + slots[None, None, :]
            real = (slots[None, :, None] < node["count"][a][:, None, None]) & (slots[None, None, :] < node["count"][b][:, None, None])
            real &= (a != b)[:, None, None] | (i <= j if level > 1 else i < j)
            pair = np.nonzero(real)
            i, j = np.broadcast_to(i, real.shape)[pair], np.broadcast_to(j, real.shape)[pair]
            sums, known = sums[pair[0]], known[pair[0]]
            both = child["mask"][i] & child["mask"][j]
            # Bits that became known on this level add their differences to those of the levels above.
            sums = sums + np.bitwise_count((child["bits"][i] ^ child["bits"][j]) & both & ~known)
            near = sums <= limit
            i, j, sums, both = i[near], j[near], sums[near], both[near]
            if level == 1:
                labels = merged_labels(size, i, j, labels)
                continue
            whole = sums + np.bitwise_count(~both) <= limit
            if whole.any():
                labels = self._join_whole(child, i[whole], j[whole], labels)
            rest = ~whole
            if rest.any():
                todo.append((level - 1, i[rest], j[rest], sums[rest], both[rest]))
        return labels

    def _join_whole(self, nodes: dict, i: np.ndarray, j: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """All leaves of two nodes (or of one with itself) link with each other."""
        left, right = [], []
        for one, other in ((i, j), (j, i)):
            width = nodes["high"][other] - nodes["low"][other]
            left.append(np.repeat(nodes["low"][one], width))
            inside = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            right.append(np.repeat(nodes["low"][other], width) + inside)
        return merged_labels(len(labels), np.concatenate(left), np.concatenate(right), labels)


def _local_links(limit: int):
    """Links of every leaf with the first leaf of its component, for rows sorted by (key, rank)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_groups(batches, "key", 1 << 17):
            rank = frame["rank"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
            prints = rank ^ (rank >> np.uint64(1))
            keys = frame["key"].to_numpy(np.int64)
            sizes = np.diff(np.append(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), len(keys)))
            busy = np.repeat(sizes > 1, sizes)
            if not busy.any():
                continue
            prints, keys = prints[busy], keys[busy]
            labels = GrayIndex(keys, prints).labels(limit)
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            if len(moved):
                yield pd.DataFrame({"u": prints[moved].view(np.int64), "v": prints[labels[moved]].view(np.int64)})

    return run


def _block_keys(print_: str, limit: int, blocks: int) -> Column:
    """One key for each choice of ``blocks - limit`` blocks: the choice and the bits of its blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - limit)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col(print_).bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def near_prints(prints: DataFrame, limit: int = DISTANCE, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """``(node, component)`` of the fingerprints that link with another; ``prints`` has one distinct column.

    Every pair with at most ``limit`` differing bits shares a key, and every key is searched in full: a
    key with more than ``group`` fingerprints is cut into chunks and searched chunk pair by chunk pair.
    """
    (name,) = prints.columns
    rank = F.col(name)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    ranked = prints.select(name, rank.bitwiseXOR(F.lit(-(1 << 63))).alias("rank"))
    keyed = ranked.select("rank", F.explode(_block_keys(name, limit, blocks)).alias("key"))
    sizes = keyed.groupBy("key", spread("key")).agg(F.count(F.lit(1)).alias("n")).select("key", "n")
    # Keys with a single fingerprint have no pair; only the others are sent on.
    dealt = keyed.join(sizes.where("n > 1"), "key").select(
        "key", "rank", F.ceil(F.col("n") / group).cast("int").alias("chunks")
    )
    own = F.pmod(F.xxhash64("rank"), F.col("chunks")).cast("int")
    with_ = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: (c != F.col("own")) | (F.col("chunks") == 1))
    cells = dealt.withColumn("own", own).withColumn("with_", F.explode(with_)).select(
        F.when(F.col("chunks") == 1, F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "with_"), F.greatest("own", "with_"))
        ).alias("key"),
        "rank",
    )
    sorted_ = cells.repartition("key").sortWithinPartitions("key", "rank")
    return connected_components(sorted_.mapInPandas(_local_links(limit), "u long, v long"))


def simhash_groups(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = SHINGLE,
                   limit: int = DISTANCE) -> DataFrame:
    """Near-duplicate groups of documents: ``(ident, text_hash, print, group, component_id)`` per row.

    ``print`` is the fingerprint, ``group`` a fingerprint that names the group, ``component_id`` the
    smallest id in the group. Texts without words (null, empty, blank) have fingerprint 0 and link like any
    other. Repeated rows and repeated ids stay rows of their own; a null id never is the smallest
    unless all ids of a group are null. Other columns are ignored. ``text_hash`` (XXH64 of the text,
    42 for null) tells rows with one id apart.
    """
    hashed = docs.select(F.col(ident).alias("_id"), F.xxhash64(text).alias("_hash"), fingerprints(text, size).alias("_print"))
    hashed = cut_lineage(hashed, "prints")
    first = hashed.groupBy("_print").agg(F.min("_id").alias("_first"))
    linked = near_prints(first.select("_print"), limit).select(
        F.col("node").alias("_print"), F.col("component").alias("_linked")
    )
    named = first.join(linked, "_print", "left").select(
        "_print", "_first", F.coalesce("_linked", "_print").alias("_group")
    )
    smallest = named.groupBy("_group", spread("_group")).agg(F.min("_first").alias("_smallest"))
    by_print = named.join(smallest.select("_group", "_smallest"), "_group").select("_print", "_group", "_smallest")
    return hashed.join(by_print, "_print").select(
        F.col("_id").alias(ident), F.col("_hash").alias("text_hash"), F.col("_print").alias("print"),
        F.col("_group").alias("group"), F.col("_smallest").alias("component_id"),
    )


def print_hex(column: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def one_of_each_group(docs: DataFrame, groups: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group that with the smallest (id, text hash); nulls last.

    Rows that repeat in id and text are one document: one of them stays, by the smallest other values.
    """
    i, h = fresh(docs, "_kept_id", "_kept_hash")
    order = F.struct(F.col(ident).isNull().alias("n"), F.col(ident).alias("i"), F.col("text_hash").alias("h"))
    chosen = groups.groupBy("group").agg(F.min(order).alias("best")).select("best.i", "best.h")
    counts = groups.groupBy(F.col(ident).alias("i2"), F.col("text_hash").alias("h2")).agg(F.count(F.lit(1)).alias("rows"))
    stay = chosen.join(counts, F.col("i").eqNullSafe(F.col("i2")) & (F.col("h") == F.col("h2")))
    stay = cut_lineage(stay.select(F.col("i").alias(i), F.col("h").alias(h), "rows"), "stay")
    at = F.col(ident).eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(h))
    alone = docs.join(stay.where("rows = 1").select(i, h), at, "left_semi")
    repeated = docs.join(stay.where("rows > 1").select(i, h), at, "left_semi")
    sortable = F.struct(*[F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    single = repeated.groupBy(F.col(ident).alias(i), F.xxhash64(text).alias(h)).agg(
        F.min_by(F.struct(*[F.col(c) for c in docs.columns]), sortable).alias("row")
    )
    return alone.unionByName(single.select("row.*"))
