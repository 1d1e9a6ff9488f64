"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosine, components.

Two unit vectors at angle a fall on the same side of a random hyperplane with probability 1 - a/pi. A
table keys a vector by the signs of ``bits`` hyperplanes; pairs that share a key in some table are
compared exactly, in double precision. The number of tables follows from the miss that is allowed for a
pair right at the threshold: pairs above it are missed far more rarely. Every key is searched in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.membership import spread
from ..session import cut_lineage
from .common import merged_labels, sorted_groups
from .components import connected_components

THRESHOLD = 0.9
# Chance that a pair right at the threshold meets in no table.
MISS = 1e-5
# Vectors of random directions that share a key on average, and vectors compared at once for one key.
PER_KEY = 32
GROUP = 2048
SEED = 20_241


def tables_for(count: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """``(bits, tables)`` for a number of vectors: keys grow with the corpus, so their groups do not."""
    bits = max(4, math.ceil(math.log2(max(count, 1) / PER_KEY)) if count > PER_KEY else 4)
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-hit))


def hyperplanes(size: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Normals, one column each; the same for all tasks as they follow from the seed."""
    return np.random.default_rng([seed, size, bits, tables]).standard_normal((size, bits * tables))


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def codes(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Signs as numbers, vectors x tables."""
    signs = units @ hyperplanes(units.shape[1], bits, tables) >= 0
    return signs.reshape(len(units), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _keys(bits: int, tables: int):
    """Rows ``(key, node, copies, vector)``, one for each table."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            sizes = frame["vector"].str.len().to_numpy()
            for size in np.unique(sizes):
                own = frame[sizes == size].reset_index(drop=True)
                if not len(own):
                    continue
                units = unit(np.stack(own["vector"].to_numpy()).astype(float))
                found = codes(units, bits, tables)
                for table in range(tables):
                    yield pd.DataFrame({
                        "code": found[:, table], "place": np.int64(table) + np.int64(size) * 65_536,
                        "node": own["node"], "copies": own["copies"], "vector": own["vector"],
                    })

    return run


def _links(bits: int, tables: int, threshold: float):
    """``(node, links, root)`` of the vectors that link within a key.

    A pair counts in the first table it meets in, so that counts over all tables add up.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_groups(batches, "key", 4096):
            keys = frame["key"].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            ends = np.append(starts[1:], len(keys))
            for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                found = _group_links(frame.iloc[a:b], bits, tables, threshold)
                if found is not None:
                    yield found

    return run


def _group_links(own: pd.DataFrame, bits: int, tables: int, threshold: float) -> pd.DataFrame | None:
    units = unit(np.stack(own["vector"].to_numpy()).astype(float))
    side, place = own["side"].to_numpy(), own["place"].to_numpy()
    left, right = [], []
    for at in range(0, len(units), 1024):
        i, j = np.nonzero(units[at:at + 1024] @ units.T >= threshold)
        i += at
        ordered = (i < j) & ((side[i] != side[j]) | (side[i] < 0))
        left.append(i[ordered])
        right.append(j[ordered])
    left, right = np.concatenate(left), np.concatenate(right)
    if not len(left):
        return None
    linked, back = np.unique(np.concatenate((left, right)), return_inverse=True)
    own_codes = codes(units[linked], bits, tables)
    table = int(place[0] % 65_536)
    l, r = back[:len(left)], back[len(left):]
    new = np.ones(len(left), bool)
    for earlier in range(table):
        new &= own_codes[l, earlier] != own_codes[r, earlier]
    copies = own["copies"].to_numpy()
    counts = np.bincount(left[new], copies[right[new]], len(own)) + np.bincount(right[new], copies[left[new]], len(own))
    nodes = own["node"].to_numpy()
    labels = merged_labels(len(own), left, right)
    return pd.DataFrame({"node": nodes[linked], "links": counts[linked].astype(np.int64), "root": nodes[labels[linked]]})


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, group: int = GROUP) -> DataFrame:
    """``(node, links, root)`` partial rows for distinct vectors ``(node, copies, vector)``.

    A key with more than ``group`` vectors is cut into chunks; tasks compare pairs of chunks. A pair of
    different chunks meets in one such task, a pair of one chunk in the task of that chunk alone.
    """
    bits, tables = tables_for(vectors.count(), threshold, miss)
    schema = f"code long, place long, node long, copies long, vector {vectors.schema['vector'].dataType.simpleString()}"
    rows = vectors.select("node", "copies", "vector").mapInPandas(_keys(bits, tables), schema)
    rows = rows.withColumn("key", F.xxhash64("place", "code"))
    light = vectors.select("node", "vector").mapInPandas(_light_keys(bits, tables), "code long, place long")
    hot = light.groupBy(F.xxhash64("place", "code").alias("hot"), spread("place", "code")).agg(
        F.count(F.lit(1)).alias("n")
    ).where(F.col("n") > group).select("hot", F.ceil(F.col("n") / group).cast("int").alias("chunks"))
    # Written first: Spark then knows its size, and sends it to all tasks only if it is small.
    hot = cut_lineage(hot, "hot")
    dealt = rows.join(hot, F.col("key") == F.col("hot"), "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    with_ = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = dealt.withColumn("own", own).withColumn("with_", with_).select(
        F.when(F.col("chunks") == 1, F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "with_"), F.greatest("own", "with_"))
        ).alias("key"),
        # -1: all pairs of the cell count; otherwise only those of different chunks.
        F.when(F.col("own") == F.col("with_"), F.lit(-1)).otherwise(F.col("own")).alias("side"),
        "place", "node", "copies", "vector",
    )
    sorted_ = cells.repartition("key").sortWithinPartitions("key", "node")
    return sorted_.mapInPandas(_links(bits, tables, threshold), "node long, links long, root long")


def _light_keys(bits: int, tables: int):
    full = _keys(bits, tables)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in full(batch.assign(copies=0) for batch in batches):
            yield frame[["code", "place"]]

    return run


def embedding_groups(embeddings: DataFrame, ident: str = "vec_id", vector: str = "embedding",
                     threshold: float = THRESHOLD, miss: float = MISS, group: int = GROUP) -> DataFrame:
    """``(ident, n_links, component_id, kept)`` per row.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, and so do
    rows with a null id: each is a component of its own. Rows with equal vectors are one vector with
    that many copies; copies link with each other and share all links. Vectors of different length do
    not link. Repeated ids count as rows of their own. Other columns are ignored.
    """
    rows = embeddings.select(F.col(ident).alias("id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    sound = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = cut_lineage(rows.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("node", F.xxhash64("vector")), "vectors")
    distinct = rows.where("sound").groupBy("node", spread("node")).agg(
        F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("first")
    ).drop("_spread")
    distinct = cut_lineage(distinct, "distinct")
    found = cut_lineage(near_vectors(distinct, threshold, miss, group), "near")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select("node", "root")).select("node", "component")
    named = distinct.select("node", "copies", "first").join(counted, "node", "left").join(linked, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "first",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
    )
    least = named.groupBy("component", spread("component")).agg(F.min("first").alias("least")).select("component", "least")
    by_node = named.join(least, "component").select(F.col("node").alias("of"), "n", "least")
    out = rows.select("id", F.when(F.col("sound"), F.col("node")).alias("node")).join(
        by_node, F.col("node") == F.col("of"), "left"
    )
    component = F.coalesce("least", "id")
    return out.select(
        F.col("id").alias(ident), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
