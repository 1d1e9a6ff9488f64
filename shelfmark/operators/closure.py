"""One-hop closure over the label graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .membership import among

# Label types that stand for people (a person and a nickname).
PEOPLE = ("+", "-")


def label_edges(labels: DataFrame, known_parents: bool) -> DataFrame:
    """``(label_id, related_id)``: to both parents, and down to children that are people or untyped.

    With ``known_parents`` both ends must be listed labels; otherwise only the label that names the other is.
    """
    ups = labels.select(
        F.col("id").alias("label_id"), F.explode(F.array("from_id", "owner_id")).alias("related_id")
    ).where("related_id is not null")
    if known_parents:
        ups = among(ups, "related_id", labels, "id", unique=True)
    children = labels.where(F.col("labeltype_id").isNull() | F.col("labeltype_id").isin(*PEOPLE))
    downs = children.select(
        F.explode(F.array("from_id", "owner_id")).alias("label_id"), F.col("id").alias("related_id")
    ).where("label_id is not null")
    if known_parents:
        downs = among(downs, "label_id", labels, "id", unique=True)
    return ups.unionByName(downs).distinct()


def label_closure(seed: DataFrame, labels: DataFrame, known_parents: bool = True) -> DataFrame:
    """Distinct ``(label_id, entry_id)``: the seed and everything one edge away."""
    pairs = seed.where("label_id is not null and entry_id is not null").select("label_id", "entry_id").distinct()
    reached = pairs.join(label_edges(labels, known_parents), "label_id").select(
        F.col("related_id").alias("label_id"), "entry_id"
    )
    return pairs.unionByName(reached).distinct()


def labels_reaching(wanted: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct ``label_id``: the wanted labels and those one edge before them.

    The closure turned round: who asks for a few labels can search the seed itself with these, without
    the pairs of every entry with every relative.
    """
    before = among(edges, "related_id", wanted, "label_id")
    return wanted.select("label_id").unionByName(before.select("label_id")).distinct()
