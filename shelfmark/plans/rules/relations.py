"""Rules on relations between entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...operators.groups import unlike_pair_counts
from ...operators.membership import absent, among
from .entries import entries_base
from .registry import Tables, finding, rule, titled


def _related_genre(t: Tables, kind: str, side: str) -> DataFrame:
    rows = t["relations"].where(F.col("relationtype_id") == kind).select(F.col(side).alias("id"))
    entries = entries_base(t).where("genre is not null").select("id", "title", "genre")
    return rows.join(entries, "id")


@rule("authored_with_non_tool", "program authored with another program that is not programming tool or utility")
def _(t: Tables) -> DataFrame:
    # Fixed value: one original known to be right.
    rows = _related_genre(t, "a", "original_id").where(
        "not startswith(genre, 'Utility:') and not startswith(genre, 'Programming:') and id <> 3032"
    )
    return finding(rows, "id", "title", "genre")


@rule("editor_not_utility", "game editor that is not utility")
def _(t: Tables) -> DataFrame:
    rows = _related_genre(t, "e", "entry_id").where("not startswith(genre, 'Utility:')")
    return finding(rows, "id", "title", "genre")


@rule("multiple_origins", "title cannot have multiple origins")
def _(t: Tables) -> DataFrame:
    ported = t["relations"].where("relationtype_id in ('p', 'u')")
    pairs = unlike_pair_counts(ported, ["entry_id", "relationtype_id"], "original_id")
    types = t["relationtypes"].select(F.col("id").alias("relationtype_id"), F.col("text").alias("kind"))
    rows = titled(pairs.join(types, "relationtype_id"), t, "entry_id")
    return finding(rows, "entry", "title", "kind", "occurrences")


def _of_genre(t: Tables, genre: int) -> DataFrame:
    return entries_base(t).where((F.col("genretype_id") == genre) & F.col("genre").isNotNull())


def _editors(t: Tables) -> DataFrame:
    return t["relations"].where("relationtype_id = 'e'")


@rule("misclassified_editor", "possibly misclassified game editor")
def _(t: Tables) -> DataFrame:
    return finding(among(_of_genre(t, 52), "id", _editors(t), "entry_id"), "id", "title", "genre")


@rule("editor_without_game", "game editor for unidentified game")
def _(t: Tables) -> DataFrame:
    return finding(absent(_of_genre(t, 53), "id", _editors(t), "entry_id"), "id", "title", "genre")
