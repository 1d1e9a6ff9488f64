"""Table changes as new versions of immutable tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .groups import first_by
from .membership import spread
from .sequences import assign_ids


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], values: Mapping[str, str],
                where: Column | None = None, unique: bool = False, kept: Sequence[str] = ()) -> DataFrame:
    """Take ``values`` (target column: source column) from the source row with the same key.

    Of several source rows with one key the smallest is taken, unless the caller knows keys to be ``unique``.
    A row that matches takes the source value even where it is NULL; columns ``kept`` stay then.
    """
    taken = source.select(*on, *[F.col(s).alias(f"_new_{t}") for t, s in values.items()])
    if not unique:
        taken = first_by(taken, list(on), [c for c in taken.columns if c not in on])
    taken = taken.withColumn("_matched", F.lit(True))
    joined = target.join(taken, list(on), "left")
    hit = F.coalesce("_matched", F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    return joined.select(
        *[
            F.when(hit & F.col(f"_new_{c}").isNotNull() if c in kept else hit, F.col(f"_new_{c}")).otherwise(target[c]).alias(c)
            if c in values else F.col(c)
            for c in target.columns
        ]
    )


def insert_missing(target: DataFrame, rows: DataFrame, key: Sequence[str], ident: str = "id",
                   present: DataFrame | None = None) -> DataFrame:
    """The distinct ``key`` rows not yet present, numbered above the largest id of ``target``."""
    known = (target if present is None else present).select(*key).distinct()
    fresh = rows.select(*key).distinct().join(known, list(key), "left_anti")
    return assign_ids(fresh, list(key), target.agg(F.coalesce(F.max(ident), F.lit(0))).scalar(), ident)


def replace_slice(target: DataFrame, fresh: DataFrame, column: str, value: object) -> DataFrame:
    """Drop the rows of one slice and put ``fresh`` in their place; other slices stay untouched."""
    kept = target.where(~F.col(column).eqNullSafe(F.lit(value)))
    return kept.unionByName(fresh.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns]))


def match_choices(df: DataFrame, key: Sequence[str], choice: str) -> DataFrame:
    """Per key the smallest choice and the number of choices: ``(key…, choice, candidates)``.

    Built on the side that is looked up, so that a join never pairs all its rows with all that ask.
    """
    grouped = df.groupBy(*key, spread(*key)).agg(F.min(choice).alias(choice), F.count(F.lit(1)).alias("candidates"))
    return grouped.drop("_spread")


def tiered_match(tiers: Sequence[DataFrame], key: str, choice: str, tier: str | None = None) -> DataFrame:
    """First tier that knows a key wins. Each tier holds ``(key, choice, candidates)``, one row per key.

    ``candidates`` tells how many choices the winning tier had: more than one is a collision. Frames that hold several
    tiers, one row per key and tier, tell them by a column ``tier``.
    """
    ranked = [
        df.select(key, choice, "candidates", (F.col(tier) if tier else F.lit(i)).cast("int").alias("tier"))
        for i, df in enumerate(tiers, 1)
    ]
    union = reduce(DataFrame.unionByName, ranked).where(F.col(key).isNotNull() & F.col(choice).isNotNull())
    return first_by(union, [key], ["tier"]).select(key, choice, "tier", "candidates")
