"""Groups of equal rows: pair counts, twins, set signatures, canonical rows, first choices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .membership import spread
from .sequences import order_span, running_before


def pair_counts(df: DataFrame, key: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """Groups of two or more rows with equal keys; ``occurrences`` is their number of pairs."""
    grouped = df.groupBy(*[c.alias(n) for c, n in zip(key, names)]).agg(F.count(F.lit(1)).alias("_n"))
    return grouped.where("_n > 1").withColumn(
        "occurrences", F.expr("_n * (_n - 1) div 2")
    ).drop("_n")


def unlike_pair_counts(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Per key, the number of row pairs with two different values."""
    per_value = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n")
    return (
        per_value.groupBy(*key)
        .agg(total.alias("_all"), F.sum(F.col("_n") * F.col("_n")).alias("_same"))
        .withColumn("occurrences", F.expr("(_all * _all - _same) div 2"))
        .where("occurrences > 0").drop("_all", "_same")
    )


def twins(df: DataFrame, key: list[str], ident: str, carry: str, weight: str | None = None) -> DataFrame:
    """Rows that repeat an earlier row's key, each set against the first of its group.

    A star instead of all pairs: ``occurrences`` counts the pairs the row closes with any earlier one,
    so the total is the number of pairs while the output stays linear.
    """
    rows = df.withColumn("_w", F.col(weight) if weight else F.lit(1).cast("long"))
    firsts = rows.groupBy(*key, spread(*key)).agg(
        F.min(F.struct(F.col(ident).alias("id"), F.col(carry).alias("name"))).alias("first"),
        F.count(F.lit(1)).alias("_rows"),
    ).where("_rows > 1").drop("_rows", "_spread")
    repeated = rows.join(firsts, key).select(*rows.columns, "first")
    counted = running_before(repeated, key, ident, "_w", "_earlier", span=order_span(df, ident))
    return counted.where("_earlier > 0").withColumn(
        "occurrences", F.col("_w") * F.col("_earlier")
    ).drop("_w", "_earlier")


def same_members(groups: DataFrame, ident: str, name: str, members: DataFrame, group: str, member: str) -> DataFrame:
    """Groups with exactly the members (and repetitions) of an earlier group.

    Candidates share an order-free fingerprint built by map-side aggregation, never a member list;
    every candidate is then compared row by row with the first group of its fingerprint.
    """
    counted = members.where(F.col(member).isNotNull()).groupBy(
        F.col(group).alias("_g"), F.col(member).alias("_m")
    ).agg(F.count(F.lit(1)).alias("_n"))
    prints = counted.groupBy("_g").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("_m").alias("low"),
        F.max("_m").alias("high"),
        F.bit_xor(F.xxhash64("_m", "_n")).alias("print1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "_n", "_m")).alias("print2"),
    )
    keyed = groups.join(prints, groups[ident] == prints["_g"]).select(
        F.col(ident).alias("id"), F.col(name).alias("name"), "size", "low", "high", "print1", "print2"
    )
    repeated = twins(keyed, ["size", "low", "high", "print1", "print2"], "id", "name")
    pairs = repeated.select(F.col("first.id").alias("_first"), F.col("id").alias("_twin"))
    theirs = counted.join(pairs, counted["_g"] == pairs["_twin"]).select("_first", "_twin", "_m", "_n")
    ours = counted.select(F.col("_g").alias("_first"), "_m", "_n")
    differing = theirs.join(ours, ["_first", "_m", "_n"], "left_anti").select(F.col("_twin").alias("id")).distinct()
    return repeated.join(differing, "id", "left_anti").select("first", "id", "name", "occurrences")


def content_key(columns: Sequence[str]) -> Column:
    """SHA-256 over whole texts; NULL and empty differ, and no two column splits collide."""
    parts = [
        F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def canonical_ids(df: DataFrame, columns: Sequence[str], ident: str, out: str, digest: str | None = None) -> DataFrame:
    """Give every row the smallest id among the rows with equal ``columns`` (NULL equals NULL).

    Only digests and ids travel; ids that stand for themselves alone never reach the join back. A column may hold
    the ``digest`` of ``columns`` already, which then need not be in ``df``.
    """
    keyed = df.select(F.col(ident).alias("_id"), (F.col(digest) if digest else content_key(columns)).alias("_key"))
    firsts = keyed.groupBy("_key", spread("_key")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    others = (
        keyed.join(firsts.where("_n > 1").drop("_spread"), "_key").where("_id <> _first").select("_id", "_first")
    )
    return df.join(others, df[ident] == others["_id"], "left").withColumn(
        out, F.coalesce("_first", ident)
    ).drop("_id", "_first")


def first_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``. Partially aggregated, so hot keys shrink early."""
    rest = [c for c in df.columns if c not in key and c not in order]
    row = F.struct(*order, *rest)
    return df.groupBy(*key, spread(*key)).agg(F.min(row).alias("_row")).select(
        *key, *[F.col(f"_row.{c}").alias(c) for c in (*order, *rest)]
    ).select(*df.columns)


def first_source(sources: Sequence[DataFrame], key: str, tie: list[str]) -> DataFrame:
    """One row per key from the first source that has it; ``tie`` decides inside a source."""
    ranked = [df.withColumn("_rank", F.lit(rank)) for rank, df in enumerate(sources)]
    union = reduce(DataFrame.unionByName, ranked).where(F.col(key).isNotNull())
    return first_by(union, [key], ["_rank", *tie]).drop("_rank")


# Bytes of one segment of an ordered text.
SEGMENT = 1 << 16


def segmented_text(df: DataFrame, key: list[str], order: str, text: str, sep: str = ", ", size: int = SEGMENT) -> DataFrame:
    """The texts of each group in order, joined: ``(key…, segment, text)``, one row for each ``size`` bytes.

    A piece belongs to the segment in which it begins, counted in bytes of all pieces before it and their separators; so a
    segment holds ``size`` bytes and the rest of one piece at most, and segments joined by ``sep`` are the
    whole. Rows follow the integer ``order``, NULL first, then the text; NULL texts are left out, as are groups without any.
    Offsets are running sums over ranges of places: no window holds a whole group, only rows of one place
    are sorted together. The rows are asked three times, for their span, their places and their texts, so they are written once.
    """
    rows = df.where(F.col(text).isNotNull()).select(*key, F.col(order).alias("_order"), F.col(text).alias("_text"))
    rows = cut_lineage(rows, "pieces")
    low, high = order_span(rows, "_order")
    pieces = rows.select(
        *key, F.coalesce(F.col("_order").cast("long") - low + 1, F.lit(0).cast("long")).alias("_place"), "_text",
        (F.octet_length("_text") + F.octet_length(F.lit(sep))).cast("long").alias("_bytes"),
    )
    places = pieces.groupBy(*key, "_place").agg(F.sum("_bytes").alias("_bytes"))
    placed = running_before(places, key, "_place", "_bytes", "_offset", span=(0, high - low + 1)).select(
        *[F.col(k).alias(f"_of_{k}") for k in key], F.col("_place").alias("_of_place"), "_offset"
    )
    tied = Window.partitionBy(*key, "_place").orderBy("_text").rowsBetween(Window.unboundedPreceding, -1)
    local = pieces.withColumn("_here", F.coalesce(F.sum("_bytes").over(tied), F.lit(0)))
    same = F.col("_place") == F.col("_of_place")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    segment = F.floor((F.col("_offset") + F.col("_here")) / size).alias("segment")
    in_order = F.array_sort(F.collect_list(F.struct("_place", "_here", "_text")))
    return local.join(placed, same).groupBy(*key, segment).agg(
        F.array_join(F.transform(in_order, lambda p: p["_text"]), sep).alias("text")
    )


def whole_text(segments: DataFrame, key: list[str], out: str, sep: str = ", ") -> DataFrame:
    """``(key…, out)``: the segments of each group as one text, for groups whose text a caller wants as one value."""
    in_order = F.array_sort(F.collect_list(F.struct("segment", "text")))
    return segments.groupBy(*key, spread(*key)).agg(
        F.array_join(F.transform(in_order, lambda s: s["text"]), sep).alias(out)
    ).drop("_spread")
