"""Semi- and anti-joins with the null behaviour the rules rely on."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage


SALTS = 32


def spread(*key: str) -> Column:
    """An extra grouping column that follows from the key and leaves the groups as they are.

    A join that consumes the grouped rows cannot take over their partitioning then, so both its sides
    arrive by an exchange of their own. Only such joins are split at run time when one key is hot.
    """
    return F.pmod(F.xxhash64(*key), F.lit(1024)).alias("_spread")


def key_set(df: DataFrame, column: str, name: str = "key", unique: bool = False) -> DataFrame:
    """Distinct non-null keys. The partial distinct shrinks a hot key before any exchange."""
    keys = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull())
    return keys if unique else keys.select(name, spread(name)).distinct().select(name)


def among(left: DataFrame, column: str, right: DataFrame, right_column: str, unique: bool = False) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``, whose keys may be known to be ``unique``."""
    keys = key_set(right, right_column, "_key", unique)
    return left.join(keys, left[column] == keys["_key"], "left_semi")


def absent(
    left: DataFrame, column: str, right: DataFrame, right_column: str, null_aware: bool = False, unique: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    ``null_aware`` follows SQL ``NOT IN``: one NULL on the right leaves no rows, and a NULL on the left
    stays only when the right side is empty. Those two facts are one-row subqueries, so the join itself
    stays a plain hash or merge anti-join and never has to ship the whole right side to every task.
    """
    keys = key_set(right, right_column, "_key", unique)
    kept = left.join(keys, left[column] == keys["_key"], "left_anti")
    if not null_aware:
        return kept
    flags = right.agg(
        F.struct(
            F.coalesce(F.max(F.col(right_column).isNull()), F.lit(False)).alias("has_null"),
            (F.count(F.lit(1)) == 0).alias("empty"),
        )
    ).scalar()
    return kept.where(~flags["has_null"] & (kept[column].isNotNull() | flags["empty"]))


def among_any(left: DataFrame, column: str, sets: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose key occurs in any of several sets: one distinct union and one semi-join."""
    lists = [df.select(F.col(col).alias("_key")).where("_key is not null") for df, col in sets]
    keys = key_set(reduce(DataFrame.unionByName, lists), "_key", "_key")
    return left.join(keys, left[column] == keys["_key"], "left_semi")


def missing_references(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key check: ``(column, occurrences)`` of non-null values without a parent, counted before the join."""
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    return absent(used, column, parent, parent_column, unique=True)


def broken_references(children: Mapping[str, tuple[DataFrame, Iterable[str]]], parent: DataFrame, parent_column: str) -> DataFrame:
    """All references to one parent: ``(tab, col, value, occurrences)`` of the non-null values that it lacks.

    ``children`` gives by table its rows and the columns that refer to the parent. Values of all of them and the
    parent's keys are tagged and counted by tag in one aggregate, whose partial counts shrink a hot value before the only
    exchange; each child is read once, however many of its columns refer to the parent.
    """
    tags = [(name, column) for name, (_, columns) in children.items() for column in columns]
    rows = [parent.select(F.col(parent_column).alias("_key"), F.lit(-1).alias("_tag"))]
    for name, (df, columns) in children.items():
        used = [F.struct(F.col(c).alias("_key"), F.lit(tags.index((name, c))).alias("_tag")) for c in columns]
        rows.append(df.select(F.explode(F.array(*used)).alias("_use")).select("_use._key", "_use._tag"))
    counted = reduce(DataFrame.unionByName, rows).where("_key is not null").groupBy("_key").agg(
        F.min("_tag").alias("_least"), *[F.count_if(F.col("_tag") == i).alias(f"_n{i}") for i in range(len(tags))]
    )
    found = F.array(*[
        F.struct(F.lit(name).alias("tab"), F.lit(column).alias("col"), F.col(f"_n{i}").alias("occurrences"))
        for i, (name, column) in enumerate(tags)
    ])
    lost = counted.where("_least >= 0").select(F.col("_key").cast("string").alias("value"), F.explode(found).alias("_found"))
    return lost.select("_found.tab", "_found.col", "value", "_found.occurrences").where("occurrences > 0")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key check: key values that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def without_suffix(df: DataFrame, column: str, suffixes: DataFrame, suffix: str) -> DataFrame:
    """Rows whose text ends in none of the listed suffixes.

    A hash semi-join on the endings of each length that occurs, not a nested loop over the list.
    ``df`` needs no key of its own: identical texts share one verdict. A common ending is spread over
    ``SALTS`` copies of the short list.
    """
    lengths = suffixes.agg(F.collect_set(F.char_length(suffix))).scalar()
    texts = key_set(df, column, "_text")
    endings = texts.select(
        "_text", F.pmod(F.xxhash64("_text"), F.lit(SALTS)).alias("_salt"), F.explode(lengths).alias("_n")
    ).where(F.char_length("_text") >= F.col("_n")).select("_text", "_salt", F.expr("right(_text, _n)").alias("_key"))
    listed = key_set(suffixes, suffix, "_key").select(
        "_key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt")
    )
    known = endings.join(listed, ["_key", "_salt"], "left_semi")
    return absent(df, column, known, "_text")


def prefix_counts(names: DataFrame, name: str, stems: DataFrame, stem: str) -> DataFrame:
    """``(_key, _hits)``: for every distinct stem, the number of names that it starts; NULLs are left out.

    In the order of their bytes the names that a stem starts lie together, so their number is a difference of two ranks:
    names before the end of that range less names before its beginning. Equal names are one row with a count, each
    stem is two rows, and all of them are range-sorted together; the ranges are written once, as another sample would
    cut them elsewhere. Ranks are running counts inside a range and of whole ranges.
    """
    held = names.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("binary").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    wanted = key_set(stems, stem, "stem")
    # No text holds the byte FF: it comes after all that may follow a stem.
    ends = F.array(
        F.struct(F.col("stem").cast("binary").alias("at"), F.lit(0).alias("kind")),
        F.struct(F.concat(F.col("stem").cast("binary"), F.unhex(F.lit("FF"))).alias("at"), F.lit(2).alias("kind")),
    )
    events = held.select("at", F.lit(1).alias("kind"), "n", F.lit(None).cast("string").alias("stem")).unionByName(
        wanted.select(F.explode(ends).alias("e"), "stem").select("e.at", "e.kind", F.lit(0).cast("long").alias("n"), "stem")
    )
    placed = events.repartitionByRange("at", "kind").withColumn("range", F.spark_partition_id())
    placed = cut_lineage(placed, "ranks")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("range").agg(F.sum("n").alias("held")).select("range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("inside", F.sum("n").over(inside)).where("stem is not null").join(before, "range")
    rank = F.col("before") + F.col("inside")
    return ranked.groupBy(F.col("stem").alias("_key"), spread("stem")).agg(
        F.sum(F.when(F.col("kind") == 2, rank).otherwise(-rank)).alias("_hits")
    ).drop("_spread")


def lonely_prefixes(df: DataFrame, ident: str, name: str, stem: str) -> DataFrame:
    """Rows with a stem that starts no other row's name; what is exchanged are names and stems, whatever their lengths."""
    stems = df.where(F.col(stem).isNotNull())
    counts = prefix_counts(df, name, stems, stem)
    own = F.coalesce(F.col(name).startswith(F.col(stem)), F.lit(False)).cast("int")
    return (
        stems.join(counts, stems[stem] == counts["_key"], "left")
        .where(F.coalesce("_hits", F.lit(0)) - own == 0)
        .drop("_key", "_hits")
    )
