"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1. Its integral, scaled to the source's target,
is the source's cumulative demand of tokens. The documents of a source are laid end to end in a fixed
random order, pass after pass; a copy that starts at token ``x`` is trained at the time the cumulative
demand reaches ``x``. Sorting all copies by that time is the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import count_words, fresh

# Fixed values of the contract: weights of the sources in order, repeating, and the most passes.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
# Ratio of a source's rate at the end of training to its rate at the start, in the order of sources.
TILTS = (0.5, 1.0, 2.0)
# Ranges a source is cut into for running totals.
BUCKETS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_PASSES) -> DataFrame:
    """``(source, source_size, weight, rank, target)`` for rows ``(source, size)``.

    Targets share the total by weight; none is above ``most`` times its source's size, and what is
    above goes to the others by weight until none is above. That is a common level: a source gets the
    smaller of its bound and level x weight. In the order of bound / weight the capped sources come first, so
    running sums tell for each source whether the level that is left for it and all later ones reaches its bound.
    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    given = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("rank", rank).withColumn(
        "weight", F.element_at(given, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ).withColumn("bound", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    later = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    levels = ranked.withColumn("level", (total - before) / later).withColumn(
        "free", F.col("bound") > F.col("level") * F.col("weight")
    )
    # The first source under its bound sets the level of all that follow.
    level = F.min(F.when(F.col("free"), F.struct(F.col("bound") / F.col("weight"), "rank", "level"))).over(Window.partitionBy())
    target = F.least("bound", F.coalesce(F.col("l.level") * F.col("weight"), F.col("bound")))
    return levels.withColumn("l", level).select("source", "source_size", "weight", "rank", target.alias("target"))


def place(ident: str) -> Column:
    """A fixed random place of a document in its source: 128 bits of its id as text, as hex digits."""
    return F.md5(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary"))


def bucket_of(place_: Column | str) -> Column:
    return F.conv(F.left(place_, F.lit(3)), 16, 10).cast("int")


def running_sizes(rows: DataFrame) -> DataFrame:
    """Adds ``before``: the words of the source that come earlier in the order of places.

    A source is cut into 4,096 ranges of places. Sums inside a range need one small window each, sums of
    whole ranges one window of at most 4,096 rows per source, so no task holds a whole source.
    """
    cut = rows.withColumn("bucket", bucket_of("place"))
    ranges = cut.groupBy("source", "bucket").agg(F.sum("all_size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("carried")
    )
    order = Window.partitionBy("source", "bucket").orderBy("place", F.col("_id").isNull(), "_id", "size")
    inside = F.coalesce(F.sum("all_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = cut.withColumn("inside", inside).join(
        carried, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    )
    return joined.withColumn("before", F.col("carried") + F.col("inside"))


def demand_time(share: Column, tilt: Column) -> Column:
    """The training time 0..1 at which a source has used up ``share`` of its target.

    The rate runs linearly from 2/(1+tilt) to 2*tilt/(1+tilt): its integral is a + b with b the curve's
    part, and the inverse is the root of a quadratic that lies in 0..1.
    """
    low, high = 2 / (1 + tilt), 2 * tilt / (1 + tilt)
    # share = low t + (high - low) t^2 / 2, in the form that is stable for high = low.
    root = 2 * share / (low + F.sqrt(F.greatest(low * low + 2 * (high - low) * share, F.lit(0.0))))
    return F.least(F.greatest(root, F.lit(0.0)), F.lit(1.0))


def mix_plan(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = WEIGHTS, most: int = MOST_PASSES, tilts: Sequence[float] = TILTS) -> DataFrame:
    """How often and when each document is trained: one row per distinct (id, source, size).

    Columns: ``(_id, source, size, all_size, source_size, target, copies, taken, positions)``; ``all_size``
    counts the words of all rows that share id, source and size: they are taken alike. A source's full
    passes take every document; the last, partial one takes a document when its middle lies within what
    is left of the target, so a source misses its target by half a document at most. ``positions``
    holds the training time of each copy, ascending. Null texts and texts without words have size 0 and are
    taken 0 words, in as many copies as their neighbours. A null source is a source of its own, the last in order. An empty
    table gives an empty plan. A null id has the place of an empty one. Reruns agree: places follow ids.
    """
    sizes = docs.select(F.col(ident).alias("_id"), F.col(source).alias("source"), count_words(text).alias("size"))
    sizes = cut_lineage(sizes, "sizes")
    return plan_sizes(sizes, weights, most, tilts)


def plan_sizes(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_PASSES,
               tilts: Sequence[float] = TILTS) -> DataFrame:
    """The plan of ``mix_plan`` for rows ``(_id, source, size)``."""
    rows = sizes.groupBy("_id", "source", "size").agg(F.sum("size").alias("all_size")).withColumn("place", place("_id"))
    targets = cut_lineage(source_targets(sizes, weights, most), "targets").select(
        F.col("source").alias("t"), "source_size", "target", "rank"
    )
    placed = running_sizes(rows).drop("s", "b").join(targets, F.col("source").eqNullSafe(F.col("t")))
    size = F.col("source_size").cast("double")
    middle = F.col("before") + F.col("all_size") / 2
    passes = F.ceil((F.col("target") - middle) / F.when(size > 0, size))
    copies = F.greatest(F.least(F.coalesce(passes, F.lit(0)), F.lit(most)), F.lit(0)).cast("int")
    given = F.array(*[F.lit(float(x)) for x in tilts])
    tilt = F.element_at(given, ((F.col("rank") - 1) % len(tilts) + 1).cast("int"))
    counted = placed.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    start = lambda turn: (turn * size + F.col("before")) / F.col("target")
    positions = F.when(
        F.col("copies") > 0,
        F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda turn: demand_time(start(turn), tilt)),
    ).otherwise(F.array().cast("array<double>"))
    return counted.select(
        "_id", "source", "size", "all_size", "source_size", "target", "copies", "taken", positions.alias("positions")
    )


def planned_rows(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The plan for every row: ``(_id, source, size, source_size, target, copies, taken, positions, row)``.

    Rows that repeat in id, source and size come back as often as they came, told apart by ``row``.
    """
    sizes = cut_lineage(
        docs.select(F.col(ident).alias("_id"), F.col(source).alias("source"), count_words(text).alias("size")), "sizes"
    )
    rows = sizes.groupBy("_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    plan = plan_sizes(sizes, **options)
    same = [plan[c].eqNullSafe(rows[c]) for c in ("_id", "source", "size")]
    both = plan.join(rows, same[0] & same[1] & same[2]).select(plan["*"], rows["rows"])
    each = both.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return each.select("_id", "source", "size", "source_size", "target", "copies", "taken", "positions", "row")


def training_order(planned: DataFrame) -> DataFrame:
    """The mix itself, from :func:`planned_rows`: ``(_id, source, size, row, position, turn)``, a row for each copy in training order.

    Copies are range-sorted by position; ties follow the place and the id.
    """
    copies = planned.select("_id", "source", "size", "row", F.posexplode("positions").alias("turn", "position"))
    placed = copies.withColumn("place", place("_id"))
    order = ["position", "place", "_id", "source", "size", "row", "turn"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "source", "size", "row", "position", "turn")


def mix_sizes(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """What the mix holds of every row: ``(ident, source, size, source_size, target, copies, taken, first_position)``.

    The copies are laid out in training order and stored; copies, words taken and the first position are counted on that order.
    """
    planned = cut_lineage(planned_rows(docs, ident, text, source, **options), "plan")
    order = cut_lineage(training_order(planned), "order")
    key = ["_id", "source", "size", "row"]
    held = order.groupBy(*[F.col(c).alias(f"h{c}") for c in key]).agg(
        F.count(F.lit(1)).cast("int").alias("held"), F.sum("size").alias("words"), F.min("position").alias("first_position")
    )
    same = F.lit(True)
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"h{c}"))
    return planned.select(*key, "source_size", "target").join(held, same, "left").select(
        F.col("_id").alias(ident), "source", "size", "source_size", "target",
        F.coalesce("held", F.lit(0)).alias("copies"), F.coalesce("words", F.lit(0)).cast("long").alias("taken"), "first_position",
    )


def mixed_documents(docs: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents as they are trained: a row for each copy, range-sorted by position.

    Columns are those of ``docs``. Documents that the mix does not take are left out, repeated ones come
    as several rows. Ties of position follow the place and the id.
    """
    key, from_, words = fresh(docs, "_mix_id", "_mix_source", "_mix_size")
    at, where = fresh(docs, "_mix_at", "_mix_place")
    plan = mix_plan(docs, ident, text, source, **options).where("copies > 0").select(
        F.col("_id").alias(key), F.col("source").alias(from_), F.col("size").alias(words), F.col("positions").alias(at)
    )
    sized = docs.withColumn(words + "_d", count_words(text))
    taken = sized.join(
        plan,
        F.col(ident).eqNullSafe(F.col(key)) & F.col(source).eqNullSafe(F.col(from_)) & (F.col(words + "_d") == F.col(words)),
    )
    copies = taken.withColumn(at, F.explode(at)).withColumn(where, place(ident))
    ordered = copies.repartitionByRange(at, where).sortWithinPartitions(at, where, key)
    return ordered.select(*docs.columns)
