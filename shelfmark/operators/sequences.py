"""Sequence columns: gaps, running values, order inversions, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .membership import spread


def sequence_gaps(df: DataFrame, parent: list[str], seq: str, start: int) -> DataFrame:
    """``(parent…, seq, occurrences)`` for numbers above ``start`` whose predecessor is missing.

    Each row votes for its own number and for the next one, so one partially aggregated exchange on
    (parent, number) answers the question: no self-join, and a hot parent spreads over its numbers.
    """
    here = F.struct(F.col(seq).cast("long").alias("n"), F.lit(1).alias("own"))
    after = F.struct((F.col(seq).cast("long") + 1).alias("n"), F.lit(0).alias("own"))
    votes = df.where(F.col(seq).isNotNull()).select(*parent, F.explode(F.array(here, after)).alias("v"))
    numbers = votes.groupBy(*parent, F.col("v.n").alias(seq)).agg(
        F.sum(F.col("v.own").cast("long")).alias("occurrences"), F.min("v.own").alias("_before")
    )
    known_parent = F.lit(True)
    for column in parent:
        known_parent &= F.col(column).isNotNull()
    gap = (F.col("_before") == 1) | ~known_parent
    return numbers.where((F.col("occurrences") > 0) & (F.col(seq) > start) & gap).drop("_before")


# Bits of an order value that one window covers.
WINDOW_BITS = 16


def order_span(df: DataFrame, order: str) -> tuple[int, int]:
    """``(low, high)`` of an integer order, ``(0, 0)`` without any value: one aggregate over one column."""
    row = df.agg(F.min(order).cast("long").alias("low"), F.max(order).cast("long").alias("high")).first()
    return (row.low, row.high) if row.low is not None else (0, 0)


def running_before(
    df: DataFrame, key: list[str], order: str, value: str, out: str, how: str = "sum", width: int = 1 << WINDOW_BITS,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """Sum or maximum of ``value`` over the rows of the group with a strictly smaller ``order``.

    ``span`` are the least and the largest order, where the caller knows them; otherwise ``df`` is asked.
    """
    return _running(df, key, order, {out: (value, how)}, width, span or order_span(df, order))


def _running(df: DataFrame, key: list[str], order: str, values: dict[str, tuple[str, str]], width: int, span: tuple[int, int]) -> DataFrame:
    """``out: (value, how)`` over the rows of the group with a strictly smaller ``order``, an integer in ``span``.

    Groups are cut into ranges of ``width`` order values. Each range is one small window; totals of whole
    ranges are carried over in the same way, ranges of ranges, until one window covers what is left
    of the span. So no window holds more than ``width`` different places, however the values lie, and an order of
    few values takes a single window.
    """
    how_to = {"sum": F.sum, "max": F.max}

    def level(rows: DataFrame, order: str, values: dict[str, tuple[str, str]], low: int, high: int, depth: int) -> DataFrame:
        inside = {out: how_to[how](value) for out, (value, how) in values.items()}
        if high - low < width:
            window = Window.partitionBy(*key).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
            return rows.withColumns({
                out: F.coalesce(c.over(window), F.lit(0)) if values[out][1] == "sum" else c.over(window)
                for out, c in inside.items()
            })
        # A level orders ranges by the name the level below gave them, so each has a name of its own.
        place, theirs = f"_range_{depth}", f"_of_range_{depth}"
        cut = F.floor(F.col(order) / width).cast("long")
        ranges = rows.groupBy(*key, cut.alias(place)).agg(*[c.alias(f"{out}_total") for out, c in inside.items()])
        carried = level(
            ranges, place, {f"{out}_carried": (f"{out}_total", how) for out, (_, how) in values.items()},
            low // width - 1, high // width + 1, depth + 1,  # one more on both sides, as large orders are divided inexactly
        )
        given = carried.select(
            *[F.col(k).alias(f"_of_{k}") for k in key], F.col(place).alias(theirs), *[f"{out}_carried" for out in values]
        )
        window = Window.partitionBy(*key, place).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
        local = rows.withColumn(place, cut).withColumns({f"{out}_here": c.over(window) for out, c in inside.items()})
        same = F.col(place) == F.col(theirs)
        for k in key:
            same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        joined = local.join(given, same, "left")
        both = {
            out: F.coalesce(f"{out}_here", F.lit(0)) + F.coalesce(f"{out}_carried", F.lit(0)) if how == "sum"
            else F.greatest(f"{out}_here", f"{out}_carried")
            for out, (_, how) in values.items()
        }
        return joined.select(*[F.col(c) for c in rows.columns], *[c.alias(out) for out, c in both.items()])

    return level(df, order, values, *span, 0)


# Rows of a group whose pairs are compared where they lie.
SMALL_GROUP = 32


def inversions(df: DataFrame, key: str, seq: str, value: str, small: int = SMALL_GROUP) -> DataFrame:
    """Rows that follow a row of their group with a larger value.

    One output row per offending ``(seq, value)``: it names the earlier row with the largest value and
    counts in ``occurrences`` all (earlier, later) pairs the offender is the later part of.

    Groups of at most ``small`` rows come together whole and compare their own pairs, so their rows are exchanged once;
    larger ones, of which there are few for their rows, are compared by bits of the value.
    """
    known = F.col(value).isNotNull() & F.col(seq).isNotNull() & F.col(key).isNotNull()
    rows = df.where(known).select(key, F.col(seq).alias("seq"), F.col(value).cast("long").alias("value"))
    large = rows.groupBy(F.col(key).alias("_large"), spread(key)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > small).select("_large")
    few = rows.join(large, rows[key] == large["_large"], "left_anti")
    many = rows.join(large, rows[key] == large["_large"], "left_semi")
    return _inversions_inside(few, key).unionByName(_inversions_by_bits(many, key, rows))


def _inversions_inside(rows: DataFrame, key: str) -> DataFrame:
    """Inversions of groups that are small enough to be one value each."""
    groups = rows.groupBy(key).agg(F.collect_list(F.struct("seq", "value")).alias("_rows")).where(F.size("_rows") > 1)
    each = groups.withColumn("_row", F.explode(F.array_distinct("_rows")))
    before = F.filter("_rows", lambda r: (r["seq"] < F.col("_row.seq")) & (r["value"] > F.col("_row.value")))
    found = each.withColumn("_before", before).where(F.size("_before") > 0)
    peak = F.array_max(F.transform("_before", lambda r: F.struct(r["value"].alias("v"), (-r["seq"].cast("long")).alias("s"))))
    own = F.size(F.filter("_rows", lambda r: r == F.col("_row")))
    return found.withColumn("_peak", peak).select(
        key, F.col("_row.seq").cast("long").alias("seq"), F.col("_row.value").alias("value"), F.col("_peak.v").alias("first_value"),
        (-F.col("_peak.s")).alias("first_seq"), (own.cast("long") * F.size("_before")).alias("occurrences"),
    )


def _inversions_by_bits(rows: DataFrame, key: str, whole: DataFrame) -> DataFrame:
    """Inversions of groups of any size; the spans are those of the ``whole`` table, which asks for no join.

    Of two different values the larger one has a 1 and the smaller one a 0 at the first bit in which they
    differ. Every point becomes one row per bit, grouped by the bits above: a 0 then asks for the 1s of its
    group that come earlier. That is rows times bits, whatever the number of inversions.
    """
    points = rows.groupBy(key, "seq", "value").agg(F.count(F.lit(1)).alias("n"))
    # Bits above the highest in which any two values differ are alike everywhere.
    range_ = whole.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    offset = F.col("value") - range_["low"]
    bits = F.sequence(F.lit(0), F.greatest(F.length(F.bin(range_["high"] - range_["low"])) - 1, F.lit(0)))
    split = points.withColumn("_offset", offset).withColumn("_bit", F.explode(bits)).select(
        key, "seq", "value", "n", "_bit",
        F.expr("shiftright(_offset, _bit + 1)").alias("_above"),
        (F.expr("shiftright(_offset, _bit)") % 2 == 1).alias("_one"),
    )
    weighed = split.withColumn("_w", F.when(F.col("_one"), F.col("n")).otherwise(0)).withColumn(
        "_top", F.when(F.col("_one"), F.struct(F.col("value").alias("v"), (-F.col("seq").cast("long")).alias("s")))
    )
    counted = _running(
        weighed, [key, "_bit", "_above"], "seq", {"_before": ("_w", "sum"), "_peak": ("_top", "max")}, 1 << WINDOW_BITS, order_span(whole, "seq")
    ).where(~F.col("_one") & (F.col("_before") > 0))
    return counted.groupBy(key, "seq", "value").agg(
        F.max("_peak").alias("_peak"), (F.first("n") * F.sum("_before")).alias("occurrences")
    ).select(
        key, F.col("seq").cast("long").alias("seq"), "value", F.col("_peak.v").alias("first_value"),
        (-F.col("_peak.s")).alias("first_seq"), "occurrences",
    )


def last_of_group(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows with the largest sequence number of their group (ties all stay)."""
    last = df.groupBy(F.col(key).alias("_k")).agg(F.max(seq).alias("_last"))
    return df.join(last, df[key].eqNullSafe(last["_k"]) & (df[seq] == last["_last"]), "left_semi")


def assign_sequence(df: DataFrame, group: str, ident: str, out: str) -> DataFrame:
    """Number the rows of each group from 1 by the unique ``ident``; rows of a null group are one group."""
    return running_before(df.drop(out).withColumn("_one", F.lit(1).cast("long")), [group], ident, "_one", out).withColumn(
        out, (F.col(out) + 1).cast("int")
    ).drop("_one")


def hashed_bucket(key: list[str]) -> Column:
    """An even, engine-independent bucket 0..65535 of a composite key."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in key])
    return F.conv(F.left(F.md5(text), F.lit(4)), 16, 10).cast("int")


def assign_ids(df: DataFrame, key: list[str], start: Column | int, out: str = "id") -> DataFrame:
    """Consecutive numbers above ``start`` for rows with a unique ``key``.

    Numbers follow (bucket of the key, key): they depend on values only, so a recomputed partition
    gets the same ones. The only ungrouped window runs over at most 65,536 bucket counts.
    """
    bucketed = df.withColumn("_bucket", hashed_bucket(key))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    start = F.lit(start) if isinstance(start, int) else start
    return bucketed.join(offsets, "_bucket").withColumn(
        out, (start + F.col("_offset") + inside).cast("long")
    ).drop("_bucket", "_offset")
