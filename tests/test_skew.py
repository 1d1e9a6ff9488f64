"""A third of all rows on one key: right results, and joins that split the hot key at run time."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import groups, membership
from shelfmark.operators.changes import update_from
from shelfmark.operators.groups import canonical_ids, first_by, pair_counts, twins
from shelfmark.operators.membership import absent, among, without_suffix
from shelfmark.operators.sequences import assign_ids, assign_sequence, inversions, running_before, sequence_gaps

ROWS = 30_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8192",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "8192",
}


@pytest.fixture()
def small(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def hot(small):
    """Key 0 holds a third of the rows."""
    return small.range(0, ROWS, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_semi_and_anti_joins_split_the_hot_key(hot):
    lists = hot.where("k < 500").select(F.col("k").alias("key"))
    inside, outside = among(hot, "k", lists, "key"), absent(hot, "k", lists, "key")
    assert "skew=true" in final_plan(inside)
    assert "skew=true" in final_plan(outside)
    assert inside.count() + outside.count() == ROWS
    assert outside.where("k < 500").count() == 0


def test_canonical_ids_split_the_hot_text(hot):
    texts = hot.withColumn("text", F.concat(F.lit("t"), F.col("k")))
    out = canonical_ids(texts, ["text"], "id", "first")
    assert "skew=true" in final_plan(out)
    first = {}
    rows = out.select("id", "k", "first").collect()
    for r in sorted(rows):
        first.setdefault(r.k, r.id)
    assert all(r["first"] == first[r.k] for r in rows)


def test_update_from_splits_the_hot_key(hot):
    source = first_by(hot.select("k", F.col("id").alias("low")), ["k"], ["low"])
    out = update_from(hot.withColumn("v", F.lit(-1).cast("long")), source, ["k"], {"v": "low"})
    assert "skew=true" in final_plan(out)
    assert out.where("v < 0 or v > id").count() == 0


def test_hot_parent_gaps_pairs_and_numbers(hot):
    rows = hot.select("k", "id").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.k].append(r.id)

    gaps = sequence_gaps(hot, ["k"], "id", 0).agg(F.sum("occurrences")).first()[0]
    known = {k: set(ids) for k, ids in groups.items()}
    assert gaps == sum(1 for k, ids in groups.items() for i in ids if i > 0 and i - 1 not in known[k])

    pairs = {r.k: r.occurrences for r in pair_counts(hot, [F.col("k")], ["k"]).collect()}
    assert pairs == {k: len(v) * (len(v) - 1) // 2 for k, v in groups.items() if len(v) > 1}

    numbered = {r.id: r.seq for r in assign_sequence(hot, "k", "id", "seq").select("id", "seq").collect()}
    for ids in groups.values():
        assert [numbered[i] for i in sorted(ids)] == list(range(1, len(ids) + 1))


def test_sparse_ids_of_a_hot_key_share_windows(small):
    """Ids far apart put one row in each range; ranges of ranges keep every window small."""
    far = small.range(0, 3000, 1, 8).select(
        (F.col("id") % 1).alias("k"), (F.col("id") * 5_000_000_011).alias("id"), F.lit(1).cast("long").alias("w")
    )
    out = running_before(far, ["k"], "id", "w", "before", "sum", 256)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Places span 44 bits; at 8 a level that is five levels of ranges below a last window.
    assert all(f"_range_{depth}" in plan for depth in range(5)) and "_range_5" not in plan
    assert sorted(r.before for r in out.collect()) == list(range(3000))


def test_null_groups_are_numbered(small):
    rows = small.range(0, 300).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"), (F.col("id") * 70_000).alias("id"))
    numbered = assign_sequence(rows, "k", "id", "seq").where("k is null").orderBy("id").collect()
    assert [r.seq for r in numbered] == list(range(1, 151))


def test_inversions_stay_linear(small):
    """One key, all values falling: rows times bits, not offenders times values."""
    def sizes(n):
        falling = small.range(0, n).select((F.col("id") % 1).alias("k"), F.col("id").cast("int").alias("seq"), (n - F.col("id")).alias("v"))
        out = inversions(falling, "k", "seq", "v")
        total = out.agg(F.count(F.lit(1)).alias("n"), F.sum("occurrences").alias("pairs")).first()
        assert (total.n, total.pairs) == (n - 1, n * (n - 1) // 2)
        return out

    sizes(500)
    plan = final_plan(sizes(4000))
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") <= 10


def test_twins_count_all_pairs_in_linear_rows(hot):
    rows = twins(hot.withColumn("name", F.lit("x")), ["k"], "id", "name")
    sizes = Counter(r.k for r in hot.select("k").collect())
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("occurrences").alias("pairs")).first()
    assert total.n == sum(n - 1 for n in sizes.values())
    assert total.pairs == sum(n * (n - 1) // 2 for n in sizes.values())


def test_running_values_over_many_ranges(small):
    df = small.range(0, 5000).select(
        F.lit("a").alias("k"), ((F.col("id") * 7919) % 5000).alias("o"), (F.col("id") % 13).alias("v")
    )
    rows = sorted(df.collect(), key=lambda r: r.o)
    out = {r.o: r.before for r in running_before(df, ["k"], "o", "v", "before", "sum", 64).collect()}
    total = 0
    for r in rows:
        assert out[r.o] == total
        total += r.v


def test_inversions_against_brute_force(small):
    df = small.range(0, 400).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("k"),
        ((F.col("id") * 37) % 101).alias("seq"), ((F.col("id") * 53) % 17).alias("v"),
    )
    rows = df.collect()
    want = Counter()
    for a in rows:
        for b in rows:
            if a.k == b.k and a.seq < b.seq and a.v > b.v:
                want[(b.k, b.seq, b.v)] += 1
    got = {(r.k, r.seq, r.value): r.occurrences for r in inversions(df, "k", "seq", "v").collect()}
    assert got == dict(want)


def test_inversions_of_small_groups_need_no_bits(small):
    df = small.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60).alias("k"),
        ((F.col("id") * 37) % 23).alias("seq"), F.when(F.col("id") % 29 > 0, (F.col("id") * 53) % 17).alias("v"),
    )
    both = [sorted(map(tuple, inversions(df.unionAll(df), "k", "seq", "v", limit).collect())) for limit in (0, 40, 5000)]
    assert both[0] and both[0] == both[1] == both[2]


def test_ids_are_consecutive_unique_and_stable(hot):
    out = assign_ids(hot, ["k", "id"], 100, "n").select("k", "id", "n")
    again = assign_ids(hot.repartition(7), ["k", "id"], 100, "n").select("k", "id", "n")
    numbers = sorted(r.n for r in out.collect())
    assert numbers == list(range(101, 101 + ROWS))
    assert out.exceptAll(again).count() == 0


def test_common_suffix(hot):
    links = hot.select(F.concat("payload", F.when(F.col("k") == 0, ".tap").otherwise(".xyz")).alias("link"))
    known = hot.sparkSession.createDataFrame([(".tap",), (".tar.gz",)], "ext string")
    assert without_suffix(links, "link", known, "ext").count() == hot.where("k <> 0").count()


def test_segmented_text_of_a_hot_group(spark):
    """A third of all pieces in one group, places far apart, ties and NULLs; segments of bounded size, none lost."""
    rows = [("hot", i * 70_001 % 1_000_003, f"piece {i % 97}") for i in range(3000)]
    rows += [("hot", None, "first"), ("tied", 5, "é"), ("tied", 5, "b"), ("tied", 5, "b"), ("tied", None, None), (None, 1, "no key")]
    rows += [(f"k{i % 900}", i, "x" * (i % 40)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, o long, t string")
    segments = groups.segmented_text(df, ["k"], "o", "t", "; ", 100)
    found = segments.collect()
    whole = {r.k: r.whole for r in groups.whole_text(segments, ["k"], "whole", "; ").collect()}
    expected = {}
    for k, o, t in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode())):
        expected.setdefault(k, []).append(t)
    assert whole == {k: "; ".join(own) for k, own in expected.items()}
    longest = max(len(t.encode()) for _, _, t in rows if t)
    assert max(len(r.text.encode()) for r in found) <= 100 + longest and len([r for r in found if r.k == "hot"]) > 250
    assert groups.segmented_text(df.limit(0), ["k"], "o", "t").count() == 0


def test_short_orders_take_one_window(spark):
    """The levels follow the values of the order, not its type."""
    df = spark.range(1000).selectExpr("id % 5 as k", "id % 7 as o", "id as v")
    assert running_before(df, ["k"], "o", "v", "s")._jdf.queryExecution().executedPlan().toString().count("Window") == 1
    wide = df.withColumn("o", F.when(F.col("o") == 0, -(1 << 62)).when(F.col("o") == 6, 1 << 62).otherwise(F.col("o")))
    sums = lambda d: sorted((r.k, r.v, r.s) for r in running_before(d, ["k"], "o", "v", "s").collect())
    assert sums(df) == sums(wide)


def test_prefix_counts_by_ranks(spark):
    """A stem that a third of all names begin with, repeated names, empty and non-ASCII stems, against brute force."""
    names = [f"Widget {i % 500}" for i in range(2000)] + ["Widget"] * 3 + [f"x{i:05d}" for i in range(4000)]
    names += ["", None, "é", "éa", "e", "日本", "日本語", "x0000\U0010ffff", "x0000\U0010ffff!"]
    stems = ["Widget", "Widget 1", "x0", "x0000", "", "é", "日", "日本", "nothing", None, "Widget", "x00001x", "\U0010ffff", "x0000\U0010ffff"]
    n = spark.createDataFrame([(t,) for t in names], "name string")
    s = spark.createDataFrame([(t,) for t in stems], "stem string")
    got = {r._key: r._hits for r in membership.prefix_counts(n, "name", s, "stem").collect()}
    assert got == {t: sum(m is not None and m.startswith(t) for m in names) for t in set(stems) if t is not None}
