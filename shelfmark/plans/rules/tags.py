"""Rules on tags, series and contests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...operators.groups import same_members
from ...operators.membership import absent, spread
from ...operators.sequences import sequence_gaps
from .registry import Tables, finding, rule, titled

# Names of a yearly contest and of the compilations of its entries.
CONTEST = "CSSCGC Crap Games Contest"
COMPETITION = "CSSCGC Crap Games Competition"


def _numbered(name: str, ident: str) -> Column:
    return F.concat(F.col(name), F.lit(" ("), F.col(ident).cast("string"), F.lit(")"))


def _members(t: Tables) -> DataFrame:
    tags = t["tags"].select(F.col("id").alias("tag_id"), "name", "tagtype_id")
    return t["members"].join(tags, "tag_id")


def _member_findings(rows: DataFrame, t: Tables) -> DataFrame:
    return finding(titled(rows, t, "entry_id", "left"), "entry_id", "title", _numbered("name", "tag_id"))


@rule("series_seq_missing", "missing sequence number in series")
def _(t: Tables) -> DataFrame:
    return _member_findings(_members(t).where("series_seq is null and tagtype_id = 'S'"), t)


def series_gaps(t: Tables, null_aware: bool = True) -> DataFrame:
    """Member rows after a gap. As in ``NOT IN``, one unnumbered member silences its tag by default."""
    gaps = sequence_gaps(t["members"], ["tag_id"], "series_seq", 1)
    if null_aware:
        gaps = absent(gaps, "tag_id", t["members"].where("series_seq is null"), "tag_id")
    hits = gaps.groupBy("tag_id", "series_seq", spread("tag_id", "series_seq")).agg(F.count(F.lit(1))).select("tag_id", "series_seq")
    return _member_findings(_members(t).join(hits, ["tag_id", "series_seq"], "left_semi"), t)


@rule("series_seq_gap", "skipped sequence number in series")
def _(t: Tables) -> DataFrame:
    return series_gaps(t)


@rule("seq_in_non_series", "invalid sequence number in tag that is not series")
def _(t: Tables) -> DataFrame:
    return _member_findings(_members(t).where("series_seq is not null and tagtype_id <> 'S'"), t)


def _typed_tags(t: Tables) -> DataFrame:
    types = t["tagtypes"].select(F.col("id").alias("tagtype_id"), F.col("text").alias("kind"))
    return t["tags"].join(types, "tagtype_id")


def _kind_and_name() -> Column:
    return F.concat(F.col("kind"), F.lit(": "), _numbered("name", "id"))


@rule("empty_tag", "tag without any members")
def _(t: Tables) -> DataFrame:
    return finding(absent(_typed_tags(t), "id", t["members"], "tag_id"), None, None, _kind_and_name())


@rule("single_title_series", "series (or set) with a single title")
def _(t: Tables) -> DataFrame:
    single = t["members"].groupBy("tag_id").agg(
        F.min("entry_id").alias("entry_id"), F.max("entry_id").alias("last"), F.count("entry_id").alias("n")
    ).where("entry_id = last")
    tags = _typed_tags(t).where("tagtype_id in ('S', 'U')")
    rows = titled(single.join(tags, single["tag_id"] == tags["id"]), t, "entry_id")
    return finding(rows, "entry", "title", _kind_and_name(), "n")


@rule("duplicate_tags", "possibly duplicated tags with same elements")
def _(t: Tables) -> DataFrame:
    pairs = same_members(t["tags"], "id", "name", t["members"], "tag_id", "entry_id")
    details = F.concat(_numbered("first.name", "first.id"), F.lit(" x "), _numbered("name", "id"))
    return finding(pairs, None, None, details, "occurrences")


def _contests(t: Tables) -> DataFrame:
    """``(tag_id, tag, compilation)``: contests and the title their compilations bear."""
    tags = t["tags"].where(F.col("name").startswith(CONTEST))
    title = F.concat(F.lit(COMPETITION), F.right("name", F.lit(5)))
    return tags.select(F.col("id").alias("tag_id"), F.col("name").alias("tag"), title.alias("compilation"))


def _competitions(t: Tables) -> DataFrame:
    """``(container_id, compilation, tag)``: compilations and the name their contests bear."""
    entries = t["entries"].where(F.col("title").startswith(COMPETITION))
    name = F.concat(F.lit(CONTEST), F.right("title", F.lit(5)))
    return entries.select(F.col("id").alias("container_id"), F.col("title").alias("compilation"), name.alias("tag"))


def _counted(df: DataFrame, key: list[str], out: str) -> DataFrame:
    return df.groupBy(*key, spread(*key)).agg(F.count(F.lit(1)).alias(out)).drop("_spread")


@rule("contest_title_not_compiled", "** CSSCGC title missing from compilation")
def _(t: Tables) -> DataFrame:
    # Per member and contest: compilations of that title, less those that hold or are the member.
    competitions = _competitions(t).select("container_id", "compilation")
    held = t["contents"].select("container_id", "entry_id").where("entry_id is not null").unionByName(
        competitions.select("container_id", F.col("container_id").alias("entry_id"))
    ).distinct().join(competitions, "container_id")
    members = _counted(t["members"], ["tag_id", "entry_id"], "n").join(_contests(t), "tag_id")
    rows = members.join(_counted(competitions, ["compilation"], "titled"), "compilation").join(
        _counted(held, ["entry_id", "compilation"], "holding"), ["entry_id", "compilation"], "left"
    ).withColumn("lacking", F.col("titled") - F.coalesce("holding", F.lit(0))).where("lacking > 0")
    return finding(titled(rows, t, "entry_id"), "entry", "title", "tag", F.col("n") * F.col("lacking"))


@rule("compiled_title_not_in_contest", "CSSCGC title missing from contest")
def _(t: Tables) -> DataFrame:
    # Per entry and compilation title: contests of that name, less those it takes part in; at least the lack of any.
    contests = _contests(t).select("tag_id", "tag")
    items = t["contents"].select("container_id", "entry_id").where("entry_id is not null").join(
        _competitions(t), "container_id"
    )
    taking_part = t["members"].select("tag_id", "entry_id").distinct().join(contests, "tag_id")
    rows = _counted(items, ["entry_id", "compilation", "tag"], "n").join(
        _counted(contests, ["tag"], "named"), "tag", "left"
    ).join(_counted(taking_part, ["entry_id", "tag"], "joined"), ["entry_id", "tag"], "left")
    lacking = F.when(F.col("named").isNull(), 1).otherwise(F.col("named") - F.coalesce("joined", F.lit(0)))
    rows = rows.withColumn("lacking", lacking).where("lacking > 0")
    return finding(titled(rows, t, "entry_id"), "entry", "title", "compilation", F.col("n") * F.col("lacking"))
