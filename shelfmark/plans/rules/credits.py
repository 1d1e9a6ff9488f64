"""Rules on labels: authors, teams, publishers, licences and owners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...operators.closure import PEOPLE
from ...operators.groups import twins
from ...operators.membership import absent, lonely_prefixes
from ...operators.sequences import sequence_gaps
from .registry import Tables, finding, rule, titled

PERSON, NICKNAME = PEOPLE


def _labels(t: Tables, prefix: str, *columns: str) -> DataFrame:
    return t["labels"].select(F.col("id").alias(f"{prefix}_id"), *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def _slashed(first: str, second: str) -> Column:
    return F.concat(F.col(first), F.lit(" / "), F.col(second))


@rule("author_seq_gap", "skipped author sequence in authors")
def _(t: Tables) -> DataFrame:
    gaps = sequence_gaps(t["authors"], ["entry_id"], "author_seq", 1)
    return finding(titled(gaps, t, "entry_id"), "entry", "title", F.col("author_seq") - 1, "occurrences")


@rule("publisher_seq_gap", "skipped publisher sequence in publishers")
def _(t: Tables) -> DataFrame:
    gaps = sequence_gaps(t["publishers"], ["entry_id", "release_seq"], "publisher_seq", 1)
    return finding(titled(gaps, t, "entry_id"), "entry", "title", F.col("publisher_seq") - 1, "occurrences")


@rule("label_index_unneeded", "** possibly unnecessary index in unique label name")
def _(t: Tables) -> DataFrame:
    indexed = F.col("name").like("% [%]")
    named = t["labels"].withColumn("stem", F.when(indexed, F.trim(F.substring_index("name", "[", 1))))
    return finding(lonely_prefixes(named.select("id", "name", "stem"), "id", "name", "stem"), None, None, "name")


def _team_credits(t: Tables, team_test: Column | None, member_test: Column | None) -> DataFrame:
    teams = _labels(t, "team", "name", "labeltype_id")
    members = _labels(t, "label", "name", "labeltype_id")
    if team_test is not None:
        teams = teams.where(team_test)
    if member_test is not None:
        members = members.where(member_test)
    credits = t["authors"].where("team_id is not null").select("entry_id", "label_id", "team_id")
    rows = credits.join(teams, "team_id").join(members, "label_id")
    return finding(titled(rows, t, "entry_id"), "entry", "title", _slashed("label_name", "team_name"))


@rule("team_not_company", "author's team must be a company")
def _(t: Tables) -> DataFrame:
    kind = F.col("team_labeltype_id")
    return _team_credits(t, kind.isin(*PEOPLE) | kind.isNull(), None)


@rule("team_member_not_person", "** team member must be a person")
def _(t: Tables) -> DataFrame:
    return _team_credits(t, None, ~F.col("label_labeltype_id").isin(*PEOPLE))


@rule("people_license_owned", 'license of "people" must not have owner')
def _(t: Tables) -> DataFrame:
    people = t["licenses"].where("licensetype_id = '-'").select(F.col("id").alias("license_id"), "name")
    owned = t["licensors"].join(people, "license_id").join(_labels(t, "label", "name"), "label_id")
    return finding(owned, None, None, _slashed("name", "label_name"))


@rule("nickname_owner_not_person", "nickname must be owned by person")
def _(t: Tables) -> DataFrame:
    nicknames = t["labels"].where(F.col("labeltype_id") == NICKNAME).select("name", "owner_id")
    owners = _labels(t, "owner", "name", "labeltype_id").where(F.col("owner_labeltype_id") != PERSON)
    return finding(nicknames.join(owners, "owner_id"), None, None, _slashed("name", "owner_name"))


@rule("author_credited_twice", "same author credited twice")
def _(t: Tables) -> DataFrame:
    # Entries known to be right.
    credits = (
        t["authors"].where(~F.col("entry_id").isin(4448, 15020))
        .groupBy("entry_id", "label_id").agg(F.count(F.lit(1)).alias("n"))
        .join(_labels(t, "label", "name", "labeltype_id", "owner_id"), "label_id")
    )
    owners = credits.select("entry_id", F.col("label_id").alias("label_owner_id"),
                            F.col("label_name").alias("owner_name"), F.col("n").alias("m"))
    with_owner = credits.join(owners, ["entry_id", "label_owner_id"]).select(
        "entry_id", _slashed("owner_name", "label_name").alias("details"), (F.col("n") * F.col("m")).alias("occurrences")
    )
    nicknames = credits.where((F.col("label_labeltype_id") == NICKNAME) & F.col("label_owner_id").isNotNull())
    siblings = twins(nicknames, ["entry_id", "label_owner_id"], "label_id", "label_name", "n")
    # A nickname that owns itself and its siblings is already reported as their owner.
    distinct = siblings.where("label_id <> label_owner_id")
    both = with_owner.unionByName(distinct.select(
        "entry_id", _slashed("label_name", "first.name").alias("details"), "occurrences"
    ))
    return finding(titled(both, t, "entry_id"), "entry", "title", "details", "occurrences")


@rule("empty_license", "license without any entries")
def _(t: Tables) -> DataFrame:
    unused = absent(t["licenses"], "id", t["relatedlicenses"], "license_id")
    details = F.concat(F.lit("License: "), F.col("name"), F.lit(" ("), F.col("id").cast("string"), F.lit(")"))
    return finding(unused, None, None, details)
