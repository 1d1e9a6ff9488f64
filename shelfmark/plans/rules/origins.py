"""Rules on original publications."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...operators.membership import among, among_any
from .registry import Tables, finding, rule, titled


def _originals(t: Tables, name: str) -> DataFrame:
    return t[name].where("is_original = 1")


@rule("multiple_originals", "multiple original publications")
def _(t: Tables) -> DataFrame:
    # Each list is made distinct on its own, so the lists never multiply each other.
    issues = t["issues"].select(F.col("id").alias("issue_id"), "magazine_id")
    magazines = _originals(t, "magrefs").select("entry_id", "issue_id").join(issues, "issue_id")
    publications = (
        _originals(t, "contents").select("entry_id", F.lit("c").alias("kind"), F.col("container_id").alias("in"))
        .unionByName(magazines.select("entry_id", F.lit("m").alias("kind"), F.col("magazine_id").alias("in")))
        .unionByName(_originals(t, "booktypeins").select("entry_id", F.lit("b").alias("kind"), F.col("book_id").alias("in")))
        .where("entry_id is not null and `in` is not null").distinct()
    )
    several = publications.groupBy("entry_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    details = F.concat(F.col("n").cast("string"), F.lit(" original publications"))
    return finding(titled(several, t, "entry_id"), "entry", "title", details)


def _originally_elsewhere(t: Tables, entries: DataFrame) -> DataFrame:
    sets = [(_originals(t, name), "entry_id") for name in ("contents", "booktypeins", "magrefs")]
    return finding(among_any(entries, "id", sets), "id", "title", None)


def _first_releases(t: Tables, known: str) -> DataFrame:
    releases = t["releases"].where(f"release_seq = 0 and {known} is not null").select(F.col("entry_id").alias("id"))
    return t["entries"].select("id", "title").join(releases, "id")


@rule("original_date_conflict", "** conflicting information about original publication date")
def _(t: Tables) -> DataFrame:
    return _originally_elsewhere(t, _first_releases(t, "release_year"))


@rule("original_publisher_conflict", "** conflicting information about original publisher")
def _(t: Tables) -> DataFrame:
    published = among(t["entries"], "id", t["publishers"].where("release_seq = 0"), "entry_id")
    return _originally_elsewhere(t, published)


@rule("original_price_conflict", "** conflicting information about original price")
def _(t: Tables) -> DataFrame:
    return _originally_elsewhere(t, _first_releases(t, "currency_id"))
