"""Rules on entries: identifier ranges, titles, availability, contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...operators.membership import absent, among, among_any, lonely_prefixes
from ...operators.sequences import inversions, sequence_gaps
from .registry import Tables, base, finding, row_rule, rule, titled

# Inclusive identifier ranges of books, hardware and Timex machines.
HARDWARE_IDS = (1_000_000, 1_999_999)
BOOK_IDS = (2_000_000, 2_999_999)
TIMEX_IDS = (4_000_000, 4_999_999)


@base("entries")
def entries_base(t: Tables) -> DataFrame:
    genres = t["genretypes"].select(F.col("id").alias("genretype_id"), F.col("text").alias("genre"))
    machines = t["machinetypes"].select(F.col("id").alias("machinetype_id"), F.col("text").alias("machine"))
    return (
        t["entries"].withColumn("entry_id", F.col("id"))
        .join(genres, "genretype_id", "left").join(machines, "machinetype_id", "left")
    )


def genre():
    return F.col("genre")


def machine():
    return F.col("machine")


def library_title():
    return F.col("library_title")


def _outside(limits: tuple[int, int]) -> Column:
    return ~F.col("entry_id").between(*limits)


def _inside_without(limits: tuple[int, int], column: str, start: str) -> Column:
    return F.col("entry_id").between(*limits) & ~F.coalesce(F.col(column).startswith(start), F.lit(False))


@row_rule("library_title_mismatch", "possible mismatch between title and library title", "entries", library_title)
def _() -> Column:
    same_start = F.left("title", F.lit(4)) == F.left("library_title", F.lit(4))
    return (F.col("title") != F.col("library_title")) & same_start & ~F.col("title").contains("+")


@row_rule("timex_id_range", "timex programs should have ID above 4000000", "entries", machine)
def _() -> Column:
    return machine().startswith("Timex") & _outside(TIMEX_IDS)


@row_rule("book_id_range", "books should have ID above 2000000", "entries", genre)
def _() -> Column:
    return genre().startswith("Book") & _outside(BOOK_IDS)


@row_rule("hardware_id_range", "hardware devices should have ID above 1000000", "entries", genre)
def _() -> Column:
    return genre().startswith("Hardware") & _outside(HARDWARE_IDS)


@row_rule("range_not_timex", "title with ID above 4000000 that is not timex program", "entries", machine)
def _() -> Column:
    return _inside_without(TIMEX_IDS, "machine", "Timex")


@row_rule("range_not_book", "title with ID above 2000000 that is not book", "entries", genre)
def _() -> Column:
    return _inside_without(BOOK_IDS, "genre", "Book")


@row_rule("range_not_hardware", "title with ID above 1000000 that is not hardware device", "entries", genre)
def _() -> Column:
    return _inside_without(HARDWARE_IDS, "genre", "Hardware")


@row_rule("issue_title_unlinked", "** program must be associated with magazine issue", "entries", genre)
def _() -> Column:
    return F.col("title").contains(" issue ") & F.col("issue_id").isNull()


@row_rule("library_title_article", 'library title should not start with article "The"', "entries", library_title)
def _() -> Column:
    return library_title().startswith("The ")


def _plain(df: DataFrame) -> DataFrame:
    return finding(df, "id", "title", None)


def _deprecated(t: Tables) -> DataFrame:
    return t["entries"].where("availabletype_id = '*'")


def _duplicates(t: Tables) -> DataFrame:
    return t["relations"].where("relationtype_id = '*'")


@rule("entry_without_release", "no release number in releases")
def _(t: Tables) -> DataFrame:
    return finding(absent(t["entries"], "id", t["releases"], "entry_id"), "id", "title", F.lit("0"))


@rule("title_index_unneeded", "** possibly unnecessary index in unique entry title")
def _(t: Tables) -> DataFrame:
    indexed = F.col("title").like("% [%]")
    named = t["entries"].withColumn("stem", F.when(indexed, F.trim(F.substring_index("title", "[", 1))))
    return _plain(lonely_prefixes(named.select("id", "title", "stem"), "id", "title", "stem"))


@rule("container_genre", "container that is not compilation, covertape or electronic magazine")
def _(t: Tables) -> DataFrame:
    contents = t["contents"].groupBy("container_id").agg(
        F.max(F.coalesce(F.col("container_id") == F.col("entry_id"), F.lit(False))).alias("itself")
    ).where("not itself")
    plain = entries_base(t).where("genretype_id is null or genretype_id < 80")
    return finding(among(plain, "id", contents, "container_id"), "id", "title", "genre")


@rule("deprecated_with_data", "deprecated entry containing possibly redundant data")
def _(t: Tables) -> DataFrame:
    lists = {
        "aliases": ["entry_id"], "authors": ["entry_id"], "booktypeins": ["entry_id", "book_id"],
        "contents": ["entry_id", "container_id"], "magrefs": ["entry_id"], "members": ["entry_id"],
        "ports": ["entry_id"], "publishers": ["entry_id"], "relatedlicenses": ["entry_id"],
        "relations": ["original_id"], "remakes": ["entry_id"], "webrefs": ["entry_id"],
    }
    sets = [(t[table], column) for table, columns in lists.items() for column in columns]
    sets.append((t["relations"].where("relationtype_id <> '*'"), "entry_id"))
    return _plain(among_any(_deprecated(t), "id", sets))


@rule("deprecated_without_original", "deprecated title without related original title")
def _(t: Tables) -> DataFrame:
    return _plain(absent(_deprecated(t), "id", _duplicates(t), "entry_id"))


@rule("deprecated_as_original", "deprecated title cannot be an original")
def _(t: Tables) -> DataFrame:
    return _plain(among(_deprecated(t), "id", t["relations"], "original_id"))


@rule("duplicate_not_deprecated", "duplicated title not marked as deprecated")
def _(t: Tables) -> DataFrame:
    live = t["entries"].where("availabletype_id is null or availabletype_id <> '*'")
    return _plain(among(live, "id", _duplicates(t), "entry_id"))


@rule("redundant_alias", "redundant alias identical to entry title")
def _(t: Tables) -> DataFrame:
    aliases = t["aliases"].where("release_seq = 0").select("entry_id", F.col("title").alias("alias"))
    entries = t["entries"].select("id", "title")
    return _plain(entries.join(aliases, (entries["id"] == aliases["entry_id"]) & (F.col("alias") == F.col("title"))))


@rule("redundant_contents_alias", "redundant alias in contents")
def _(t: Tables) -> DataFrame:
    contents = t["contents"].where("alias is not null").select("container_id", "entry_id", "alias")
    entries = t["entries"].select("id", "title")
    same = entries.join(contents, (entries["id"] == contents["entry_id"]) & (F.col("alias") == F.col("title")))
    return finding(same, "id", "title", "container_id")


@rule("missing_contents", "** missing list of contents")
def _(t: Tables) -> DataFrame:
    holders = entries_base(t).where("genre is not null and (genretype_id in (80, 81) or genretype_id >= 110)")
    return finding(absent(holders, "id", t["contents"], "container_id"), "id", "title", "genre")


@rule("magazine_entry_genre", "entry linked to magazine must be Covertape or Electronic Magazine")
def _(t: Tables) -> DataFrame:
    # A series of titles and a magazine that are known exceptions.
    odd = entries_base(t).where(
        "(genretype_id is null or genretype_id not in (81, 82)) and title not like 'DigiTape%'"
    )
    issues = t["issues"].where("magazine_id <> 323").select(F.col("id").alias("issue_id"))
    return finding(odd.join(issues, "issue_id"), "entry_id", "title", "genre")


@rule("release_seq_gap", "skipped release number in releases")
def _(t: Tables) -> DataFrame:
    gaps = sequence_gaps(t["releases"], ["entry_id"], "release_seq", 0)
    return finding(titled(gaps, t, "entry_id"), "entry", "title", F.col("release_seq") - 1, "occurrences")


@rule("release_order", "** incorrect release order")
def _(t: Tables) -> DataFrame:
    late = titled(inversions(t["releases"], "entry_id", "release_seq", "release_year"), t, "entry_id")
    details = F.format_string("#%d (%d) and #%d (%d)", "first_seq", "first_value", "seq", "value")
    return finding(late, "entry", "title", details, "occurrences")


@rule("contents_seq_gap", "skipped item in contents")
def _(t: Tables) -> DataFrame:
    gaps = sequence_gaps(t["contents"], ["container_id", "media_seq", "media_side"], "prog_seq", 1)
    dash = F.lit("-")
    details = F.concat(
        F.col("media_seq").cast("string"), dash, F.col("media_side"), dash, (F.col("prog_seq") - 1).cast("string")
    )
    return finding(titled(gaps, t, "container_id"), "entry", "title", details, "occurrences")
