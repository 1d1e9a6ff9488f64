"""Rules on downloads, files, archived files and web links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.text import last_segment
from ...operators.membership import without_suffix
from .registry import Tables, base, finding, row_rule, rule, titled

# Path roots and file kinds.
LATER_ARCHIVE = "/zxdb/"
ENTRY_FOLDER = "/zxdb/sinclair/entries"
OLD_ARCHIVE = "/pub/sinclair/"
ARCHIVE_HOST = "/archive.org/"
ARCHIVE_DOWNLOADS = "https://archive.org/download/"
LOADING, RUNNING, OPENING = 1, 2, 3
SOURCE_CODE_TYPES = (32, 71)
UNSORTED_FOLDERS = ("books-pics/", "games-", "hardware-", "slt/", "technical-", "zx81/")


@base("downloads")
def downloads_base(t: Tables) -> DataFrame:
    genres = t["genretypes"].select(F.col("id").alias("genretype_id"), F.col("text").alias("genre"))
    entries = t["entries"].select(
        F.col("id").alias("entry_id"), "title", "genretype_id", "availabletype_id",
        F.col("machinetype_id").alias("entry_machine"),
    )
    return t["downloads"].join(entries, "entry_id").join(genres, "genretype_id", "left")


@base("scraps")
def scraps_base(t: Tables) -> DataFrame:
    scraps = t["scraps"].select(F.col("entry_id").alias("of"), "file_link")
    entries = t["entries"].select(F.col("id").alias("entry_id"), "title")
    return scraps.join(entries, scraps["of"] == entries["entry_id"], "left")


@base("files")
def files_base(t: Tables) -> DataFrame:
    return t["files"].select(
        F.lit(None).cast("long").alias("entry_id"), F.lit(None).cast("string").alias("title"),
        "file_link", "label_id", "issue_id", "tool_id",
    )


def link() -> Column:
    return F.col("file_link")


def _type(*types: int) -> Column:
    return F.col("filetype_id").isin(*types)


def _early_machine() -> Column:
    return F.coalesce("machinetype_id", "entry_machine").between(18, 24)


@row_rule("bad_archive_link", "invalid archive.org link in downloads", "downloads", link)
def _() -> Column:
    return link().contains(ARCHIVE_HOST) & ~link().startswith(ARCHIVE_DOWNLOADS)


@row_rule("source_code_filetype", "source code with incorrect filetype", "downloads", link)
def _() -> Column:
    return link().contains("SourceCode") & ~_type(*SOURCE_CODE_TYPES)


@row_rule("zx81_border", "ZX80/ZX81 cannot have non-white border", "downloads", link)
def _() -> Column:
    return _early_machine() & _type(LOADING, RUNNING, OPENING) & (F.col("scr_border") != 7)


@row_rule("zx81_loading_screen", "ZX80/ZX81 cannot have loading screen", "downloads", link)
def _() -> Column:
    return _early_machine() & _type(LOADING) & ~F.col("entry_id").isin(31929)


@row_rule("loading_screen_name", "loading screen does not follow filename convention", "downloads", link)
def _() -> Column:
    later = link().startswith(LATER_ARCHIVE) & (F.col("entry_id") > 30407)
    return _type(LOADING) & later & ~link().contains("-load-")


@row_rule("running_screen_name", "running screen does not follow filename convention", "downloads", link)
def _() -> Column:
    later = link().startswith(LATER_ARCHIVE) & (F.col("entry_id") > 30000) & ~F.col("entry_id").isin(37752)
    return _type(RUNNING) & later & ~link().contains("-run-")


@row_rule("opening_screen_name", "opening screen does not follow filename convention", "downloads", link)
def _() -> Column:
    dashed = link().startswith(LATER_ARCHIVE) & link().contains("-")
    return _type(OPENING) & dashed & ~link().contains("-open-")


@row_rule("wrong_directory", "file located in wrong directory", "downloads", link)
def _() -> Column:
    folder = F.lpad(F.col("entry_id").cast("string"), 7, "0")
    return link().startswith(ENTRY_FOLDER) & ~link().contains(folder)


@row_rule("unmarked_demo", "** probably demo version not marked as demo", "downloads", link)
def _() -> Column:
    named = F.lower(link()).contains("(demo") & ~F.col("genre").contains("Demo")
    return named & (F.col("is_demo") == 0) & _type(8, 9, 10, 11)


@row_rule("suspect_release_seq", "** possibly file with incorrect release_seq", "downloads", link)
def _() -> Column:
    numbered = F.col("entry_id").between(2_000_000, 3_000_000) & ~F.col("entry_id").isin(2000113)
    return numbered & link().contains(")") & (F.col("release_seq") == 0)


@row_rule("never_released_playable", "playable file from never released title", "downloads", link)
def _() -> Column:
    return (F.col("availabletype_id") == "N") & _type(8, 10, 11) & (F.col("is_demo") == 0)


@row_rule("itch_link_in_downloads", "itch.io links must be moved to webrefs", "downloads", link)
def _() -> Column:
    return _type(0) & link().contains("itch.io")


@row_rule("archived_non_historical", "** archived non-historical file", "scraps", link)
def _() -> Column:
    return link().startswith(LATER_ARCHIVE)


@row_rule("unidentified_file", '** file to be identified and moved to table "downloads"', "files", link)
def _() -> Column:
    unsorted = F.lit(False)
    for folder in UNSORTED_FOLDERS:
        unsorted |= link().startswith(OLD_ARCHIVE + folder)
    return F.coalesce("label_id", "issue_id", "tool_id").isNull() & unsorted


@rule("unknown_extension", "unknown file extension")
def _(t: Tables) -> DataFrame:
    # "_" in the last pattern is any one character, as in every LIKE pattern.
    expected = link().startswith("http") | link().endswith(".zip") | link().startswith(OLD_ARCHIVE)
    odd = t["downloads"].where(~expected & ~link().like("%_SourceCode.tar.bz2"))
    rows = without_suffix(odd.select("entry_id", "file_link"), "file_link", t["extensions"], "ext")
    return finding(titled(rows, t, "entry_id"), "entry", "title", "file_link")


@rule("archived_in_use", "archived file in use")
def _(t: Tables) -> DataFrame:
    def uses(name: str, out: str) -> DataFrame:
        return t[name].where("file_link is not null").groupBy("file_link").agg(F.count(F.lit(1)).alias(out))

    both = uses("scraps", "n").join(uses("downloads", "m"), "file_link")
    return finding(both, None, None, "file_link", F.col("n") * F.col("m"))


@rule("duplicate_filename", "** duplicated filename (to be avoided if possible)")
def _(t: Tables) -> DataFrame:
    tapes = link().endswith(".tap.zip") | link().endswith(".tzx.zip")
    named = t["downloads"].where(link().startswith(ENTRY_FOLDER + "/") & tapes)
    repeated = named.groupBy(last_segment("file_link").alias("name")).agg(F.count("id").alias("n")).where("n > 1")
    return finding(repeated, None, None, F.concat(F.lit(ENTRY_FOLDER + "/.../"), F.col("name")))


@rule("link_host_mismatch", "mismatch between magazine reference link and host")
def _(t: Tables) -> DataFrame:
    hosts = t["hosts"].select(F.col("id").alias("host_id"), F.col("link").alias("root"))
    odd = t["magreflinks"].join(hosts, "host_id").where(~F.col("link").startswith(F.col("root")))
    return finding(odd, None, None, F.concat(F.col("magref_id").cast("string"), F.lit(" - "), F.col("link")))


@rule("web_link_mismatch", "mismatching web link")
def _(t: Tables) -> DataFrame:
    sites = t["websites"].select(F.col("id").alias("website_id"), F.col("link").alias("root"))
    site, url = F.col("website_id"), F.col("link")
    # Sites that may also live under other addresses.
    fits = (
        url.startswith(F.col("root"))
        | ((site == 10) & url.like("https://%.wikipedia.org/wiki/%"))
        | (site.isin(16, 19, 36, 37) & url.startswith("https://youtu.be/"))
        | (site.isin(16, 19) & url.startswith("https://www.youtube.com/"))
        | ((site == 31) & url.like("https://%.itch.io/%"))
    )
    odd = t["webrefs"].join(sites, "website_id").where(~fits)
    return finding(titled(odd.select("entry_id", "link"), t, "entry_id"), "entry", "title", "link")
