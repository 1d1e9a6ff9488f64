"""Reconciliation of file listings with the files the catalogue knows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators.changes import update_from
from ...operators.membership import absent
from ...sources.text_files import drop_edges, first_loaded, read_delimited, read_fixed_width

Tables = Mapping[str, DataFrame]

# Charset, tables with files, archive roots, layout of the mirror listing.
ENCODING = "ISO-8859-2"
FILE_TABLES = ("downloads", "files", "scraps")
LATER_ARCHIVE, OLD_ARCHIVE = "/zxdb/", "/pub/"
MIRROR_CUTS = {"file_size": (1, 11), "file_date": (12, 11), "file_time": (23, 6), "file_link": (29, None)}
MIRROR_ROOT = "World of Spectrum June 2017 Mirror/"
MIRROR_HEADER, MIRROR_FOOTER = 3, 2
TOLERATED = (
    "unavailable (distribution denied)",
    "broken link at www.worldofspectrum.org",
    "missing file at archive.org mirror replaced by fixed version",
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file_size, file_link, file_md5)``; the digest field carries a tail that is cut off."""
    rows = read_delimited(spark, path, ("file_size", "file_link", "file_md5"), "\t", ENCODING)
    typed = rows.withColumn("file_size", F.col("file_size").try_cast("bigint")).withColumn(
        "file_md5", F.left("file_md5", F.lit(32))
    )
    return first_loaded(typed, "file_link")


def read_mirror(spark: SparkSession, path: str) -> DataFrame:
    """``(file_size, file_date, file_time, file_link)`` of a fixed-width listing, links under the old archive."""
    rows = drop_edges(read_fixed_width(spark, path, MIRROR_CUTS, ENCODING), MIRROR_HEADER, MIRROR_FOOTER)
    linked = rows.withColumn("file_size", F.col("file_size").try_cast("bigint")).withColumn(
        "file_link", F.replace("file_link", F.lit(MIRROR_ROOT), F.lit(OLD_ARCHIVE))
    )
    return first_loaded(linked, "file_link")


def malformed_sizes(spark: SparkSession, path: str, mirror: bool = False) -> DataFrame:
    """Report: ``(file_size, file_link)`` as texts of the listed files whose size is no number."""
    if mirror:
        rows = drop_edges(read_fixed_width(spark, path, MIRROR_CUTS, ENCODING), MIRROR_HEADER, MIRROR_FOOTER)
    else:
        rows = read_delimited(spark, path, ("file_size", "file_link"), "\t", ENCODING)
    return rows.where(F.col("file_size").try_cast("bigint").isNull() & F.col("file_link").isNotNull()).select("file_size", "file_link")


def unknown_files(listing: DataFrame, t: Tables) -> DataFrame:
    """Listed files that no table knows: one anti-join against the union of all known links."""
    known = reduce(DataFrame.unionByName, [t[name].select("file_link") for name in FILE_TABLES])
    return absent(listing, "file_link", known, "file_link")


def unknown_mirror_files(listing: DataFrame, t: Tables) -> DataFrame:
    """As :func:`unknown_files`, without magazines and folders."""
    return unknown_files(listing, t).where(
        "file_link not like '/pub/sinclair/magazines/%' and file_link not like '/pub/sinclair/%/'"
    )


def missing_files(table: DataFrame, listing: DataFrame, root: str = LATER_ARCHIVE) -> DataFrame:
    """Rows of a table under ``root`` whose file is not listed."""
    return absent(table.where(F.col("file_link").startswith(root)), "file_link", listing, "file_link", unique=True)


def missing_mirror_scraps(scraps: DataFrame, listing: DataFrame) -> DataFrame:
    """Archived rows missing in the mirror, unless for a tolerated reason; an unknown reason is let pass too."""
    return missing_files(scraps, listing, OLD_ARCHIVE).where(~F.col("rationale").isin(*TOLERATED))


def enriched(table: DataFrame, listing: DataFrame, digest: bool = True) -> DataFrame:
    """New version of a table with size and digest of its listed files under the later archive.

    A malformed size leaves the stored one as it is.
    """
    values = {"file_size": "file_size"} | ({"file_md5": "file_md5"} if digest else {})
    return update_from(table, listing, ["file_link"], values, F.col("file_link").startswith(LATER_ARCHIVE), unique=True, kept=("file_size",))
