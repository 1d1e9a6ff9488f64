"""Links to maps from a delimited list; replaces all web links of one site."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...operators.changes import replace_slice
from ...operators.membership import among
from ...sources.text_files import LINE_ORDER, read_delimited

# Layout and charset of the list, root of the links, site and language.
COLUMNS = (
    "title", "file_image", "file_res", "file_size", "file_type", "file_date", "comments", "file_text",
    "none1", "file_zip", "numb", "author", "id", "genre", "none2",
)
ENCODING = "ISO-8859-2"
ROOT = "http://maps.speccy.cz/map.php?id="
SITE, LANGUAGE = 6, "en"


def read_map_list(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, COLUMNS, ";", ENCODING).drop(*LINE_ORDER)


def unclean_ids(maps: DataFrame) -> DataFrame:
    """Rows whose entry number is not a whole number; they are reported, not guessed at."""
    return maps.where((F.col("id") != "") & F.col("id").try_cast("int").isNull())


def map_links(maps: DataFrame, entries: DataFrame) -> DataFrame:
    """One link per entry and picture. The picture's extension is cut by length in bytes."""
    numbered = maps.select(F.col("id").try_cast("int").alias("entry_id"), "file_image").where("entry_id is not null")
    known = among(numbered, "entry_id", entries, "id", unique=True).distinct()
    name = F.left("file_image", F.octet_length("file_image") - 4)
    return known.select(
        "entry_id", F.concat(F.lit(ROOT), name).alias("link"), F.lit(SITE).alias("website_id"),
        F.lit(LANGUAGE).alias("language_id"),
    )


def import_map_links(maps: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """New version of ``webrefs``."""
    return replace_slice(t["webrefs"], map_links(maps, t["entries"]), "website_id", SITE)
