"""Declared tables of the catalogue: columns, types, keys and references.

Schemas are declared, never inferred. One-character codes are strings and compare case-sensitively;
flags are 0/1 bytes; partial dates are three nullable integers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    ddl: str
    key: tuple[str, ...]
    references: dict[str, str] = field(default_factory=dict)
    # Most characters a text may have; longer ones are reported when a dump is loaded, never cut.
    widths: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_DATE = "date_year int, date_month int, date_day int"
_ENTRY = {"entry_id": "entries"}

TABLES: dict[str, Table] = {
    "entries": Table(
        "id int not null, title string not null, library_title string, genretype_id int, machinetype_id int,"
        " issue_id int, availabletype_id string", ("id",),
        {"genretype_id": "genretypes", "machinetype_id": "machinetypes", "issue_id": "issues"}, {"title": 250}),
    "labels": Table(
        "id int not null, name string not null, labeltype_id string, owner_id int, from_id int", ("id",),
        {"owner_id": "labels", "from_id": "labels"}, {"name": 100}),
    "releases": Table(
        "entry_id int not null, release_seq int not null, release_year int, release_month int, release_day int,"
        " currency_id string", ("entry_id", "release_seq"), _ENTRY),
    "authors": Table(
        "entry_id int not null, author_seq int not null, label_id int not null, team_id int",
        ("entry_id", "author_seq"), {**_ENTRY, "label_id": "labels", "team_id": "labels"}),
    "publishers": Table(
        "entry_id int not null, release_seq int not null, publisher_seq int not null, label_id int not null",
        ("entry_id", "release_seq", "publisher_seq"), {**_ENTRY, "label_id": "labels"}),
    "contents": Table(
        "container_id int not null, media_seq int not null, media_side string not null, prog_seq int not null,"
        " entry_id int, label_id int, alias string, is_original tinyint not null",
        ("container_id", "media_seq", "media_side", "prog_seq"),
        {"container_id": "entries", "entry_id": "entries", "label_id": "labels"}),
    "tags": Table("id int not null, name string not null, tagtype_id string not null", ("id",),
                  {"tagtype_id": "tagtypes"}),
    "members": Table("tag_id int not null, entry_id int not null, series_seq int",
                     ("tag_id", "entry_id", "series_seq"), {"tag_id": "tags", **_ENTRY}),
    "magazines": Table("id int not null, name string not null, link_mask string, archive_mask string", ("id",)),
    "issues": Table(
        f"id int not null, magazine_id int not null, number int, volume int, special string, supplement string,"
        f" {_DATE}, parent_id int, cover_page int", ("id",), {"magazine_id": "magazines", "parent_id": "issues"}),
    "magrefs": Table(
        "id int not null, issue_id int not null, page int not null, entry_id int, label_id int, topic_id int,"
        " award_id int, referencetype_id int not null, is_original tinyint not null, review_id int,"
        " score_group string not null", ("id",),
        {"issue_id": "issues", **_ENTRY, "label_id": "labels", "referencetype_id": "referencetypes"}, {"score_group": 100}),
    "magreflinks": Table("magref_id int not null, link string not null, host_id int not null",
                         ("magref_id", "link"), {"magref_id": "magrefs", "host_id": "hosts"}),
    "hosts": Table("id int not null, link string not null", ("id",)),
    "magreffeats": Table("magref_id int not null, feature_id int not null", ("magref_id", "feature_id"),
                         {"magref_id": "magrefs", "feature_id": "features"}),
    "features": Table("id int not null, name string not null", ("id",)),
    "downloads": Table(
        "id int not null, entry_id int not null, file_link string not null, filetype_id int not null,"
        " machinetype_id int, scr_border int, is_demo tinyint not null, release_seq int not null,"
        " file_size int, file_md5 string", ("id",), _ENTRY),
    "files": Table(
        "id int not null, label_id int, issue_id int, tool_id int, file_link string not null, file_size int,"
        " file_md5 string", ("id",), {"label_id": "labels", "issue_id": "issues"}),
    "scraps": Table("id int not null, entry_id int, file_link string, rationale string, file_size int", ("id",),
                    _ENTRY),
    "notes": Table("entry_id int, text string not null", (), _ENTRY),
    "relations": Table("entry_id int not null, original_id int not null, relationtype_id string not null",
                       ("entry_id", "original_id", "relationtype_id"),
                       {**_ENTRY, "original_id": "entries", "relationtype_id": "relationtypes"}),
    "licenses": Table("id int not null, name string not null, licensetype_id string not null", ("id",)),
    "licensors": Table("license_id int not null, label_id int not null", ("license_id", "label_id"),
                       {"license_id": "licenses", "label_id": "labels"}),
    "relatedlicenses": Table("entry_id int not null, license_id int not null", ("entry_id", "license_id"),
                             {**_ENTRY, "license_id": "licenses"}),
    "aliases": Table("entry_id int not null, release_seq int not null, title string not null",
                     ("entry_id", "release_seq", "title"), _ENTRY),
    "booktypeins": Table("entry_id int not null, book_id int not null, is_original tinyint not null",
                         ("entry_id", "book_id"), {**_ENTRY, "book_id": "entries"}),
    "webrefs": Table("entry_id int not null, link string not null, website_id int not null, language_id string",
                     ("entry_id", "link"), {**_ENTRY, "website_id": "websites"}),
    "websites": Table("id int not null, link string not null", ("id",)),
    "ports": Table("entry_id int not null", (), _ENTRY),
    "remakes": Table("entry_id int not null", (), _ENTRY),
    "genretypes": Table("id int not null, text string not null", ("id",)),
    "machinetypes": Table("id int not null, text string not null", ("id",)),
    "tagtypes": Table("id string not null, text string not null", ("id",)),
    "relationtypes": Table("id string not null, text string not null", ("id",)),
    "referencetypes": Table("id int not null, text string not null", ("id",)),
    "extensions": Table("ext string not null", ("ext",)),
    "awards": Table("id int not null, magazine_id int not null", ("id",), {"magazine_id": "magazines"}),
    # Review collection, target side.
    "review_texts": Table(
        "id int not null, review_text string, review_comments string, review_rating string, reviewers string",
        ("id",)),
    "review_scores": Table(
        "magref_id int not null, score_seq int not null, category string, is_overall tinyint not null,"
        " score string, comments string", ("magref_id", "score_seq"), {"magref_id": "magrefs"}),
    "review_captions": Table(
        "magref_id int not null, caption_seq int not null, text string not null, is_banner tinyint not null",
        ("magref_id", "caption_seq", "is_banner"), {"magref_id": "magrefs"}),
    # Review collection, source side (a second database).
    "magazines_src": Table("mag_id int not null, mag_name string not null", ("mag_id",)),
    "issues_src": Table("issue_code int not null, mag_id int not null, issue string", ("issue_code",),
                        {"mag_id": "magazines_src"}),
    "reviewers_src": Table("reviewer_id int not null, mag_id int not null", ("reviewer_id",)),
    "awards_src": Table("award_id int not null, mag_type int not null", ("award_id",)),
    "reviews_src": Table(
        "review_id int not null, game_id int not null, issue_code int not null, review_page string,"
        " review_text string, review_comments string, review_rating string, reviewers string, award_id int,"
        " mag_type int", ("review_id",), {"issue_code": "issues_src"}),
    "scores_src": Table(
        "review_id int not null, header_order int not null, review_header string, review_score string,"
        " score_suffix string, score_text string", ("review_id", "header_order"), {"review_id": "reviews_src"}),
    "compilations_src": Table(
        "score_id int not null, review_id int not null, game_id int not null, header_order int not null,"
        " review_header string, review_score string, score_suffix string", ("score_id",),
        {"review_id": "reviews_src"}),
    "captions_src": Table("id int not null, review_id int not null, caption string, is_banner tinyint not null",
                          ("id",), {"review_id": "reviews_src"}),
}


def require_columns(name: str, df: DataFrame) -> DataFrame:
    """Fail early when a table lacks a declared column."""
    missing = [f.name for f in TABLES[name].schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {name} lacks columns {missing}")
    return df
