from __future__ import annotations

import re

import pytest
from handmade import Handmade, rows

from shelfmark.fixtures.derived import DerivedCatalogue
from shelfmark.plans import grams, search


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_titles_hold_variants_aliases_and_contents(spark):
    t = Handmade(
        spark, entries=rows("id title", (1, "Elite II"), (2, "Zap! [SAM]"), (3, "zap")),
        aliases=rows("entry_id release_seq title", (1, 0, "Elite V"), (1, 1, "Elite 2")),
        contents=rows("container_id prog_seq entry_id alias", (9, 1, 2, "Boom II"), (9, 2, None, "Gone"), (9, 3, 3, None)),
    )
    assert pairs(search.titles(t)) == [
        ("boomii", 2), ("elite2", 1), ("elite5", 1), ("eliteii", 1), ("elitev", 1), ("zap", 2), ("zap", 3)]


LABELS = rows("id name labeltype_id owner_id from_id", (1, "Ann", "+", None, None), (2, "Axe", "-", 1, None), (3, "Corp", "C", None, None),
              (4, "New Corp", "C", None, 3), (5, "Team", None, 3, None), (6, "Über Zoé", "+", None, 2))


def test_author_closure_is_one_hop_up_and_down_to_people(spark):
    t = Handmade(spark, labels=LABELS, authors=rows("entry_id author_seq label_id team_id", (10, 1, 2, None), (11, 1, 1, 3), (12, 1, 99, None)))
    assert pairs(search.authors(t)) == [
        (1, 10), (1, 11), (2, 10), (2, 11), (3, 11), (5, 11), (6, 10), (99, 12)]


def test_publishers_inherit_from_the_original_container(spark):
    t = Handmade(
        spark, labels=LABELS, publishers=rows("entry_id release_seq publisher_seq label_id", (20, 0, 1, 3), (20, 1, 1, 1)),
        contents=rows("container_id prog_seq entry_id is_original label_id", (20, 1, 30, 1, None), (20, 2, 31, 0, 6), (20, 3, None, 1, None)),
    )
    own = {(3, 20), (5, 20), (1, 20), (2, 20), (6, 20)}
    assert set(pairs(search.publishers(t))) == own | {(3, 30), (5, 30)}


ORIGINS = dict(
    labels=LABELS, magazines=rows("id name", (1, "Mag")),
    issues=rows("id magazine_id number date_year date_month", (1, 1, 5, 1984, 2), (2, 1, 6, 1984, 3)),
    entries=rows("id title genretype_id issue_id", (1, "Tape", 81, 1), (2, "Game", 1, None), (3, "Book", 20, None), (4, "Pack", 80, None),
                 (5, "E-mag", 82, None), (6, "Prog", 1, None), (7, "Loose tape", 81, None), (8, "G8", 1, None), (9, "G9", 1, None), (10, "G10", 1, None)),
    releases=rows("entry_id release_seq release_year", (1, 0, 1984), (3, 0, 1983), (4, 0, 1985), (5, 0, 1990), (6, 0, None), (7, 0, 1986)),
    booktypeins=rows("entry_id book_id is_original", (2, 3, 1), (8, 3, 0)),
    magrefs=rows("id issue_id entry_id is_original", (1, 2, 2, 1), (2, 2, 8, 1), (3, 1, 8, 1), (4, 1, 9, 0)),
    contents=rows("container_id prog_seq entry_id is_original", (1, 1, 9, 1), (4, 1, 9, 1), (4, 2, 10, 1), (5, 1, 10, 1), (6, 1, 4, 1), (7, 1, 5, 1), (4, 3, 6, 0)),
    publishers=rows("entry_id release_seq publisher_seq label_id", (4, 0, 2, 1), (4, 0, 1, 3), (4, 1, 1, 2), (3, 0, 1, 4)),
)


def test_origins_follow_the_cascade(spark):
    found = {r.entry_id: r for r in search.origins_with_publication(Handmade(spark, **ORIGINS)).collect()}
    kinds = {e: (r.origintype_id, r.container_id, r.issue_id, r.date_year) for e, r in found.items()}
    assert kinds == {
        1: ("C", None, 1, 1984), 2: ("B", 3, None, 1983), 8: ("M", None, 1, 1984), 9: ("T", 1, 1, 1984),
        10: ("A", 4, None, 1985), 4: ("P", 6, None, None), 5: ("T", 7, None, 1986),
    }
    assert found[1].publication == "Mag - covertape from magazine issue #5 - 1984/Feb"
    assert found[2].publication == 'New Corp - type-in from book "Book"'
    assert found[8].publication == "Mag - type-in from magazine issue #5 - 1984/Feb"
    assert found[9].publication == 'Mag - within covertape "Tape"'
    assert found[10].publication == 'Corp, Ann - within compilation "Pack"'
    assert found[4].publication == '? - within program "Prog"'


def test_lookups_ignore_case_and_accents(spark):
    t = Handmade(spark, labels=LABELS, entries=rows("id title", (1, "Élan"), (2, "Plan 9"), (3, "Z")), authors=rows("entry_id author_seq label_id", (3, 1, 6)),
                 publishers=rows("entry_id release_seq publisher_seq label_id", (2, 0, 1, 6)))
    assert [r.title for r in search.find_entries(t, "elan").collect()] == ["Élan"]
    assert [r.id for r in search.find_entries(t, "LAN").collect()] == [2, 1]
    assert [r.name for r in search.find_labels(t, "uberzoe").collect()] == ["Über Zoé"]
    assert [r.id for r in search.find_entries(t, "zoe", "author").collect()] == [3]
    assert [r.id for r in search.find_entries(t, "zoe", "publisher").collect()] == [2]


@pytest.fixture(scope="module")
def catalogue(spark, sf_dir):
    return DerivedCatalogue(spark, sf_dir)


def test_index_properties(catalogue):
    origins = search.origins(catalogue)
    assert origins.count() == origins.select("entry_id").distinct().count()
    seed = catalogue["authors"].selectExpr("cast(label_id as long)", "cast(entry_id as long)")
    assert seed.subtract(search.authors(catalogue)).count() == 0
    titles = search.titles(catalogue)
    assert titles.count() == titles.distinct().count()
    changed = catalogue["aliases"].select("entry_id")
    assert search.refresh_titles(titles, catalogue, changed).exceptAll(titles).count() == 0


NAMES = ["Über Zoé", "uber alles", "Straße 7", "strasse", "a", "ab", "", None, "ＦＵＬＬ width", "tab\there", "zoe", "ZOÉ", "xx yy", "%_\\", "oe ligature œuvre", "日本語 text"]


@pytest.mark.parametrize("word", ["zoe", "ZOÉ", "über", "ab", "a", "%", "_\\", "full", "ss", "œ", "日本", "nowhere", "x y", "her", ""])
def test_grams_find_what_a_scan_finds(spark, gram_folder, word):
    index = spark.createDataFrame(list(enumerate(NAMES)), "label_id long, label_name string").select("label_name", "label_id")
    scanned = sorted(r.label_id for r in search._holding(index, "label_name", word).collect())
    assert sorted(r.label_id for r in search._holding(index, "label_name", word, gram_folder).collect()) == scanned


@pytest.fixture(scope="module")
def gram_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("grams") / "names")
    index = spark.createDataFrame(list(enumerate(NAMES)), "label_id long, label_name string")
    grams.store_grams(index, "label_name", "label_id", folder)
    return folder


def test_a_lookup_reads_its_own_lists(spark, gram_folder):
    """Two buckets at most, and the gram is pushed to the files."""
    plan = grams.holding(spark, gram_folder, "label_name", "strasse")._jdf.queryExecution().toString()
    buckets = sorted({grams.bucket_of(grams.ODD), *(grams.bucket_of(g) for g in ("str", "tra", "ras", "ass", "sse"))})
    (filters,) = set(re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(([\d,]+)\)|$", plan)) - {""} or {""}
    read = sorted(map(int, filters.split(",")))
    assert len(read) == 2 and set(read) <= set(buckets) and "PushedFilters: [In(gram" in plan
