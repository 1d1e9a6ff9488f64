"""Refreshed indexes against indexes built anew, table by table, on hand-written rows."""

from __future__ import annotations

import pytest
from handmade import Handmade, rows
from test_search import LABELS, ORIGINS

from shelfmark.plans import refresh, search

BASE = ORIGINS | dict(
    aliases=rows("entry_id release_seq title", (2, 0, "Second II"), (6, 0, "Sixth")),
    authors=rows("entry_id author_seq label_id team_id", (2, 1, 1, 3), (6, 1, 2, None)),
)
# One table's earlier version at a time: rows that came, rows that went, rows that were edited.
EARLIER = {
    "labels": LABELS[1:-1] + rows("id name labeltype_id owner_id from_id", (6, "Zoé", None, 1, None), (7, "Gone", "+", 2, 3)),
    "entries": rows("id title genretype_id issue_id", (1, "Tape I", 81, 2), (2, "Game", 81, 1), (3, "Book", 20, None), (4, "Pack", 81, 1), (11, "New", 81, 1)),
    "issues": rows("id magazine_id number date_year date_month", (1, 1, 7, 1985, None), (3, 1, 9, 1986, 1)),
    "releases": rows("entry_id release_seq release_year", (1, 0, 1985), (4, 0, 1985), (6, 0, 1999), (7, 1, 1986)),
    "booktypeins": rows("entry_id book_id is_original", (2, 3, 0), (9, 3, 1)),
    "magrefs": rows("id issue_id entry_id is_original", (1, 2, 2, 1), (2, 2, 8, 0), (5, 1, 10, 1)),
    "contents": rows("container_id prog_seq entry_id is_original label_id alias", (1, 1, 9, 0, None, "Nine II"), (4, 2, 10, 1, 2, None), (4, 5, 2, 1, None, None)),
    "publishers": rows("entry_id release_seq publisher_seq label_id", (4, 0, 1, 1), (4, 1, 1, 2), (6, 0, 1, 5), (3, 0, 1, 4)),
    "aliases": rows("entry_id release_seq title", (2, 0, "Other IV"), (3, 0, "Third")),
    "authors": rows("entry_id author_seq label_id team_id", (2, 1, 1, 5), (3, 1, 4, None)),
}


def held(df):
    return sorted(map(str, df.collect()))


# The indexes that join a table to others, by table; "all" changes every table at once.
CONCERNED = {
    "labels": ("author_relations", "publisher_relations", "publisher_lists"), "entries": ("titles", "origins"), "issues": ("origins",),
    "releases": ("origins",), "booktypeins": ("origins", "publisher_lists"), "magrefs": ("origins",),
    "contents": ("publisher_credits", "origins", "publisher_lists"), "publishers": ("publisher_credits", "publisher_lists"),
    "all": tuple(search.INDEXES),
}


@pytest.fixture(scope="module")
def anew(spark):
    return {name: held(build(Handmade(spark, **BASE))) for name, build in search.INDEXES.items()}


@pytest.mark.parametrize("table", CONCERNED)
def test_refresh_is_a_rebuild(spark, anew, table):
    tables = EARLIER if table == "all" else {table: EARLIER[table]}
    old, new = Handmade(spark, **(BASE | tables)), Handmade(spark, **BASE)
    delta = {name: refresh.table_delta(old[name], new[name]) for name in tables}
    for name in CONCERNED[table]:
        stale = {n: search.INDEXES[n](old) for n in {name, "origins"}}
        assert held(refresh.refreshed(name, stale, new, delta)) == anew[name], name


def test_no_change_leaves_an_index(spark, anew):
    t = Handmade(spark, **BASE)
    stale = {"origins": search.origins(t)}
    assert held(refresh.refreshed("origins", stale, t, {})) == anew["origins"]


def test_delta_holds_both_versions(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (3, "c")], "id int, x string")
    new = spark.createDataFrame([(1, "b"), (2, None), (3, "c")], "id int, x string")
    assert sorted(tuple(r) for r in refresh.table_delta(old, new).collect()) == [(1, "a"), (1, "b"), (3, "c")]


def test_changed_rows_are_found_once(spark):
    """A delta is read by several steps and a list's pieces are too: both are written, those not asked for are not made."""
    t, before = Handmade(spark, **BASE), Handmade(spark, **(BASE | {"labels": EARLIER["labels"]}))
    delta = refresh.deltas(before, t)
    assert set(delta) == set(refresh.SOURCES) and "labels" in delta and "notes" not in delta
    for _ in range(2):
        plan = delta["labels"]._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "Aggregate" not in plan
    assert held(delta["labels"]) == held(refresh.table_delta(before["labels"], t["labels"]))
    with pytest.raises(KeyError):
        delta["notes"]
    plan = search.publisher_lists(t)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "Scan parquet" in plan
