"""Search indexes brought up to date from the rows that changed, without building them anew.

A delta holds by table the rows that came or went since the index was built; an edited row is in it in both
versions. From the delta follow the keys of an index whose rows can differ, by way of the tables the index joins.
Only those keys are computed again, from the rows of each table that bear on them; all other rows of the stored
index are passed on. So the work follows the changes, but for one read of the index and of each table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.groups import SEGMENT
from ..operators.membership import absent, among, among_any, key_set
from ..session import cut_lineage
from . import search

Tables = Mapping[str, DataFrame]

# The tables that some index is built from.
SOURCES = (
    "entries", "aliases", "contents", "labels", "authors", "publishers", "issues", "releases", "booktypeins", "magrefs",
)


def table_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that one version holds more often than the other, once each; a NULL equals a NULL."""
    sides = old.withColumn("_n", F.lit(-1)).unionByName(new.select(*old.columns).withColumn("_n", F.lit(1)))
    return sides.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").drop("_n")


class Deltas(Mapping[str, DataFrame]):
    """:func:`table_delta` of the tables that bear on an index, each found when first asked for and written then."""

    def __init__(self, old: Tables, new: Tables):
        self._old, self._new, self._found = old, new, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SOURCES:
            raise KeyError(name)
        if name not in self._found:
            self._found[name] = cut_lineage(table_delta(self._old[name], self._new[name]), "delta")
        return self._found[name]

    def __contains__(self, name: object) -> bool:
        return name in SOURCES

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


def deltas(old: Tables, new: Tables) -> Deltas:
    """The changed rows by table; an index reads them several times over, but not those of every table."""
    return Deltas(old, new)


def _changed(t: Tables, delta: Tables, name: str) -> DataFrame:
    return delta[name] if name in delta else t[name].where(F.lit(False))


def _keys(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct values of several columns as ``key``."""
    lists = [df.select(F.col(c).cast("long").alias("key")) for df, c in columns]
    return key_set(reduce(DataFrame.unionByName, lists), "key")


def _kept(keys: DataFrame) -> DataFrame:
    """Keys are read several times: they are written once."""
    return cut_lineage(keys, "touched")


def _replaced(index: DataFrame, column: str, touched: DataFrame, fresh: DataFrame) -> DataFrame:
    rest = absent(index, column, touched, "key", unique=True)
    return rest.unionByName(among(fresh, column, touched, "key", unique=True).select(*index.columns))


def _by_own_key(build: Callable[[Tables], DataFrame], table: str, key: str, column: str):
    """Indexes whose rows follow from the rows of one table with one key."""
    def refresh(index: DataFrame, t: Tables, delta: Tables) -> DataFrame:
        touched = _kept(_keys((_changed(t, delta, table), key)))
        return _replaced(index, column, touched, build({table: among(t[table], key, touched, "key", unique=True)}))
    return refresh


def _titles(index: DataFrame, t: Tables, delta: Tables) -> DataFrame:
    touched = _kept(_keys(
        (_changed(t, delta, "entries"), "id"), (_changed(t, delta, "aliases"), "entry_id"), (_changed(t, delta, "contents"), "entry_id"),
    ))
    return search.refresh_titles(index, t, touched.withColumnRenamed("key", "entry_id"))


def _publisher_credits(index: DataFrame, t: Tables, delta: Tables) -> DataFrame:
    """A changed publisher also counts for what its container holds the original of."""
    published, contents = _changed(t, delta, "publishers"), _changed(t, delta, "contents")
    heirs = among(t["contents"], "container_id", published, "entry_id")
    touched = _kept(_keys((published, "entry_id"), (contents, "container_id"), (contents, "entry_id"), (heirs, "entry_id")))
    inside = among(t["contents"], "entry_id", touched, "key", unique=True)
    holding = among(t["contents"], "container_id", touched, "key", unique=True)
    part = {
        "contents": inside.unionByName(holding).distinct(),
        "publishers": among_any(t["publishers"], "entry_id", [(touched, "key"), (inside, "container_id")]),
    }
    return _replaced(index, "entry_id", touched, search.publisher_credits(part))


def _relations(build: Callable[[Tables], DataFrame]):
    """A relation follows from the row of its child, and from whether its parent is listed: either end may have changed."""
    def refresh(index: DataFrame, t: Tables, delta: Tables) -> DataFrame:
        touched = _kept(_keys((_changed(t, delta, "labels"), "id")))
        labels = t["labels"]
        children = [among(labels, c, touched, "key", unique=True) for c in ("id", "from_id", "owner_id")]
        near = reduce(DataFrame.unionByName, children).distinct()
        listed = among_any(labels, "id", [(near, "id"), (near, "from_id"), (near, "owner_id")])
        fresh = build({"labels": listed})
        rest = absent(absent(index, "label_id", touched, "key", unique=True), "related_id", touched, "key", unique=True)
        ends = [among(fresh, c, touched, "key", unique=True) for c in ("label_id", "related_id")]
        return rest.unionByName(ends[0].unionByName(ends[1]).distinct().select(*index.columns))
    return refresh


def _origin_entries(t: Tables, delta: Tables) -> DataFrame:
    """Entries whose first publication may differ: their own sources, their containers, or issues of either, changed."""
    entries, issues = _changed(t, delta, "entries"), _changed(t, delta, "issues")
    dated = among(t["entries"], "issue_id", issues, "id")
    holders = _kept(_keys((entries, "id"), (_changed(t, delta, "releases"), "entry_id"), (dated, "id")))
    return _kept(_keys(
        (holders, "key"),
        *[(_changed(t, delta, name), "entry_id") for name in ("booktypeins", "magrefs", "contents")],
        (among(t["booktypeins"], "book_id", holders, "key", unique=True), "entry_id"),
        (among(t["contents"], "container_id", holders, "key", unique=True), "entry_id"),
        (among(t["magrefs"], "issue_id", issues, "id"), "entry_id"),
    ))


def _origins_of(t: Tables, touched: DataFrame) -> DataFrame:
    """The cascade over the sources of some entries alone."""
    sources = {name: among(t[name], "entry_id", touched, "key", unique=True) for name in ("booktypeins", "magrefs", "contents")}
    holders = _kept(_keys((sources["booktypeins"], "book_id"), (sources["contents"], "container_id")))
    entries = among_any(t["entries"], "id", [(touched, "key"), (holders, "key")])
    part = sources | {
        "entries": entries, "releases": among(t["releases"], "entry_id", holders, "key", unique=True),
        "issues": among_any(t["issues"], "id", [(entries, "issue_id"), (sources["magrefs"], "issue_id")]),
    }
    return among(search.origins(part), "entry_id", touched, "key", unique=True)


def _origins(index: DataFrame, t: Tables, delta: Tables) -> DataFrame:
    touched = _origin_entries(t, delta)
    return _replaced(index, "entry_id", touched, _origins_of(t, touched))


def publisher_lists(index: DataFrame, stale: DataFrame, t: Tables, delta: Tables, size: int = SEGMENT) -> DataFrame:
    """The lists of publishers, from the stored ones and the ``stale`` origins they were built with.

    A list changes with its container's publishers, with a name, and when its container becomes one or is none any more.
    """
    entries = _origin_entries(t, delta)
    before = among(stale, "entry_id", entries, "key", unique=True)
    after = cut_lineage(_origins_of(t, entries), "origins")
    renamed = among(t["publishers"], "label_id", _changed(t, delta, "labels"), "id")
    touched = _kept(_keys(
        (_changed(t, delta, "publishers"), "entry_id"), (renamed, "entry_id"), (before, "container_id"), (after, "container_id"),
    ))
    found = _replaced(stale, "entry_id", entries, after)
    part = {"publishers": among(t["publishers"], "entry_id", touched, "key", unique=True), "labels": t["labels"]}
    fresh = search.publisher_lists(part, size, among(found, "container_id", touched, "key", unique=True))
    return _replaced(index, "container_id", touched, fresh)


REFRESHES: dict[str, Callable[[DataFrame, Tables, Tables], DataFrame]] = {
    "titles": _titles,
    "names": _by_own_key(search.names, "labels", "id", "label_id"),
    "author_credits": _by_own_key(search.author_credits, "authors", "entry_id", "entry_id"),
    "publisher_credits": _publisher_credits,
    "author_relations": _relations(search.author_relations),
    "publisher_relations": _relations(search.publisher_relations),
    "issue_names": _by_own_key(search.issue_names, "issues", "id", "issue_id"),
    "origins": _origins,
}


def refreshed(name: str, indexes: Tables, t: Tables, delta: Tables, size: int = SEGMENT) -> DataFrame:
    """New version of one stored index for the tables as they are now.

    ``indexes`` are the stored ones, ``delta`` the changed rows by table; tables without changes may be missing from it.
    """
    if name == "publisher_lists":
        return publisher_lists(indexes[name], indexes["origins"], t, delta, size)
    return REFRESHES[name](indexes[name], t, delta)
