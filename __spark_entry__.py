"""

The catalogue queries run over tables that Spark derives from the given parquet files
(``shelfmark.fixtures.derived``); DuckDB derives the same tables from the same definitions.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Mapping
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from shelfmark.fixtures import files  # noqa: E402
from shelfmark.fixtures.derived import DerivedCatalogue  # noqa: E402
from shelfmark.functions.text import link_from_mask  # noqa: E402
from shelfmark.operators import groups, membership, sequences  # noqa: E402
from shelfmark.plans import grams, refresh, search  # noqa: E402
from shelfmark.plans.imports import listings, map_links  # noqa: E402
from shelfmark.plans.imports.reviews import ReviewIntegration  # noqa: E402
from shelfmark.plans.rules import REGISTRY, read_findings, run_checks, run_rule, store_findings  # noqa: E402
from shelfmark.plans.rules.magazines import pending_reviews  # noqa: E402
from shelfmark.plans.rules.tags import series_gaps  # noqa: E402
from shelfmark.schema import TABLES  # noqa: E402
from shelfmark.session import apply_settings, cut_lineage, new_path, short_lived_shuffles, staging  # noqa: E402
from shelfmark.sources import dump, tables  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry(spark: SparkSession) -> DataFrame:
    """Line items whose predecessor in the order is missing."""
    return lineitem_sequence_gaps(spark, "/root/testdata/sf0.001")


# Operators over the plain tables.

def lineitem_sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.sequence_gaps(_read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", 1)


def orders_without_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return membership.absent(orders, "o_orderkey", _read(spark, sf_dir, "lineitem"), "l_orderkey")


def orders_same_customer_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = [F.col("o_custkey"), F.to_date("o_orderdate").cast("string")]
    return groups.pair_counts(_read(spark, sf_dir, "orders"), key, ["o_custkey", "o_orderdate"])


def lineitem_ship_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _read(spark, sf_dir, "lineitem").withColumn("day", F.unix_date(F.to_date("l_shipdate")))
    return sequences.inversions(items, "l_orderkey", "l_linenumber", "day")


def orders_same_return_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = groups.same_members(
        _read(spark, sf_dir, "orders"), "o_orderkey", "o_orderpriority",
        _read(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag",
    )
    return pairs.select(F.col("first.id").alias("first_id"), "id", "name", "occurrences")


def documents_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return groups.canonical_ids(docs, ["text"], "doc_id", "first_id").select("doc_id", "first_id")


def events_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select("event_id", "user_id")
    return sequences.assign_sequence(events, "user_id", "event_id", "seq")


def conversations_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return sequences.last_of_group(turns, "conv_id", "turn")


def documents_without_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang")
    return membership.absent(docs, "doc_id", _read(spark, sf_dir, "labels"), "doc_id", null_aware=True)


def labels_without_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _read(spark, sf_dir, "labels").select("doc_id", "quality")
    return membership.absent(labels, "doc_id", _read(spark, sf_dir, "documents"), "doc_id")


def lineitem_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.check_keys(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def parts_first_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.first_by(
        _read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), ["l_partkey"], ["l_suppkey"]
    )


def orders_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return sequences.assign_ids(orders, ["o_custkey", "o_orderkey"], 1000).select("o_orderkey", "id")


# Table-level jobs over the derived catalogue.

def catalogue_broken_references(t: Mapping[str, DataFrame]) -> DataFrame:
    return tables.check_all_references(t, [name for name in t if TABLES[name].references])


def magazine_page_links(t: Mapping[str, DataFrame]) -> DataFrame:
    issues = t["issues"].withColumnRenamed("id", "issue_id")
    magazines = t["magazines"].withColumnRenamed("id", "magazine_id")
    refs = t["magrefs"].select(F.col("id").alias("magref_id"), "issue_id", "page")
    rows = refs.join(issues, "issue_id").join(magazines, "magazine_id")
    values = {
        "i": "number", "v": "volume", "y": "date_year", "m": "date_month", "M": "date_month", "d": "date_day",
        "p": "page", "s": "special", "u": "supplement",
    }
    return rows.select(
        "magref_id", link_from_mask("link_mask", values).alias("page_link"),
        link_from_mask("archive_mask", values).alias("archive_link"),
    )


def series_gaps_plain(t: Mapping[str, DataFrame]) -> DataFrame:
    return series_gaps(t, null_aware=False)


def findings_in_one_pass(t: Mapping[str, DataFrame]) -> DataFrame:
    return run_checks(t, [r.name for r in REGISTRY.values() if r.base is not None])


def findings_per_rule(t: DerivedCatalogue) -> DataFrame:
    spark = t["entries"].sparkSession
    path = new_path(spark, "findings")
    with staging(spark), short_lived_shuffles(spark):
        store_findings(t.with_grouped_stored(), path, advisory=True)
    return read_findings(spark, path).groupBy("rule").agg(
        F.count(F.lit(1)).alias("findings"), F.sum("occurrences").alias("occurrences")
    )


def rebuild_titles(t: Mapping[str, DataFrame]) -> DataFrame:
    index = search.titles(t)
    path = new_path(index.sparkSession, "titles")
    tables.rebuild(index, path, ["entry_title", "entry_id"])
    return index.sparkSession.read.parquet(path)


def refresh_titles(t: Mapping[str, DataFrame]) -> DataFrame:
    """An index that is stale for the titles in the contents, brought up to date."""
    index = search.titles(t)
    changed = t["contents"].where("alias is not null").select("entry_id")
    marked = changed.select("entry_id", F.lit(True).alias("old")).distinct()
    stale = index.join(marked, "entry_id", "left").select(
        F.when(F.col("old"), F.concat(F.lit("old"), F.col("entry_title"))).otherwise(F.col("entry_title")).alias("entry_title"),
        "entry_id",
    )
    return search.refresh_titles(stale, t, changed)


# What the catalogue was before some rows came, went or changed, by table: rows that were missing, values that
# were others, and ids by which copies of rows that are gone stood beside the others.
EARLIER = {
    "entries": ("id % 13 = 5", {"title": "if(id % 11 = 3, concat(title, ' II'), title)", "genretype_id": "if(id % 17 = 2, 81, genretype_id)",
                                "issue_id": "if(id % 19 = 4, null, issue_id)"}, ("id % 23 = 1", {"id": "id + 500000000"})),
    "labels": ("id % 13 = 5", {"name": "if(id % 11 = 3, concat('Old ', name), name)", "owner_id": "if(id % 17 = 2, null, owner_id)",
                               "from_id": "if(id % 19 = 4, id - 1, from_id)"}, ("id % 23 = 1", {"id": "id + 500000000", "owner_id": "id"})),
    "aliases": ("entry_id % 7 = 2", {"title": "if(entry_id % 11 = 3, concat(title, ' IV'), title)"}, ("entry_id % 23 = 1", {"title": "concat('Gone ', title)"})),
    "authors": ("entry_id % 13 = 7", {"team_id": "if(entry_id % 11 = 1, null, team_id)"}, ("entry_id % 23 = 1", {"label_id": "label_id + 1"})),
    "publishers": ("(entry_id + publisher_seq) % 13 = 6", {"label_id": "if(entry_id % 11 = 1, label_id + 1, label_id)"},
                   ("entry_id % 17 = 3", {"publisher_seq": "publisher_seq + 1000"})),
    "contents": ("container_id % 13 = 2", {"is_original": "if(entry_id % 11 = 5, 1 - is_original, is_original)",
                                           "label_id": "if(entry_id % 17 = 3, null, label_id)"}, ("entry_id % 23 = 1", {"prog_seq": "prog_seq + 1000", "is_original": "1"})),
    "issues": ("id % 13 = 1", {"number": "if(id % 11 = 2, number + 1, number)", "date_year": "if(id % 17 = 2, 1900, date_year)"},
               ("id % 23 = 1", {"id": "id + 500000000"})),
    "releases": ("entry_id % 13 = 4", {"release_year": "if(entry_id % 11 = 6, 1900, release_year)"}, ("entry_id % 23 = 1", {"release_seq": "release_seq + 1000"})),
    "booktypeins": ("entry_id % 7 = 1", {"is_original": "if(entry_id % 11 = 5, 1 - is_original, is_original)"}, ("entry_id % 23 = 1", {"book_id": "book_id + 1"})),
    "magrefs": ("id % 13 = 3", {"is_original": "if(id % 11 = 4, 1 - is_original, is_original)"}, ("id % 23 = 1", {"id": "id + 500000000", "is_original": "1"})),
}


def _earlier(df: DataFrame, missing: str, edits: Mapping[str, str], gone: tuple[str, Mapping[str, str]]) -> DataFrame:
    def version(rows: DataFrame, values: Mapping[str, str]) -> DataFrame:
        return rows.select(*[
            F.expr(values[f.name]).cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name) for f in df.schema.fields
        ])

    there = df.where(f"({missing}) is not true")
    return version(there, edits).unionByName(version(df.where(gone[0]), gone[1]))


def _refreshed(t: Mapping[str, DataFrame], name: str) -> DataFrame:
    """An index built from the earlier tables and brought up to date by the rows that changed since."""
    before = {table: _earlier(t[table], *how) for table, how in EARLIER.items()}
    stored = {}
    if name == "publisher_lists":
        stored["origins"] = cut_lineage(search.origins(before), "index")
        stored[name] = cut_lineage(search.publisher_lists(before, LIST_BYTES, stored["origins"]), "index")
    else:
        stored[name] = cut_lineage(search.INDEXES[name](before), "index")
    return refresh.refreshed(name, stored, t, refresh.deltas(before, t), LIST_BYTES)


def export_batches(t: Mapping[str, DataFrame]) -> DataFrame:
    spark = t["issues"].sparkSession
    path = new_path(spark, "export")
    tables.export_tables({"issues": t["issues"], "labels": t["labels"]}, path, 1000)
    out = None
    for name in ("issues", "labels"):
        per_file = spark.read.parquet(f"{path}/{name}").groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
        part = per_file.agg(
            F.lit(name).alias("tab"), F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("in_batches")
        )
        out = part if out is None else out.unionByName(part)
    return out


def dump_rejects(t: Mapping[str, DataFrame]) -> DataFrame:
    path = files.write_dump({"labels": t["labels"], "notes": t["notes"]})
    return dump.read_rejects(t["labels"].sparkSession, path).groupBy("table", "problem", "text").agg(
        F.count(F.lit(1)).alias("occurrences")
    ).withColumnRenamed("table", "tab")


# Segments small enough that the derived lists have several.
LIST_BYTES = 256


def tag_member_lists(t: Mapping[str, DataFrame]) -> DataFrame:
    """The members of each tag by id, as ordered texts in segments."""
    members = t["members"].select(F.col("tag_id").cast("long").alias("tag_id"), "entry_id", F.col("entry_id").cast("string").alias("member"))
    return groups.segmented_text(members, ["tag_id"], "entry_id", "member", size=LIST_BYTES)


def search_publisher_lists(t: Mapping[str, DataFrame]) -> DataFrame:
    return search.publisher_lists(t, LIST_BYTES)


def _by_grams(t: Mapping[str, DataFrame], find: Callable[..., DataFrame], index: str, word: str) -> DataFrame:
    """A lookup over gram lists that are built and stored first."""
    build, (text, ident) = search.INDEXES[index], search.GRAM_INDEXES[index]
    folder = new_path(t["entries"].sparkSession, "grams")
    grams.store_grams(build(t), text, ident, f"{folder}/{index}")
    return find(t, word, lists=folder)


def _dumped(t: Mapping[str, DataFrame], name: str) -> DataFrame:
    spark = t[name].sparkSession
    path = files.write_dump({"labels": t["labels"], "notes": t["notes"]})
    typed, _ = tables.apply_schema(dump.dump_table(dump.read_dump(spark, path), name), TABLES[name].schema)
    return typed


# Imports.

def import_map_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = map_links.read_map_list(spark, files.write_map_list(spark, sf_dir))
    return map_links.import_map_links(maps, DerivedCatalogue(spark, sf_dir))


def sliced_map_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web links stored by site, of which one site's are replaced in place."""
    t = DerivedCatalogue(spark, sf_dir)
    path = new_path(spark, "webrefs")
    tables.store_slices(t["webrefs"], path, "website_id")
    maps = map_links.read_map_list(spark, files.write_map_list(spark, sf_dir))
    tables.overwrite_slice(map_links.map_links(maps, t["entries"]), path, "website_id", map_links.SITE)
    return spark.read.parquet(path)


def _with_manifest(job: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        listing = listings.read_manifest(spark, files.write_manifest(spark, sf_dir))
        return job(listing, DerivedCatalogue(spark, sf_dir))
    return query


def _with_mirror(job: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        listing = listings.read_mirror(spark, files.write_mirror(spark, sf_dir))
        return job(listing, DerivedCatalogue(spark, sf_dir))
    return query


_JOBS: dict[tuple[str, str], ReviewIntegration] = {}


def _reviews(spark: SparkSession, sf_dir: str) -> ReviewIntegration:
    """One integration per session and data folder: its outputs share frames kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _JOBS:
        t = DerivedCatalogue(spark, sf_dir)
        _JOBS[key] = ReviewIntegration(t, t)
    return _JOBS[key]


_REVIEW_OUTPUTS: dict[str, Callable[[ReviewIntegration], DataFrame]] = {
    "review_magazine_map": lambda j: j.magazines,
    "review_issue_map": lambda j: j.issues,
    "review_cleaned": lambda j: j.cleaned,
    "review_canonical": lambda j: j.placed.select("id", "entry_id", "issue_id", "page", "parent_id"),
    "review_texts": lambda j: j.review_texts,
    "review_magrefs": lambda j: j.magrefs,
    "review_feature_links": lambda j: j.feature_links,
    "review_scores": lambda j: j.review_scores,
    "review_captions": lambda j: j.review_captions,
    "review_unmapped_magazines": lambda j: j.report("unmapped_magazines"),
    "review_unmapped_magazine_issues": lambda j: j.report("unmapped_magazine_issues"),
    "review_unmapped_reviewers": lambda j: j.report("unmapped_reviewers"),
    "review_unmapped_awards": lambda j: j.report("unmapped_awards"),
    "review_unmapped_issues": lambda j: j.report("unmapped_issues"),
    "review_unmapped_reviews": lambda j: j.report("unmapped_reviews"),
    "review_ambiguous_issues": lambda j: j.report("ambiguous_issues"),
    "review_odd_supplements": lambda j: j.report("odd_supplements"),
    "review_without_page": lambda j: j.report("reviews_without_page"),
    "review_unknown_sections": lambda j: j.report("unknown_sections"),
}


def _over(job: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(DerivedCatalogue(spark, sf_dir))


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return query(spark, sf_dir.rstrip("/"))
    return run


def queries() -> dict[str, Query]:
    plain = (
        lineitem_sequence_gaps, orders_without_lineitem, orders_same_customer_date, lineitem_ship_inversions,
        orders_same_return_flags, documents_canonical, events_numbered, conversations_last_turn,
        documents_without_label, labels_without_document, lineitem_repeated_keys, parts_first_supplier,
        orders_numbered, import_map_links, sliced_map_links,
    )
    over_catalogue = (
        catalogue_broken_references, magazine_page_links, series_gaps_plain, findings_in_one_pass,
        findings_per_rule, rebuild_titles, refresh_titles, export_batches, dump_rejects,
        tag_member_lists, search_publisher_lists,
    )
    out: dict[str, Query] = {q.__name__: q for q in plain}
    out |= {q.__name__: _over(q) for q in over_catalogue}
    out |= {f"dump_{name}": _over(partial(_dumped, name=name)) for name in ("labels", "notes")}
    out |= {f"check_{name}": _over(partial(run_rule, name=name)) for name in REGISTRY}
    out["pending_reviews"] = _over(pending_reviews)
    out |= {
        "search_titles": _over(search.titles), "search_names": _over(search.names),
        "search_authors": _over(search.authors), "search_publishers": _over(search.publishers),
        "search_issue_names": _over(search.issue_names), "search_origins": _over(search.origins),
        "search_origin_publications": _over(search.origins_with_publication),
        "search_origin_publishers": _over(search.origin_publishers),
        "search_author_credits": _over(search.author_credits), "search_publisher_credits": _over(search.publisher_credits),
        "search_author_relations": _over(search.author_relations),
        "search_publisher_relations": _over(search.publisher_relations),
        "lookup_entries_by_title": _over(lambda t: search.find_entries(t, "WIDGET3")),
        "lookup_labels_by_name": _over(lambda t: search.find_labels(t, "#00000012")),
        "lookup_entries_by_author": _over(lambda t: search.find_entries(t, "#00000001", "author")),
        "lookup_entries_by_publisher": _over(lambda t: search.find_entries(t, "#00000001", "publisher")),
    }
    out |= {
        "grams_entries_by_title": _over(partial(_by_grams, find=search.find_entries, index="titles", word="WIDGET3")),
        "grams_entries_by_short_word": _over(partial(_by_grams, find=search.find_entries, index="titles", word="8T")),
        "grams_labels_by_name": _over(partial(_by_grams, find=search.find_labels, index="names", word="#00000012")),
    }
    out |= {f"refreshed_{name}": _over(partial(_refreshed, name=name)) for name in search.INDEXES}
    out["manifest_listing"] = _with_manifest(lambda listing, t: listing)
    out["manifest_unknown_files"] = _with_manifest(listings.unknown_files)
    out["manifest_malformed_sizes"] = lambda spark, sf_dir: listings.malformed_sizes(spark, files.write_manifest(spark, sf_dir))
    out["mirror_malformed_sizes"] = lambda spark, sf_dir: listings.malformed_sizes(spark, files.write_mirror(spark, sf_dir), True)
    out["mirror_listing"] = _with_mirror(lambda listing, t: listing)
    out["mirror_unknown_files"] = _with_mirror(listings.unknown_mirror_files)
    for name in listings.FILE_TABLES:
        out[f"manifest_missing_{name}"] = _with_manifest(
            lambda listing, t, n=name: listings.missing_files(t[n], listing)
        )
        out[f"manifest_enriched_{name}"] = _with_manifest(
            lambda listing, t, n=name: listings.enriched(t[n], listing, digest=n != "scraps")
        )
    for name in ("downloads", "files"):
        out[f"mirror_missing_{name}"] = _with_mirror(
            lambda listing, t, n=name: listings.missing_files(t[n], listing, listings.OLD_ARCHIVE)
        )
    out["mirror_missing_scraps"] = _with_mirror(
        lambda listing, t: listings.missing_mirror_scraps(t["scraps"], listing)
    )
    out |= {
        name: (lambda spark, sf_dir, pick=pick: pick(_reviews(spark, sf_dir))) for name, pick in _REVIEW_OUTPUTS.items()
    }
    return {name: _prepared(q) for name, q in out.items()} | _training_data("queries")


def _training_data(what: str) -> dict:
    """Queries or SQL of the training-data operators, where their subpackage and pipeline are present."""
    try:
        from shelfmark.llm import queries as training
        import corpus_pipeline  # noqa: F401
    except ImportError:  # also where a library that only the subpackage needs is missing
        return {}
    return getattr(training, what)()


def oracle_sql() -> dict[str, str]:
    from oracle import checks, imports, operators
    from oracle import search as searches

    return (
        operators.SQL | searches.SQL | imports.SQL
        | {f"check_{name}": checks.check_sql(name) for name in REGISTRY} | {"pending_reviews": checks.PENDING}
        | _training_data("oracle_sql")
    )
