"""Whole jobs over stored tables, for ``spark-submit`` or a notebook.

``tables`` is a folder with one parquet folder per declared table. Each job writes new tables to ``out``;
the caller swaps them in.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from .plans import refresh as updates, search
from .plans.grams import store_grams
from .plans.imports import listings, map_links
from .plans.imports.reviews import ReviewIntegration
from .plans.rules import read_findings, sorted_findings, store_findings
from .plans.rules.magazines import pending_reviews
from .schema import TABLES
from .session import apply_settings, cut_lineage, new_path, staging
from .sources.dump import dump_table, read_dump, read_rejects
from .sources.tables import DatabaseTables, StoredTables, apply_schema, check_all_references, check_keys, overwrite_slice, rebuild
from .sources.text_files import LINE_ORDER

Tables = Mapping[str, DataFrame]


def _staged(job: Callable[..., None]) -> Callable[..., None]:
    """A job that removes what it staged when it ends, also by an error."""
    @wraps(job)
    def run(*args, **options) -> None:
        with staging(SparkSession.active()):
            job(*args, **options)
    return run


@_staged
def checks(t: Tables, out: str, advisory: bool = False) -> None:
    """Findings partitioned by rule, the same as one report in order, and the list of pending reviews."""
    store_findings(t, f"{out}/findings", advisory=advisory)
    found = read_findings(t["entries"].sparkSession, f"{out}/findings")
    sorted_findings(found).write.mode("overwrite").parquet(f"{out}/report")
    pending_reviews(t).write.mode("overwrite").parquet(f"{out}/pending_reviews")


@_staged
def indexes(t: Tables, out: str) -> None:
    """All search tables, sorted by their lookup columns, and gram lists for lookups by a part of a name."""
    for name, build in search.INDEXES.items():
        index = build(t)
        rebuild(index, f"{out}/{name}", index.columns[:2])
        if name in search.GRAM_INDEXES:
            stored = index.sparkSession.read.parquet(f"{out}/{name}")
            store_grams(stored, *search.GRAM_INDEXES[name], f"{out}/_grams/{name}")


@_staged
def refresh(t: Tables, before: Tables, stored: str, out: str) -> None:
    """New versions of the index tables under ``stored``, which were built from ``before``, for the tables as they are now.

    Gram lists are dealt by gram over whole indexes; those of the titles and names are written anew.
    """
    spark = t["entries"].sparkSession
    delta = updates.deltas(before, t)
    indexes_ = {name: spark.read.parquet(f"{stored}/{name}") for name in search.INDEXES}
    for name, index in indexes_.items():
        rebuild(updates.refreshed(name, indexes_, t, delta), f"{out}/{name}", index.columns[:2])
        if name in search.GRAM_INDEXES:
            store_grams(spark.read.parquet(f"{out}/{name}"), *search.GRAM_INDEXES[name], f"{out}/_grams/{name}")


@_staged
def maps(t: Tables, path: str, out: str, slices: str | None = None) -> None:
    """Web links with one site's links replaced by those of a map list; unclean rows beside them.

    With ``slices``, the folder of web links stored by site, only that site's folder is written, in its place.
    """
    found = map_links.read_map_list(t["entries"].sparkSession, path)
    if slices:
        overwrite_slice(map_links.map_links(found, t["entries"]), slices, "website_id", map_links.SITE)
    else:
        map_links.import_map_links(found, t).write.mode("overwrite").parquet(f"{out}/webrefs")
    map_links.unclean_ids(found).write.mode("overwrite").parquet(f"{out}/unclean_ids")


@_staged
def manifest(t: Tables, path: str, out: str) -> None:
    """Unknown and missing files, and tables enriched with size and digest."""
    spark = t["downloads"].sparkSession
    staged = new_path(spark, "manifest")
    listings.read_manifest(spark, path).write.parquet(staged)
    listing = spark.read.parquet(staged)
    listings.malformed_sizes(spark, path).write.mode("overwrite").parquet(f"{out}/malformed_sizes")
    listings.unknown_files(listing, t).write.mode("overwrite").parquet(f"{out}/unknown_files")
    for name in listings.FILE_TABLES:
        listings.missing_files(t[name], listing).write.mode("overwrite").parquet(f"{out}/missing_{name}")
        enriched = listings.enriched(t[name], listing, digest=name != "scraps")
        enriched.write.mode("overwrite").parquet(f"{out}/{name}")


@_staged
def mirror(t: Tables, path: str, out: str) -> None:
    """Files missing in a mirror listing and files only it knows."""
    spark = t["downloads"].sparkSession
    staged = new_path(spark, "mirror")
    listings.read_mirror(spark, path).write.parquet(staged)
    listing = spark.read.parquet(staged)
    listings.malformed_sizes(spark, path, mirror=True).write.mode("overwrite").parquet(f"{out}/malformed_sizes")
    listings.unknown_mirror_files(listing, t).write.mode("overwrite").parquet(f"{out}/unknown_files")
    for name in ("downloads", "files"):
        missing = listings.missing_files(t[name], listing, listings.OLD_ARCHIVE)
        missing.write.mode("overwrite").parquet(f"{out}/missing_{name}")
    listings.missing_mirror_scraps(t["scraps"], listing).write.mode("overwrite").parquet(f"{out}/missing_scraps")


@_staged
def reviews(t: Tables, s: Tables, out: str) -> None:
    """Reports first, then the new versions of all tables the integration touches."""
    job = ReviewIntegration(t, s)
    for name, df in job.reports().items():
        df.write.mode("overwrite").parquet(f"{out}/reports/{name}")
    job.store(out)


@_staged
def load_dump(spark: SparkSession, path: str, out: str, names: Mapping[str, str] | None = None) -> None:
    """Dump text to typed tables, with rejected rows and broken keys and references beside them.

    ``names`` maps declared tables to their names in the dump where those differ. The dump is read once
    and staged by table; every table then reads its own part.
    """
    staged = new_path(spark, "dump")
    read_dump(spark, path).drop(*LINE_ORDER, "_tuple").write.partitionBy("table").parquet(staged)
    read_rejects(spark, path).write.mode("overwrite").parquet(f"{out}/_rejects/_lines")
    rows = spark.read.schema("columns array<string>, values array<string>, table string").parquet(staged)
    for name, table in TABLES.items():
        typed, rejects = apply_schema(dump_table(rows, name, (names or {}).get(name)), table.schema, table.widths)
        typed.write.mode("overwrite").parquet(f"{out}/{name}")
        rejects.write.mode("overwrite").parquet(f"{out}/_rejects/{name}")
    loaded = StoredTables(spark, out)
    for name, table in TABLES.items():
        if table.key:
            check_keys(loaded[name], table.key).write.mode("overwrite").parquet(f"{out}/_broken_keys/{name}")
    referring = [name for name, table in TABLES.items() if table.references]
    lost = cut_lineage(check_all_references(loaded, referring), "references")
    for name in referring:
        own = lost.where(F.col("tab") == name).select(F.col("col").alias("column"), "value", "occurrences")
        own.write.mode("overwrite").parquet(f"{out}/_broken_references/{name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["checks", "indexes", "refresh", "maps", "manifest", "mirror", "reviews", "load-dump"])
    parser.add_argument("--tables", help="folder of the stored tables")
    parser.add_argument("--source", help="text file, dump, or folder of the outside tables")
    parser.add_argument("--database", help="database of the session catalogue that holds the outside tables")
    parser.add_argument("--before", help="folder of the tables that the stored indexes were built from")
    parser.add_argument("--indexes", help="folder of the stored indexes")
    parser.add_argument("--slices", help="folder of the web links stored by site, of which the job maps replaces one")
    parser.add_argument("--out", required=True)
    parser.add_argument("--advisory", action="store_true", help="also run advisory rules")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"shelfmark-{args.job}").getOrCreate()
    apply_settings(spark)
    t = StoredTables(spark, args.tables) if args.tables else None
    if args.job == "load-dump":
        load_dump(spark, args.source, args.out)
    elif args.job == "reviews":
        source = DatabaseTables(spark, args.database) if args.database else StoredTables(spark, args.source)
        reviews(t, source, args.out)
    elif args.job == "maps":
        maps(t, args.source, args.out, args.slices)
    elif args.job in ("manifest", "mirror"):
        {"manifest": manifest, "mirror": mirror}[args.job](t, args.source, args.out)
    elif args.job == "refresh":
        refresh(t, StoredTables(spark, args.before), args.indexes, args.out)
    elif args.job == "checks":
        checks(t, args.out, args.advisory)
    else:
        indexes(t, args.out)


if __name__ == "__main__":
    main()
