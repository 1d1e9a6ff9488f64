"""Whole jobs from files to files, by way of the command line."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark import jobs
from shelfmark.fixtures import files
from shelfmark.fixtures.derived import DerivedCatalogue
from shelfmark.plans import search
from shelfmark.plans.refresh import SOURCES
from shelfmark.plans.rules import REGISTRY, read_findings, sorted_findings, store_findings
from shelfmark.schema import TABLES
from shelfmark.sources.tables import StoredTables, apply_schema, export_tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    t = DerivedCatalogue(spark, sf_dir)
    export_tables({name: t[name] for name in TABLES if name in t}, folder, 100_000)
    return folder


def test_checks(spark, stored, tmp_path):
    jobs.main(["checks", "--tables", stored, "--out", str(tmp_path), "--advisory"])
    findings = read_findings(spark, f"{tmp_path}/findings")
    rules = {r.rule for r in findings.select("rule").distinct().collect()}
    assert rules <= set(REGISTRY) and len(rules) > 75
    ids = [r.entry_id for r in sorted_findings(findings.where("rule = 'author_seq_gap'")).collect()]
    assert ids == sorted(ids)
    store_findings(StoredTables(spark, stored), f"{tmp_path}/findings", ["itch_link_in_downloads"])
    assert {r.rule for r in read_findings(spark, f"{tmp_path}/findings").collect()} <= {"itch_link_in_downloads"}
    assert spark.read.parquet(f"{tmp_path}/pending_reviews").count() > 0
    report = [(r.entry_id is not None, r.entry_id) for r in spark.read.parquet(f"{tmp_path}/report").select("entry_id").collect()]
    assert len(report) > 1000


def test_refresh_follows_the_tables(spark, stored, tmp_path):
    """Some labels and entries come, some issues go: the refreshed indexes are those built anew."""
    t = StoredTables(spark, stored)
    edits = {"labels": "id % 5 > 0", "entries": "id % 7 > 0", "publishers": "entry_id % 3 > 0", "contents": "container_id % 4 > 0"}
    before = {name: t[name].where(edits.get(name, "true")) for name in SOURCES}
    before["issues"] = t["issues"].unionByName(t["issues"].where("id % 2 = 0").withColumn("id", F.expr("cast(id + 900000000 as int)")))
    export_tables(before, f"{tmp_path}/before", 100_000)
    jobs.main(["indexes", "--tables", f"{tmp_path}/before", "--out", f"{tmp_path}/stored"])
    jobs.main(["refresh", "--tables", stored, "--before", f"{tmp_path}/before", "--indexes", f"{tmp_path}/stored", "--out", f"{tmp_path}/new"])
    for name, build in search.INDEXES.items():
        found, anew = spark.read.parquet(f"{tmp_path}/new/{name}"), build(t)
        assert found.exceptAll(anew).isEmpty() and anew.exceptAll(found).isEmpty(), name


def test_indexes_serve_lookups(spark, stored, tmp_path):
    jobs.main(["indexes", "--tables", stored, "--out", str(tmp_path)])
    t = StoredTables(spark, stored)
    indexes = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in search.INDEXES}
    for by, word in (("title", "widget"), ("author", "#00000001"), ("publisher", "#00000001")):
        fast, slow = search.find_entries(t, word, by, indexes), search.find_entries(t, word, by)
        assert fast.count() > 0 and fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


@pytest.mark.parametrize("job, write, table", [
    ("maps", files.write_map_list, "webrefs"), ("manifest", files.write_manifest, "downloads"), ("mirror", files.write_mirror, "unknown_files")])
def test_listing_jobs(spark, sf_dir, stored, tmp_path, job, write, table):
    jobs.main([job, "--tables", stored, "--source", write(spark, sf_dir), "--out", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/{table}").count() > 0


def test_reviews(spark, stored, tmp_path):
    jobs.main(["reviews", "--tables", stored, "--source", stored, "--out", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/magrefs").count() > StoredTables(spark, stored)["magrefs"].count()
    assert spark.read.parquet(f"{tmp_path}/reports/unmapped_issues").count() > 0


def test_reviews_from_a_second_database(spark, stored, tmp_path):
    spark.sql("create database if not exists outside")
    for name in TABLES:
        if name.endswith("_src"):
            spark.sql(f"drop view if exists outside.{name}")
            spark.sql(f"drop table if exists outside.{name}")
            spark.sql(f"create table outside.{name} using parquet location '{stored}/{name}'")
    jobs.main(["reviews", "--tables", stored, "--database", "outside", "--out", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/reports/unmapped_issues").count() > 0


def test_load_dump(spark, sf_dir, tmp_path):
    t = DerivedCatalogue(spark, sf_dir)
    names = ("labels", "authors", "relations")
    path = files.write_dump({name: apply_schema(t[name], TABLES[name].schema)[0] for name in names})
    jobs.main(["load-dump", "--source", path, "--out", str(tmp_path)])
    loaded = StoredTables(spark, str(tmp_path))
    for name in names:
        assert loaded[name].count() == t[name].count()
        assert loaded[name].dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES[name].schema.fields]
    assert loaded["entries"].count() == 0
    assert spark.read.parquet(f"{tmp_path}/_broken_references/authors").count() > 0
