"""What jobs leave behind: staged files, findings of runs that fail, slices in place, references checked by parent."""

from __future__ import annotations

import os
import time
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from handmade import Handmade
from shelfmark import jobs
from shelfmark.fixtures import files
from shelfmark.fixtures.derived import GROUPED, DerivedCatalogue
from shelfmark.operators.membership import broken_references
from shelfmark.plans.imports import map_links
from shelfmark.plans.rules import read_findings, registry, store_findings
from shelfmark.schema import TABLES
from shelfmark.session import SHUFFLE_CLEANUP, cut_lineage, new_path, shared_folder, short_lived_shuffles, staging
from shelfmark.sources.tables import check_all_references, check_references, export_tables, overwrite_slice, store_slices


@pytest.fixture
def added(spark):
    """Lists what came into the shared folder since the test began."""
    folder = shared_folder(spark).removeprefix("file://")

    def names():
        return set(os.listdir(folder)) if os.path.exists(folder) else set()

    before = names()
    return lambda: names() - before


def test_scopes_remove_what_they_staged_and_nest(spark, added):
    kept = new_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with staging(spark) as outer:
        first = cut_lineage(spark.range(5), "outer")
        with staging(spark) as inner:
            assert cut_lineage(spark.range(7), "inner").count() == 7 and inner.startswith(outer)
        assert not os.path.exists(inner.removeprefix("file://")) and first.count() == 5
    assert added() == {os.path.basename(kept)}
    assert new_path(spark, "x").rsplit("/", 1)[0] == shared_folder(spark)


def test_scope_ends_by_an_error(spark, added):
    with pytest.raises(KeyError), staging(spark):
        cut_lineage(spark.range(5))
        raise KeyError
    assert added() == set()
    with staging(spark):
        pass  # nothing was staged
    assert added() == set()


def test_jobs_leave_the_shared_folder_empty(spark, sf_dir, tmp_path, added):
    t = DerivedCatalogue(spark, sf_dir)
    export_tables({n: t[n] for n in ("downloads", "files", "scraps")}, f"{tmp_path}/tables", 100_000)
    listing = files.write_manifest(spark, sf_dir)
    before = added()
    jobs.main(["manifest", "--tables", f"{tmp_path}/tables", "--source", listing, "--out", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/unknown_files").count() > 0
    with pytest.raises(PySparkException):
        jobs.main(["manifest", "--tables", f"{tmp_path}/none", "--source", listing, "--out", f"{tmp_path}/none"])
    assert added() == before


def test_threads_of_the_checks_stage_in_the_scope(spark, added, tmp_path):
    with staging(spark):
        store_findings(Handmade(spark), f"{tmp_path}/findings", ["title_index_unneeded", "label_index_unneeded"])
    assert added() == set()


def test_findings_are_seen_as_a_whole(spark, tmp_path, monkeypatch):
    t, path = Handmade(spark), f"{tmp_path}/findings"
    with pytest.raises(PySparkException):
        read_findings(spark, path)
    rules = ["entry_without_release", "author_seq_gap"]

    def broken(tables):
        return registry.finding(spark.range(1).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), "id", None, None)

    monkeypatch.setitem(registry.REGISTRY, "broken", registry.Rule("broken", "Broken", build=broken))
    with pytest.raises(PySparkException):
        store_findings(t, path, ["broken"])
    with pytest.raises(ValueError, match="no run"):
        read_findings(spark, path)
    store_findings(t, path, rules)
    whole = sorted(map(str, read_findings(spark, path).collect()))
    with pytest.raises(PySparkException):
        store_findings(t, path, [*rules, "broken"])
    assert sorted(map(str, read_findings(spark, path).collect())) == whole
    assert len(os.listdir(f"{path}/runs")) == 1
    for _ in range(3):
        store_findings(t, path, rules[:1])
    assert len(os.listdir(f"{path}/runs")) == 2
    assert {r.rule for r in read_findings(spark, path).collect()} <= set(rules[:1])


def shuffles(spark):
    """Names of the shuffle files that are on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that came since, once those that are on their way out are gone."""
    until = time.time() + 10
    while (new := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def test_rules_take_their_shuffle_files_with_them(spark, sf_dir, tmp_path):
    t, before = DerivedCatalogue(spark, sf_dir), shuffles(spark)
    store_findings(t, f"{tmp_path}/findings", ["author_seq_gap", "release_order", "team_not_company", "title_index_unneeded"])
    assert not left(spark, before)
    assert read_findings(spark, f"{tmp_path}/findings").count() > 0


def test_scope_of_short_lived_shuffles(spark):
    before, setting = shuffles(spark), spark.conf.get(SHUFFLE_CLEANUP)
    with pytest.raises(KeyError), short_lived_shuffles(spark):
        with short_lived_shuffles(spark):
            counts = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
            assert counts.agg(F.sum("count")).first()[0] == 1000
        assert sorted(counts.collect()) == sorted(counts.collect())  # asked again, it is computed again
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting and not left(spark, before)


def test_grouped_tables_are_stored_whole(spark, sf_dir):
    t = DerivedCatalogue(spark, sf_dir)
    with staging(spark):
        stored = t.with_grouped_stored()
        for name in GROUPED:
            plan = stored[name]._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Exchange" in t[name]._jdf.queryExecution().executedPlan().toString()
            assert stored[name].dtypes == t[name].dtypes
            assert stored[name].exceptAll(t[name]).isEmpty() and t[name].exceptAll(stored[name]).isEmpty()
        assert list(stored) == list(t) and stored["entries"].count() == t["entries"].count()


def test_findings_per_rule_reads_stored_groups_and_removes_them(spark, sf_dir, added, monkeypatch):
    plans, before = [], shuffles(spark)

    def one_rule(t, path, **options):
        plans.append(t["contents"]._jdf.queryExecution().executedPlan().toString())
        store_findings(t, path, ["release_order"], **options)

    monkeypatch.setattr(entry, "store_findings", one_rule)
    entry.findings_per_rule(DerivedCatalogue(spark, sf_dir))
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert not left(spark, before)
    assert [name.rsplit("-", 1)[0] for name in added()] == ["findings"]


def stamps(folder):
    return {
        os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


def test_other_slices_stay_as_they_are(spark, sf_dir, tmp_path):
    t, path = DerivedCatalogue(spark, sf_dir), tmp_path / "webrefs"
    extra = t["webrefs"].limit(2).withColumn("website_id", F.lit(None).cast("int"))
    store_slices(t["webrefs"].unionByName(extra), str(path), "website_id")
    others = {f: s for f, s in stamps(path).items() if "website_id=6" not in f}
    assert others and len(others) < len(stamps(path))
    export_tables({"entries": t["entries"]}, f"{tmp_path}/tables", 100_000)
    jobs.main(["maps", "--tables", f"{tmp_path}/tables", "--source", files.write_map_list(spark, sf_dir), "--slices", str(path), "--out", f"{tmp_path}/out"])
    assert {f: s for f, s in stamps(path).items() if "website_id=6" not in f} == others
    maps = map_links.read_map_list(spark, files.write_map_list(spark, sf_dir))
    wanted = map_links.map_links(maps, t["entries"])
    found = spark.read.parquet(str(path)).where("website_id = 6").select(*wanted.columns)
    assert found.count() == wanted.count() > 0 and found.exceptAll(wanted).isEmpty()


def test_empty_null_and_wrong_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a b=c"), (2, "x"), (3, None)], "n int, kind string")
    store_slices(rows, path, "kind")

    def now():
        return sorted((r.n, r.kind) for r in spark.read.parquet(path).collect() if r.kind) + [
            (r.n, None) for r in spark.read.parquet(path).where("kind is null").collect()]

    overwrite_slice(rows.where("false"), path, "kind", "a b=c")
    assert now() == [(2, "x"), (3, None)]
    overwrite_slice(rows.where("false"), path, "kind", "unknown")
    with pytest.raises(PySparkException):
        overwrite_slice(rows.where("n > 1"), path, "kind", "x")
    assert now() == [(2, "x"), (3, None)]
    overwrite_slice(spark.createDataFrame([(9, None), (8, None)], "n int, kind string"), path, "kind", None)
    assert [(2, "x")] == now()[:1] and sorted(n for n, _ in now()[1:]) == [8, 9]
    overwrite_slice(rows.where("false"), path, "kind", None)
    assert now() == [(2, "x")]


def test_references_of_all_tables_by_parent(spark, sf_dir):
    t = DerivedCatalogue(spark, sf_dir)
    names = [n for n in t if TABLES[n].references]
    found = {(r.tab, r.col, r.value): r.occurrences for r in check_all_references(t, names).collect()}
    for name in ("labels", "authors", "relations", "contents", "members"):
        one = {(name, r.column, r.value): r.occurrences for r in check_references(t, name).collect()}
        assert one == {k: v for k, v in found.items() if k[0] == name}
    assert len({k[:2] for k in found}) > 3


def test_references_of_a_hot_value_in_one_exchange(spark, tmp_path):
    """Half of the rows point at one lost value, another third at a sound one; NULL refers to nothing."""
    rows = spark.range(60_000).selectExpr(
        "cast(case when id % 2 = 0 then 7 when id % 3 = 0 then 1 else null end as int) as a", "cast(id % 5 as int) as b")
    rows.write.parquet(f"{tmp_path}/rows")
    spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int").write.parquet(f"{tmp_path}/parent")
    child, parent = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/parent")
    lost = broken_references({"x": (child, ["a", "b"]), "y": (child, ["b"]), "z": (child.where("false"), ["a"])}, parent, "id")
    assert {(r.tab, r.col, r.value): r.occurrences for r in lost.collect()} == {
        ("x", "a", "7"): 30_000, ("x", "b", "0"): 12_000, ("x", "b", "4"): 12_000, ("y", "b", "0"): 12_000, ("y", "b", "4"): 12_000}
    text = lost._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
