"""Plans: no nested loops, no Python per row, pruned scans, pushed filters."""

from __future__ import annotations

import pytest
from compare import catalogue
from handmade import Handmade

import __spark_entry__ as entry
from shelfmark.plans import search
from shelfmark.plans.rules import REGISTRY, run_checks, run_rule

QUERIES = catalogue(entry.queries())
EAGER = {"findings_per_rule"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_nested_loop_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("NestedLoop", "Cartesian", "PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas"):
        assert word not in text


@pytest.mark.parametrize("name", list(REGISTRY))
def test_rules_stay_hash_or_merge_joins_without_broadcast(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(run_rule(Handmade(spark), name))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in text and "Cartesian" not in text


def test_gap_query_reads_two_columns(spark, sf_dir):
    text = QUERIES["lineitem_sequence_gaps"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text.replace("`", "")
    assert text.split("== Physical Plan ==")[1].split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def stored(spark, sf_dir, folder, *names):
    from shelfmark.fixtures.derived import DerivedCatalogue
    from shelfmark.sources.tables import StoredTables

    t = DerivedCatalogue(spark, sf_dir)
    for name in names:
        t[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    return StoredTables(spark, str(folder))


def test_one_pass_scans_each_table_once_and_pushes_filters(spark, sf_dir, tmp_path):
    t = stored(spark, sf_dir, tmp_path, "downloads", "entries", "genretypes")
    names = [r.name for r in REGISTRY.values() if r.base == "downloads"]
    text = plan(run_checks(t, names))
    assert len(names) == 12
    assert text.count("FileScan parquet") == 3
    tape = plan(run_rule(t, "source_code_filetype"))
    assert "StringContains(file_link,SourceCode)" in tape


def test_title_index_has_one_exchange(spark, sf_dir, tmp_path):
    t = stored(spark, sf_dir, tmp_path, "entries", "aliases", "contents")
    text = plan(search.titles(t))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan parquet") == 3


def test_tables_count_for_broadcasts_by_their_rows(spark, tmp_path):
    """A file that packs its rows twentyfold is above the limit by its rows, below it by its bytes."""
    spark.range(300_000).selectExpr("id", "concat('the same long title of many, ', id % 7) as title").write.parquet(f"{tmp_path}/names")
    spark.range(1000).selectExpr("id * 3 as id").write.parquet(f"{tmp_path}/few")
    names, few = spark.read.parquet(f"{tmp_path}/names"), spark.read.parquet(f"{tmp_path}/few")
    plan = few.join(names, "id", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    plan = names.join(few, "id", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # a table that is small as it stands


def test_tasks_read_bounded_parts(spark, tmp_path):
    """The parts that tasks read of files and of exchanges do not grow with the table."""
    spark.range(5_000_000).selectExpr("xxhash64(id) as k").coalesce(1).write.parquet(f"{tmp_path}/keys")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        keys = spark.read.parquet(f"{tmp_path}/keys")
        assert keys.rdd.getNumPartitions() > 2
        assert keys.repartition("k").rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
