"""Rule registry and the runs over it.

A rule yields findings ``(entry_id, title, details)`` with ``occurrences``, the number of times the
same finding stands. Row rules test single rows of a shared base; all chosen row rules of one base
run in a single pass. Built rules bring a plan of their own.

Fixed values: the warnings of the rules, here and in the modules beside this one, are the report's own texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ...session import remove, short_lived_shuffles

Tables = Mapping[str, DataFrame]
COLUMNS = ("rule", "entry_id", "title", "details", "warning", "occurrences")
FINISHED = "run string, number long"
FINDINGS = "rule string, entry_id long, title string, details string, warning string, occurrences long"


@dataclass(frozen=True)
class Rule:
    name: str
    warning: str
    build: Callable[[Tables], DataFrame] | None = None
    base: str | None = None
    test: Callable[[], Column] | None = None
    details: Callable[[], Column] | None = None

    @property
    def advisory(self) -> bool:
        return self.warning.startswith("**")


REGISTRY: dict[str, Rule] = {}
BASES: dict[str, Callable[[Tables], DataFrame]] = {}


def _register(rule: Rule) -> None:
    if rule.name in REGISTRY:
        raise ValueError(f"rule {rule.name} is registered twice")
    REGISTRY[rule.name] = rule


def base(name: str):
    """Register a base: one row per tested row, with ``entry_id`` and ``title`` among its columns."""
    def wrap(build: Callable[[Tables], DataFrame]):
        BASES[name] = build
        return build
    return wrap


def row_rule(name: str, warning: str, on: str, details: Callable[[], Column]):
    """Register a test on single rows of a base; the decorated function returns the condition."""
    def wrap(test: Callable[[], Column]):
        _register(Rule(name, warning, base=on, test=test, details=details))
        return test
    return wrap


def rule(name: str, warning: str):
    """Register a rule with a plan of its own; the decorated function returns its findings."""
    def wrap(build: Callable[[Tables], DataFrame]):
        _register(Rule(name, warning, build=build))
        return build
    return wrap


def finding(df: DataFrame, entry: str | None, title: str | None, details: Column | str | None,
            occurrences: Column | str | None = None) -> DataFrame:
    def column(c, kind):
        c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
        return c.cast(kind)

    count = F.lit(1) if occurrences is None else occurrences
    return df.select(
        column(entry, "long").alias("entry_id"), column(title, "string").alias("title"),
        column(details, "string").alias("details"), column(count, "long").alias("occurrences"),
    )


def titled(df: DataFrame, tables: Tables, on: str, how: str = "inner") -> DataFrame:
    """Add the entry's own id (``entry``) and ``title``."""
    names = tables["entries"].select(F.col("id").alias("entry"), "title")
    return df.join(names, df[on] == names["entry"], how)


def _labelled(df: DataFrame, rule_: Rule) -> DataFrame:
    return df.withColumn("rule", F.lit(rule_.name)).withColumn("warning", F.lit(rule_.warning)).select(*COLUMNS)


def run_rule(tables: Tables, name: str) -> DataFrame:
    rule_ = REGISTRY[name]
    if rule_.build is not None:
        return _labelled(rule_.build(tables), rule_)
    rows = BASES[rule_.base](tables).where(rule_.test())
    return _labelled(finding(rows, "entry_id", "title", rule_.details()), rule_)


def _one_pass(tables: Tables, name: str, rules: list[Rule]) -> DataFrame:
    """All row rules of one base: test every row once, keep the rules that fire."""
    hits = [
        F.when(r.test(), F.struct(
            F.lit(r.name).alias("rule"), r.details().cast("string").alias("details"),
            F.lit(r.warning).alias("warning"),
        ))
        for r in rules
    ]
    any_hit = reduce(Column.__or__, [r.test() for r in rules])
    rows = BASES[name](tables).where(any_hit).select(
        F.col("entry_id").cast("long").alias("entry_id"), "title", F.explode(F.array_compact(F.array(*hits))).alias("hit")
    )
    return rows.select(
        "hit.rule", "entry_id", "title", "hit.details", "hit.warning", F.lit(1).cast("long").alias("occurrences")
    )


def choose(rules: Iterable[str] | None, advisory: bool) -> list[Rule]:
    """Rules are chosen before planning: what is not asked for costs nothing."""
    if rules is not None:
        return [REGISTRY[r] for r in rules]
    return [r for r in REGISTRY.values() if advisory or not r.advisory]


def run_checks(tables: Tables, rules: Iterable[str] | None = None, advisory: bool = False) -> DataFrame:
    """Findings of the chosen rules in one frame; advisory rules are left out unless asked for."""
    chosen = choose(rules, advisory)
    parts = [run_rule(tables, r.name) for r in chosen if r.build is not None]
    for name in BASES:
        group = [r for r in chosen if r.base == name]
        if group:
            parts.append(_one_pass(tables, name, group))
    return reduce(DataFrame.unionByName, parts)


def sorted_findings(findings: DataFrame) -> DataFrame:
    """Report order: by entry, then details, unknowns first."""
    return findings.orderBy(F.col("entry_id").asc_nulls_first(), F.col("details").asc_nulls_first())


def store_findings(tables: Tables, path: str, rules: Iterable[str] | None = None, advisory: bool = False,
                   parallel: int = 4) -> None:
    """Write a findings table with one folder per rule, which readers see as a whole or not at all.

    Each run has a folder of its own and becomes the table by the one row that is added when all rules are through. A
    run that fails removes its folder and the findings before it stay; runs older than those go when the next one is through.
    Row rules are written base by base. Built rules are planned and run ``parallel`` at a time, so that the
    planning of one overlaps with the run of others. The shuffle files of a rule go with it: those of ``parallel``
    rules take disk at once, not those of all.
    """
    chosen = choose(rules, advisory)
    spark = tables["entries"].sparkSession
    run = uuid.uuid4().hex
    folder = f"{path}/runs/{run}"
    spark.createDataFrame([], FINISHED).write.mode("append").parquet(f"{path}/finished")

    def store(name: str) -> None:
        run_rule(tables, name).drop("rule").write.mode("overwrite").parquet(f"{folder}/rule={name}")

    try:
        with short_lived_shuffles(spark):
            spark.createDataFrame([], FINDINGS).write.partitionBy("rule").parquet(folder)
            for name in BASES:
                group = [r.name for r in chosen if r.base == name]
                if group:
                    run_checks(tables, group).write.partitionBy("rule").mode("append").parquet(folder)
            with ThreadPoolExecutor(parallel) as pool:
                list(pool.map(inheritable_thread_target(spark)(store), [r.name for r in chosen if r.build is not None]))
    except BaseException:
        remove(spark, folder)
        raise
    earlier = _last_runs(spark, path)
    number = earlier[0].number + 1 if earlier else 0
    spark.createDataFrame([(run, number)], FINISHED).coalesce(1).write.mode("append").parquet(f"{path}/finished")
    for old in earlier[1:]:
        remove(spark, f"{path}/runs/{old.run}")


def _last_runs(spark: SparkSession, path: str) -> list:
    """The two finished runs with the highest numbers, the latest first."""
    finished = spark.read.schema(FINISHED).parquet(f"{path}/finished")
    return finished.orderBy(F.desc("number"), F.desc("run")).limit(2).collect()


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    """The findings of the last run that went through; an error if there was none."""
    last = _last_runs(spark, path)
    if not last:
        raise ValueError(f"no run of the checks has finished in {path}")
    return spark.read.schema(FINDINGS).parquet(f"{path}/runs/{last[0].run}").select(*COLUMNS)
