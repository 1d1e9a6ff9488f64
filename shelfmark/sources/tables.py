"""Typed loading, key checks over loaded tables, and table writers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.membership import broken_references, missing_references, repeated_keys
from ..schema import TABLES, require_columns
from ..session import remove


class StoredTables(Mapping[str, DataFrame]):
    """Declared tables under one folder, read with their declared columns when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return require_columns(name, self._spark.read.parquet(f"{self._folder}/{name}"))

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


class DatabaseTables(StoredTables):
    """The same tables out of a database of the session catalogue, such as a second, foreign one."""

    def __getitem__(self, name: str) -> DataFrame:
        return require_columns(name, self._spark.table(f"{self._folder}.{name}"))


def apply_schema(
    df: DataFrame, schema: StructType, widths: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Text columns to declared types: ``(typed rows, rejected rows with their reasons)``.

    A row is rejected when a value does not convert, is too long for its declared width, or is missing
    where the column may not be NULL.
    """
    widths = widths or {}
    problems = []
    for field in schema.fields:
        raw = F.col(field.name)
        if not isinstance(field.dataType, StringType):
            broken = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
            problems.append(F.when(broken, F.lit(f"{field.name}: not {field.dataType.simpleString()}")))
        if not field.nullable:
            problems.append(F.when(raw.isNull(), F.lit(f"{field.name}: missing")))
        if field.name in widths:
            problems.append(F.when(F.char_length(raw) > widths[field.name], F.lit(f"{field.name}: too long")))
    judged = df.withColumn("problems", F.array_compact(F.array(*problems)))
    typed = judged.where(F.size("problems") == 0).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    return typed, judged.where(F.size("problems") > 0)


def check_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Values of a primary or unique key that occur more than once."""
    return repeated_keys(df, list(key))


def check_references(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Rows of a table that point at nothing: ``(column, value, occurrences)`` per declared reference."""
    out = None
    for column, parent in TABLES[name].references.items():
        lost = missing_references(tables[name].select(column), column, tables[parent], TABLES[parent].key[0])
        part = lost.select(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), "occurrences")
        out = part if out is None else out.unionByName(part)
    return out


def check_all_references(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Rows of the named tables that point at nothing: ``(tab, col, value, occurrences)``, one exchange for each parent."""
    children: dict[str, dict[str, list[str]]] = {}
    for name in names:
        for column, parent in TABLES[name].references.items():
            children.setdefault(parent, {}).setdefault(name, []).append(column)
    parts = [
        broken_references({n: (tables[n], columns) for n, columns in used.items()}, tables[parent], TABLES[parent].key[0])
        for parent, used in children.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def store_slices(df: DataFrame, path: str, column: str) -> None:
    """Write a table with one folder for each value of ``column``."""
    df.write.partitionBy(column).mode("overwrite").parquet(path)


def overwrite_slice(fresh: DataFrame, path: str, column: str, value: object) -> None:
    """Put ``fresh`` in the place of one slice of a table written by :func:`store_slices`; files of others stay as they are.

    A slice that gets no rows is removed. ``fresh`` is checked to hold the slice alone before anything is written.
    """
    spark = fresh.sparkSession
    stored = spark.read.parquet(path)
    held = fresh.select(*[
        F.when(F.col(c).eqNullSafe(F.lit(value)), F.col(c)).otherwise(F.raise_error(F.lit(f"row of another slice of {column}")))
        .cast(stored.schema[c].dataType).alias(c) if c == column else F.col(c).cast(stored.schema[c].dataType).alias(c)
        for c in stored.columns
    ])
    if held.isEmpty():
        old = stored.where(F.col(column).eqNullSafe(F.lit(value))).select("_metadata.file_path").first()
        if old:
            file = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(old.file_path))
            remove(spark, file.getParent().toString())
        return
    held.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def rebuild(df: DataFrame, path: str, sort: Sequence[str]) -> None:
    """Write a table anew, range-partitioned and sorted by its lookup columns."""
    df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)


def export_tables(tables: Mapping[str, DataFrame], path: str, rows_per_file: int) -> None:
    """One folder per table with at most ``rows_per_file`` rows in each file."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/{name}")


def constant_dim(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small table of fixed values, shipped to every task: its size is the length of ``rows``."""
    return F.broadcast(spark.createDataFrame(list(rows), ddl))
