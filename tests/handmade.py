"""Tiny hand-written tables with declared schemas; what is not given is empty, NULL or a neutral default."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

from shelfmark.schema import TABLES

DEFAULTS = {"media_side": "A", "availabletype_id": None}


class Handmade(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, **tables: list[dict]):
        self._spark, self._tables = spark, tables

    def __getitem__(self, name: str) -> DataFrame:
        schema = TABLES[name].schema
        rows = []
        for given in self._tables.get(name, []):
            unknown = set(given) - set(schema.fieldNames())
            assert not unknown, (name, unknown)
            row = []
            for field in schema.fields:
                neutral = None
                if not field.nullable:
                    neutral = DEFAULTS.get(field.name, "") if isinstance(field.dataType, StringType) else 0
                row.append(given.get(field.name, neutral))
            rows.append(tuple(row))
        return self._spark.createDataFrame(rows, schema)

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def rows(columns: str, *values) -> list[dict]:
    """``rows("id title", (1, "a"), (2, "b"))`` as dictionaries."""
    names = columns.split()
    return [dict(zip(names, v if isinstance(v, tuple) else (v,))) for v in values]
