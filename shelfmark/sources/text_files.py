"""Readers for delimited, fixed-width and plain text files that keep the order of lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.groups import first_by

# Position of a line: file, split of the file, place inside the split. Splits are read in parallel.
LINE_ORDER = ["_file", "_block", "_pos"]


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", raw: bool = False) -> DataFrame:
    """``(_file, _block, _pos, value)``: every line with its place, decoded from ``encoding``.

    Lines end at a newline only; a carriage return before it is dropped unless ``raw``, one inside a line stays.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"), "value",
    )
    if encoding.upper().replace("-", "") != "UTF8":
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return lines if raw else lines.withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def unescape(column: Column) -> Column:
    """Undo backslash escapes of text exports; a lone ``\\N`` is NULL."""
    mark = "\u0001"
    out = F.replace(column, F.lit("\\\\"), F.lit(mark))
    for escaped, plain in (("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")):
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    out = F.replace(F.regexp_replace(out, r"\\(.)", "$1"), F.lit(mark), F.lit("\\"))
    changed = F.when(column.contains("\\"), out).otherwise(column)
    return F.when(column != F.lit("\\N"), changed)


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";",
                   encoding: str = "UTF-8") -> DataFrame:
    """Text columns of a file without quoting; a backslash escapes the separator. Keeps the line place.

    Missing trailing fields are NULL, surplus ones are ignored.
    """
    # Each field with the separator before it; a backslash takes the next character along, however many there are.
    mark = _quoted(sep)
    field = rf"{mark}((?:[^\\{mark}]++|\\[\s\S]|\\\z)*+)"
    fields = F.regexp_extract_all(F.concat(F.lit(sep), F.col("value")), F.lit(field), F.lit(1))
    parts = read_lines(spark, path, encoding).select(*LINE_ORDER, fields.alias("_fields"))
    return parts.select(
        *[unescape(F.get("_fields", F.lit(i))).alias(c) for i, c in enumerate(columns)], *LINE_ORDER
    )


def _quoted(sep: str) -> str:
    return {"\t": r"\t"}.get(sep, f"\\{sep}")


def read_fixed_width(spark: SparkSession, path: str, cuts: Mapping[str, tuple[int, int | None]],
                     encoding: str = "UTF-8") -> DataFrame:
    """Trimmed cuts ``name: (first, length)`` of each line, up to its first tab. Keeps the line place."""
    line = F.substring_index("value", "\t", 1)
    return read_lines(spark, path, encoding).withColumn("value", line).select(
        *[
            F.trim(F.substring("value", first, 2**31 - 1 if length is None else length)).alias(name)
            for name, (first, length) in cuts.items()
        ],
        *LINE_ORDER,
    )


def drop_edges(lines: DataFrame, head: int, tail: int) -> DataFrame:
    """Without the first ``head`` and the last ``tail`` lines; only that many places are looked up."""
    order = [F.col(c) for c in LINE_ORDER]
    first = lines.select(*LINE_ORDER).orderBy(*order).limit(head)
    last = lines.select(*LINE_ORDER).orderBy(*[c.desc() for c in order]).limit(tail)
    return lines.join(F.broadcast(first.unionByName(last)), LINE_ORDER, "left_anti")


def first_loaded(rows: DataFrame, key: str) -> DataFrame:
    """Of rows with the same key the first by line place stays; the place is dropped."""
    return first_by(rows, [key], LINE_ORDER).drop(*LINE_ORDER)


def write_lines(lines: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write a single text column as lines in ``encoding``, in the order of the partitions."""
    (
        lines.write.mode("overwrite").option("encoding", encoding).option("sep", "\u0001").option("quote", "")
        .option("escape", "").option("escapeQuotes", "false").option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false").option("emptyValue", "").csv(path)
    )
