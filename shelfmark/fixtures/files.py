"""Text files in the layouts the import jobs read, written from the derived catalogue.

The selects are read by Spark and DuckDB alike; names hold Latin-2 letters and lines are planted that
must be skipped, cut or reported.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.imports.listings import ENCODING, MIRROR_ROOT
from ..session import new_path
from ..sources.text_files import write_lines
from .derived import DEFINITIONS, spark_sql

MAP_LIST = """
    select id, 'mapa č'||cast(id as string)||case when id%3=0 then 'ž' else '' end||'.png' as file_image,
      case when id%7=0 then '' when id%11=0 then 'x'||cast(entry_id as string)
           when id%13=0 then cast(entry_id+7000000 as string) else cast(entry_id as string) end as entry
    from cat_downloads"""
_LISTED = """
    select id as n, file_link, file_size+1 as file_size, file_md5 from cat_downloads where file_link not like 'http%'
    union all select 1000000000+id, file_link, file_size+1, file_md5 from cat_files
    union all select 2000000000+id, file_link, cast(id%1000 as int), md5(file_link) from cat_scraps
      where file_link is not null
    union all select 3000000000+id, '/zxdb/nové/'||cast(id as string)||'.tap', cast(id%100 as int),
      'ffffffffffffffffffffffffffffffff' from cat_files"""
# A share of the links is lost, so that their rows are missing in the listing. Some files are larger than an
# integer holds, and some sizes are no numbers.
LISTING = f"""
    select n, case when right(md5(file_link),1) in ('0','1') then file_link||'.lost' else file_link end as file_link,
      case when n%89=0 then cast(3000000000+n as string) when n%83=0 then 'n/a' else cast(file_size as string) end as file_size, file_md5
    from ({_LISTED}) l"""
MIRROR = f"""
    select n, case when file_link like '/pub/%' then '{MIRROR_ROOT}'||substr(file_link, 6)
                   else '{MIRROR_ROOT}sinclair/č'||substr(file_link, 2) end as file_link, file_size
    from ({LISTING}) l"""


def _select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [n for n in DEFINITIONS if re.search(rf"\bcat_{n}\b", sql)]
    tables = ", ".join(f"cat_{n} as ({spark_sql(n, sf_dir)})" for n in used)
    return spark.sql(f"with {tables} {sql}")


def _write(lines: DataFrame, order: list[str], label: str) -> str:
    path = new_path(lines.sparkSession, label)
    placed = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    write_lines(placed.select("line"), path, ENCODING)
    return path


def write_map_list(spark: SparkSession, sf_dir: str) -> str:
    # 43 backslashes and a separator: 21 of them are text, the last one takes the separator along.
    fixed = {"title": "\\" * 43 + ";of č", "file_res": "256x192", "file_zip": "map.zip", "author": "čeněk"}
    rows = _select(spark, sf_dir, MAP_LIST)
    order = ("title", "file_image", "file_res", "", "", "", "", "", "", "file_zip", "", "author", "entry", "", "")
    fields = [F.col(c) if c in rows.columns else F.lit(fixed.get(c, "")) for c in order]
    return _write(rows.select("id", F.concat_ws(";", *fields).alias("line")), ["id"], "maps")


def write_manifest(spark: SparkSession, sf_dir: str) -> str:
    rows = _select(spark, sf_dir, LISTING)
    line = F.concat_ws(
        "\t", F.col("file_size").cast("string"), "file_link", F.concat(F.col("file_md5"), F.lit("  "), F.col("file_link"))
    )
    return _write(rows.select("n", line.alias("line")), ["n"], "manifest")


def write_mirror(spark: SparkSession, sf_dir: str) -> str:
    rows = _select(spark, sf_dir, MIRROR)
    size = F.lpad(F.col("file_size").cast("string"), 11, " ")
    line = F.concat(size, F.rpad(F.lit(" 2017-06-01"), 11, " "), F.lit(" 12:00"), F.col("file_link"), F.lit("\tseen"))
    edges = spark.createDataFrame(
        [(-3, "Listing of"), (-2, "the mirror"), (-1, "=" * 60), (2**62, "-" * 60), (2**62 + 1, "the end")],
        "n long, line string",
    )
    return _write(rows.select("n", line.alias("line")).unionByName(edges), ["n"], "mirror")


def _literal(column: str, kind: str, raw: bool = False) -> Column:
    """A value as it stands in a dump; ``raw`` leaves newlines as they are and doubles quotes."""
    value = F.col(column).cast("string")
    if kind == "string":
        escapes = (("\\", "\\\\"), ("'", "''" if raw else "\\'"), ("\n", "\n" if raw else "\\n"), ("\r", "\\r"), ("\t", "\\t"))
        for plain, escaped in escapes:
            value = F.replace(value, F.lit(plain), F.lit(escaped))
        value = F.concat(F.lit("'"), value, F.lit("'"))
    return F.coalesce(value, F.lit("NULL"))


# Rows of one batch, and the layouts batches take in turn.
DUMP_BATCH, DUMP_LAYOUTS = 100, 5


def write_dump(tables: dict[str, DataFrame]) -> str:
    """Dump text in five layouts: a tuple per line, two tuples per line, a whole statement per row, a head with a database
    and tuples over several lines, and texts with raw newlines.

    Every batch of rows is one statement, except in the third layout; some lines are planted that are no tuples, and
    heads that cannot be read.
    """
    spark = next(iter(tables.values())).sparkSession
    lines = spark.createDataFrame(
        [("", 0, 0, 0, "CREATE DATABASE IF NOT EXISTS `catalogue`;"), ("", 0, 0, 1, "USE `catalogue`;"),
         ("", 0, 0, 2, "CREATE TABLE `x` ("), ("", 0, 0, 3, "  `id` int(11) NOT NULL"), ("", 0, 0, 4, ") ENGINE=InnoDB;")],
        "tab string, batch long, kind int, n long, line string",
    )
    for name, df in tables.items():
        columns = ", ".join(f"`{c}`" for c in df.columns)
        insert = f"INSERT INTO `{name}` ({columns}) VALUES"
        spread_ = f"INSERT INTO `catalogue`.`{name}`\n  (" + ",\n   ".join(f"`{c}`" for c in df.columns) + ")\nVALUES"
        first = F.col(df.columns[0]).cast("long")
        batch = F.floor(F.col(df.columns[0]) / DUMP_BATCH)
        tuple_of = lambda by, raw=False: F.concat(
            F.lit("("), F.concat_ws(by, *[_literal(c, k, raw) for c, k in df.dtypes]), F.lit(")")
        )
        layout = F.pmod(batch, F.lit(DUMP_LAYOUTS))
        tuple_ = F.when(layout == 3, tuple_of(",\n    ")).when(layout == 4, tuple_of(", ", True)).otherwise(tuple_of(", "))
        rows = df.select(
            F.lit(name).alias("tab"), batch.alias("batch"), layout.alias("layout"), F.lit(1).alias("kind"), first.alias("n"),
            tuple_.alias("t"),
        )
        alone = rows.where("layout in (0, 3, 4)").withColumn("line", F.concat(F.lit("\t"), "t", F.lit(",")))
        # Two neighbours share a line; which ones follows from their number alone.
        pairs = rows.where("layout = 1").groupBy("tab", "batch", "kind", F.expr("n div 2 * 2").alias("n")).agg(
            F.concat(F.array_join(F.sort_array(F.collect_list("t")), ","), F.lit(",")).alias("line")
        )
        whole = rows.where("layout = 2").withColumn("line", F.concat(F.lit(insert + " "), "t", F.lit(";")))

        def planted(kind: int, n: int, line: str) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.lit(n).cast("long").alias("n"), F.lit(line).alias("line"))

        batches = rows.select("tab", "batch", "layout").distinct()
        around = F.when(F.col("layout") < 2, F.array(
            planted(0, 0, insert), planted(2, 0, "\t(1, 'no end"), planted(2, 1, "\t(1);")
        )).when(F.col("layout") == 3, F.array(
            planted(0, 0, spread_), planted(2, 0, ";"), planted(2, 1, f"INSERT INTO `catalogue`.`{name}` SET `id` = 1;")
        )).when(F.col("layout") == 4, F.array(planted(0, 0, insert), planted(2, 0, ";")))
        heads = batches.where(around.isNotNull()).select("tab", "batch", F.explode(around).alias("x")).select("tab", "batch", "x.*")
        for part in (alone, pairs, whole, heads):
            lines = lines.unionByName(part.select(*lines.columns))
    path = new_path(spark, "dump")
    # Rows with one number keep their lines together.
    each = lines.select("tab", "batch", "kind", "n", F.col("line").alias("whole"), F.posexplode(F.split("line", "\n")).alias("at", "line"))
    placed = each.repartitionByRange("tab", "batch").sortWithinPartitions("tab", "batch", "kind", "n", "whole", "at")
    write_lines(placed.select("line"), path)
    return path
