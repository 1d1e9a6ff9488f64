"""Substring lookups by an inverted index of character grams: a word reads one posting list, not the whole index.

Names are folded (lower case, accents off) and cut to their distinct grams of one to three characters. Each gram has
its list of names, dealt to buckets by the gram's checksum and sorted, so a lookup opens one bucket and reads the
row groups of one gram. Of the grams of a word the rarest is read, and every name in its list is checked in full, by the
same collation as without an index. Names that hold characters the folding does not know are in one more list,
which every lookup reads: the collation may match them in ways grams do not show.
"""

from __future__ import annotations

import unicodedata
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Index columns are matched without regard to case and accents.
LOOKUP_COLLATION = "UNICODE_CI_AI"
LONGEST = 3
BUCKETS = 256
# The gram of names with characters that are not folded to printable ASCII.
ODD = ""


def _accents() -> dict[str, str]:
    """Lower-case Latin letters with accents and the ASCII letters they stand on, by the rule of decomposition."""
    pairs = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(0xC0, 0x250) if chr(c).islower()}
    return {letter: base for letter, base in pairs.items() if base.isascii()}


_FOLDED = _accents()


def folded(text: Column | str) -> Column:
    return F.translate(F.lower(text), "".join(_FOLDED), "".join(_FOLDED.values()))


def fold_word(word: str) -> str | None:
    """The folded word; None if it holds characters that grams do not cover."""
    out = "".join(_FOLDED.get(c, c) for c in word.lower())
    return out if out and all(" " <= c <= "~" for c in out) else None


def bucket_of(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def postings(index: DataFrame, text: str, ident: str) -> DataFrame:
    """``(bucket, gram, text, ident)``: every name under each of its distinct grams; NULL names have none."""
    name = F.col("_folded")

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(name) - n + 1)
        return F.when(F.length(name) >= n, F.transform(starts, lambda i: F.substr(name, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    odd = F.when(F.rlike(name, F.lit(r"[^ -~]")), F.array(F.lit(ODD))).otherwise(F.array().cast("array<string>"))
    every = F.array_distinct(F.concat(odd, *[grams(n) for n in range(1, LONGEST + 1)]))
    cut = index.where(F.col(text).isNotNull()).select(text, ident, folded(text).alias("_folded")).select(
        text, ident, F.explode(every).alias("gram")
    )
    return cut.select((F.crc32(F.col("gram").cast("binary")) % BUCKETS).cast("int").alias("bucket"), "gram", text, ident)


def store_grams(index: DataFrame, text: str, ident: str, path: str) -> None:
    """Write the lists and their lengths: ``<path>/lists`` and ``<path>/counts``, both dealt by bucket.

    Ranges run over bucket, gram and name, so the list of a frequent gram is written by many tasks.
    """
    spark = index.sparkSession
    rows = postings(index, text, ident)
    order = ["bucket", "gram", text, ident]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/lists")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/lists")
    counts = stored.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("names"))
    counts.repartitionByRange("bucket", "gram").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")


def _exact(names: DataFrame, text: str, word: str) -> DataFrame:
    return names.where(F.contains(F.collate(F.col(text), LOOKUP_COLLATION), F.lit(word)))


def holding(spark: SparkSession, path: str, text: str, word: str) -> DataFrame | None:
    """Index rows whose name holds the word, from the stored lists; None if the word needs the index itself.

    Only the lengths of the word's own lists come to the driver, one row a gram.
    """
    plain = fold_word(word)
    if plain is None:
        return None
    size = min(len(plain), LONGEST)
    grams = sorted({plain[i:i + size] for i in range(len(plain) - size + 1)})
    buckets = sorted({bucket_of(g) for g in grams})
    counts = spark.read.parquet(f"{path}/counts").where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    lengths = {r["gram"]: r["names"] for r in counts.collect()}
    # A gram without a list: no folded name holds the word.
    read = [ODD] + ([min(grams, key=lambda g: (lengths[g], g))] if len(lengths) == len(grams) else [])
    lists = spark.read.parquet(f"{path}/lists").where(F.col("bucket").isin([bucket_of(g) for g in read]) & F.col("gram").isin(read))
    return _exact(lists.drop("bucket", "gram"), text, word).distinct()
