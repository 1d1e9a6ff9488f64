"""Token counts of documents in flat token files without an index.

A file is a run of fixed-width token ids in which each document ends with a separator. Blocks of a file
are searched for separators on their own, each as one vectorised comparison; a prefix scan over block
summaries then tells how many documents ended before a block and where the open one began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import vocabulary
from .files import map_file, write_file

SEPARATOR = 50_256
WIDTH = "<u2"
# Tokens of one block, and blocks whose summaries are scanned together.
BLOCK = 1 << 20
SPAN = 4096


def write_tokens(docs: DataFrame, folder: str, path: str, pattern: str, ident: str = "doc_id", text: str = "text",
                 separator: int = SEPARATOR, width: str = WIDTH) -> DataFrame:
    """One flat file per partition of ``docs``; returns ``(file, tokens, ordinal, ident)``, a row per document.

    The files hold nothing but ids; the rows tell which document went where, and must be stored before the
    files are read. A null or empty text is a separator alone.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path, pattern)
        if max(vocab.tokens) >= separator or separator > np.iinfo(width).max:
            raise ValueError("the separator is an id of the vocabulary or too large for the files")
        end = np.array([separator], width).tobytes()
        name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
        parts, idents, size = [], [], 0
        for frame in batches:
            idents.append(frame["ident"])
            for value in frame["text"]:
                ids = np.frombuffer(vocab.encode(value), "<u4").astype(width)
                size += len(ids) + 1
                parts += (ids.tobytes(), end)
        if idents:
            write_file(folder, name, parts)
            out = pd.concat(idents, ignore_index=True).to_frame("ident")
            yield out.assign(file=name, tokens=size, ordinal=np.arange(len(out)))[["file", "tokens", "ordinal", "ident"]]

    rows = docs.select(F.col(ident).cast("string").alias("ident"), F.col(text).alias("text"))
    found = rows.mapInPandas(run, "file string, tokens long, ordinal long, ident string")
    return found.withColumn("ident", F.col("ident").cast(docs.schema[ident].dataType))


def _search(folder: str, separator: int, width: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = np.dtype(width).itemsize
        for frame in batches:
            rows = []
            for file, block, start, count in zip(frame["file"], frame["block"], frame["start"], frame["count"]):
                ids = map_file(folder, file, width, int(start) * size, int(count))
                rows.append((file, block, start, count, (np.flatnonzero(ids == separator) + start).tolist()))
            yield pd.DataFrame(rows, columns=["file", "block", "start", "count", "ends"])

    return run


def token_counts(files: DataFrame, folder: str, separator: int = SEPARATOR, width: str = WIDTH, block: int = BLOCK) -> DataFrame:
    """``(file, ordinal, start, n_tokens, closed)`` of each document of the files ``(file, tokens)``.

    ``start`` and ``n_tokens`` count ids, separators left out. Two separators in a row close an empty
    document. Tokens after the last separator of a file are one more document that is not ``closed``. Empty files
    have no documents.
    """
    number = F.ceil(F.col("tokens") / block).cast("int")
    blocks = files.where("tokens > 0").select("file", "tokens", F.explode(F.sequence(F.lit(0), number - 1)).alias("block"))
    start = F.col("block").cast("long") * block
    blocks = blocks.select("file", "block", start.alias("start"), F.least(F.lit(block).cast("long"), F.col("tokens") - start).alias("count"))
    found = blocks.repartition("file", "block").mapInPandas(
        _search(folder, separator, width), "file string, block int, start long, count long, ends array<long>"
    )
    # Position after the last separator, and number of separators, of all earlier blocks.
    found = found.withColumn("span", F.floor(F.col("block") / SPAN)).withColumn("open", F.array_max("ends") + 1)
    spans = found.groupBy("file", "span").agg(F.max("open").alias("open"), F.sum(F.size("ends")).alias("ended"))
    earlier = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(
        F.col("file").alias("f"), F.col("span").alias("s"), F.max("open").over(earlier).alias("open_before"),
        F.sum("ended").over(earlier).alias("ended_before"), (F.lead("span").over(Window.partitionBy("file").orderBy("span")).isNull()).alias("last"),
    )
    inside = Window.partitionBy("file", "span").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.withColumn("open_here", F.max("open").over(before)).withColumn(
        "ended_here", F.sum(F.size("ends")).over(before)
    ).withColumn("end_of_span", F.lead("block").over(inside).isNull())
    joined = scanned.join(carried, (F.col("file") == F.col("f")) & (F.col("span") == F.col("s")))
    first = F.coalesce("open_here", "open_before", F.lit(0).cast("long"))
    total = F.col("start") + F.col("count")
    # The last block of a file also closes what has no separator.
    rest = F.col("last") & F.col("end_of_span") & (F.coalesce("open", first) < total)
    ends = F.when(rest, F.concat("ends", F.array(total))).otherwise(F.col("ends"))
    starts = F.concat(F.array(first), F.transform(F.col("ends"), lambda e: e + 1))
    documents = joined.select(
        "file", (F.coalesce("ended_before", F.lit(0)) + F.coalesce("ended_here", F.lit(0))).alias("ended"),
        F.size("ends").alias("separators"), starts.alias("starts"), ends.alias("ends"),
    )
    each = documents.select("file", "ended", "separators", "starts", F.posexplode("ends").alias("at", "end"))
    begin = F.get("starts", F.col("at"))
    return each.select(
        "file", (F.col("ended") + F.col("at")).alias("ordinal"), begin.alias("start"),
        (F.col("end") - begin).alias("n_tokens"), (F.col("at") < F.col("separators")).alias("closed"),
    )
