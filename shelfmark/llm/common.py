"""What the operators share: settings, code on the executors, folds, words."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import apply_settings

# What separates words.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of one Arrow batch. A batch of documents stays small even where texts are long.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Settings and code that the operators need; safe to call again."""
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_code(spark)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, so that their Python workers can import what tasks call."""
    context = spark.sparkContext
    if any(name.startswith("shelfmark-code-") for name in context._python_includes):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    handle, path = tempfile.mkstemp(prefix="shelfmark-code-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("shelfmark", os.path.relpath(full, top)))
    context.addPyFile(path)


def fold(ident: Column | str, parts: int) -> Column:
    """The fold 0..parts-1 of a document by its id as text; a null id counts as an empty text."""
    ident = F.col(ident) if isinstance(ident, str) else ident
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % parts


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The given names, changed where the frame already has a column of that name."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def words_of(text: str | None) -> list[bytes]:
    """Lower-case (A-Z only) words of a text as UTF-8; bytes.split() cuts exactly at the six blanks."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def count_words(text: Column | str) -> Column:
    """Number of words of a text, 0 for null, without leaving the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sorted_groups(batches: Iterator, key: str, rows: int) -> Iterator:
    """Join sorted batches to frames of about ``rows`` rows that never split the rows of one key."""
    import pandas as pd

    held: list = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        if count < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        keys = frame[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield frame.iloc[:cut]
        held, count = [frame.iloc[cut:]], len(frame) - cut
    if held:
        yield pd.concat(held, ignore_index=True)


def merged_labels(size: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index of each of ``size`` points over the given links (and earlier labels)."""
    labels = np.arange(size) if labels is None else labels
    while len(left):
        a, b = labels[left], labels[right]
        open_ = a != b
        if not open_.any():
            break
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(labels, high, low)
        while True:
            nearer = labels[labels]
            if (nearer == labels).all():
                break
            labels = nearer
    return labels
