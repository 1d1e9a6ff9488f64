"""Severity of toxic texts by cumulative-link ordinal regression.

Grades are ordered: 0 harmless, 1 toxic, 2 severely toxic. Labels tell toxic texts from others only; of
the toxic ones, those that hold more telling words than the median of them are the severe ones. The
chance that a grade is above k is the logistic function of ``x.w - threshold[k]``: all thresholds share
one weight for each word, and only the thresholds differ. A text's features are the words it holds and the first letters of
these words, each once: insults are inflected.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The bounded training sample; in how many of its texts a feature must occur, and by how many standard errors its
# frequencies in toxic and harmless texts must differ.
SAMPLE_DOCS = 10_000
LEAST_TEXTS = 5
GRADES = 3
LEAST_ERRORS = 4.0
PENALTY = 1e-5
ROUNDS = 400
# Bytes of the beginnings of words.
STEMS = (4, 5, 6)
# Words are runs of ASCII letters and digits and of bytes beyond ASCII, letters in lower case.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def features_of(text: str | None) -> set[bytes]:
    """Words, and beginnings of longer words with a hyphen."""
    words = set(text.encode("utf-8", "replace").translate(_KEPT).split()) if text else set()
    out = set(words)
    for size in STEMS:
        out.update([w[:size] + b"-" for w in words if len(w) > size])
    return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(texts: list[str], toxic: np.ndarray, least: int, chunk: int = 500) -> set[int]:
    """Hashes of the features that occur in ``least`` texts and tell toxic texts from others.

    Only hashes and counts are held, merged chunk by chunk: the features of all texts together are many
    times the texts.
    """
    known = [np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)]
    for at in range(0, len(texts), chunk):
        own = [np.fromiter(map(xxhash.xxh64_intdigest, f), np.uint64, len(f)) for f in map(features_of, texts[at:at + chunk])]
        bad = np.repeat(toxic[at:at + chunk].astype(np.int64), [len(x) for x in own])
        keys = np.concatenate([known[0], *own])
        counts, among = np.concatenate([known[1], np.ones(len(bad), np.int64)]), np.concatenate([known[2], bad])
        order = np.argsort(keys)
        keys = keys[order]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
        known = [keys[heads], *(np.add.reduceat(x[order], heads) if len(heads) else x for x in (counts, among))]
    keys, counts, among = known
    sides = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    share = counts / sum(sides)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / sides[0] + 1 / sides[1]))
    apart = np.abs(among / sides[0] - (counts - among) / sides[1])
    return set(keys[(counts >= least) & (apart >= LEAST_ERRORS * error)].tolist())


def descend(loss: Callable, point: np.ndarray, memory: int = 10) -> np.ndarray:
    """A minimum of a smooth function by limited-memory quasi-Newton steps (L-BFGS)."""
    value, gradient = loss(point)
    past: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=memory)
    for _ in range(ROUNDS):
        way, shares = -gradient, []
        for step, turn, rho in reversed(past):
            shares.append(rho * (step @ way))
            way = way - shares[-1] * turn
        if past:
            step, turn, rho = past[-1]
            way = way / (rho * (turn @ turn))
        for (step, turn, rho), share in zip(past, reversed(shares)):
            way = way + step * (share - rho * (turn @ way))
        slope, length = gradient @ way, 1.0 if past else 1.0 / max(np.abs(gradient).max(), 1.0)
        while True:
            trial = point + length * way
            new, turned = loss(trial)
            if new <= value + 1e-4 * length * slope or length < 1e-9:
                break
            length /= 2
        step, turn = trial - point, turned - gradient
        if length < 1e-9 or value - new < 1e-9 * max(abs(value), 1e-6):
            break
        if step @ turn > 1e-12:
            past.append((step, turn, 1 / (step @ turn)))
        point, value, gradient = trial, new, turned
    return point


@dataclass
class SeverityModel:
    words: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    @classmethod
    def fit(cls, texts: list[str], toxic: np.ndarray, least: int = LEAST_TEXTS, penalty: float = PENALTY) -> SeverityModel:
        chosen = telling(texts, toxic, least)
        bags = [sorted(w for w in features_of(t) if xxhash.xxh64_intdigest(w) in chosen) for t in texts]
        words = {w: i for i, w in enumerate(sorted({w for bag in bags for w in bag}))}
        rows = [np.array([words[w] for w in bag], np.int64) for bag in bags]
        sizes = np.array([len(r) for r in rows], np.int64)
        columns = np.concatenate(rows) if rows else np.empty(0, np.int64)
        lines = np.repeat(np.arange(len(rows)), sizes)
        grades = toxic.astype(np.int64)
        if toxic.any():
            grades[toxic & (sizes > np.median(sizes[toxic]))] = 2
        tops = np.arange(GRADES - 1)
        above = (grades[:, None] > tops).astype(float)
        share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4) if len(rows) else np.full(GRADES - 1, 0.5)
        # Thresholds as a first one and positive steps, so that they stay in order.
        first = -np.log(share[0] / (1 - share[0]))
        steps = np.log(np.maximum(np.diff(-np.log(share / (1 - share))), 1e-2))
        point = np.concatenate((np.zeros(len(words)), [first], steps))

        def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
            weights, thresholds = cls._parts(point, len(words))
            x = np.bincount(lines, weights[columns], len(rows))
            chance, slope = cls._slopes(x, thresholds, grades)
            by_row = slope.sum(axis=1) / len(rows)
            later = -(slope.sum(axis=0) / len(rows))[::-1].cumsum()[::-1]
            # A grade that the sample lacks must not send its threshold away for ever.
            free = np.concatenate((weights, [0.0], point[len(words) + 1:]))
            gradient = np.concatenate((
                np.bincount(columns, by_row[lines], len(words)), later[:1], later[1:] * np.exp(point[len(words) + 1:])
            ))
            return -np.log(chance).mean() + penalty / 2 * free @ free, gradient + penalty * free

        if rows:
            point = descend(loss, point)
        weights, thresholds = cls._parts(point, len(words))
        return cls(words, weights, thresholds)

    @staticmethod
    def _parts(point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        return point[:size], point[size] + np.concatenate(([0.0], np.exp(point[size + 1:]).cumsum()))

    @staticmethod
    def _slopes(x: np.ndarray, thresholds: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of each text's grade, and the slope of the loss by ``x - threshold``, texts x thresholds.

        The chance of a grade is the difference of two neighbouring curves; each curve pulls by its slope
        over that difference.
        """
        curve = _logistic(x[:, None] - thresholds)
        padded = np.concatenate((np.ones((len(x), 1)), curve, np.zeros((len(x), 1))), axis=1)
        rows = np.arange(len(x))
        chance = np.maximum(padded[rows, grades] - padded[rows, grades + 1], 1e-12)
        steep = curve * (1 - curve)
        out = np.zeros_like(curve)
        up, down = grades > 0, grades < len(thresholds)
        out[rows[up], grades[up] - 1] -= steep[rows[up], grades[up] - 1] / chance[up]
        out[rows[down], grades[down]] += steep[rows[down], grades[down]] / chance[down]
        return chance, out

    def chances(self, texts: list[str | None]) -> np.ndarray:
        """Chance that a text's grade is above 0, above 1, ..., texts x thresholds."""
        known = self.words.keys()
        x = np.array([sum(self.weights[self.words[w]] for w in sorted(features_of(t) & known)) for t in texts], float)
        return _logistic(x[:, None] - self.thresholds)


def labelled(labels: DataFrame, ident: str = "doc_id") -> DataFrame:
    """``(ident, toxic)`` of the documents with a toxic label."""
    return labels.where("toxic is not null").select(ident, (F.col("toxic") > 0).alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> SeverityModel:
    """Fit on the ``sample`` labelled documents whose ids have the smallest hashes.

    The sample is taken after ids and texts have met, so labels without a document take no place in it. An id counts
    once, toxic if any of its labels says so; of several texts of an id the one with the smallest hash counts. What comes
    to the driver is each text's distinct words, whatever its length: features follow from them alone.
    """
    judged = labels.where(F.col(ident).isNotNull()).groupBy(ident).agg(F.max("toxic").alias("toxic"))
    hashes = docs.where(F.col(text).isNotNull()).groupBy(ident).agg(F.min(F.xxhash64(text)).alias("_hash"))
    chosen = hashes.join(judged, ident).orderBy(F.xxhash64(ident), ident).limit(sample)
    rows = docs.select(ident, F.col(text).alias("_text"), F.xxhash64(text).alias("_hash")).join(F.broadcast(chosen), [ident, "_hash"])
    words = F.array_join(F.array_distinct(F.split(F.lower(F.regexp_replace("_text", r"[\x00-\x7F&&[^A-Za-z0-9]]+", " ")), " ")), " ")
    sampled = rows.dropDuplicates([ident, "_hash"]).select(words.alias("words"), "toxic").toPandas().sort_values(["words", "toxic"])
    return SeverityModel.fit(sampled["words"].tolist(), sampled["toxic"].to_numpy(bool))


def severity(spark: SparkSession, text: Column | str, model: SeverityModel) -> Column:
    """Struct ``(severity, grade, toxic)`` of a whole text.

    ``severity`` is the expected grade, ``grade`` the most likely one (the lower of equals), ``toxic`` whether
    a grade above 0 is more likely than not. A null, empty or wordless text has the severity of no words at all.
    """
    shared = spark.sparkContext.broadcast(model)  # at most the words of the bounded sample

    @F.pandas_udf("severity double, grade int, toxic boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            above = model.chances(texts.tolist())
            edges = np.concatenate((np.ones((len(above), 1)), above, np.zeros((len(above), 1))), axis=1)
            yield pd.DataFrame({
                "severity": above.sum(axis=1), "grade": (edges[:, :-1] - edges[:, 1:]).argmax(axis=1).astype("int32"),
                "toxic": above[:, 0] >= 0.5,
            })

    return of(text)
