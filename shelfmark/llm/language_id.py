"""Language identification by string kernels with Nyström landmarks.

The kernel of two texts is the number of character n-grams of one to three characters that both have
(each counted once, a blended spectrum of presences), divided by the geometric mean of their own
numbers. Landmarks are texts of the training sample; the kernel between all texts and the landmarks,
multiplied by the inverse root of the kernel among the landmarks, gives the features of a kernel ridge
regression, one target per language against the rest. As the kernel is a product of presences, landmarks
and weights are multiplied once: a text's score is the sum of the weights of its n-grams, divided by the
root of their number.

N-grams are of real characters, each a number of its own, so that no two of any scripts are taken for one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The bounded training sample: texts per language, of any length, and landmarks per language.
SAMPLE_TEXTS = 400
LANDMARKS = 40
RIDGE = 1e-2
# Presences held at once while the kernel of the sample is computed.
BLOCK = 1 << 24
# More than any code point: an n-gram is a number of up to three such digits, after its length less one.
BASE = 0x110000
NO_LANGUAGE = "und"


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(BASE)), bool, BASE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")


def grams_of(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Sorted distinct n-grams as numbers; None for a text without letters."""
    points = code_points(text)
    inside = letters[points]
    if not inside.any():
        return None
    # One blank, 0, stands for everything between two words, and at both ends.
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    marks = np.concatenate(([0], np.where(inside, points, 0)[keep], [0])).astype(np.int64)
    pairs = marks[:-1] * BASE + marks[1:]
    triples = pairs[:-1] * BASE + marks[2:]
    return np.unique(np.concatenate((marks[marks > 0], pairs + BASE ** 3, triples + 2 * BASE ** 3)))


@dataclass
class LanguageModel:
    letters: np.ndarray  # by code point
    known: np.ndarray  # sorted n-grams of the landmarks
    weights: np.ndarray  # known n-grams x languages
    languages: list[str]

    @classmethod
    def fit(cls, texts: list[str], languages: list[str]) -> LanguageModel:
        letters = letter_table()
        return cls.fit_grams([(g, lang) for t, lang in zip(texts, languages) if (g := grams_of(t, letters)) is not None])

    @classmethod
    def fit_grams(cls, rows: list[tuple[np.ndarray, str]]) -> LanguageModel:
        """Fit on the n-grams of texts and their languages."""
        letters = letter_table()
        names = sorted({lang for _, lang in rows})
        if not names:
            return cls(letters, np.empty(0, np.int64), np.zeros((0, 0)), [])
        chosen = [g for name in names for g in [r[0] for r in rows if r[1] == name][:LANDMARKS]]
        known = np.unique(np.concatenate(chosen))
        model = cls(letters, known, np.zeros((len(known), len(names))), names)
        kernel, among = model.kernel([g for g, _ in rows], chosen), model.kernel(chosen, chosen)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        sound = values > 1e-6 * values.max()
        root = vectors[:, sound] / np.sqrt(values[sound])
        features = kernel @ root
        targets = np.array([[lang == name for name in names] for _, lang in rows], float)
        # Rare languages weigh as much as frequent ones.
        share = (1 / targets.sum(axis=0))[targets.argmax(axis=1)]
        gram = (features * share[:, None]).T @ features
        ridge = RIDGE * np.trace(gram) / len(gram)
        solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), (features * share[:, None]).T @ targets)
        for grams, own in zip(chosen, root @ solved):
            model.weights[model.columns(grams)] += own / np.sqrt(len(grams))
        return model

    def columns(self, grams: np.ndarray) -> np.ndarray:
        """Places of n-grams among the known ones, without those that are not."""
        at = np.searchsorted(self.known, grams)
        at[at == len(self.known)] = 0
        return at[self.known[at] == grams]

    def kernel(self, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Of all texts with all landmarks, block by block."""
        step = max(1, BLOCK // len(self.known))

        def presences(grams: list[np.ndarray]) -> np.ndarray:
            out = np.zeros((len(grams), len(self.known)), np.float32)
            for row, own in zip(out, grams):
                row[self.columns(own)] = 1
            return out

        out = np.zeros((len(left), len(right)))
        for i in range(0, len(right), step):
            held = presences(right[i:i + step]).T
            for j in range(0, len(left), step):
                out[j:j + step, i:i + step] = presences(left[j:j + step]) @ held
        sizes = [np.sqrt([len(g) for g in side]) for side in (left, right)]
        return out / sizes[0][:, None] / sizes[1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Best language and score of each text: blocks of presences times the weights of their n-grams."""
        names, scores = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        step = max(1, BLOCK // (8 * len(self.known)))
        for at in range(0, len(texts), step):
            rows = [
                (i, self.columns(grams), len(grams)) for i, text in enumerate(texts[at:at + step], at)
                if text and (grams := grams_of(text, self.letters)) is not None
            ]
            if not rows:
                continue
            # Only n-grams that some text of the block has take part.
            used, place = np.unique(np.concatenate([own for _, own, _ in rows]), return_inverse=True)
            presences = np.zeros((len(rows), len(used)))
            presences[np.repeat(np.arange(len(rows)), [len(own) for _, own, _ in rows]), place] = 1
            values = presences @ self.weights[used] / np.sqrt([size for _, _, size in rows])[:, None]
            best = values.argmax(axis=1)
            for (i, _, _), language, value in zip(rows, best, values[np.arange(len(rows)), best]):
                names[i], scores[i] = self.languages[language], min(max(value, 0.0), 1.0)
        return names, scores


def training_sample(labelled: DataFrame, text: str, lang: str, per_language: int = SAMPLE_TEXTS) -> DataFrame:
    """At most ``per_language`` distinct texts of each language, whatever their length, by their hash."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.rlike(text, F.lit(r"\p{L}")))
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"))
    # Hashes are chosen first, in 64 parts of a language and then among the best of each part, so that no task
    # sees more than 64 times the sample. The chosen ones then fetch their texts, copies once.
    chosen = rows.select("lang", "hash", F.pmod("hash", F.lit(64)).alias("part")).distinct()
    for group in (("lang", "part"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("hash"))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")
    chosen = chosen.drop("part")
    return rows.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"])


def _sample_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters = letter_table()
    for frame in batches:
        grams = [grams_of(text, letters) for text in frame["text"]]
        out = frame[["lang", "hash"]].assign(grams=pd.Series(grams, index=frame.index, dtype=object))
        yield out[[g is not None for g in grams]]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on a bounded sample of labelled rows; what comes to the driver are its distinct n-grams, not its texts."""
    sample = training_sample(labelled, text, lang).select("lang", "hash", "text")
    rows = sample.mapInPandas(_sample_grams, "lang string, hash long, grams array<long>").toPandas().sort_values(["lang", "hash"])
    return LanguageModel.fit_grams([(np.asarray(g, np.int64), lang) for g, lang in zip(rows["grams"], rows["lang"])])


def identify(spark: SparkSession, text: Column | str, model: LanguageModel) -> Column:
    """Struct ``(lang, score)`` of a whole text.

    ``und`` with score 0 for a null text, one without letters, and any text if nothing was learned. Of
    equal scores the language that sorts first wins. The score is the winner's regression value cut to 0..1.
    """
    shared = spark.sparkContext.broadcast(model)  # bounded by the landmarks, whatever the corpus

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            names, scores = model.predict(texts.tolist())
            yield pd.DataFrame({"lang": names, "score": scores})

    return of(text)
