"""The Kneser-Ney model of order three by its definition, over dictionaries."""

from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import kneser_ney
from shelfmark.llm.files import local_path

from .test_queries_llm import kneser_ney as bigrams, rows_of, words


def steps(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if min(n) < 1:
        return (0, 0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    return (0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) for i in (1, 2, 3)))


def trigrams(train, texts):
    """Log10 scores of texts. N-grams that begin with the start keep their counts; others count words before them."""
    start, end = b"\n\n", b"\n"
    tables = {1: Counter(), 2: Counter(), 3: Counter()}
    for t in train:
        s = [start, *words(t), end]
        tables[3].update(zip(s, s[1:], s[2:]))
        tables[2][s[0], s[1]] += 1
    tables[2].update((b, c) for _, b, c in list(tables[3]))
    tables[1].update((c,) for _, c in tables[2])
    off = {k: steps(t.values()) for k, t in tables.items()}
    total, back = Counter(), Counter()
    for k, table in tables.items():
        for gram, n in table.items():
            total[k, gram[:-1]] += n
            back[k, gram[:-1]] += off[k][min(n, 3)]

    def chance(gram):
        if not gram:
            return 1 / (len(tables[1]) + 1)
        k, low = len(gram), chance(gram[1:])
        whole = total[k, gram[:-1]]
        if not whole:
            return low
        n = tables[k][gram]
        return max(n - off[k][min(n, 3)], 0) / whole + back[k, gram[:-1]] / whole * low

    # Chances add up to one after the start, after known and after unknown words.
    for before in ((start,), next(iter(tables[3]))[:2], (b"never", b"seen")):
        assert abs(sum(chance((*before, *w)) for w in tables[1]) + chance((*before, b"never seen")) - 1) < 1e-9
    out = []
    for t in texts:
        s = [start, *words(t), end]
        out.append(sum(np.log10(chance(tuple(s[max(i - 2, 0):i + 1]))) for i in range(1, len(s))))
    return out


def test_order_three(spark, documents, small_dir):
    found = rows_of(spark, "op7_kneser_ney", small_dir)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in documents.doc_id]
    texts = documents.text.tolist()
    expected = trigrams([t for t, h in zip(texts, held) if not h], texts)
    for doc_id, n, want in zip(documents.doc_id, (len(words(t)) + 1 for t in texts), expected):
        assert found[doc_id].score == pytest.approx(want, rel=1e-9)
        assert found[doc_id].perplexity == pytest.approx(10 ** (-want / n), rel=1e-9)


def test_longer_contexts_tell(spark):
    """What follows "b" depends on the word before it."""
    train = ["a b c", "x b y"] * 300 + ["", None]
    texts = ["a b c", "a b y", "x b y", "q", ""]
    frame = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string")
    for order, name in ((2, "score"), (3, "score_3")):
        model = kneser_ney.train(frame(train).repartition(3), order=order)
        score = {r.doc.text: r for r in kneser_ney.scored(frame(texts), model).collect()}
        assert [score[t].score for t in texts] == pytest.approx([x[4] for x in bigrams(train, texts)], rel=1e-9)
        if order == 3:
            assert [score[t][name] for t in texts] == pytest.approx(trigrams(train, texts), rel=1e-9)
            assert score["a b c"].score == pytest.approx(score["a b y"].score) and score["a b c"].score_3 > score["a b y"].score_3 + 1


def by_definition(train, texts, order):
    """Log10 scores of texts by the model of any order."""
    start, end = b"\n\n", b"\n"
    tables = {k: Counter() for k in range(1, order + 1)}
    for t in train:
        s = [start, *words(t), end]
        tables[order].update(tuple(s[i:i + order]) for i in range(len(s) - order + 1))
        for k in range(2, order):
            if len(s) >= k:
                tables[k][tuple(s[:k])] += 1
    for k in range(order - 1, 0, -1):
        tables[k].update(gram[1:] for gram in tables[k + 1])
    off = {k: steps(t.values()) for k, t in tables.items()}
    total, back = Counter(), Counter()
    for k, table in tables.items():
        for gram, n in table.items():
            total[gram[:-1], k] += n
            back[gram[:-1], k] += off[k][min(n, 3)]

    def chance(gram):
        if not gram:
            return 1 / (len(tables[1]) + 1)
        k, low = len(gram), chance(gram[1:])
        whole = total[gram[:-1], k]
        n = tables[k][gram]
        return max(n - off[k][min(n, 3)], 0) / whole + back[gram[:-1], k] / whole * low if whole else low

    tokens = [[start, *words(t), end] for t in texts]
    return [sum(np.log10(chance(tuple(s[max(i - order + 1, 0):i + 1]))) for i in range(1, len(s))) for s in tokens]


def corpus(rows, size):
    random = np.random.default_rng(5)
    return [" ".join(f"w{min(n, 999)}" for n in random.zipf(1.4, size)) for _ in range(rows)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_frequent_words_are_dealt_by_two(spark, monkeypatch, order):
    """Scores are those of the definition whether or not words are dealt with the word before them."""
    train = [*corpus(60, 40), "", "w1", "w1 w1"]
    texts = [*corpus(63, 40)[60:], *train[:3], "", "never seen", "w1 never w2 w1 w3", "w1 w1"]
    frame = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    want = by_definition(train, texts, order)
    if order == 3:
        assert want == pytest.approx(trigrams(train, texts), rel=1e-9)
    for limit in (1, 32, 1 << 21):
        monkeypatch.setattr(kneser_ney, "FREQUENT", limit)
        model = kneser_ney.train(frame(train), order=order)
        assert (model.sums.size > 0) == (limit < 1 << 21)
        found = {r.doc.text: r for r in kneser_ney.scored(frame(texts), model).collect()}
        assert [found[t][model.scores[-1]] for t in texts] == pytest.approx(want, rel=1e-9)


def test_files_take_few_bytes(spark):
    """A model of order three takes at most 20 bytes a distinct trigram, with its pairs, words and their sums."""
    random = np.random.default_rng(6)
    train = [" ".join(f"w{n}" for n in random.integers(0, 3000, 500)) for _ in range(100)]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in train], "text string"), shards=4)
    tokens = [[b"\n\n", *words(t), b"\n"] for t in train]
    distinct = len({gram for s in tokens for gram in zip(s, s[1:], s[2:])})
    folder = local_path(model.folder)
    assert sum(os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder)) < 20 * distinct


@pytest.mark.parametrize("order, vocabulary", [(2, 50), (3, 70_000), (4, 50), (4, 70_000)])
def test_n_grams_of_a_chunk(order, vocabulary):
    """Packed in one number or not, n-grams are counted and sorted by the nearest word before first."""
    random = np.random.default_rng(8)
    numbers = random.permutation(vocabulary).astype(np.uint32) * np.uint32(7) + np.uint32(kneser_ney.FIRST_WORD)
    word = np.concatenate((np.minimum(random.zipf(1.3, 3000), vocabulary) - 1, np.arange(vocabulary)))
    starts = np.array([0, 1, 500, 2000])
    columns, counts = kneser_ney._distinct_grams(numbers, word, starts, order)
    want = Counter()
    for text in np.split(numbers[word], starts[1:]):
        s = [kneser_ney.NOTHING] * (order - 2) + [kneser_ney.START, *text.tolist()]
        want.update((*s[i - order + 1:i][::-1], s[i]) for i in range(order - 1, len(s)))
    assert list(zip(*(c.tolist() for c in columns), strict=True)) == sorted(want)
    assert counts.tolist() == [want[g] for g in sorted(want)]
