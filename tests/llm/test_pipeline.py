"""The pipeline stage by stage against brute force, and every stage over odd, clashing and empty tables."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import secret_scan, simhash

from .conftest import CLASHES, DOCUMENTS, LONG, ODD
from .test_queries_llm import ASSIGN, base_spans, encoding, fingerprint, reached, words  # noqa: F401

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stored(spark, small_dir, tmp_path_factory):
    """What each stage returns, each on what its predecessor kept."""
    out, docs = {}, spark.read.parquet(f"{small_dir}/documents.parquet")
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, small_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
    return out


def test_language_keeps_clean_documents(stored):
    kept = {r.doc_id for r in stored["language_id"]}
    assert kept == {r.doc_id for r in stored["documents"] if any(c.isalpha() for c in r.text or "")}


def test_one_of_each_group(stored):
    docs = sorted(stored["language_id"], key=lambda r: r.doc_id)
    prints = np.array([fingerprint(r.text) for r in docs], np.uint64)
    pairs = [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4) if i < j]
    label = reached(len(docs), pairs)
    assert sorted(stored["near_duplicates"], key=lambda r: r.doc_id) == [r for i, r in enumerate(docs) if label[i] == i]


def value_of(text, span):
    start, _, end, kind = span
    return ASSIGN.fullmatch(text[start:end])[2] if kind == "assign" else text[start:end]


def without(text, owners):
    at, out = 0, []
    for span in base_spans(text):
        start, _, end, _ = span
        if len(owners[value_of(text, span)]) >= secret_scan.EXAMPLE_OWNERS:
            continue
        if start >= at:
            out += [text[at:start], secret_scan.MARK]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_live_secrets_are_cut(stored):
    before = {r.doc_id: r for r in stored["near_duplicates"]}
    owners = defaultdict(set)
    for row in before.values():
        for span in base_spans(row.text):
            owners[value_of(row.text, span)].add(row.source)
    assert len(stored["secrets"]) == len(before)
    for row in stored["secrets"]:
        text = without(before[row.doc_id].text, owners)
        assert row.text == text and row.n_chars == (len(text) if secret_scan.MARK in text else before[row.doc_id].n_chars)


def test_mixture_meets_targets(stored):
    sizes, taken = Counter(), Counter()
    for r in stored["secrets"]:
        sizes[r.source] += len(words(r.text))
    for r in stored["mixture"]:
        taken[r.source] += len(words(r.text))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    level, open_, left = 0.0, set(sizes), float(sum(sizes.values()))
    target = {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        target |= {s: 3.0 * sizes[s] for s in full} if full else {s: level * weight[s] for s in open_}
        left -= sum(3 * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    largest = max(len(words(r.text)) for r in stored["secrets"])
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest
    assert max(Counter(r.doc_id for r in stored["mixture"]).values()) <= 3
    assert {tuple(r) for r in stored["mixture"]} <= {tuple(r) for r in stored["secrets"]}


def test_tokens(stored, encoding):  # noqa: F811
    known = encoding(corpus_pipeline.VOCABULARY)
    texts = {r.doc_id: r.text for r in stored["mixture"]}
    assert Counter(r.doc_id for r in stored["tokens"]) == Counter(r.doc_id for r in stored["mixture"])
    for r in stored["tokens"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == known.encode_ordinary(texts[r.doc_id])
        assert r.round_trip and r.n_tokens == len(r.ids) // 4


def test_run(spark, small_dir, stored):
    rows = corpus_pipeline.run(spark, small_dir).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, stored["tokens"]))


def clashing(spark, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for i, name in enumerate(CLASHES):
        docs = docs.withColumn(name, F.lit(f"x{i}"))
    return docs.withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_and_clashing_rows(spark, odd_dir, name):
    docs = clashing(spark, ODD)
    out = STAGES[name](spark, docs, odd_dir)
    rows = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns
        assert all(r[c] == f"x{i}" for r in rows for i, c in enumerate(CLASHES))
    ids = Counter(r.doc_id for r in rows)
    if name == "language_id":
        assert not set(ids) & {3, 4, 5, 8} and ids[2] == 2 and ids[None] == 1
    if name == "near_duplicates":
        assert ids == {1: 1, 3: 1, 6: 1, 7: 1, 8: 1, 9: 2, -7: 1, None: 1}
    if name == "secrets":
        texts = {r.doc_id: r.text for r in rows}
        assert len(rows) == len(ODD) and texts[7] == secret_scan.MARK + "'"
        assert texts[6] == LONG[:LONG.index("password")] + secret_scan.MARK
    if name == "mixture":
        assert all(n <= 3 * Counter(r[0] for r in ODD)[i] for i, n in ids.items())
    if name == "tokens":
        assert len(rows) == len(ODD) and all(r.round_trip for r in rows)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty(spark, empty_dir, name):
    assert STAGES[name](spark, clashing(spark, []), empty_dir).count() == 0


def test_repeated_rows_leave_one(spark, odd_dir):
    rows = [(5, "one two three four five", "en", "a", None)] * 40 + [(5, "one two three four five", "en", "b", 1)] * 2
    out = STAGES["near_duplicates"](spark, clashing(spark, rows), odd_dir).collect()
    assert len(out) == 1 and out[0].source == "a"


def test_hot_groups_are_searched_in_chunks(spark):
    """A dense ball of fingerprints, more than one task compares at once, and random ones around it."""
    random = np.random.default_rng(3)
    ball = {0x1234567890ABCDEF}
    while len(ball) < 3000:
        value = 0x1234567890ABCDEF
        for bit in random.choice(64, random.integers(1, 6), replace=False):
            value ^= 1 << int(bit)
        ball.add(value)
    far = random.integers(0, 2 ** 64, 3000, dtype=np.uint64).tolist()
    prints = np.array(sorted(ball | set(far)), np.uint64)
    label = np.array(reached(len(prints), [
        (i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4) if i < j
    ]))
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "p long").repartition(8)
    for group in (4096, 500):
        found = {r.node: r.component for r in simhash.near_prints(frame, group=group).collect()}
        groups = {}
        for value, own in zip(prints.view(np.int64).tolist(), label):
            groups.setdefault(own, set()).add(found.get(value, value))
        assert all(len(names) == 1 for names in groups.values())
        assert len(groups) == len({next(iter(n)) for n in groups.values()})
