"""Samples bounded in rows alone, scores against the kernel written out, and bounded memories of the tokenizer."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import bpe, fingerprints, language_id, toxicity

TEXTS = {
    "aa": ["the cat sat on the mat", "the dog and the cat", "a mat for the dog", "there is the other cat", "that the dog sat"],
    "bb": ["der hund und die katze", "die katze auf der matte", "eine matte für den hund", "das ist der hund", "und die andere katze"],
}


def grams(text):
    """N-grams of one to three characters as texts; one blank for what is between words."""
    kept = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return {kept[i:i + n] for n in (1, 2, 3) for i in range(len(kept) - n + 1)} - {" "}


def test_scores_are_those_of_the_kernel(monkeypatch):
    """Kernel, inverse root of the landmarks' kernel and ridge regression, one text pair at a time."""
    monkeypatch.setattr(language_id, "LANDMARKS", 2)
    texts, languages = zip(*[(t, lang) for lang, own in TEXTS.items() for t in own])
    names = sorted(TEXTS)
    model = language_id.LanguageModel.fit(list(texts), list(languages))
    landmarks = [t for name in names for t in TEXTS[name][:2]]
    kernel = lambda a, b: len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    among = np.array([[kernel(a, b) for b in landmarks] for a in landmarks])
    values, vectors = np.linalg.eigh(among)
    root = vectors / np.sqrt(values)
    features = np.array([[kernel(t, m) for m in landmarks] for t in texts]) @ root
    targets = np.array([[lang == n for n in names] for lang in languages], float)
    share = np.array([1 / languages.count(lang) for lang in languages])
    gram = (features * share[:, None]).T @ features
    ridge = language_id.RIDGE * np.trace(gram) / len(gram)
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), (features * share[:, None]).T @ targets)
    asked = ["the hund", "katze", "x", "mat mat MAT", "Ein Dog"]
    expected = np.array([[kernel(t, m) for m in landmarks] for t in asked]) @ root @ solved
    found, scores = model.predict([*asked, None, "", "123"])
    assert found == [names[i] for i in expected.argmax(axis=1)] + [language_id.NO_LANGUAGE] * 3
    assert np.allclose(scores[:5], np.clip(expected.max(axis=1), 0, 1), atol=1e-5)


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_blocks_do_not_change_scores(monkeypatch, block):
    texts, languages = zip(*[(t, lang) for lang, own in TEXTS.items() for t in own])
    model = language_id.LanguageModel.fit(list(texts), list(languages))
    alone = [model.predict([t])[1][0] for t in texts]
    monkeypatch.setattr(language_id, "BLOCK", block)
    assert np.allclose(model.predict(list(texts))[1], alone, atol=1e-12)


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, t, "aa") for i, t in enumerate(TEXTS["aa"])] + [(9 + i, f"{t} " * 4000, "bb") for i, t in enumerate(TEXTS["bb"])]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"] and model.predict(["die katze und der hund"])[0] == ["bb"]


def test_short_clean_documents_stay(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    short = spark.createDataFrame([(-i, t, None, "s", len(t)) for i, t in enumerate(("WWW", "xx yy", "Z", "ok", "123", ""), 1)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(short), small_dir).where("doc_id < 0")
    assert sorted(r.text for r in kept.collect()) == ["WWW", "Z", "ok", "xx yy"]


def test_toxicity_sample_is_of_documents(spark):
    """Labels without a document, repeated ids and long texts neither fill the sample nor leave it."""
    words = ["calm", "lake", "vile", "insult"]
    docs = [(i, f"{words[i % 2]} {words[2 + i % 2] if i % 4 > 1 else 'tree'} word{i} " * (3000 if i % 4 == 2 else 1)) for i in range(40)]
    docs += [(3, docs[3][1])] * 5 + [(4, None)]
    labels = [(i, i % 4 > 1) for i in range(40)] + [(i, True) for i in range(1000, 3000)] + [(3, False)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, toxic boolean")
    model = toxicity.train(frame, told, sample=40)
    plain = toxicity.SeverityModel.fit([d[1] for d in docs[:40]], np.array([i % 4 > 1 for i in range(40)]))
    assert model.words == plain.words and np.allclose(model.weights, plain.weights, atol=1e-3)


def test_distinct_words_have_the_features_of_the_text():
    for text in ("Abc abc-DEF déjà\tVU x", "", "ÄÖ ä1 1a", "a\x7fb\x00c"):
        cut = " ".join(dict.fromkeys("".join(c if ord(c) > 127 or c.isalnum() else " " for c in text).lower().split()))
        assert toxicity.features_of(cut) >= {f for f in toxicity.features_of(text) if f.isascii()}


def test_remembered_is_bounded():
    held = bpe.Remembered(10)
    for i in range(100):
        held.put(i, i)
        assert len(held.new) + len(held.old) <= 10
    assert held.aged(98) == 98 or held.new.get(98) == 98
    assert held.aged(1) is None and held.new.get(1) is None


def test_samplers_remember_the_words_of_many_texts(monkeypatch):
    """The words of 150,000 in turn are worked out once; more than fit are worked out again and give the same."""
    asked, costs = [0], fingerprints.costs

    def counted(hashes, weights):
        asked[0] += len(hashes)
        return costs(hashes, weights)

    monkeypatch.setattr(fingerprints, "costs", counted)
    texts = [[b"%d" % n for n in range(at, at + 5000)] for at in range(0, 150_000, 5000)]
    own = fingerprints.Sampler()
    first = [own.fingerprint(t) for t in texts]
    assert [own.fingerprint(t) for t in texts] == first and asked[0] == 150_000
    monkeypatch.setattr(fingerprints, "REMEMBERED", 1 << 13)
    short = fingerprints.Sampler()
    assert [short.fingerprint(t) for t in texts] == first and asked[0] == 300_000


def test_samplers_forget_rare_words_first(monkeypatch):
    """Words of all texts are worked out once, though the others do not fit; blocks and odd texts give the same."""
    asked, costs = [], fingerprints.costs

    def counted(hashes, weights):
        asked.extend(hashes.tolist())
        return costs(hashes, weights)

    monkeypatch.setattr(fingerprints, "costs", counted)
    monkeypatch.setattr(fingerprints, "REMEMBERED", 1 << 10)
    often = [f"often{i}" for i in range(100)]
    texts = [" ".join(often + [f"rare{n}_{i}" for i in range(100)]) for n in range(60)]
    own = fingerprints.Sampler()
    first = [own.fingerprint(t.encode().split()) for t in texts]
    assert len(asked) == len(set(asked)) == 100 + 60 * 100
    assert sum(asked.count(h) for h in set(asked[:200])) == 200
    odd = ["", None, *texts, " ", "a " * 500 + "b", " ".join(f"w{i}" for i in range(5000)), ""]
    plain = [own.fingerprint(fingerprints.words_of(t)) for t in odd]
    assert plain[2:62] == first and plain[0] == plain[1] == plain[62] == plain[-1] == fingerprints.EMPTY
    for block in (7, 1 << 10, 1 << 13):
        monkeypatch.setattr(fingerprints, "BLOCK", block)
        assert fingerprints.Sampler().fingerprints(odd) == plain
