"""Every registered query against brute force over whole tables, and over odd and empty tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from compare import connect, differences

from shelfmark.llm import embedding_dedup
from shelfmark.llm.queries import oracle_sql, queries

from .conftest import LONG, ODD

# The later operators have files of their own.
QUERIES = {k: v for k, v in queries().items() if k != "pipeline" and int(k[2:].split("_")[0]) <= 10}
SQL = {k: v for k, v in oracle_sql().items() if k in QUERIES}


def rows_of(spark, name, folder, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, folder).collect()}


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def reached(size, pairs):
    """Smallest index reachable, by repeated search."""
    near = [[] for _ in range(size)]
    for a, b in pairs:
        near[a].append(b)
        near[b].append(a)
    label = [-1] * size
    for i in range(size):
        todo = [i] if label[i] < 0 else []
        while todo:
            x = todo.pop()
            if label[x] < 0:
                label[x] = i
                todo += near[x]
    return label


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, duck, small_dir, name):
    assert differences(QUERIES[name](spark, small_dir), duck, SQL[name]) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_odd_rows_stay(spark, odd_dir, name):
    expected = 15 if name.startswith("op8") else len(ODD)
    rows = QUERIES[name](spark, odd_dir).collect()
    assert len(rows) == expected
    key = "vec_id" if name.startswith("op8") else "doc_id"
    assert Counter(r[key] for r in rows)[2] == 2


def test_language(spark, documents, small_dir):
    found = rows_of(spark, "op1_language_id", small_dir)
    assert len(found) == len(documents)
    right = []
    for doc_id, lang in zip(documents.doc_id, documents.lang):
        row = found[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1
        if row.held_out:
            right.append(row.lang_pred == lang)
    assert np.mean(right) > 0.98


def test_language_of_nothing(spark, odd_dir):
    rows = QUERIES["op1_language_id"](spark, odd_dir).collect()
    by_text = {r.doc_id: r for r in rows}
    for i in (3, 4, 5, 8):
        assert by_text[i].lang_pred == "und" and by_text[i].score == 0
    assert by_text[1].lang_pred in ("en", "de", "fr", "ko")


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets(spark, documents, small_dir, odd_dir):
    found = rows_of(spark, "op2_secret_scan", small_dir)
    held = 0
    for doc_id, text in zip(documents.doc_id, documents.text):
        spans = base_spans(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        row = found[doc_id]
        assert row.base_sha256 == sha(listed)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex"))
        assert set(filter(None, listed.split(","))) <= set(row.spans.split(","))
        held += bool(spans)
    assert held > 5
    odd = rows_of(spark, "op2_secret_scan", odd_dir)
    assert odd[6].spans == f"assign:{LONG.index('password')}:{len(LONG)}"
    assert odd[7].spans == "assign:0:29,access:9:29"
    assert odd[3].spans == "" and odd[3].base_sha256 == sha("")


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = pq.read_table(f"{folder}/labels.parquet").to_pandas()
    found = rows_of(spark, "op3_toxicity", folder)
    held = [(found[i].toxic, t) for i, t in zip(labels.doc_id, labels.toxic) if found[i].held_out]
    assert len(held) > 500
    hit = sum(p and t for p, t in held)
    assert hit >= 0.8 * sum(t for _, t in held)
    assert sum(p and not t for p, t in held) <= 5
    assert all(0 <= r.severity <= 2 for r in found.values())


@pytest.fixture(scope="module")
def encoding():
    def of(name):
        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    return of


def test_bpe(spark, documents, small_dir, odd_dir, encoding):
    known = encoding("byte_bpe_multi_50k.tiktoken")
    found = rows_of(spark, "op4_byte_bpe", small_dir)
    for doc_id, text in zip(documents.doc_id, documents.text):
        ids = known.encode_ordinary(text or "")
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert found[doc_id].decoded_sha256 == sha(text or "")
    odd = rows_of(spark, "op4_byte_bpe", odd_dir)
    for doc_id, text, *_ in ODD:
        if doc_id in (-7, 3, 6, 8):
            ids = known.encode_ordinary(text or "")
            assert (odd[doc_id].n_tokens, odd[doc_id].ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))


def test_token_counts(spark, documents, small_dir, encoding):
    known = encoding("byte_bpe_50k.tiktoken")
    found = rows_of(spark, "op5_token_counts", small_dir)
    assert {d: found[d].n_tokens for d in documents.doc_id} == {
        d: len(known.encode_ordinary(t or "")) for d, t in zip(documents.doc_id, documents.text)
    }


def test_fingerprints(spark, documents, small_dir):
    found = rows_of(spark, "op6_fingerprints", small_dir)
    ordered = documents.sort_values("doc_id", ascending=False)
    texts, ids = [t or "" for t in ordered.text], ordered.doc_id.tolist()
    errors, same = [], {}
    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        after = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = found[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == sha(edited)
        assert same.setdefault(text, row.fingerprint) == row.fingerprint
        for got, other in ((row.near_edited, edited), (row.near_next, after)):
            a, b = Counter(words(text)), Counter(words(other))
            errors.append(got - sum((a & b).values()) / max(sum((a | b).values()), 1))
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    distinct = set(same.values())
    assert len(distinct) == len(same)


def test_fingerprints_of_odd_rows(spark, odd_dir):
    rows = QUERIES["op6_fingerprints"](spark, odd_dir).collect()
    zero = [r for r in rows if r.n_chars == 0]
    assert len(zero) == 3 and {r.fingerprint for r in zero} == {"0" * 512}
    last = next(r for r in rows if r.doc_id == -7)
    assert last.n_chars == len(ODD[-1][1])


def kneser_ney(train, texts):
    """The model by its definition, over dictionaries."""
    end, start = "\n", "\n\n"
    streams = [[w.decode() for w in words(t)] + [end] for t in train]
    count, pairs, total = Counter(w for s in streams for w in s), Counter(), Counter()
    for s in streams:
        for a, b in zip([start] + s, s):
            pairs[a, b] += 1
            total[a] += 1
    after, kinds = Counter(), {}
    for (a, b), n in pairs.items():
        after[b] += 1
        kinds.setdefault(a, Counter())[min(n, 3)] += 1

    def steps(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if min(n) < 1:
            return (0, 0.5, 1.0, 1.5)
        y = n[0] / (n[0] + 2 * n[1])
        return (0, 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])

    high, low = steps(pairs.values()), steps(after.values())
    distinct = len(pairs)
    spare = sum(low[min(c, 3)] for c in after.values()) / distinct

    def chance(a, b):
        base = max(after[b] - low[min(after[b], 3)], 0) / distinct + spare / (len(count) + 1)
        if not total[a]:
            return base
        back = sum(high[k] * n for k, n in kinds[a].items()) / total[a]
        return max(pairs[a, b] - high[min(pairs[a, b], 3)], 0) / total[a] + back * base

    size, known = sum(count.values()), len(count)
    out = []
    for t in texts:
        s = [w.decode() for w in words(t)] + [end]
        out.append((
            len(s), sum(w in count for w in s), size,
            sum(np.log10((count[w] + 1) / (size + known + 1)) for w in s),
            sum(np.log10(chance(a, b)) for a, b in zip([start] + s, s)),
        ))
    # Chances after a word that occurs, and after one that does not, add up to one.
    for a in (start, next(iter(total)), "never seen"):
        assert abs(sum(chance(a, b) for b in count) + chance(a, "never seen") - 1) < 1e-9
    return out


def test_kneser_ney(spark, documents, small_dir):
    found = rows_of(spark, "op7_kneser_ney", small_dir)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in documents.doc_id]
    texts = documents.text.tolist()
    expected = kneser_ney([t for t, h in zip(texts, held) if not h], texts)
    gain = 0.0
    for doc_id, out, want in zip(documents.doc_id, held, expected):
        row = found[doc_id]
        assert row.held_out == out
        assert (row.n_tokens, row.n_known, row.train_tokens) == want[:3]
        assert row.base_score == pytest.approx(want[3], rel=1e-9) and row.score_2 == pytest.approx(want[4], rel=1e-9)
        gain += out * (row.score - row.base_score)
    assert gain > 0


def test_embeddings_recall(spark):
    """Links and components against all pairs, for groups of neighbours around the threshold and a hot group of copies."""
    random = np.random.default_rng(1)
    centres = random.standard_normal((150, 48))
    vectors = [c + random.standard_normal(48) * random.choice((0.1, 0.3, 0.5)) for c in centres for _ in range(random.integers(1, 14))]
    vectors += [centres[0]] * 400
    units = np.stack(vectors).astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(units)]
    units /= np.linalg.norm(units, axis=1)[:, None]
    near = units @ units.T >= 0.9
    np.fill_diagonal(near, False)
    label = reached(len(units), np.argwhere(near))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8)
    for group in (2048, 16):
        found = {r.vec_id: r for r in embedding_dedup.embedding_groups(table, group=group).collect()}
        assert 1000 < near[400:].sum()
        for i in range(len(units)):
            least = min(j for j in range(len(units)) if label[j] == label[i]) if i < 60 else label[i]
            assert (found[i].n_links, found[i].component_id) == (near[i].sum(), least)


def test_odd_embeddings(spark, odd_dir):
    rows = QUERIES["op8_embedding_dedup"](spark, odd_dir).collect()
    by_id = {r.vec_id: r for r in rows}
    assert {r.n_links for r in rows if r.vec_id in (1, 2, 3, 13)} == {4}
    assert {r.component_id for r in rows if r.vec_id in (1, 2, 3, 13)} == {1}
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert (by_id[None].n_links, by_id[None].component_id, by_id[None].kept) == (0, None, False)


def test_mixing(spark, documents, small_dir):
    found = rows_of(spark, "op9_mixing", small_dir)
    again = rows_of(spark, "op9_mixing", small_dir)
    assert found == again
    size, taken, target = Counter(), Counter(), {}
    for doc_id, text, source in zip(documents.doc_id, documents.text, documents.source):
        row = found[doc_id]
        assert row["size"] == len(words(text)) and row.taken <= 3 * row["size"]
        size[source] += row["size"]
        taken[source] += row.taken
        target[source] = row.target
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    largest = max(r["size"] for r in found.values())
    for source in size:
        assert target[source] <= 3 * size[source] * (1 + 1e-12)
        assert abs(taken[source] - target[source]) <= largest


def test_mix_is_laid_out_in_training_order(spark, odd_dir, monkeypatch):
    from shelfmark.llm import mixing

    stored = {}

    def kept(df, label="stage", cut=mixing.cut_lineage):
        stored[label] = cut(df, label)
        return stored[label]

    monkeypatch.setattr(mixing, "cut_lineage", kept)
    found = QUERIES["op9_mixing"](spark, odd_dir).collect()
    order = stored["order"].collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert len(order) == sum(r.copies for r in found) and len(found) == spark.read.parquet(f"{odd_dir}/documents.parquet").count()
    assert sum(r["size"] for r in order) == sum(r.taken for r in found)
    first = {}
    for r in order:
        first.setdefault((r._id, r["size"]), r.position)
    for r in found:
        assert r.first_position == first.get((r.doc_id, r["size"])) and r.taken == r.copies * r["size"]


def fingerprint(text, size=4):
    own = words(text)
    shingles = [b" ".join(own[i:i + size]) for i in range(max(len(own) - size + 1, 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash(spark, documents, small_dir):
    found = rows_of(spark, "op10_simhash", small_dir)
    prints = [fingerprint(t) for t in documents.text]
    array = np.array(prints, np.uint64)
    pairs = [(i, j) for i in range(len(array)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 4) if i < j]
    label = reached(len(prints), pairs)
    ids = documents.doc_id.tolist()
    least = {}
    for i, l in enumerate(label):
        least[l] = min(least.get(l, ids[i]), ids[i])
    for i, doc_id in enumerate(ids):
        assert found[doc_id].fingerprint == f"{prints[i]:016x}"
        assert found[doc_id].component_id == least[label[i]]


def test_simhash_of_odd_rows(spark, odd_dir):
    rows = QUERIES["op10_simhash"](spark, odd_dir).collect()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {3} and len(zero) == 4
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
