"""Unkeyed credentials that reach the secrets stage from several sources."""

from __future__ import annotations

import duckdb

from shelfmark.llm import oracle, queries, secret_scan

from .conftest import DOCUMENTS

BLOBS = [f"{c}z9QkLmW3xTn7RbVcY5pHdJf2GsEa8uKo4iM" for c in "ABCDE"]
COPY, QUOTED, EXAMPLE, COPIES, OWN = BLOBS
ROWS = [
    # A copy of one document in another source, and in two others.
    (1, f"use {COPY} now", "a"), (2, f"use {COPY} now", "b"),
    (3, f"take {COPIES} then", "a"), (4, f"take {COPIES} then", "b"), (5, f"take {COPIES} then", "c"), (6, f"take {COPIES} then", None),
    # Quotes: two owners are fewer than an example has, three are one.
    (7, f"one {QUOTED}", "a"), (8, f"two {QUOTED}", "b"),
    (9, f"one {EXAMPLE}", "a"), (10, f"two {EXAMPLE}", "b"), (11, f"three {EXAMPLE}", "c"),
    (12, f"own {OWN}", "a"), (13, f"own too {OWN}", "a"),
]


def test_blobs_of_several_sources_are_cut(spark):
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in ROWS], DOCUMENTS).repartition(3)
    found = {r.doc.doc_id: r.spans for r in secret_scan.scan(docs, ["doc_id"]).collect()}
    holders = {i: [(s.kind, s.holders, s.live) for s in spans] for i, spans in found.items()}
    one, two = [("blob", 1, True)], [("blob", 2, True)]
    assert holders == dict.fromkeys(range(1, 7), one) | {7: two, 8: two, 9: [], 10: [], 11: [], 12: one, 13: one}
    assert [s.owners for s in found[3]] == [4]
    texts = {r.doc_id: (r.text, r.n_chars) for r in secret_scan.without_secrets(docs).collect()}
    for i, text, _ in ROWS:
        for blob in (COPY, QUOTED, COPIES, OWN):
            text = text.replace(blob, secret_scan.MARK)
        assert texts[i] == (text, len(text))


def test_blobs_like_their_sql(spark, tmp_path):
    """Blobs of one to four owners, quotes, copies, and blobs beside and inside spans of other kinds."""
    beside = [(20, f"password={OWN}", "a"), (21, f"{OWN} token={COPY[:20]} {QUOTED}", "c"), (22, None, "a"), (23, f"{'ab12' * 9}{COPY}", "b"),
              (24, f"{QUOTED} {'0f' * 15}G{OWN}", None)]
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in ROWS + beside]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op2_secret_scan(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    answer = con.execute(oracle.SQL["op2_secret_scan"])
    names = [d[0] for d in answer.description]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(answer.fetchall())


def test_a_text_of_many_secrets(spark):
    """Tens of thousands of spans in one text, with characters beyond 16 bits, are found and cut in one go."""
    n = 60_000
    lines = [f"\U0001F600é token={i:06d}abc " for i in range(n)]
    text = "".join(lines)
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, "token=000007abc", "en", "b", 15), (3, "token=000007abc", "en", "c", 15)], DOCUMENTS)
    spans = {r.doc.doc_id: r.spans for r in secret_scan.scan(docs, ["doc_id"]).collect()}
    width = len(lines[0])
    assert [(s.start, s.end, s.live) for s in spans[1]] == [(i * width + 3, (i + 1) * width - 1, i != 7) for i in range(n)]
    texts = {r.doc_id: r.text for r in secret_scan.without_secrets(docs).collect()}
    assert texts[1] == "".join(line if i == 7 else f"\U0001F600é {secret_scan.MARK} " for i, line in enumerate(lines))
    assert texts[2] == texts[3] == "token=000007abc"
