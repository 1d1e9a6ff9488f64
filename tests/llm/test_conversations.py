"""The prefix trie and the chat format against SQL and brute force, over odd, skewed and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from shelfmark.llm import chat_format, conversation_trie
from shelfmark.llm.queries import PLANTED, oracle_sql, queries

from .conftest import TURNS

NAMES = ("op11_prefix_trie", "op13_chat_format")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(turns):
    """Turns of each conversation as (role, text), sorted as the operators do."""
    out = defaultdict(list)
    for conv, turn, role, text in turns:
        out[conv].append((turn, role or "", text or ""))
    return out


def brute_trie(lists):
    """All nodes of ``{conv_id: [(role, text)]}`` by a dictionary of prefixes."""
    members = defaultdict(list)
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        leaf = [n for n in below if not any(m[:-1] == n for m in members if m)]
        ends = sorted(c for c in who if len(lists[c]) == len(node))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
            sum(1 for n in members if n and n[:-1] == node), len(leaf), saved, sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=str)


def plain_lists(turns):
    digest = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()
    return {
        c: [t[1:] for t in sorted(own, key=lambda t: (t[0] is not None, t[0] or 0, digest(t)))]
        for c, own in in_order(turns).items() if c is not None
    }


def rebuilt(lists):
    out = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = lists.get(base, [])[:h] + own[h:]
    return out


def nodes_of(frame):
    return sorted((tuple(r) for r in frame.select(*conversation_trie.NODE_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, small_dir, name):
    assert differences(queries()[name](spark, small_dir), connect(small_dir), oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_against_sql(spark, odd_dir, name):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{odd_dir}/conversations.parquet/*.parquet'")
    assert differences(queries()[name](spark, odd_dir), con, oracle_sql()[name]) == ""


def test_trie_against_brute_force(spark, odd_dir):
    found = queries()["op11_prefix_trie"](spark, odd_dir)
    assert nodes_of(found) == brute_trie(rebuilt(plain_lists(TURNS)))


def test_empty(spark, empty_dir):
    assert queries()["op11_prefix_trie"](spark, empty_dir).count() == 0
    assert [r.conv_id for r in queries()["op13_chat_format"](spark, empty_dir).collect()] == [-1]


def test_many_shards_and_rounds(spark):
    """Shards of a few turns in many partitions, a first turn and a conversation that a third of all share."""
    turns = []
    for c in range(400):
        if c % 3 == 0:
            said = ["hi", "common", "end"]
        elif c % 3 == 1:
            said = ["hi"] + [f"w {c * d % 7}" for d in range(1, c % 5)]
        else:
            said = [f"x{c % 11}"] + ["again and again"] * (c % 13)
        turns += [(c, d, "user" if d % 2 == 0 else "assistant", t) for d, t in enumerate(said)]
    turns += [(1000, d, "user", "long") for d in range(300)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    told = conversation_trie.encoded_conversations(frame, "conv_id", "turn", "role", "text")
    expected = brute_trie(plain_lists(turns))
    for shard, partition, fan in ((1 << 17, 1 << 20, 16), (7, 100, 2), (1, 64, 3)):
        assert nodes_of(conversation_trie.conversation_nodes(told, shard, partition, fan)) == expected


def test_trie_keeps_clashing_columns_out(spark):
    frame = spark.createDataFrame(
        [(1, 0, "user", "a", 5, "x"), (2, 0, "user", "a", 6, "y")],
        "conv_id long, turn long, role string, text string, ids long, digest string",
    )
    assert nodes_of(conversation_trie.prefix_trie(frame)) == brute_trie({1: [("user", "a")], 2: [("user", "a")]})
    formatted = chat_format.format_chats(frame.withColumn("parts", F.array(chat_format.text_part("text"))))
    assert formatted.count() == 2


def test_ends_of_a_hot_list(spark, monkeypatch):
    """Parts of ids are digested in numeric order, negative ones first."""
    monkeypatch.setattr(conversation_trie, "ENDS_RANGE", 8)
    frame = spark.range(-40, 60).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("a").alias("text"))
    found = {r.depth: r.ends_sha256 for r in conversation_trie.prefix_trie(frame).collect()}
    assert found == {0: sha(""), 1: sha(",".join(map(str, range(-40, 60))))}


def test_search_tree_is_balanced():
    """Sorted lists go in median first: the siblings of 1,023 first turns are at most ten steps apart."""
    tree = conversation_trie.SearchTree()
    tree.fill([{"ids": [i], "words": [1], "ended": 1, "ended_first": i, "ends": ""} for i in range(1023)])

    def height(at):
        return 0 if not at else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.below[0]) == 10


# Chat format.

def brute_chats(turns):
    out = {}
    for c, own in in_order([*turns, (-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)]).items():
        own = sorted(own, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        loss = "".join(t[2] for t in own if t[1] == "assistant")
        out[c] = (len(own), sha("".join(f"{t[1]}\n{t[2]}\n" for t in own)), len(loss), sha(loss))
    return out


def test_chats_against_brute_force(spark, odd_dir):
    rows = queries()["op13_chat_format"](spark, odd_dir).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == brute_chats(TURNS)


def test_no_python_in_the_plan(spark, odd_dir):
    plan = queries()["op13_chat_format"](spark, odd_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_planted_conversation_reads_back(spark, empty_dir):
    (row,) = queries()["op13_chat_format"](spark, empty_dir).collect()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(PLANTED), sha(PLANTED))


@pytest.mark.parametrize("text", ["", "<", "|", "<|", "<\\|", "<\\\\|", "<<||", "\\<|\\", "<|image|>", "a\nb<|im_end|>\n", "$1 \\1"])
def test_escape_is_reversible(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    out = chat_format.escaped(F.col("t"))
    row = frame.select(out.alias("e"), chat_format.unescaped(out).alias("back")).first()
    assert row.back == text and "<|" not in row.e


def test_typed_parts(spark):
    """Placeholders in order, references and expanded tokens recorded, and texts and kinds read back."""
    parts = [
        [("text", "see <|image|> ", None, None, None, None, None), ("image", None, "a.png", 29, 28, None, None),
         ("audio", None, "b.wav", None, None, 1.02, None), ("text", "and", None, None, None, None, None),
         ("document", None, "c.pdf", None, None, None, 3)],
        [("image", None, None, None, None, None, None), (None, "odd", None, None, None, None, None), ("video", None, "d", None, None, None, None)],
        None,
    ]
    frame = spark.createDataFrame(
        [(1, 0, "user", parts[0]), (1, 1, "assistant", parts[1]), (1, 2, None, parts[2]), (2, 0, "assistant", [])],
        f"conv_id long, turn long, role string, parts array<{chat_format.PART}>",
    )
    chats = chat_format.format_chats(frame)
    rows = {r.conv_id: r for r in chats.withColumn("turns", chat_format.read_turns("formatted")).withColumn(
        "loss", chat_format.loss_text("formatted", "loss_spans")
    ).collect()}
    assert rows[1].formatted == (
        "<|im_start|>user<|im_sep|>see <\\|image|> <|image|><|audio|>and<|document|><|im_end|>\n"
        "<|im_start|>assistant<|im_sep|><|image|>odd<|im_end|>\n<|im_start|><|im_sep|><|im_end|>\n"
    )
    assert [tuple(a) for a in rows[1].attachments] == [
        ("image", "a.png", 2), ("audio", "b.wav", 26), ("document", "c.pdf", 768), ("image", None, 1)
    ]
    assert rows[1].expanded_tokens == 797
    assert [(t.role, t.text, t.kinds) for t in rows[1].turns] == [
        ("user", "see <|image|> and", ["image", "audio", "document"]), ("assistant", "odd", ["image"]), ("", "", [])
    ]
    (span,) = rows[1].loss_spans
    assert rows[1].formatted[span.start:span.end] == "<|image|>odd" and rows[1].loss == "odd"
    assert rows[2].loss == "" and len(rows[2].loss_spans) == 1 and rows[2].expanded_tokens == 0
