"""Prefix trie of conversations: ternary search trees over turn ids, one per range shard, merged at the shards' edges.

Turns are numbered by a dictionary of their role and text, so a conversation is a list of numbers. Equal lists are one
row with a count before anything is sorted. The lists are range-partitioned in their own order, and every run of about
``SHARD_TURNS`` turns of a partition is a shard: a ternary search tree of it, into which the lists go median first, which
balances the search among siblings. A walk with a stack of its own adds up members, leaves and savings.

Only the nodes on the way to the first and the last list of a shard can also lie in another one. All others are final
at once. The two ways leave the shard as lists of their own, each node with what it holds itself and what hangs on it, and
``FAN`` neighbouring partitions at a time are merged by the same tree, whose inner nodes are final in turn, until one
is left. Each round reads two short lists a shard of the round before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.membership import spread
from ..session import cut_lineage
from .common import count_words

# Turns of one search tree, and of one partition of lists.
SHARD_TURNS = 1 << 17
PARTITION_TURNS = 1 << 20
# Neighbouring partitions whose edges one task merges.
FAN = 16
# Conversation ids that one part of a list of ends covers.
ENDS_RANGE = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()

_NODE = "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, " \
    "saved_tokens long, ends_sha256 string, key binary"
# What an edge carries at each depth from 0 on: lists that end there, and what hangs on the node without being an edge.
_OWN = ("ended", "ended_first", "ends", "hung", "hung_first", "hung_leaves", "hung_saved", "hung_children")
_EDGE = "ids array<long>, words array<long>, ended array<long>, ended_first array<long>, ends array<string>, hung array<long>, " \
    "hung_first array<long>, hung_leaves array<long>, hung_saved array<long>, hung_children array<long>"
_SCHEMA = f"{_NODE}, shard long, place long, {_EDGE}"
_COLUMNS = [c.split(" ")[0] for c in _SCHEMA.split(", ")]


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


class SearchTree:
    """A ternary search tree of lists of turn ids. Node 0 is the root of the trie, without a turn."""

    def __init__(self):
        self.turn, self.words = [None], [0]
        self.low, self.high, self.below = [0], [0], [0]
        self.ended, self.ended_first, self.ends = [0], [None], [None]
        self.hung, self.hung_first, self.hung_leaves, self.hung_saved, self.hung_children = [0], [None], [0], [0], [0]

    def _new(self, turn: int, words: int) -> int:
        self.turn.append(turn)
        self.words.append(words)
        for column, start in (
            (self.low, 0), (self.high, 0), (self.below, 0), (self.ended, 0), (self.ended_first, None), (self.ends, None),
            (self.hung, 0), (self.hung_first, None), (self.hung_leaves, 0), (self.hung_saved, 0), (self.hung_children, 0),
        ):
            column.append(start)
        return len(self.turn) - 1

    def path(self, ids, words) -> list[int]:
        """Nodes on the way of a list, the root first; those that are missing are added."""
        out, node = [0], 0
        for turn, size in zip(ids, words):
            at, links, from_ = self.below[node], self.below, node
            while at and self.turn[at] != turn:
                links, from_ = (self.low if turn < self.turn[at] else self.high), at
                at = links[at]
            if not at:
                at = self._new(turn, size)
                links[from_] = at
            node = at
            out.append(node)
        return out

    def insert(self, edge: dict) -> None:
        """Add what a list carries: at its last node alone (a fresh list), or at each depth (an edge)."""
        nodes = self.path(edge["ids"], edge["words"])
        if "hung" not in edge:
            self._end(nodes[-1], edge["ended"], edge["ended_first"], edge["ends"])
            return
        for depth, node in enumerate(nodes):
            if edge["ended"][depth]:
                self._end(node, edge["ended"][depth], edge["ended_first"][depth], edge["ends"][depth])
            self._hang(node, *(edge[c][depth] for c in _OWN[3:]))

    def _end(self, node: int, n: int, first: int, ends: str) -> None:
        self.ended[node] += n
        self.ended_first[node] = _least(self.ended_first[node], first)
        self.ends[node] = ends

    def _hang(self, node: int, n: int, first: int | None, leaves: int, saved: int, children: int) -> None:
        self.hung[node] += n
        self.hung_first[node] = _least(self.hung_first[node], first)
        self.hung_leaves[node] += leaves
        self.hung_saved[node] += saved
        self.hung_children[node] += children

    def fill(self, edges: list[dict]) -> None:
        """Insert sorted lists median first, so that siblings are searched by halves."""
        todo = [(0, len(edges))]
        while todo:
            low, high = todo.pop()
            if low < high:
                middle = (low + high) // 2
                self.insert(edges[middle])
                todo += [(middle + 1, high), (low, middle)]

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes with parents before children, their parents and their depths."""
        nodes, parents, depths = [], [], []
        todo = [(0, -1, 0)]
        while todo:
            node, parent, depth = todo.pop()
            nodes.append(node)
            parents.append(parent)
            depths.append(depth)
            # All siblings hang in one search tree below their parent.
            at = [self.below[node]] if self.below[node] else []
            while at:
                child = at.pop()
                todo.append((child, node, depth + 1))
                if self.low[child]:
                    at.append(self.low[child])
                if self.high[child]:
                    at.append(self.high[child])
        return nodes, parents, depths

    def results(self, shard: int, place: int, open_paths: list[dict], named: bool) -> pd.DataFrame:
        """Rows of the final nodes, and of the open paths, whose nodes are not final.

        ``open_paths`` are the first and the last list of the shard, or none, if the shard is all there is. Each open node
        takes up what hangs on it; what the two paths share goes with the first. ``named`` nodes were open a round
        before: nodes of that round wait for them as their parents, so they come with their names.
        """
        paths = [self.path(p["ids"], p["words"]) for p in open_paths]
        open_nodes = set().union(*paths) if paths else set()
        size = len(self.turn)
        nodes, parents, depths = self.walk()
        members, first, children = [0] * size, [None] * size, [0] * size
        leaves, saved = [0] * size, [0] * size
        for node, parent in zip(reversed(nodes), reversed(parents)):
            members[node] += self.ended[node] + self.hung[node]
            first[node] = _least(first[node], _least(self.ended_first[node], self.hung_first[node]))
            children[node] += self.hung_children[node]
            leaves[node] += self.hung_leaves[node]
            saved[node] += self.hung_saved[node]
            if node in open_nodes:
                continue
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * self.words[node]
            if parent < 0:
                continue
            if parent in open_nodes:
                self._hang(parent, members[node], first[node], leaves[node], saved[node], 1)
            else:
                members[parent] += members[node]
                first[parent] = _least(first[parent], first[node])
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
        names = self._names(nodes, parents, None if named else open_nodes)
        rows: list[tuple] = []
        blank_edge = (None,) * (2 + 2 + len(_OWN))
        for node, parent, depth in zip(nodes, parents, depths):
            if node in open_nodes:
                continue
            pending = parent in open_nodes
            rows.append((
                first[node], depth, None if pending or parent < 0 else first[parent], names[parent] if pending else None,
                members[node], children[node], leaves[node], saved[node], self.ends[node] or NOTHING, names.get(node), *blank_edge,
            ))
        blank_node, told = (None,) * 10, set()
        for number, (edge, path) in enumerate(zip(open_paths, paths)):
            own = [[] for _ in _OWN]
            for node in path:
                fresh = node not in told
                told.add(node)
                values = (
                    self.ended[node], self.ended_first[node], self.ends[node], self.hung[node], self.hung_first[node],
                    self.hung_leaves[node], self.hung_saved[node], self.hung_children[node],
                )
                for column, value, empty in zip(own, values, (0, None, None, 0, None, 0, 0, 0)):
                    column.append(value if fresh else empty)
            rows.append((*blank_node, shard, 2 * place + number, list(edge["ids"]), list(edge["words"]), *own))
        return pd.DataFrame(rows, columns=_COLUMNS, dtype=object).astype({
            c: "Int64" for c in _COLUMNS if c not in ("ends_sha256", "key", "parent_key", "ids", "words", *_OWN)
        })

    def _names(self, nodes: list[int], parents: list[int], only: set[int] | None) -> dict[int, bytes]:
        """A name of each node that is the same in all shards: the digest of its turns. ``only`` is closed upwards."""
        states, out = {}, {}
        for node, parent in zip(nodes, parents):
            if only is not None and node not in only:
                continue
            state = hashlib.sha256() if parent < 0 else states[parent].copy()
            if parent >= 0:
                state.update(int(self.turn[node]).to_bytes(8, "little"))
            states[node], out[node] = state, state.digest()
        return out


def _ends_only(edges: list[dict]) -> list[dict]:
    return edges[:1] if len(edges) == 1 else [edges[0], edges[-1]]


def _search_shards(turns: int):
    """Trees of runs of about ``turns`` turns of a sorted partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, place, held, count = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pd.DataFrame:
            tree = SearchTree()
            tree.fill(held)
            return tree.results(shard, place, _ends_only(held), False)

        for frame in batches:
            for row in frame.to_dict("records"):
                held.append(row | {"ids": row["ids"].tolist(), "words": row["words"].tolist()})
                count += len(held[-1]["ids"]) + 1
                if count >= turns:
                    yield flush()
                    place, held, count = place + 1, [], 0
        if held:
            yield flush()

    return run


def _merge_edges(last: bool):
    """One tree over the edges of neighbouring shards."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        edges = frame.sort_values(["shard", "place"])[["ids", "words", *_OWN]].to_dict("records")
        edges = [{name: column.tolist() for name, column in edge.items()} for edge in edges]
        for edge in edges:
            edge.update({name: [None if x is None or x != x else int(x) for x in edge[name]] for name in _OWN if name != "ends"})
        tree = SearchTree()
        tree.fill(edges)
        return tree.results(int(key[0]), 0, [] if last else _ends_only(edges), True)

    return run


def turn_dictionary(turns: DataFrame) -> DataFrame:
    """``(digest, turn_id, words)``: consecutive numbers of the distinct turns, in the order of their digests.

    Numbers follow from the digests alone. The only ungrouped window runs over at most 65,536 counts of buckets.
    """
    known = turns.groupBy("digest", spread("digest")).agg(F.min("words").alias("words")).withColumn(
        "_bucket", F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    )
    sizes = known.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("digest"))
    return known.withColumn("_inside", inside).join(offsets, "_bucket").select(
        "digest", (F.col("_offset") + F.col("_inside")).cast("long").alias("turn_id"), "words"
    )


def encoded_conversations(turns: DataFrame, ident: str, order: str, role: str, text: str) -> DataFrame:
    """``(conv_id, ids, words)``: conversations as dictionary numbers of their turns, and the words of each turn's text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    told = turns.where(F.col(ident).isNotNull()).select(
        F.col(ident).cast("long").alias("conv_id"), F.col(order).alias("turn"), digest.alias("digest"), count_words(text).alias("words")
    )
    told = cut_lineage(told, "turns")
    numbered = told.select("conv_id", "turn", "digest").join(turn_dictionary(told), "digest")
    in_order = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("n"), "turn", "turn_id", "words")))
    # A conversation is one row: two numbers a turn, never its texts.
    return numbered.groupBy("conv_id").agg(in_order.alias("t")).select(
        "conv_id", F.transform("t", lambda x: x["turn_id"]).alias("ids"), F.transform("t", lambda x: x["words"]).alias("words")
    )


def _digest_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the parts of each list, which arrive in order: a running state, never a whole list."""
    last, state = None, None
    for frame in batches:
        keys, digests = [], []
        for key, part in zip(frame["list"], frame["part"]):
            if key != last:
                if last is not None:
                    keys.append(last)
                    digests.append(state.hexdigest())
                last, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(part.encode())
        if keys:
            yield pd.DataFrame({"list": keys, "ends": digests}, dtype=object)
    if last is not None:
        yield pd.DataFrame({"list": [last], "ends": [state.hexdigest()]}, dtype=object)


def distinct_lists(conversations: DataFrame) -> DataFrame:
    """``(ids, words, ended, ended_first, ends)``: equal lists as one row, with the digest of its conversations' ids.

    Ids are written out by ranges of ``ENDS_RANGE`` numbers, so that a list which a third of all conversations share
    reaches the task that digests it as few parts, in order.
    """
    keyed = conversations.withColumn("list", F.sha2(F.array_join("ids", ","), 256))
    lists = keyed.groupBy("list").agg(
        F.any_value("ids").alias("ids"), F.any_value("words").alias("words"), F.count(F.lit(1)).alias("ended"),
        F.min("conv_id").alias("ended_first"),
    )
    range_ = F.floor(F.col("conv_id") / ENDS_RANGE).alias("range")
    parts = keyed.groupBy("list", range_).agg(F.array_sort(F.collect_list("conv_id")).alias("own")).select(
        "list", "range", F.array_join(F.transform("own", lambda c: c.cast("string")), ",").alias("part")
    )
    in_order = parts.repartition("list").sortWithinPartitions("list", "range").select("list", "part")
    return lists.join(in_order.mapInPandas(_digest_parts, "list string, ends string"), "list").drop("list")


def conversation_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS, partition_turns: int = PARTITION_TURNS,
                       fan: int = FAN) -> DataFrame:
    """Nodes of the prefix trie of ``(conv_id, ids, words)``, one row each; see :func:`prefix_trie` for the columns."""
    lists = cut_lineage(distinct_lists(conversations), "lists")
    context = lists.sparkSession.sparkContext
    turns = lists.agg(F.sum(F.size("ids").cast("long") + 1)).first()[0] or 0
    # As many partitions as the turns ask for, and on small tables as many as there are cores.
    n = max(1, -(-turns // partition_turns), min(context.defaultParallelism, turns // (partition_turns // 64 or 1)))
    in_order = lists.repartitionByRange(n, "ids").sortWithinPartitions("ids")
    found = cut_lineage(in_order.mapInPandas(_search_shards(shard_turns), _SCHEMA), "trie")
    parts = [found]
    top = found.agg(F.max("shard")).first()[0]
    while top is not None:
        edges = found.where("shard is not null").select("shard", "place", *_EDGE_COLUMNS)
        top = None if top < fan else top // fan
        merged = edges.groupBy(F.floor(F.col("shard") / fan).alias("group")).applyInPandas(_merge_edges(top is None), _SCHEMA)
        found = cut_lineage(merged, "trie")
        parts.append(found)
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    nodes = nodes.where("shard is null")
    wait = F.col("parent_key").isNotNull()
    named = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    known = nodes.where(~wait).select(*NODE_COLUMNS)
    late = nodes.where(wait).drop("parent_conv_id").join(named, "parent_key").withColumnRenamed("_parent", "parent_conv_id")
    return known.unionByName(late.select(*NODE_COLUMNS))


NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_EDGE_COLUMNS = ("ids", "words", *_OWN)


def prefix_trie(turns: DataFrame, ident: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of conversations: one row for each distinct sequence of first turns.

    Columns, all long but the last: the smallest member ``conv_id``, ``depth``, the parent's ``parent_conv_id`` (null for the
    root), members ``n_convs``, ``n_children``, childless nodes ``n_leaves`` of the subtree, ``saved_tokens`` (words that
    the members need not repeat, over the subtree) and ``ends_sha256`` over the ids of the members that end at the node.

    A null role or text counts as empty; a blank text is a text without words. Turns follow ``order``, null first, equal
    ones the digest of role and text; repeated rows are turns of their own. Rows with a null ``ident`` belong to
    no conversation. An empty table has no node, not even a root. Other columns are ignored.
    """
    return conversation_nodes(encoded_conversations(turns, ident, order, role, text))


def rebuilt(conversations: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """Conversations ``(conv_id, ids, words)`` that begin like the first one of their block of ids.

    Conversation c takes the first h turns of c - c % block (all it has, none if it does not exist), then its own after the
    first h; h is the CRC-32 of its decimal id modulo ``most``. At most ``block`` conversations meet at a key.
    """
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = conversations.withColumn("_h", taken).withColumn("_base", F.col("conv_id") - F.col("conv_id") % block)
    heads = conversations.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("_base"), F.slice("ids", 1, most - 1).alias("_ids"), F.slice("words", 1, most - 1).alias("_words")
    )
    both = own.join(heads, "_base", "left")

    def begun(head: str, tail: str):
        none = F.array().cast("array<bigint>")
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), F.col("_h")), F.slice(tail, F.col("_h") + 1, F.greatest(F.size(tail), F.lit(1))))

    return both.select("conv_id", begun("_ids", "ids").alias("ids"), begun("_words", "words").alias("words"))
