"""Conversation prefix trie: ternary search trees over turn ids, one per range shard.

1. Dictionary: every distinct turn (role, text) has an id; turns meet theirs by SHA-256.
2. Sequences: conversations are arrays of turn ids (here: rebuilt ones, that begin with the first
   turns of another).  Equal sequences become one row with their number and least conv_id.
3. Shards: distinct sequences are range-partitioned in order of their ids.  A shard inserts
   its sequences into a ternary search tree, the median first, so the tree of each node's
   children is balanced without rotations.
4. Traversal: with a stack of its own, no recursion.  Nodes in order of the sequences give
   members, children, leaves and saved tokens of each subtree from behind.
5. Boundary nodes: a node that several shards hold lies on the first or the last path of each
   of them.  Only these paths (two a shard) go to one task, which goes through them in
   order with one open path, adds up the parts and corrects what the parts could not know:
   a child counted by several shards, a leaf that has children elsewhere, and a first copy
   that each shard counted for itself.
6. The conv_ids that end at a node are hashed as a sorted stream, whatever their number.

Defined results: null roles and texts are empty; rows with a null conv_id take no part; turns
are ordered with null first, equal turns by the SHA-256 of their role and text; repeated
rows are turns of their own; an empty table gives no rows; other columns are not read.  A
conversation is one row of ids, so its length is bounded by what a task can hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.llm.shared import partitions, written

SHARD = 200_000  # turns of a shard, about
WORD = r"[^\x20\x09-\x0D]+"
TURN = "array<struct<id: bigint, words: bigint>>"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, as (id, words of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = (conversations.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
            .withColumn("digest", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))
    rows = written(rows.select("conv_id", "turn", "digest", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))
    ids = written(rows.groupBy("digest").agg(F.min("words").alias("words")).withColumn("id", F.monotonically_increasing_id()))
    whole = (rows.select("conv_id", "turn", "digest").join(ids, "digest")
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "words"))).alias("turns")))
    return whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(whole: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first h turns of conversation c - c % every, h = crc32(c) % most."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    heads = whole.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    rows = whole.withColumn("h", h.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.array().cast(TURN)).otherwise(F.expr("slice(head, 1, h)"))
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return rows.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def ends_of(named: DataFrame, n: int) -> DataFrame:
    """(path, ends_sha256): SHA-256 of the comma-joined ascending conv_ids of each path, streamed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state = None, None
        for batch in batches:
            done = []
            for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
                if p != path:
                    if path is not None:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(str(c).encode())
                else:
                    state.update(f",{c}".encode())
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "ends_sha256": [s for _, s in done]}, schema=shape)
        if path is not None:
            yield pa.RecordBatch.from_pydict({"path": [path], "ends_sha256": [state.hexdigest()]}, schema=shape)

    shape = pa.schema([("path", pa.string()), ("ends_sha256", pa.string())])
    return (named.select("path", "conv_id").repartition(n, "path").sortWithinPartitions("path", "conv_id")
            .mapInArrow(run, "path string, ends_sha256 string"))


class TernaryTree:
    """Sequences of ids as a ternary search tree in lists; node 0 is the root of the trie."""

    def __init__(self):
        self.key, self.low, self.high, self.eq, self.depth, self.words = [None], [0], [0], [0], [0], [0]

    def _add(self, key: int, words: int, depth: int) -> int:
        for values, value in ((self.key, key), (self.low, 0), (self.high, 0), (self.eq, 0), (self.depth, depth), (self.words, words)):
            values.append(value)
        return len(self.key) - 1

    def insert(self, ids: list[int], words: list[int]) -> int:
        """The node of the whole sequence."""
        at = 0
        for depth, (k, w) in enumerate(zip(ids, words), 1):
            now = self.eq[at]
            if not now:
                now = self.eq[at] = self._add(k, w, depth)
            while k != self.key[now]:
                side = self.low if k < self.key[now] else self.high
                if not side[now]:
                    side[now] = self._add(k, w, depth)
                now = side[now]
            at = now
        return at

    def insert_sorted(self, rows: list[tuple[list[int], list[int]]]) -> list[int]:
        """The nodes of ascending sequences: the median is inserted first, then those of both halves."""
        nodes, todo = [0] * len(rows), [(0, len(rows))]
        while todo:
            lo, hi = todo.pop()
            if lo < hi:
                mid = (lo + hi) // 2
                nodes[mid] = self.insert(*rows[mid])
                todo += [(lo, mid), (mid + 1, hi)]
        return nodes

    def in_order(self) -> list[tuple[int, int]]:
        """(node, parent) in order of the sequences, parents before their children."""
        out, todo = [(0, -1)], [(self.eq[0], 0, False)]
        while todo:
            node, parent, lower_done = todo.pop()
            if not node:
                continue
            if not lower_done:
                todo += [(node, parent, True), (self.low[node], parent, False)]
            else:
                out.append((node, parent))
                todo += [(self.high[node], parent, False), (self.eq[node], node, False)]
        return out


_PART = [("shard", pa.int64()), ("side", pa.int64()), ("depth", pa.int64()), ("key", pa.int64()), ("words", pa.int64()), ("conv_id", pa.int64()),
         ("parent_conv_id", pa.int64()), ("parent_side", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("leaf", pa.bool_()), ("path", pa.string())]
PART = ", ".join(f"{n} {'boolean' if t == pa.bool_() else 'string' if t == pa.string() else 'long'}" for n, t in _PART)


def shard_nodes(shard: int, rows: list[dict]) -> pa.RecordBatch:
    """Nodes of one shard.  ``side`` is 0 or 1 on its first or last path (a node of both has a row for each), else null.

    An inner node whose parent lies on a path names the parent by ``parent_side``.
    """
    tree = TernaryTree()
    ends = tree.insert_sorted([([t["id"] for t in r["turns"]], [t["words"] for t in r["turns"]]) for r in rows])
    order = tree.in_order()
    n = len(tree.key)
    members, least, children, leaves, saved, path = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n, [None] * n
    for node, r in zip(ends, rows):
        members[node], least[node], path[node] = r["n"], r["first"], r["path"]
    for node, parent in reversed(order):
        if not children[node]:
            leaves[node] = 1
        saved[node] += (members[node] - 1) * tree.words[node]
        if parent >= 0:
            members[parent] += members[node]
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    above = dict(order)
    sides: dict[int, list[int]] = {}
    for side, node in ((0, ends[0]), (1, ends[-1])):
        while node >= 0:
            sides.setdefault(node, []).append(side)
            node = above[node]
    out = []
    for node, parent in order:
        own = sides.get(node, [None])
        inside = own == [None] and parent not in sides
        for side in own:
            out.append((shard, side, tree.depth[node], tree.key[node], tree.words[node], least[node], least[parent] if inside else None,
                        sides[parent][0] if own == [None] and not inside else None, members[node], children[node], leaves[node], saved[node],
                        children[node] == 0, path[node]))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), _PART)], names=[x for x, _ in _PART])


def parts(distinct: DataFrame, shards: int) -> DataFrame:
    """The nodes of all shards, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]  # of one shard
        if rows:
            yield shard_nodes(TaskContext.get().partitionId(), rows)

    return written(distinct.repartitionByRange(shards, "turns").sortWithinPartitions("turns").mapInArrow(run, PART))


def merge_boundaries(rows: Iterator[dict]) -> Iterator[tuple]:
    """Boundary parts in order of (shard, side, depth) -> ("node", ...) and ("place", ...) rows.

    One path is open at a time.  A node is closed when the next path leaves it; its parent
    takes over what the node's parts had counted more than once.
    """
    open_path: list[dict] = []
    number = 0

    def close():
        x = open_path.pop()
        shards = x["shards"]
        # leaves: of all parts where the node itself counted as one, at most one is right
        leaf_fix = x["leaf_fix"] + (int(x["children"] == 0) - x["leaf_parts"])
        saved_fix = x["saved_fix"] + (shards - 1) * x["words"]
        if open_path:
            up = open_path[-1]
            up["children"] -= shards - 1
            up["leaf_fix"] += leaf_fix
            up["saved_fix"] += saved_fix
        return ("node", x["number"], x["parent"], x["depth"], x["conv_id"], x["members"], x["children"], x["leaves"] + leaf_fix,
                x["saved"] + saved_fix, x["path"], None, None)

    for r in rows:
        depth = r["depth"]
        # a path starts with the root; what is open below the place where it departs is closed
        if len(open_path) > depth and (open_path[depth]["key"] != r["key"]):
            while len(open_path) > depth:
                yield close()
        if len(open_path) == depth:
            parent = open_path[-1]["number"] if open_path else None
            open_path.append({"key": r["key"], "number": number, "parent": parent, "depth": depth, "conv_id": r["conv_id"], "members": 0, "children": 0,
                              "leaves": 0, "saved": 0, "leaf_parts": 0, "leaf_fix": 0, "saved_fix": 0, "shards": 0, "last": -1, "path": None, "words": r["words"]})
            number += 1
        x = open_path[depth]
        if x["last"] != r["shard"]:
            x["last"] = r["shard"]
            x["shards"] += 1
            x["conv_id"] = min(x["conv_id"], r["conv_id"])
            x["members"] += r["n_convs"]
            x["children"] += r["n_children"]
            x["leaves"] += r["n_leaves"]
            x["saved"] += r["saved_tokens"]
            x["leaf_parts"] += r["leaf"]
            x["path"] = x["path"] or r["path"]
        yield ("place", x["number"], None, depth, None, None, None, None, None, None, r["shard"], r["side"])
    while open_path:
        yield close()


_MERGED = [("kind", pa.string()), ("number", pa.int64()), ("parent", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
           ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("path", pa.string()), ("shard", pa.int64()), ("side", pa.int64())]
MERGED = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _MERGED)


def merged(found: DataFrame) -> DataFrame:
    """Nodes on the shards' paths, put together in one task: two paths a shard, however many sequences there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), _MERGED)], names=[x for x, _ in _MERGED])

        for row in merge_boundaries(r for batch in batches for r in batch.to_pylist()):
            held.append(row)
            if len(held) >= 10_000:
                yield out()
                held = []
        if held:
            yield out()

    rows = found.filter("side is not null").repartition(1).sortWithinPartitions("shard", "side", "depth")
    return written(rows.mapInArrow(run, MERGED))


def trie(whole: DataFrame, shards: int | None = None) -> DataFrame:
    """Every node of the prefix trie of (conv_id, turns)."""
    spark = whole.sparkSession
    path = F.sha2(F.concat_ws(",", F.transform("turns", lambda t: t["id"].cast("string"))), 256)
    named = written(whole.withColumn("path", path))
    distinct = written(named.groupBy("turns", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")))
    if shards is None:
        shards = max(1, -(-(distinct.agg(F.sum(F.size("turns"))).first()[0] or 0) // SHARD))
    found = parts(distinct, shards)
    ends = ends_of(named, partitions(spark))
    both = merged(found)
    nodes = both.filter("kind = 'node'")
    above = nodes.select(F.col("number").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    boundary = nodes.drop("parent_conv_id").join(above, "parent", "left")
    # inner nodes below a boundary node take its conv_id by its place on the shard's path
    places = (both.filter("kind = 'place'").select("shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), "number")
              .join(nodes.select("number", F.col("conv_id").alias("above")), "number").drop("number"))
    inner = (found.filter("side is null").join(places, ["shard", "parent_side", "depth"], "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")))
    columns = [*COLUMNS[:-1], "path"]
    every = boundary.select(*columns).unionByName(inner.select(*columns))
    return every.join(ends, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).select(*COLUMNS)
