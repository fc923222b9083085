"""A trie of conversation prefixes, built in shards as balanced parentheses.

A conversation is a path of turns; equal turns have equal keys (SHA-256, 128 bits of it).  Paths are
sorted into ranges, so equal prefixes stand together, and only the first and the last path of a range
can have nodes in common with other ranges.  Each range is a shard: its paths give a sequence of
balanced parentheses, ``findclose`` delimits the subtrees, ranks of leaf pairs count the leaves, and
cumulative arrays give members and savings.  Nodes off the first and last path are complete.  Those on
them (the spines) are handed on, with the sums of what hangs on them, as paths of the next level, where
equal spines of different shards merge; a level has a fraction of the paths of the one below it, and
the last level is one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmeter.llm.parentheses import Parentheses
from tripmeter.llm.texts import WORD, reach_workers
from tripmeter.operators.skew import join_facts

#: Turns of one shard, and paths that a shard has at least on average, so that each level leaves fewer.
SHARD_TURNS = 1 << 15
LEAST_PATHS = 8
KEY_BYTES = 16
_NONE = np.iinfo(np.int64).max
_SUMS = ("members", "least", "leaves", "children", "saved")
_EMPTY = hashlib.sha256(b"").hexdigest()
_MADE = (
    "kind string, prefix binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string, path_keys binary, words array<int>, "
    + ", ".join(f"{s} array<bigint>" for s in _SUMS)
)


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path``: the turns of each conversation in order, as ``known, turn, key, words``.

    A null turn comes first; turns of one number are ordered by their key.  Null roles and texts are
    empty ones; rows without a conversation take no part.  The keys of one conversation have to fit
    into a task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY_BYTES)
    turn = F.col("turn").cast("long")
    step = F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), step.alias("step")).where(F.col("conv_id").isNotNull())
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("step")).alias("path"))


def stored_paths(paths: DataFrame, path: str) -> DataFrame:
    """``conv_id, path_keys, words``: keys of a path as one byte string, which sorts prefixes before what they begin."""
    joined = F.unhex(F.array_join(F.transform("path", lambda s: s["key"]), ""))
    paths.select("conv_id", joined.alias("path_keys"), F.transform("path", lambda s: s["words"]).alias("words")).write.parquet(path)
    return paths.sparkSession.read.parquet(path)


@dataclass
class Paths:
    """Sorted paths: conversation, keys (16 bytes a turn), words by turn; from the second level on sums by node."""

    conv_ids: list[int]
    keys: list[bytes]
    words: list[list[int]]
    sums: dict[str, list[list[int]]] | None

    @classmethod
    def read(cls, table: pa.Table) -> Paths:
        sums = {s: table.column(s).to_pylist() for s in _SUMS} if "members" in table.column_names else None
        return cls(*(table.column(c).to_pylist() for c in ("conv_id", "path_keys", "words")), sums)


def common_turns(a: bytes, b: bytes) -> int:
    """Turns with which both paths begin."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY_BYTES
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // KEY_BYTES


def range_min(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value of each range [begin, end), by doubling."""
    out = np.empty(len(begin), values.dtype)
    power = np.floor(np.log2(np.maximum(end - begin, 1))).astype(int)
    row, width = values, 1
    for p in range(int(power.max(initial=0)) + 1):
        own = np.flatnonzero(power == p)
        out[own] = np.minimum(row[begin[own]], row[end[own] - width])
        if len(row) > width:
            row = np.minimum(row[:-width], row[width:])
        width *= 2
    return out


class Shard:
    """The trie of sorted paths; node 0 is the root, nodes are numbered in preorder."""

    def __init__(self, paths: Paths) -> None:
        self.paths = paths
        n = len(paths.keys)
        sizes = np.array([len(k) // KEY_BYTES for k in paths.keys], np.int64)
        self.shared = np.array([0, *(common_turns(a, b) for a, b in zip(paths.keys[:-1], paths.keys[1:], strict=True))], np.int64)
        fresh = sizes - self.shared
        first = 1 + np.cumsum(fresh) - fresh
        total = int(1 + fresh.sum())
        self.parent = np.arange(-1, total - 1)
        self.depth = np.zeros(total, np.int64)
        self.words = np.zeros(total, np.int64)
        direct = {s: np.zeros(total, np.int64) for s in _SUMS}
        direct["least"][:] = _NONE
        self.end = np.empty(n, np.int64)
        here = np.zeros(int(sizes.max(initial=0)) + 1, np.int64)
        self.nodes_of: dict[int, np.ndarray] = {}
        for i in range(n):
            low, high, node = int(self.shared[i]), int(sizes[i]), int(first[i])
            if high > low:
                self.parent[node] = here[low]
                here[low + 1:high + 1] = np.arange(node, node + high - low)
                self.depth[node:node + high - low] = np.arange(low + 1, high + 1)
                self.words[node:node + high - low] = paths.words[i][low:]
            self.end[i] = here[high]
            if i in (0, n - 1):
                self.nodes_of[i] = here[:high + 1].copy()
            if paths.sums is not None:
                nodes = here[:high + 1]
                for s in _SUMS:
                    values = np.array(paths.sums[s][i], np.int64)
                    direct[s][nodes] = np.minimum(direct[s][nodes], values) if s == "least" else direct[s][nodes] + values
        if paths.sums is None:
            direct["members"] += np.bincount(self.end, minlength=total)
            np.minimum.at(direct["least"], self.end, np.array(paths.conv_ids, np.int64))
        self.direct = direct
        closing = np.concatenate([[0], sizes[:-1] - self.shared[1:], [sizes[-1]]]) if n else np.zeros(1, np.int64)
        counts = np.concatenate([[1], np.column_stack([closing[:-1], fresh]).ravel(), [closing[-1] + 1]]).astype(np.int64)
        tree = Parentheses(np.repeat(np.concatenate([[True], np.tile([False, True], n), [False]]), counts))
        close = tree.find_close(tree.opens)
        self.past = tree.rank[close]
        own_children = np.bincount(self.parent[1:], minlength=total)
        self.children = own_children + direct["children"]
        self.members = self._inside(direct["members"])
        # A pair without a child here is no leaf if it has children in other shards.
        not_leaf = (own_children == 0) & (direct["children"] > 0)
        self.leaves = tree.leaves(close) - self._inside(not_leaf) + self._inside(direct["leaves"])
        self.saved = self._inside((self.members - 1) * self.words + direct["saved"])
        self.least = range_min(direct["least"], np.arange(total), self.past)

    def _inside(self, values: np.ndarray) -> np.ndarray:
        """Sum of values over each node's subtree."""
        running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return running[self.past] - running[:-1]

    def hanging(self, spine: np.ndarray) -> dict[str, np.ndarray]:
        """Sums of the nodes of a spine with what hangs on them beside the spines."""
        out = {s: v.copy() for s, v in self.direct.items()}
        off = np.flatnonzero(~spine)
        off = off[spine[self.parent[off]]]
        at = self.parent[off]
        for s, v in (("members", self.members), ("leaves", self.leaves), ("saved", self.saved), ("children", np.ones_like(self.members))):
            np.add.at(out[s], at, v[off])
        np.minimum.at(out["least"], at, self.least[off])
        return out


def prefixes(keys: bytes) -> list[bytes]:
    """A name for the path's beginnings of 0, 1, … turns."""
    running = hashlib.sha256()
    out = [running.digest()]
    for i in range(0, len(keys), KEY_BYTES):
        running.update(keys[i:i + KEY_BYTES])
        out.append(running.copy().digest())
    return out


def shard_rows(paths: Paths, last: bool) -> list[dict]:
    """What a shard knows (kinds): complete nodes, its spines, and the conversations that end at spine nodes."""
    if not paths.keys:
        return []
    shard, first_level, n = Shard(paths), paths.sums is None, len(paths.keys)
    total = len(shard.parent)
    names: list[bytes | None] = [None] * total
    for i in range(n) if not first_level else sorted({0, n - 1}) if not last else ():
        nodes = shard.nodes_of.get(i)
        own = prefixes(paths.keys[i])
        if nodes is None:
            nodes = _walk(shard, int(shard.end[i]), len(own))
        for node, name in zip(nodes.tolist(), own, strict=True):
            names[node] = name
    spine = np.zeros(total, bool)
    if not last:
        spine[shard.nodes_of[0]] = spine[shard.nodes_of[n - 1]] = True
    ends: dict[int, list[int]] = {}
    if first_level:
        for node, conv in zip(shard.end.tolist(), paths.conv_ids, strict=True):
            ends.setdefault(node, []).append(conv)
    rows: list[dict] = []
    for node in np.flatnonzero(~spine).tolist():
        up = int(shard.parent[node])
        known = up >= 0 and not spine[up]
        rows.append({
            "kind": "node", "prefix": names[node], "parent": names[up] if up >= 0 and not known else None, "conv_id": int(shard.least[node]),
            "depth": int(shard.depth[node]), "parent_conv_id": int(shard.least[up]) if known else None, "n_convs": int(shard.members[node]),
            "n_children": int(shard.children[node]), "n_leaves": int(shard.leaves[node]), "saved_tokens": int(shard.saved[node]),
            "ends": hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest() if node in ends else _EMPTY if first_level else None,
        })
    if last:
        return rows
    for node in np.flatnonzero(spine).tolist():
        if node in ends:
            rows.append({"kind": "ends", "prefix": names[node], "conv_id": ends[node][0], "ends": ",".join(map(str, ends[node]))})
    sums = shard.hanging(spine)
    taken = np.zeros(total, bool)
    for i in sorted({0, n - 1}):
        nodes = shard.nodes_of[i]
        new = ~taken[nodes]
        if not new.any():
            continue
        taken[nodes] = True
        # What both spines share is counted once.
        own = {s: np.where(new, sums[s][nodes], _NONE if s == "least" else 0).tolist() for s in _SUMS}
        rows.append({"kind": "spine", "conv_id": paths.conv_ids[i], "path_keys": paths.keys[i], "words": paths.words[i], **own})
    return rows


def _walk(shard: Shard, node: int, count: int) -> np.ndarray:
    """The nodes from the root to ``node``."""
    out = np.empty(count, np.int64)
    for i in range(count - 1, -1, -1):
        out[i] = node
        node = int(shard.parent[node])
    return out


def _level(paths: DataFrame, shards: int, path: str) -> DataFrame:
    """One level of shards, stored."""
    columns = [c for c in ("conv_id", "path_keys", "words", *_SUMS) if c in paths.columns]
    frame = paths.select(*columns)
    last = shards == 1
    dealt = frame.repartition(1) if last else frame.repartitionByRange(shards, "path_keys", "conv_id")

    made = StructType.fromDDL(_MADE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(made)
        whole = list(batches)
        if whole:
            rows = shard_rows(Paths.read(pa.Table.from_batches(whole)), last)
            for begin in range(0, len(rows), 5000):
                yield pa.RecordBatch.from_pylist(rows[begin:begin + 5000], schema=schema)

    dealt.sortWithinPartitions("path_keys", "conv_id").mapInArrow(run, _MADE).write.parquet(path)
    return paths.sparkSession.read.parquet(path)


def joined_ends(pieces: DataFrame) -> DataFrame:
    """``prefix, ends_sha256``: the digest of each node's pieces in order, a piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, running = None, hashlib.sha256()
        schema = pa.schema([("prefix", pa.binary()), ("ends_sha256", pa.string())])

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"prefix": prefix, "ends_sha256": running.hexdigest()}], schema=schema)

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name != prefix:
                    if prefix is not None:
                        yield made()
                    prefix, running = name, hashlib.sha256(ids.encode())
                else:
                    running.update(f",{ids}".encode())
        if prefix is not None:
            yield made()

    sorted_pieces = pieces.select("prefix", "conv_id", "ends").repartition("prefix").sortWithinPartitions("prefix", "conv_id")
    return sorted_pieces.mapInArrow(run, "prefix binary, ends_sha256 string")


def prefix_trie(paths: DataFrame, scratch: str, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``paths`` (``conv_id, path`` as of :func:`conversation_paths`).

    ``conv_id`` is the node's smallest member; ``depth, parent_conv_id`` (the parent's, null for the
    root); ``n_convs`` members, ``n_children``, ``n_leaves`` of the subtree, ``saved_tokens``: what the
    subtree saves when each node is kept once, in words; ``ends_sha256``: digest of the conversations
    that end there, in order.  A conversation without turns is a member of the root.  Conversations
    that repeat all have their number among the members; no conversations give no nodes.  ``scratch``
    is a folder that all executors share.
    """
    spark = reach_workers(paths.sparkSession)
    todo, level, made = stored_paths(paths, f"{scratch}/paths"), 1, []
    while True:
        size = todo.agg(F.sum(F.size("words") + 1), F.count("*")).first()
        shards = max(1, min(-(-(size[0] or 0) // shard_turns), size[1] // LEAST_PATHS))
        made.append(_level(todo, shards, f"{scratch}/level-{level}"))
        if shards == 1:
            break
        todo, level = made[-1].where("kind = 'spine'"), level + 1
    whole = made[0]
    for more in made[1:]:
        whole = whole.unionByName(more)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = whole.where("kind = 'node'").select("prefix", "parent", *columns, "ends")
    joined_ends(whole.where("kind = 'ends'")).write.parquet(f"{scratch}/ends")
    ends = spark.read.parquet(f"{scratch}/ends")
    # Where the parent was on a spine, its smallest member is known only now.
    parents = nodes.where("prefix IS NOT NULL").select(F.col("prefix").alias("parent"), F.col("conv_id").alias("above"), "n_children")
    known = nodes.where("parent IS NULL")
    rest = nodes.where("parent IS NOT NULL").drop("parent_conv_id")
    found = join_facts(rest, parents.withColumnRenamed("n_children", "below"), ["parent"], "below")
    found = found.withColumnRenamed("above", "parent_conv_id").select(*nodes.columns)
    all_nodes = known.unionByName(found)
    plain = all_nodes.where("prefix IS NULL").select(*columns, F.col("ends").alias("ends_sha256"))
    spines = all_nodes.where("prefix IS NOT NULL").join(ends, "prefix", "left")
    return plain.unionByName(spines.select(*columns, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))


def with_heads(paths: DataFrame, of: int = 20, most: int = 4) -> DataFrame:
    """Paths rebuilt: the first h turns of conversation c - c % ``of``, then the own ones from h on; h is crc32(c) % ``most``."""
    heads = paths.where(F.col("conv_id") % of == 0).select(F.col("conv_id").alias("head_id"), F.slice("path", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = paths.withColumns({"head_id": F.col("conv_id") - F.col("conv_id") % of, "h": h})
    head = F.coalesce("head", F.slice("path", 1, 0))
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(F.slice(head, F.lit(1), F.col("h")), rest).alias("path"))
