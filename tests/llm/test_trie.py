"""The trie of conversations against sets of prefixes, over one and many levels of shards."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from fixtures import words_of

from tripmeter.llm import trie
from tripmeter.llm.parentheses import Parentheses
from tripmeter.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, depth string, prefix string"


def conversations(seed=4, n=300):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        turns = [("user", f"hello {rng.randint(0, 2)}"), ("assistant", rng.choice(["yes it is", "no", ""]))]
        turns += [(rng.choice(["user", "assistant", None]), rng.choice([None, "a b", "a  b", "the end of it"])) for _ in range(rng.choice([0, 0, 1, 2, 5]))]
        if c % 3 == 0:
            turns = [("user", "the same"), ("assistant", "answer to all")]
        if c % 97 == 5:
            turns = [("user", f"turn {i}") for i in range(120)]
        out += [(c if c != 40 else -47, i if i else None, role, text, "p", "d", "x") for i, (role, text) in enumerate(turns)]
    out += [(None, 1, "user", "nobody's", "p", "d", "x"), (9000, 5, None, None, "p", "d", "x")]
    rng.shuffle(out)
    return out


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0], t[1], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()[:32]))
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h]
        paths[c] = tuple((r, t) for _, _, r, t in head + turns[h:])
    return paths


def brute(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        gain = (len(own) - 1) * len(words_of(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += gain
            leaves[node[:d]] += children[node] == 0
    return sorted((
        min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
    ) for node, own in members.items())


def nodes(found):
    return sorted(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found.collect()
    )


def key(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[3:]))


@pytest.mark.parametrize("shard_turns", [1 << 15, 200, 40])
def test_nodes(spark, path, shard_turns):
    data = conversations()
    frame = spark.createDataFrame(data, SCHEMA).repartition(4)
    paths = trie.with_heads(trie.conversation_paths(frame))
    got = trie.prefix_trie(paths, path, shard_turns)
    assert key([tuple(r) for r in nodes(got)]) == key(brute(rebuilt(data)))
    if shard_turns < 1000:
        spark.read.parquet(f"{path}/level-2")


def test_no_and_turnless_conversations(spark, path):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(trie.conversation_paths(none), path).count() == 0
    # crc32("7") % 4 turns are cut from a conversation whose head is absent.
    data = [(c, 0, "user", "x", "", "", "") for c in (7, 8, 9, 27, 28)]
    paths = rebuilt(data)
    assert any(not p for p in paths.values())
    found = trie.prefix_trie(trie.with_heads(trie.conversation_paths(spark.createDataFrame(data, SCHEMA))), f"{path}/b")
    assert nodes(found) == brute(paths)


def test_long_turns(spark, path):
    text = "word " * 1_000_000
    data = [(20, 0, "user", text, "", "", ""), (40, 0, "user", text, "", "", ""), (60, 0, "user", text + "x", "", "", "")]
    found = trie.prefix_trie(trie.conversation_paths(spark.createDataFrame(data, SCHEMA)), path)
    assert {(r.n_convs, r.saved_tokens) for r in found.where("depth = 1").collect()} == {(2, 1_000_000), (1, 0)}


def test_given_table(spark):
    got = QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001")
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert key([tuple(r) for r in nodes(got)]) == key(brute(rebuilt(data)))


@pytest.mark.parametrize("n", [1, 2, 31, 64, 700, 5000])
def test_parentheses(n):
    rng = random.Random(n)
    bits, open_, left = [], 0, n
    while left or open_:
        if left and (not open_ or rng.random() < 0.52):
            bits.append(True)
            open_, left = open_ + 1, left - 1
        else:
            bits.append(False)
            open_ -= 1
    tree = Parentheses(np.array(bits))
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    assert tree.find_close(tree.opens).tolist() == [close[i] for i in np.flatnonzero(bits).tolist()]
    chain = Parentheses(np.repeat([True, False], n))
    assert chain.find_close(chain.opens).tolist() == list(range(2 * n - 1, n - 1, -1))
