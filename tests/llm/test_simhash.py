"""Fingerprints and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from fixtures import empty, lower, rows, table, words_of
from pyspark.sql import functions as F

from tripmeter.llm import graphs, simhash
from tripmeter.session import scratch_path


def fingerprint(text, size=3):
    words = words_of(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i:i + size]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, bits=3):
    up = list(range(len(pairs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(pairs):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(least.get(find(i)), find(i)) for i in range(len(pairs))]


def component_ids(pairs, bits=3):
    return [c for c, _ in components(pairs, bits)]


def test_against_all_pairs(spark):
    pairs = [(r[0], fingerprint(r[1])) for r in rows()]
    want = sorted((str(k), format(f, "016x"), str(c)) for (k, f), c in zip(pairs, component_ids(pairs), strict=True))
    got = simhash.near_duplicates(table(spark), scratch_path(spark, "s"))
    assert sorted((str(r.doc_id), r.h, str(r.component_id)) for r in got.withColumn("h", simhash.as_hex(F.col("fp"))).collect()) == want


def flipped(value, k, rng):
    for b in rng.sample(range(64), k):
        value ^= 1 << b
    return value


def test_links_within_three_bits_are_never_lost(spark):
    rng = random.Random(9)
    values = set()
    for _ in range(150):
        value = rng.getrandbits(64)
        values.add(value)
        for _ in range(6):
            value = flipped(value, rng.randint(1, 5), rng)
            values.add(value)
    values |= {rng.getrandbits(8) for _ in range(60)} | {0, (1 << 64) - 1}
    pairs = [(v, v) for v in sorted(values)]
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp bigint")
    for block in (simhash.BLOCK, 7):  # 7: cells are cut into blocks that meet in units
        links = simhash.near_links(frame, 3, scratch_path(spark, "l"), block).collect()
        assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 3 for r in links)
        roots = {r.node: r.root for r in graphs.components(spark.createDataFrame(links, "a bigint, b bigint"), scratch_path(spark, "g")).collect()}
        group = {}
        for (v, _), want in zip(pairs, component_ids(pairs), strict=True):
            own = roots.get(simhash._signed(v), simhash._signed(v))
            assert group.setdefault(own, want) == want
        assert len(set(group.values())) == len(group)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 1 << 64, 2000, dtype=np.uint64) for _ in range(2))
    counts = lambda x: np.stack([np.bitwise_count((x >> np.uint64(2 * i)) & np.uint64(3)) for i in range(32)]).astype(int)
    assert (simhash.manhattan(a, b) == np.abs(counts(a) - counts(b)).sum(axis=0)).all()
    assert (simhash.manhattan(a, b) <= np.bitwise_count(a ^ b)).all()


def test_few_meet_by_chance():
    """Pairs to compare among random fingerprints, cells as they are and cells that are coarser."""
    fps = np.random.default_rng(5).integers(0, 1 << 64, 20_000, dtype=np.uint64)
    even = np.uint64(simhash._EVERY_SECOND)
    moved = fps >> np.uint64(1)
    coordinates = ((moved & fps & even) << np.uint64(1)) | ((moved ^ fps) & even)

    def pairs(key_groups):
        masks = [np.uint64(m & ((1 << 64) - 1)) for m in simhash.grids(3, key_groups)]
        sizes = [np.unique(coordinates & m, return_counts=True)[1] for m in masks]
        return sum(int((n * (n - 1) // 2).sum()) for n in sizes)

    assert len(simhash.grids(3)) == 56
    assert pairs(simhash.KEY_GROUPS) < 100 < pairs(3)


def test_range_probe_in_a_unit():
    rng = np.random.default_rng(6)
    seeds = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds] + [seeds ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(9)]))
    fps = fps[np.lexsort((fps, np.bitwise_count(fps)))]
    a, b = simhash.links_in(np.zeros(len(fps), np.int64), fps, 3)
    assert (np.bitwise_count(a ^ b) <= 3).all()
    want = component_ids([(int(v), int(v)) for v in fps])
    up = {int(v): int(v) for v in fps}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        up[max(p, q)] = min(p, q)
    assert [find(int(v)) for v in fps] == want


def test_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = graphs.components(spark.createDataFrame(links, "a bigint, b bigint"), scratch_path(spark, "g")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
    assert len(got) == 203


def test_one_of_each(spark):
    data = rows()
    pairs = [(r[0], fingerprint(r[1])) for r in data]
    kept = simhash.one_of_each(table(spark), scratch_path(spark, "s"))
    assert kept.columns == table(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    # An id with several texts may stand for several components.
    assert sorted(map(str, ids)) == sorted(str(c) for c, _ in set(components(pairs)))


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark), scratch_path(spark, "s")).count() == 0
    assert simhash.one_of_each(empty(spark), scratch_path(spark, "s")).count() == 0


def test_columns_with_the_names_that_are_used_inside(spark):
    docs = table(spark).selectExpr("doc_id", "text", *[f"'mine' AS `{c}`" for c in ("_key", "_hash", "_N", "_no_id", "_id", "block", "part", "root", "least")])
    kept = simhash.one_of_each(docs, scratch_path(spark, "s"))
    assert kept.columns == docs.columns
    assert kept.where(" AND ".join(f"`{c}` = 'mine'" for c in docs.columns[2:])).count() == kept.count() == simhash.one_of_each(table(spark), scratch_path(spark, "s")).count()


def test_cells_are_not_broadcast(spark, path, monkeypatch):
    """A table of fingerprints under the broadcast threshold has 56 times as many cells, which may be far above it."""
    frame, plans = type(spark.range(0)), []
    run = frame.mapInArrow

    def seen(self, *args, **more):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return run(self, *args, **more)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    spark.createDataFrame([(0,), (7,), (8,), (1 << 40,), (-1,)], "fp bigint").write.parquet(path + "/fps")
    links = simhash.near_links(spark.read.parquet(path + "/fps"), 3, path + "/links")
    assert {x for r in links.collect() for x in (r.a, r.b)} == {0, 7, 8, 1 << 40}
    assert "Join" in plans[0] and "Broadcast" not in plans[0]
