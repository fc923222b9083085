"""Hard negatives against all pairs, and intervals that hold every score."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from tripmeter.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, id string, score string, slot string"


def vectors(seed=1, n=260, size=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size)) * 0.3
    out = []
    for i in range(n):
        label = int(rng.integers(4))
        vector = (centres[label] * rng.choice([0.2, 1]) + rng.normal(size=size) * 0.15).astype(np.float32)
        if i % 9 == 0:
            vector = np.round(vector * 4) / 4
        out.append((i, [float(x) for x in vector], label))
    out += [(300, out[20][1], 1), (300, out[20][1], 1), (40, out[40][1], out[40][2]), (None, out[3][1], 2), (None, out[60][1], 0)]
    out += [(501, None, 1), (502, out[1][1], None), (503, [0.5, None] + out[1][1][2:], 1), (504, [math.nan] * size, 1), (505, [math.inf] * size, 2)]
    out += [(506, [], 1), (507, [0.25, -0.5], 1), (520, [0.0] * size, 0)]
    return [(a, b, c, "r", "i", "s", "t") for a, b, c in out]


def brute(data, every=20, positives=5, keep=10):
    rows = []
    for vec_id, vector, label, *_ in data:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        rows.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, (anchor, label, vector) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        found = sorted((-score(vector, v), k is None, k or 0, j) for j, (k, _, v) in enumerate(rows) if j != i)
        own = [f for f in found if rows[f[3]][1] == label][:positives]
        for p in own:
            inside = [f for f in found if rows[f[3]][1] != label and -30 * p[0] <= -100 * f[0] <= -90 * p[0]][:keep]
            out += [(anchor, rows[p[3]][0], r + 1, rows[f[3]][0], -p[0], -f[0]) for r, f in enumerate(inside)]
    return sorted(out, key=repr)


def found(spark, data, path, **more):
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    codes = negatives.prepared(frame, f"{path}/codes", "embedding", F.col("vec_id"), F.col("label"), F.col("vec_id") % 20 == 0)
    got = negatives.hard_negatives(codes, path, **more).collect()
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got), key=repr)


@pytest.mark.parametrize("block_values", [1 << 21, 200])
def test_all_pairs(spark, path, block_values):
    data = vectors()
    want = brute(data)
    assert len(want) > 200
    assert found(spark, data, path, block_values=block_values) == want


def test_small_batches(spark, path, monkeypatch):
    """Limits that rise from batch to batch leave nothing out."""
    data = vectors(7, 400)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert found(spark, data, path) == brute(data)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


@pytest.mark.parametrize("size", [3, 64, 100])
def test_intervals_hold_scores(size):
    rng = np.random.default_rng(size)
    rows = np.floor(rng.normal(size=(300, size)) * 60)
    rows[0] = 0
    rows[1] = 7
    whole = np.zeros((300, negatives.padded(size)))
    whole[:, :size] = rows
    anchors = negatives.Anchors(np.arange(40), np.zeros(40, int), whole[:40])
    bits, alignment, rest = negatives.encode(whole)
    low, high = anchors.intervals(bits, alignment, rest, slice(0, 40))
    exact = rows @ rows[:40].T
    assert (low <= exact).all() and (exact <= high).all()
    lengths = np.linalg.norm(rows, axis=1)
    width = (high - low) / 2
    # Far narrower than what lengths alone allow.
    assert np.median(width[2:, 2:] / np.outer(lengths[2:], lengths[2:40])) < 0.35


def test_rotation_keeps_products():
    rng = np.random.default_rng(2)
    values = rng.normal(size=(20, 128))
    turned = negatives.rotate(values)
    assert np.allclose(turned @ turned.T, values @ values.T)


def test_far_numbers(spark, path):
    data = [(20, [1e30, 1.0], 1, *"abcd"), (21, [1e30, 2.0], 1, *"abcd"), (22, [1e12, 5.0], 2, *"abcd"), (23, [3e8, 1.0], 2, *"abcd")]
    got = found(spark, data, path)
    assert all(r[4] == 2**63 - 1 for r in got)
    assert found(spark, [], f"{path}/empty") == []
