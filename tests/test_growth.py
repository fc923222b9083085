"""Work per row that must not grow: hashes a row in the bootstrap, sorted rows and passes of a split."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmeter.models import preprocess
from tripmeter.operators import intervals, sampling
from workload import queries

FOLDER = "/root/testdata/sf0.001"
POISSON = [int(t, 16) for t in intervals.POISSON]


def drawn(key: str, replicates: int) -> list[int]:
    """Weights worked out one by one."""
    digests = [hashlib.md5(f"{key}:{i}".encode()).hexdigest() for i in range(-(-replicates // 8))]
    numbers = [int(digests[b // 8][4 * (b % 8):][:4], 16) for b in range(replicates)]
    return [sum(n >= t for t in POISSON) for n in numbers]


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("replicates", [3, 8, 13, 40])
def test_bootstrap_hashes_a_row_once_per_digest(spark, replicates):
    rows = [("a", 1.5, "1"), ("a", 4.0, "2"), ("a", None, "3"), ("a", 9.0, None), (None, 2.0, "4"), ("b", None, "5"), *[("c", float(i), f"c{i}") for i in range(40)]]
    df = spark.createDataFrame(rows, "k string, x double, id string")
    found = intervals.bootstrap_mean(df, "x", "id", ["k"], replicates)
    assert optimized(found).count("md5(") == 1
    got = {r.k: tuple(r)[1:] for r in found.collect()}
    assert set(got) == {"a", "b", "c", None} and got["b"] == (0, None, None, None)
    for group in ("a", "c", None):
        own = [(x, drawn(key, replicates)) for k, x, key in rows if k == group and x is not None and key is not None]
        w, x = np.array([w for _, w in own], dtype=float), np.array([x for x, _ in own])
        means = (w.T @ x)[w.sum(axis=0) > 0] / w.sum(axis=0)[w.sum(axis=0) > 0]
        ends = np.quantile(means, [0.025, 0.975]) if len(means) else [None, None]
        assert got[group] == pytest.approx((len(own), x.mean(), *ends))


def test_bootstrap_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([], "x double, y double, id string")
    assert tuple(intervals.bootstrap_mean(df, "x", "id").first()) == (0, None, None, None)
    assert tuple(intervals.bootstrap_slope(df, "x", "y", "id").first()) == (0, None, None, None)


def test_bootstrap_slope_hashes_a_row_once_per_digest(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=60), rng.normal(size=60)
    rows = [(float(a), float(b), str(i)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    found = intervals.bootstrap_slope(spark.createDataFrame(rows, "x double, y double, id string"), "x", "y", "id", replicates=11)
    assert optimized(found).count("md5(") == 1
    w = np.array([drawn(str(i), 11) for i in range(60)], dtype=float)
    slopes = [np.polyfit(x, y, 1, w=np.sqrt(w[:, b]))[0] for b in range(11)]
    assert tuple(found.first()) == pytest.approx((60, np.polyfit(x, y, 1)[0], *np.quantile(slopes, [0.025, 0.975])))


@pytest.mark.parametrize("name", ["mean_interval_by_hour", "missing_rate_interval", "slope_interval"])
def test_registered_intervals_hash_a_row_once_per_digest(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    assert optimized(found).count("md5(") == (2 if name == "slope_interval" else 1)


def test_bootstrap_cuts_numbers_from_bytes(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(500)], "id string")
    rows, names = intervals._drawn(df, "id", 13)
    assert re.search(r"cast\(md5\(.*\) as binary\) AS _digest", optimized(rows))
    got = df.select("id", F.array(*intervals.weights(F.col("id"), 13)).alias("w")).collect()
    assert {r.id: r.w for r in got} == {f"k{i}": drawn(f"k{i}", 13) for i in range(500)}
    kept = rows.select("_i", F.array(*names).alias("w")).collect()
    want = [(i, tuple((drawn(f"k{k}", 13) + [None] * 3)[8 * i:8 * i + 8])) for k in range(500) for i in range(2)]
    assert sorted(map(str, ((r._i, tuple(r.w)) for r in kept))) == sorted(map(str, want))


def digest(key) -> str:
    return hashlib.md5(f"42:{key}".encode()).hexdigest()


def test_split_sorts_edge_buckets_only(spark, monkeypatch):
    # With one digit the buckets of 16 hold many rows; keys repeat, also where a quota ends.
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    rows = [(s, f"{s}{i // 3}", i) for s, n in {"a": 1000, "b": 11, "c": 10, "d": 47}.items() for i in range(n)]
    df = spark.createDataFrame([*rows, ("a", None, -1)], "s string, id string, i int").repartition(5)
    found = sampling.stratified_split(df, "s", F.col("id"))
    plan = optimized(found)
    assert plan.count("Window") == 1 and re.search(r"_bucket#\d+ = _edge#\d+", plan)
    got = found.collect()
    assert sorted((r.s, r.id, r.i) for r in got) == sorted(r for r in rows if r[0] != "c")
    # The row without a key counts in the size of its stratum, ahead of all others.
    sizes = {"a": 1001, "b": 11, "d": 47}
    strata = spark.createDataFrame(list(sizes.items()), "s string, n bigint")
    quotas = {r["s"]: r["_quota"] for r in sampling.split_quotas(strata, "s", "n", 0.2).collect()}
    assert sum(quotas.values()) == math.ceil(sum(sizes.values()) * 0.2)
    for s, quota in quotas.items():
        before = int(s == "a")
        own = sorted((digest(r.id), r.id) for r in got if r.s == s)
        chosen = sorted((digest(r.id), r.id) for r in got if r.s == s and r.split == "test")
        assert chosen == own[: quota - before]


def test_split_of_small_strata_may_give_no_test_row(spark):
    df = spark.createDataFrame([("a", str(i)) for i in range(12)], "s string, id string")
    got = sampling.stratified_split(df, "s", F.col("id"), test_fraction=0.0)
    assert [r.split for r in got.collect()] == ["train"] * 12


@pytest.mark.parametrize("name", ["batch_score_coverage", "encoded_feature_names"])
def test_fits_read_a_stored_split(spark, monkeypatch, name):
    seen = []
    scaling = preprocess.scaling
    monkeypatch.setattr(preprocess, "scaling", lambda train, features: seen.append(optimized(train)) or scaling(train, features))
    queries.QUERIES[name](spark, FOLDER)
    assert seen and not any("Window" in plan or "Join" in plan for plan in seen)
