"""Density curves, bins that the data choose, bootstrap intervals, and figures from stored counts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmeter.operators import curves, intervals
from tripmeter.plans import partials
from tripmeter.sources import tables
from workload import queries

FOLDER = "/root/testdata/sf0.001"


def frame(spark, values, group="g"):
    rows = [(group, None if v is None else float(v), str(i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, x double, id string")


def test_curve_is_near_the_direct_estimate(spark):
    values = np.concatenate([np.random.default_rng(1).normal(size=300), [5.0] * 40])
    got = curves.density_curve(frame(spark, [*values, None, math.nan]), "x", points=400).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.array([r.x for r in got])
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * math.sqrt(2 * math.pi))
    assert np.abs(np.array([r.density for r in got]) - direct).max() < 2e-3 * direct.max()
    assert sum(r.density for r in got) * (grid[1] - grid[0]) == pytest.approx(1, abs=0.01)


def test_constant_and_empty_columns_have_no_curve(spark):
    both = frame(spark, [1, 2, 4]).union(frame(spark, [3, 3, 3], "same")).union(frame(spark, [None], "none")).union(frame(spark, [1, 2], None))
    assert {r.k for r in curves.density_curve(both, "x", ["k"], points=10).collect()} == {"g"}
    assert curves.density_curve(frame(spark, [2, 2]), "x").count() == 0


@pytest.mark.parametrize("values", [
    np.random.default_rng(2).exponential(size=500), np.random.default_rng(3).normal(size=37), [0.0] * 60 + [1.0] * 5, [7.0] * 9, [1.0, 4.0],
])
def test_bins_are_as_many_as_the_data_ask_for(spark, values):
    got = curves.auto_histogram(frame(spark, [*values, None]), "x").orderBy("bin").collect()
    spread, far = np.ptp(values), 2 * np.subtract(*np.percentile(values, [75, 25])) / len(values) ** (1 / 3)
    even = spread / (np.log2(len(values)) + 1)
    counts, edges = np.histogram(values, bins=math.ceil(spread / (min(far, even) if far else even)) if spread else 1)
    assert {r.bins for r in got} == {len(counts)}
    assert {r.bin: r["count"] for r in got} == {i: c for i, c in enumerate(counts.tolist()) if c}
    assert all(r.bin_start == pytest.approx(edges[r.bin]) and r.bin_end == pytest.approx(edges[r.bin + 1]) for r in got)
    assert curves.auto_histogram(frame(spark, [None]), "x").count() == 0


def test_weights_are_poisson(spark):
    rows = spark.range(20000).select(*[w.alias(f"w{i}") for i, w in enumerate(intervals.weights(F.col("id"), 9))])
    found = rows.agg(*[F.avg(f"w{i}") for i in (0, 7, 8)], *[F.var_pop(f"w{i}") for i in (0, 7, 8)], F.corr("w0", "w8")).first()
    assert found[:6] == pytest.approx([1] * 6, abs=0.05) and abs(found[6]) < 0.03


def test_interval_is_as_wide_as_theory_says(spark):
    values = np.random.default_rng(5).normal(10, 2, 3000)
    row = intervals.bootstrap_mean(frame(spark, [*values, None]), "x", "id", replicates=200).first()
    error = values.std() / math.sqrt(len(values))
    assert row.n == 3000 and row.low < row["mean"] < row.high
    assert (row.high - row.low) / (2 * 1.96 * error) == pytest.approx(1, abs=0.25)
    none = intervals.bootstrap_mean(frame(spark, [None]), "x", "id", ["k"]).first()
    assert (none.n, none.low) == (0, None)


def test_slope_interval(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(1e6, 1, 800)
    rows = [(float(a), float(3 * a + e), str(i)) for i, (a, e) in enumerate(zip(x, rng.normal(size=800), strict=True))]
    row = intervals.bootstrap_slope(spark.createDataFrame(rows, "x double, y double, id string"), "x", "y", "id").first()
    assert row.low < 3 < row.high and row.slope == pytest.approx(3, abs=0.2)
    flat = spark.createDataFrame([(1.0, 2.0, "a"), (1.0, 3.0, "b")], "x double, y double, id string")
    assert intervals.bootstrap_slope(flat, "x", "y", "id").first().slope is None


def test_partials_read_no_trips(spark, path):
    week = queries.snapshot(spark, FOLDER, None)
    tables.replace_table(week, f"{path}/week")
    rows, history = tables.read_table(spark, f"{path}/week"), f"{path}/history"
    for ds, more in (("2024-01-15", 0), ("2024-01-22", 1), ("2024-01-15", 2)):
        stored = partials.upsert_with_partials(spark, history, rows.withColumn("atd", F.col("atd") + more), ds, ["atd"], ["territory"])
    counts = partials.read_partials(spark, partials.partials_path(history))
    got = partials.kpis_of_partials(counts, "atd", {"p": 0.9})
    want = stored.agg(F.count("*").alias("n_trips"), F.count("atd").alias("n"), F.avg(F.col("atd").cast("double")).alias("avg"), F.percentile("atd", 0.9).alias("p"))
    assert tuple(got.first()) == pytest.approx(tuple(want.first()))
    plan = got._jdf.queryExecution().toString()
    assert "history_partials" in plan and "history/data" not in plan
    until = partials.read_partials(spark, partials.partials_path(history), "2024-01-15")
    assert partials.kpis_of_partials(until, "atd", {"p": 0.5}).first().n_trips == rows.count()
