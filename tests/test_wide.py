"""Correlations of many columns against the ones of few, and against numpy."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from tripmeter.operators.profile import correlations
from tripmeter.operators.wide import correlations_wide


def test_equal_to_the_form_for_few_columns(spark):
    """Gaps, a constant column, a large offset, a column with one value, names with dots."""
    i = F.col("id")
    df = spark.range(3000).repartition(5).select(
        F.when(i % 7 != 0, F.sin(i.cast("double"))).alias("a.b"),
        F.when(i % 5 != 0, i % 13).alias("whole"),
        (F.lit(1e9) + i % 11).alias("far"),
        F.lit(0.1).alias("constant"),
        F.when(i == 3, F.lit(2.0)).alias("once"),
        F.lit(None).cast("double").alias("never"),
    )
    got = {(r.a, r.b): r["corr"] for r in correlations_wide(df, df.columns).collect()}
    plain = df.toDF("ab", "whole", "far", "constant", "once", "never")
    want = {(r.a, r.b): r["corr"] for r in correlations(plain, plain.columns).collect()}
    assert len(got) == len(want) == 15
    for (a, b), corr in want.items():
        there = got[{"ab": "a.b"}.get(a, a), {"ab": "a.b"}.get(b, b)]
        assert (corr is None) == (there is None), (a, b, corr, there)
        assert corr is None or abs(corr - there) < 1e-9


def test_not_a_number_and_infinity_are_missing(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (float("nan"), 9.0), (float("inf"), 9.0), (3.0, 6.5)], "x double, y double"
    )
    (row,) = correlations_wide(df, ["x", "y"], absolute=True).collect()
    assert abs(row.abs_corr - np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]) < 1e-12


def test_empty(spark):
    assert correlations_wide(spark.createDataFrame([], "x double, y double"), ["x", "y"]).count() == 0


def test_three_hundred_columns(spark):
    """All 44,850 pairs; the plan is made in seconds."""
    rng = np.random.default_rng(5)
    data = rng.normal(size=(400, 300)).cumsum(axis=1)
    rows = spark.createDataFrame([(row.tolist(),) for row in data], "v array<double>").repartition(4)
    df = rows.select(*[F.col("v")[i].alias(f"c{i}") for i in range(300)])
    start = time.perf_counter()
    result = correlations_wide(df, df.columns)
    result._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 20
    want = np.corrcoef(data, rowvar=False)
    got = result.collect()
    assert len(got) == 300 * 299 // 2
    assert max(abs(r["corr"] - want[int(r.a[1:]), int(r.b[1:])]) for r in got) < 1e-9
