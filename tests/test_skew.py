"""Hot and cold groups together, against plain pandas on the same rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmeter.operators import cleaning, sampling, summaries
from tripmeter.operators.quantiles import exact_quantiles
from tripmeter.operators.skew import join_facts, keep_frequent, split_hot


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 rows: one key with a third, 1,500 keys with two rows, 1,000 rows without key."""
    rng = np.random.default_rng(7)
    keys = ["hot"] * 2000 + [f"k{i // 2}" for i in range(3000)] + [None] * 1000
    frame = pd.DataFrame({
        "id": range(6000), "k": keys, "x": rng.exponential(40, 6000).round(2),
    })
    frame.loc[frame.id % 5 == 0, "x"] = np.nan
    rows = [(int(i), k, None if np.isnan(x) else float(x)) for i, k, x in frame.itertuples(index=False)]
    return frame, spark.createDataFrame(rows, "id bigint, k string, x double").repartition(16)


def test_hot_groups_are_few(skewed):
    _, df = skewed
    facts = df.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    hot, cold = split_hot(facts, "n")
    assert [r["k"] for r in hot.collect()] == ["hot"]
    assert cold.count() == 1500


def test_join_facts_keeps_all_rows(skewed):
    frame, df = skewed
    facts = df.groupBy("k").agg(F.count("*").alias("n"))
    assert join_facts(df, facts, ["k"], "n").count() == frame.k.notna().sum()
    assert join_facts(df, facts, ["k"], "n", null_safe=True).count() == len(frame)


def test_imputation(skewed):
    frame, df = skewed
    got = cleaning.impute_group_median(df, "k", ["x"]).toPandas().set_index("id").x.sort_index()
    want = frame.groupby("k").x.transform(lambda x: x.fillna(x.median()))
    want[frame.k.isna()] = np.nan
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_quantiles_by_group(skewed):
    frame, df = skewed
    probabilities = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "x", probabilities, ["k"]).collect()
    want = frame.dropna(subset=["x", "k"]).groupby("k").x
    assert len(got) == want.ngroups
    for row in got:
        values = want.get_group(row["k"])
        np.testing.assert_allclose(row["q"], np.quantile(values, probabilities))
        assert row["n"] == len(values)


def test_box_stats(skewed):
    frame, df = skewed
    got = {r["k"]: r for r in summaries.box_stats(df, "x", "k").collect()}
    x = frame[frame.k == "hot"].x.dropna()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert got["hot"]["whisker_low"] == inside.min()
    assert got["hot"]["whisker_high"] == inside.max()


def test_duplicate_members(skewed):
    frame, df = skewed
    got = cleaning.duplicate_members(df, ["k"])
    assert got.count() == frame.duplicated(subset=["k"], keep=False).sum()


def test_keep_frequent(skewed):
    frame, df = skewed
    assert keep_frequent(df, ["k"], 2).count() == 3000


def hashed(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_sample_is_exact_and_repeatable(skewed):
    frame, df = skewed
    got = [r["id"] for r in sampling.sample_rows(df, F.col("id"), 100).collect()]
    assert got == sorted(frame.id, key=hashed)[:100]
    again = [r["id"] for r in sampling.sample_rows(df.repartition(3), F.col("id"), 100).collect()]
    assert got == again
    assert sampling.sample_rows(df, F.col("id"), 10_000).count() == 6000


def test_split_gives_exact_quotas_in_hash_order(skewed):
    frame, df = skewed
    strata = df.withColumn("s", F.coalesce("k", F.lit("none")))
    split = sampling.stratified_split(strata, "s", F.col("id")).toPandas()
    assert set(split.s) == {"hot", "none"}  # two-row strata are too small
    assert len(split) == 3000 and not split.id.duplicated().any()
    assert (split.split == "test").sum() == 600
    for stratum, n in {"hot": 2000, "none": 1000}.items():
        rows = split[split.s == stratum]
        want = set(sorted(rows.id, key=hashed)[: n // 5])
        assert set(rows[rows.split == "test"].id) == want


def test_split_does_not_depend_on_partitioning(skewed):
    _, df = skewed
    strata = df.withColumn("s", F.coalesce("k", F.lit("none")))
    splits = [
        sampling.stratified_split(strata.repartition(n), "s", F.col("id")).toPandas()
        for n in (2, 13)
    ]
    a, b = (s.sort_values("id")[["id", "split"]].reset_index(drop=True) for s in splits)
    pd.testing.assert_frame_equal(a, b)


@settings(max_examples=8, deadline=None)
@given(
    xs=st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=40),
    p=st.floats(0, 1),
)
def test_any_quantile(spark, xs, p):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_quantiles(df, "x", [p]).first()["q"][0]
    assert got == pytest.approx(float(np.quantile(xs, p)), rel=1e-9, abs=1e-9)
