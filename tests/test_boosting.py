"""Histogram boosting: one tree against all splits by hand, one task against jobs a level, storing, missing values."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tripmeter.models import boosting
from tripmeter.models.boosting import Boosted, Boosting

SCHEMA = StructType([StructField("trip_key", StringType()), StructField("features", VectorUDT()), StructField("ATD", DoubleType())])


def data(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 3] = rng.integers(0, 2, n)
    x[rng.random((n, 4)) < 0.05] = np.nan
    y = 10 + 3 * np.nan_to_num(x[:, 0]) + 5 * np.isnan(x[:, 1]) - 2 * np.nan_to_num(x[:, 3]) + rng.normal(size=n) * 0.1
    return x, np.round(y, 3)


def table(spark, x, y, parts=1):
    rows = [(str(i), Vectors.dense(v.tolist()), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_first_split_is_the_best_of_all(spark):
    x, y = data()
    model = Boosting(rounds=1, depth=1, l2=1.0, learning_rate=0.5, bins=254).fit(table(spark, x, y))
    g = y.mean() - y
    score = lambda m: g[m].sum() ** 2 / (m.sum() + 1)
    best = (-1,)
    for f in range(4):
        for cut in np.unique(x[:, f][~np.isnan(x[:, f])]):
            for side in (True, False):
                left = np.where(np.isnan(x[:, f]), side, x[:, f] <= cut)
                if 0 < left.sum() < len(x):
                    best = max(best, (0.5 * (score(left) + score(~left) - g.sum() ** 2 / (len(g) + 1)), -f, -cut, side))
    tree = model.trees[0]
    assert tree.gain[0] == pytest.approx(best[0], rel=1e-6) and tree.feature[0] == -best[1]
    left = np.where(np.isnan(x[:, tree.feature[0]]), tree.missing_left[0], x[:, tree.feature[0]] <= tree.threshold[0])
    assert tree.weight[1] == pytest.approx(-0.5 * g[left].sum() / (left.sum() + 1), rel=1e-5)
    assert tree.weight[2] == pytest.approx(-0.5 * g[~left].sum() / ((~left).sum() + 1), rel=1e-5)


@pytest.mark.parametrize("parts", [3, 12])
def test_jobs_by_level_give_the_same_trees(spark, monkeypatch, parts):
    x, y = data()
    settings = Boosting(rounds=12, depth=3, l2=1.0, row_share=0.8, feature_share=0.8, bins=32)
    alone = settings.fit(table(spark, x, y))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400 // parts + 1)
    spread = settings.fit(table(spark, x, y, parts))
    assert alone.base == spread.base
    assert repr(alone.nodes(spark).collect()) == repr(spread.nodes(spark).collect())


def test_forgotten_predictions_are_worked_out_again():
    x, y = data(50)
    edges = [np.unique(c[~np.isnan(c)])[:20] for c in x.T]
    rows = boosting.binned(x, edges)
    settings = Boosting(rounds=5, depth=2, bins=20)
    keys = np.arange(50, dtype=np.uint64)
    trees = settings._rounds_of([(rows, y, keys)], 10.0, 2.0**20, edges)
    want = 10.0 + sum(t.weight[t.nodes_of(rows, t.depth)] for t in trees)

    class Sent:
        value = trees[:3]

    assert np.allclose(boosting.predictions(("a", 0, 0), rows, 10.0, 5, Sent, trees[3:]), want)
    first = boosting.predictions(("b", 0, 0), rows, 10.0, 2, Sent, trees[:2])
    assert np.allclose(boosting.predictions(("b", 0, 0), rows, 10.0, 5, Sent, trees[3:]), want) and not np.allclose(first, want)


def test_learns_and_loads_again(spark, path):
    x, y = data(600, 1)
    rows = table(spark, x, y)
    model = Boosting(rounds=60, depth=3, l2=1.0).fit(rows)
    model.save(spark, path)
    again = Boosted.load(spark, path)
    got = {r.trip_key: r.prediction for r in again.transform(rows).collect()}
    predicted = np.array([got[str(i)] for i in range(len(y))])
    assert np.allclose(predicted, model.predict(x))
    assert np.mean((predicted - y) ** 2) < 0.05 * y.var()


def test_nothing_to_learn(spark):
    x, y = data(30)
    assert Boosting(rounds=2).fit(table(spark, x, np.full(30, 5.0))).predict(x).tolist() == [5.0] * 30
    empty = spark.createDataFrame([], SCHEMA)
    assert Boosting(rounds=2).fit(empty).predict(x[:2]).tolist() == [0.0, 0.0]
    one = Boosting(rounds=2).fit(table(spark, x[:1], y[:1]))
    assert one.predict(x[:1]) == pytest.approx(y[:1])
