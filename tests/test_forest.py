"""The forest: one tree against all splits by hand, one task against jobs a level, drawing, codes, what training runs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_boosting import data, table

from tripmeter.models import boosting, coding, forest, preprocess
from tripmeter.models import features as feats
from tripmeter.models.boosting import Boosted, Boosting, binned_rows
from tripmeter.models.forest import Forest, copies
from tripmeter.models.training import Hyperparameters, catalogue, encoded_split, score, train_variant
from tripmeter.session import scratch_path
from workload import queries


def by_hand(x, y, times, depth):
    """Leaf mean of each row of a tree that tries every split."""
    if depth == 0 or times.sum() < 2:
        return np.full(len(y), np.average(y, weights=times) if times.sum() else 0.0)
    best = (1e-9,)
    cost = lambda m: ((y[m] - np.average(y[m], weights=times[m])) ** 2 * times[m]).sum()
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if times[left].sum() and times[~left].sum():
                gain = (cost(times > 0) - cost(left & (times > 0)) - cost(~left & (times > 0))) / 2
                if gain > best[0] * (1 + 1e-9):
                    best = gain, left
    if len(best) == 1:
        return np.full(len(y), np.average(y, weights=times))
    out = np.empty(len(y))
    for side in (best[1], ~best[1]):
        out[side] = by_hand(x[side], y[side], times[side], depth - 1)
    return out


def test_a_tree_takes_the_best_of_all_splits(spark):
    x, y = data(120)
    x = np.round(np.nan_to_num(x), 0)
    rows = table(spark, x, y)
    model = Forest(trees=1, depth=3, bins=254).fit(rows)
    keys = {r.trip_key: r.k for r in rows.selectExpr("trip_key", "xxhash64(trip_key) k").collect()}
    times = copies(np.array([keys[str(i)] for i in range(len(y))], np.int64).view(np.uint64), 0, 42).astype(float)
    drawn = times > 0
    np.testing.assert_allclose(model.predict(x)[drawn], by_hand(x[drawn], y[drawn], times[drawn], 3), atol=1e-5)


@pytest.mark.parametrize("parts, direct", [(3, 8), (12, 1)])
def test_jobs_by_level_give_the_same_forest(spark, monkeypatch, parts, direct):
    x, y = data()
    settings = Forest(trees=7, depth=5, bins=32)
    alone = settings.fit(table(spark, x, y))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400 // parts + 1)
    monkeypatch.setattr(boosting, "DIRECT_TASKS", direct)
    spread = settings.fit(table(spark, x, y, parts))
    assert repr(alone.nodes(spark).collect()) == repr(spread.nodes(spark).collect())


def test_copies_are_poisson():
    got = copies(np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64), 3, 42)
    share = np.bincount(got, minlength=4)[:4] / len(got)
    assert np.allclose(share, np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.005)


def test_codes_hold_the_histogram_of_every_feature():
    """Flags, one-hot columns and missing values, alone and numbered together, against counts of the bins."""
    rng = np.random.default_rng(0)
    n, label = 500, rng.integers(0, 7, 500)
    rows = np.column_stack([label == i for i in range(7)] + [rng.integers(0, 60, n), rng.integers(0, 3, n), rng.integers(0, 60, n)]).astype(np.uint8)
    rows[rng.random(rows.shape) < 0.01] = coding.MISSING
    edges = [np.arange(1 if f < 7 else 59) for f in range(10)]
    made = coding.Coding.of_blocks([rows[:200], rows[200:]], edges)
    assert len(made.members) < 6
    single = coding.Coding.of([[f] for f in range(10)], [np.zeros((1, 1), np.uint8)] * 10, edges)
    value, at = np.rint(rng.normal(size=n) * 100), rng.integers(0, 3, n)
    for own in (made, single):
        found = coding.Codes(own, own.encode(rows)).histogram(at, np.array([0, -1, 1]), 2, value)
        for f in range(10):
            got = own.feature(found, f, 62)
            for node, place in ((0, 0), (1, 2)):
                for b in range(62):
                    here = (at == place) & (rows[:, f] == (coding.MISSING if b == 61 else b))
                    assert got[node, b].tolist() == [value[here].sum(), here.sum()]


def test_levels_count_the_smaller_side_only(spark, monkeypatch):
    """The rows that all levels of a tree count are fewer than levels times rows."""
    x, y = data(400)
    seen = []
    count = coding.Codes.histogram

    def counted(self, at, rank, *rest):
        seen.append(int((rank.take(at) >= 0).sum()))
        return count(self, at, rank, *rest)

    monkeypatch.setattr(coding.Codes, "histogram", counted)
    edges = [np.unique(c[~np.isnan(c)])[::8] for c in x.T]
    Boosting(rounds=1, depth=4, bins=64)._rounds_of([(boosting.binned(x, edges), y, np.arange(400, dtype=np.uint64))], 10.0, 2.0**20, edges)
    assert seen[0] == 400 and len(seen) == 4 and all(n <= 200 for n in seen[1:])


def test_models_of_trees_share_binned_rows(spark, monkeypatch):
    """Rows are binned once for all models of trees, and models from them are those from the rows."""
    x, y = data()
    rows = table(spark, x, y)
    made = binned_rows(rows, "features", "ATD", "trip_key", 64)
    monkeypatch.setattr(boosting, "bin_edges", None)
    for estimator in list(catalogue().values())[1:]:
        assert estimator.bins == 64
    model = Forest(trees=3, depth=3).fit(rows, made=made)
    assert len(model.trees) == 3 and Boosting(rounds=2).fit(rows, made=made).trees


def test_nothing_to_learn(spark):
    x, y = data(30)
    assert np.allclose(Forest(trees=4).fit(table(spark, x, np.full(30, 5.0))).predict(x), 5.0)
    assert Forest(trees=2).fit(table(spark, x, y).limit(0)).predict(x[:2]).tolist() == [0.0, 0.0]
    assert forest.Forest(trees=2).fit(table(spark, x[:1], y[:1])).predict(x[:1]) == pytest.approx(y[:1])


def test_features_of_a_trip_share_a_few_codes(spark, monkeypatch):
    """A histogram counts a few columns, not one for each label of the encoded rows."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 3000)
    _, rows = encoded_split(spark, queries.keyed(spark, "/root/testdata/sf0.01"), feats.POST_ASSIGN, scratch_path(spark, "codes"))
    made = binned_rows(rows.repartition(3), "features", "ATD", "trip_key", 64)
    assert len(made.edges) > 20 and len(made.coding.members) <= 8 and not made.alone
    assert sorted(f for group in made.coding.members for f in group) == list(range(len(made.edges)))
    made.release()


def test_a_forest_loads_again(spark, path):
    x, y = data(200)
    model = Forest(trees=5, depth=4).fit(table(spark, x, y))
    model.save(spark, path)
    assert Boosted.load(spark, path).predict(x).tolist() == model.predict(x).tolist()


def test_a_forest_scores_every_trip(spark):
    """Trips of strata too rare to train on as well; none where a feature is missing."""
    trips = feats.feature_frame(queries.keyed(spark, "/root/testdata/sf0.01"), feats.PRE_ASSIGN)
    fitted = preprocess.fit_preprocessing(trips, feats.PRE_ASSIGN)
    model = Forest(trees=2, depth=3).fit(preprocess.encode(fitted, trips))
    got = score(fitted, model, trips)
    n, scored = got.agg(F.count("*"), F.count("prediction")).first()
    assert n == trips.count() and scored == preprocess.encode(fitted, trips).count() < n


def test_rows_are_binned_once_a_variant(spark, path, monkeypatch):
    """Both boostings and the forest of a variant read the same binned rows."""
    calls, find = [], boosting.bin_edges
    monkeypatch.setattr(boosting, "bin_edges", lambda *args: calls.append(args) or find(*args))
    quick = Hyperparameters(forest_trees=2, forest_depth=2, boosted_rounds=2, deep_rounds=2, deep_depth=2)
    trained = train_variant(spark, queries.keyed(spark, "/root/testdata/sf0.01"), "pre_assign", path, quick)
    assert len(calls) == 1 and len(trained.models) == 4


def test_a_level_is_one_wave_of_tasks(spark, monkeypatch):
    """A task adds up several blocks, so that a level sends no more tables than there are cores."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 10)
    x, y = data()
    made = binned_rows(table(spark, x, y, 20), "features", "ATD", "trip_key", 64)
    assert made.blocks.getNumPartitions() <= spark.sparkContext.defaultParallelism < 20
    assert made.blocks.map(lambda block: len(block[2])).sum() == 400
    made.release()
