"""Preprocessing, training, scoring, artifacts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripmeter.models import features as feats
from tripmeter.models import preprocess
from tripmeter.models.artifacts import artifact_dir, load_artifacts, load_preprocessing, publish
from tripmeter.models.training import Hyperparameters, catalogue, score, train_variant
from tripmeter.operators.errors import regression_metrics
from workload import queries

FOLDER = "/root/testdata/sf0.01"
QUICK = Hyperparameters(forest_trees=3, forest_depth=3, boosted_rounds=2, deep_rounds=2, deep_depth=3)


@pytest.fixture(scope="module")
def trips(spark):
    return queries.keyed(spark, FOLDER)


@pytest.fixture(scope="module")
def trained(spark, trips, tmp_path_factory):
    return train_variant(spark, trips, "pre_assign", str(tmp_path_factory.mktemp("t")), QUICK)


def dense(model, frame):
    rows = preprocess.encode(model, frame).orderBy(feats.KEY).select(vector_to_array("features"))
    return np.array([r[0] for r in rows.collect()])


def test_split_is_complete_and_disjoint(trips):
    frame = feats.feature_frame(trips, feats.PRE_ASSIGN)
    split = feats.split_frame(frame)
    frequent = frame.groupBy("strata").count().where("count > 10")
    assert split.count() == frequent.agg(F.sum("count")).first()[0]
    assert split.select(feats.KEY).distinct().count() == split.count()
    share = split.groupBy("strata").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")
    )
    assert share.where(F.abs(F.col("t") - 0.2 * F.col("n")) >= 1).count() == 0


def test_scaled_numbers_have_mean_zero_and_population_std_one(trips):
    train = feats.split_frame(feats.feature_frame(trips, feats.PRE_ASSIGN)).where("split = 'train'")
    constants = preprocess.scaling(train, feats.PRE_ASSIGN)
    for name, (mean, std) in constants.items():
        row = train.select(((F.log1p(name) - mean) / std).alias("z")).agg(
            F.avg("z"), F.stddev_pop("z")
        ).first()
        assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1, abs=1e-9)


def test_unknown_categories_give_zeros_and_constants_do_not_divide_by_zero(spark):
    columns = "trip_key string, pickup_distance double, dropoff_distance double, total_distance " \
              "double, territory string, courier_flow string, geo_archetype string, " \
              "merchant_surface string, hour_sin double, hour_cos double, ATD double"
    def row(key, territory, distance=1.0):
        return (key, distance, 2.0, 3.0, territory, "f", "g", "m", 0.0, 1.0, 30.0)
    train = spark.createDataFrame([row("1", "a"), row("2", "b"), row("3", "c")], columns)
    model = preprocess.fit_preprocessing(train, feats.PRE_ASSIGN)
    names = preprocess.encoded_names(model, feats.PRE_ASSIGN)
    at = [i for i, n in enumerate(names) if n.startswith("cat__territory_")]
    assert [names[i] for i in at] == [f"cat__territory_{x}" for x in "abc"]
    new = spark.createDataFrame(
        [row("1", "a"), row("2", "c"), row("3", "zz"), row("4", None), row("5", "a", None)], columns
    )
    got = dense(model, new)
    assert got[:, at].tolist() == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]  # row 5 dropped
    assert np.isfinite(got).all()


def test_missing_category_seen_in_training_is_its_own(spark, trips):
    frame = feats.feature_frame(trips, feats.PRE_ASSIGN)
    model = preprocess.fit_preprocessing(frame, feats.PRE_ASSIGN)
    assert "cat__territory_nan" in preprocess.encoded_names(model, feats.PRE_ASSIGN)


def test_linear_model_matches_least_squares(spark, trips):
    frame = feats.feature_frame(trips, feats.POST_ASSIGN)
    model = preprocess.fit_preprocessing(frame, feats.POST_ASSIGN)
    encoded = preprocess.encode(model, frame).orderBy(feats.KEY)
    rows = encoded.select(vector_to_array("features").alias("f"), "ATD").collect()
    x = np.array([r["f"] for r in rows])
    y = np.array([r["ATD"] for r in rows])
    design = np.c_[np.ones(len(x)), x]
    want = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    fitted = catalogue()["linear"].fit(encoded)
    got = [r[0] for r in fitted.transform(encoded).orderBy(feats.KEY).select("prediction").collect()]
    np.testing.assert_allclose(got, want, rtol=1e-5, atol=1e-5)


def test_defaults():
    models = catalogue()
    forest, gbt, deep = models["random_forest"], models["gbt"], models["gbt_deep"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (100, 10, "all")
    assert (gbt.rounds, gbt.learning_rate, gbt.depth, gbt.l2, gbt.row_share) == (100, 0.1, 3, 0, 1)
    assert (deep.rounds, deep.depth, deep.row_share, deep.feature_share, deep.l2) == (200, 6, 0.8, 0.8, 1)


def test_best_model_has_smallest_rmse(trained):
    rows = trained.metrics.collect()
    assert len(rows) == 4
    best = min(rows, key=lambda r: r["rmse"])
    assert trained.best == best["model"]
    again = regression_metrics(trained.test_predictions()).first()
    assert again["rmse"] == pytest.approx(best["rmse"])


def test_published_artifacts_load_again(spark, trained, path):
    folder = artifact_dir(path, "eu", "2024-02-05")
    assert load_artifacts(spark, folder, "pre_assign") is None
    assert load_preprocessing(spark, folder, "pre_assign") is None
    publish(trained, folder)
    publish(trained, folder)
    model, rows = load_artifacts(spark, folder, "pre_assign")
    a = regression_metrics(model.transform(rows)).first()["rmse"]
    b = regression_metrics(trained.test_predictions()).first()["rmse"]
    assert a == pytest.approx(b)
    assert load_preprocessing(spark, folder, "pre_assign") is not None


def test_one_trip_can_be_scored(trained, trips):
    one = feats.feature_frame(trips, feats.PRE_ASSIGN).where("territory IS NOT NULL").limit(1)
    got = score(trained.preprocessing, trained.best_model, one).select("prediction").collect()
    assert len(got) == 1 and got[0][0] > 0
