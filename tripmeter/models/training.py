"""Train the model catalogue, compare on the test part, keep the smallest RMSE."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmeter.models.boosting import Binned, Boosted, Boosting, binned_rows
from tripmeter.models.features import FEATURE_SETS, FeatureSet, feature_frame, split_frame
from tripmeter.models.forest import Forest
from tripmeter.models.preprocess import COMPLETE, FEATURES, encode, encode_all, fit_preprocessing
from tripmeter.operators.errors import regression_metrics
from tripmeter.schemas import TARGET

ENCODED = ["trip_key", FEATURES, TARGET, "split"]


@dataclass(frozen=True)
class Hyperparameters:
    """The default settings of the four models."""

    forest_trees: int = 100
    forest_depth: int = 10
    boosted_rounds: int = 100
    boosted_depth: int = 3
    deep_rounds: int = 200
    deep_depth: int = 6
    learning_rate: float = 0.1
    l2: float = 1.0
    row_share: float = 0.8
    feature_share: float = 0.8
    seed: int = 42


def catalogue(settings: Hyperparameters = Hyperparameters()) -> dict[str, Estimator | Forest | Boosting]:
    """The four models by name; ``gbt_deep`` is the boosting with a penalty on leaf weights."""
    common = {"featuresCol": FEATURES, "labelCol": TARGET, "predictionCol": "prediction"}
    trees = {"seed": settings.seed, "features": FEATURES, "target": TARGET}
    boosted = {"learning_rate": settings.learning_rate, **trees}
    return {
        "linear": LinearRegression(regParam=0.0, **common),
        "random_forest": Forest(settings.forest_trees, settings.forest_depth, **trees),
        "gbt": Boosting(settings.boosted_rounds, settings.boosted_depth, **boosted),
        "gbt_deep": Boosting(
            settings.deep_rounds,
            settings.deep_depth,
            l2=settings.l2,
            row_share=settings.row_share,
            feature_share=settings.feature_share,
            **boosted,
        ),
    }


Model = PipelineModel | Boosted


def fit_model(estimator: Estimator | Forest | Boosting, rows: DataFrame, made: Binned | None = None) -> Model:
    """``made`` are the same rows, binned for all models of trees."""
    return estimator.fit(rows, made=made) if isinstance(estimator, Forest | Boosting) else PipelineModel([estimator.fit(rows)])


@dataclass
class Trained:
    """Everything one training run yields."""

    features: FeatureSet
    preprocessing: PipelineModel
    models: dict[str, Model]
    metrics: DataFrame
    best: str
    encoded: DataFrame

    @property
    def best_model(self) -> Model:
        return self.models[self.best]

    def test_predictions(self) -> DataFrame:
        """Held-out rows with target and prediction side by side."""
        return self.best_model.transform(self.encoded.where(F.col("split") == "test"))


def encoded_split(
    spark: SparkSession, trips: DataFrame, features: FeatureSet, path: str
) -> tuple[PipelineModel, DataFrame]:
    """Split, fit the preprocessing on the training part, and store the encoded rows.

    All model passes read the stored rows (key, vector, target, split): the cleaning work
    is not repeated, and a lost executor costs a re-read, not a recomputation.
    """
    split_path = f"{path}/split"
    frame = split_frame(feature_frame(trips, features))
    frame.write.mode("overwrite").parquet(split_path)
    frame = spark.read.parquet(split_path)
    preprocessing = fit_preprocessing(frame.where(F.col("split") == "train"), features)
    encoded = encode(preprocessing, frame).select(*ENCODED)
    encoded.write.mode("overwrite").parquet(f"{path}/encoded")
    return preprocessing, spark.read.parquet(f"{path}/encoded")


def train_variant(
    spark: SparkSession,
    trips: DataFrame,
    variant: str,
    path: str,
    settings: Hyperparameters = Hyperparameters(),
) -> Trained:
    """Train all models of one feature set, side by side; ``trips`` are clean trips with a trip key."""
    features = FEATURE_SETS[variant]
    preprocessing, encoded = encoded_split(spark, trips, features, path)
    train = encoded.where(F.col("split") == "train").persist()
    test = encoded.where(F.col("split") == "test").persist()

    estimators = catalogue(settings)
    # All models of trees read the same binned rows.
    trees = estimators["gbt"]
    blocks = binned_rows(train, trees.features, trees.target, trees.key, trees.bins)

    def fitted(named: tuple[str, Estimator | Forest | Boosting]) -> tuple[Model, tuple]:
        name, estimator = named
        model = fit_model(estimator, train, blocks)
        score = regression_metrics(model.transform(test)).first()
        return model, (variant, name, score["mae"], score["rmse"], score["r2"], score["n"])

    # Each fit is a row of short jobs; together they keep the cluster busy.
    with ThreadPoolExecutor(len(estimators)) as pool:
        made = list(pool.map(fitted, estimators.items()))
    models, rows = {name: model for name, (model, _) in zip(estimators, made, strict=True)}, [row for _, row in made]
    blocks.release()
    train.unpersist()
    test.unpersist()
    schema = "variant string, model string, mae double, rmse double, r2 double, n bigint"
    best = min(rows, key=lambda row: (row[3], row[1]))[1]
    metrics = spark.createDataFrame(rows, schema)
    return Trained(features, preprocessing, models, metrics, best, encoded)


def score(preprocessing: PipelineModel, model: Model, frame: DataFrame) -> DataFrame:
    """Batch prediction for feature rows (a single trip is a one-row frame).

    Every row stays; the prediction is NULL where a feature is missing.
    """
    encoded = encode_all(preprocessing, frame)
    predicted = model.transform(encoded)
    whole = F.when(F.col(COMPLETE), F.col("prediction"))
    return predicted.withColumn("prediction", whole).drop(COMPLETE)
