"""Stored models under ``{base}/{country}/{ds}``; any Hadoop file system will do."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tripmeter.models.boosting import Boosted
from tripmeter.models.training import Model, Trained
from tripmeter.session import file_system
from tripmeter.sources.tables import table_exists


def artifact_dir(base: str, country: str, ds: str) -> str:
    return f"{base.rstrip('/')}/{country}/{ds}"


def _stored(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException:
        return False
    return True


def store_model(spark: SparkSession, model: Model, path: str) -> None:
    """Store a model in place of an earlier one, of whichever kind."""
    files, where = file_system(spark, path)
    files.delete(where, True)
    if isinstance(model, Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model | None:
    if _stored(spark, path):
        return PipelineModel.load(path)
    return Boosted.load(spark, path) if table_exists(spark, f"{path}/model") else None


def publish(trained: Trained, folder: str) -> None:
    """Store preprocessing, best model and encoded rows, replacing earlier ones."""
    name = trained.features.name
    trained.preprocessing.write().overwrite().save(f"{folder}/preprocessing_{name}")
    store_model(trained.encoded.sparkSession, trained.best_model, f"{folder}/best_model_{name}")
    trained.encoded.write.mode("overwrite").parquet(f"{folder}/encoded_{name}")


def load_preprocessing(spark: SparkSession, folder: str, variant: str) -> PipelineModel | None:
    path = f"{folder}/preprocessing_{variant}"
    return PipelineModel.load(path) if _stored(spark, path) else None


def load_artifacts(
    spark: SparkSession, folder: str, variant: str
) -> tuple[Model, DataFrame] | None:
    """Best model and encoded held-out rows, or None if anything is absent."""
    model, rows = load_model(spark, f"{folder}/best_model_{variant}"), f"{folder}/encoded_{variant}"
    if model is None or not table_exists(spark, rows):
        return None
    return model, spark.read.parquet(rows).where("split = 'test'")
