"""Prediction errors: metrics, error rows, error by range, model choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmeter.operators.quantiles import quantile_array
from tripmeter.operators.summaries import mean_by_quantile_bin


def with_errors(df: DataFrame, actual: str = "ATD", predicted: str = "prediction") -> DataFrame:
    """Add ``error`` (actual minus predicted) and ``abs_error``."""
    error = F.col(actual) - F.col(predicted)
    return df.withColumns({"error": error, "abs_error": F.abs(error)})


def regression_metrics(
    df: DataFrame, actual: str = "ATD", predicted: str = "prediction"
) -> DataFrame:
    """One row: MAE, RMSE and R²; one pass.  R² of a constant target is NULL."""
    scored = df.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull())
    error = F.col(actual) - F.col(predicted)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(actual))).alias("r2"),
        F.count("*").alias("n"),
    )


def error_metrics(df: DataFrame, actual: str = "ATD", predicted: str = "prediction") -> DataFrame:
    """One row: MAE, RMSE, median and 90th percentile of the absolute error."""
    scored = with_errors(df, actual, predicted)
    q = quantile_array(scored, "abs_error", [0.5, 0.9])
    totals = scored.agg(
        F.avg("abs_error").alias("mae"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
    )
    return totals.withColumn("_q", q).select(
        "mae", "rmse", F.col("_q")[0].alias("p50_abs_error"), F.col("_q")[1].alias("p90_abs_error")
    )


def error_by_range(
    df: DataFrame, bins: int = 5, actual: str = "ATD", predicted: str = "prediction"
) -> DataFrame:
    """Mean absolute error per quantile bin of the actual value."""
    return mean_by_quantile_bin(with_errors(df, actual, predicted), actual, "abs_error", bins)


def rows_by_error(df: DataFrame, worst_first: bool = False) -> DataFrame:
    """All rows ordered by absolute error (a range-partitioned sort)."""
    order = F.desc("abs_error") if worst_first else F.asc("abs_error")
    return df.orderBy(order)


def top_errors(df: DataFrame, key: str, n: int, worst_first: bool = True) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) absolute error, ties by key."""
    order = F.desc("abs_error") if worst_first else F.asc("abs_error")
    return df.orderBy(order, key).limit(n)


def axis_limits(df: DataFrame, actual: str = "ATD", predicted: str = "prediction") -> DataFrame:
    """Plot limits of actual against predicted: upper bound with 5 % room, ideal line ends."""
    return df.agg(
        (F.greatest(F.max(actual), F.max(predicted)) * 1.05).alias("axis_limit"),
        F.min(actual).alias("line_start"),
        F.max(actual).alias("line_end"),
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models in ascending order of RMSE (ties by name), with their ``place``: one row per model."""
    order = Window.orderBy("rmse", "model")
    return metrics.withColumn("place", F.row_number().over(order)).orderBy("place")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the smallest RMSE, one row."""
    return metrics.agg(
        F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse")
    )
