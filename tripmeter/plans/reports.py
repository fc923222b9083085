"""Report tables: each panel is a function of one filtered frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmeter.functions.values import display_number, log1p_or_null
from tripmeter.operators import errors, profile, summaries
from tripmeter.operators.anomalies import missing_flags
from tripmeter.operators.cleaning import slice_rows
from tripmeter.operators.quantiles import named_quantiles, quantile_trim
from tripmeter.operators.sampling import sample_rows
from tripmeter.schemas import CATEGORIES, DISTANCES
from tripmeter.sources.tables import append_union, enrich

# Points in a scatter panel and bins of the histograms.
SCATTER_POINTS = 5000
OVERVIEW_BINS = 60
DETAIL_BINS = 80
ERROR_BINS = 80
ABS_ERROR_BINS = 60


def selected_trips(
    trips: DataFrame,
    choices: dict[str, Sequence[str]] | None = None,
    hours: tuple[int, int] = (0, 23),
) -> DataFrame:
    """Enriched trips of the chosen categories and hours.

    Without choices every category value is chosen, which still leaves out rows that
    lack a category.
    """
    enriched = enrich(trips)
    if choices is not None:
        return slice_rows(enriched, choices, hours)
    return enriched.na.drop(subset=CATEGORIES).where(F.col("hour").between(*hours))


def overview(selected: DataFrame) -> dict[str, DataFrame]:
    """KPIs, duration histogram and trips by territory."""
    kpis = summaries.kpis(selected)
    shown = kpis.select(
        *[display_number(F.col(c)).alias(c) for c in ("avg_atd", "median_atd", "p90_atd")],
        "n_trips",
    )
    return {
        "kpis": shown,
        "distribution": summaries.histogram(selected, "ATD", OVERVIEW_BINS),
        "trips_by_territory": summaries.counts_by(selected, "territory"),
    }


def exploration(selected: DataFrame, key: Column) -> dict[str, DataFrame]:
    """Distributions, distance relations and time patterns."""
    points = sample_rows(selected, key, SCATTER_POINTS)
    return {
        "distribution": summaries.histogram(selected, "ATD", DETAIL_BINS),
        "percentiles": named_quantiles(selected, "ATD", [0.5, 0.9]),
        "box_by_territory": summaries.box_stats(selected, "ATD", "territory"),
        "points": points.select("dropoff_distance", "pickup_distance", "ATD"),
        "trend_dropoff": summaries.ols_trend(selected, "dropoff_distance"),
        "trend_pickup": summaries.ols_trend(selected, "pickup_distance"),
        "by_hour": summaries.mean_by(selected, ["hour"]),
        "by_weekday": summaries.mean_by_weekday(selected, "eater_request_timestamp_local"),
    }


def pairwise(trips: DataFrame, columns: Sequence[str], bins: int, key: str) -> dict[str, DataFrame]:
    """The pairwise view of logged columns: each alone (histogram) and against the others.

    Correlations and trends take all rows; the points are a repeatable sample of ``SCATTER_POINTS`` rows.
    """
    logs = trips.withColumns({c: log1p_or_null(F.col(c)) for c in columns})
    alone = [
        summaries.histogram(logs, c, bins).select(F.lit(c).alias("a"), "bin", "count") for c in columns
    ]
    return {
        "correlations": profile.correlations(logs, list(columns)),
        "trends": summaries.pair_trends(logs, list(columns)),
        "histograms": append_union(alone),
        "points": sample_rows(logs.select(key, *columns), F.col(key), SCATTER_POINTS),
    }


def exploration_profile(prepared: DataFrame, flagged: DataFrame, clean: DataFrame) -> dict[str, DataFrame]:
    """The first look at the trips: profiles, gaps and how they go together, time relations, what trimming leaves.

    ``prepared`` are the distinct trips with their gaps, ``flagged`` the imputed ones, ``clean`` the valid ones.
    """
    gaps = missing_flags(prepared)
    names = [c for c in gaps.columns if c not in prepared.columns]
    return {
        "numeric": profile.profile_numeric(prepared, [*DISTANCES, "ATD"]),
        "categorical": profile.profile_categorical(prepared, [*CATEGORIES]),
        "gaps": profile.null_rates(prepared),
        "gaps_together": profile.correlations(gaps, names),
        "by_relation": profile.profile_numeric(flagged, ["ATD"], ["offered_equals_request"]),
        "trimmed": summaries.kpis(quantile_trim(clean, "ATD")),
    }


def performance(predictions: DataFrame, key: Column) -> dict[str, DataFrame]:
    """Metrics, error histograms, plot limits and plot points of held-out predictions."""
    scored = errors.with_errors(predictions)
    points = sample_rows(scored, key, SCATTER_POINTS)
    residuals = sample_rows(scored, key, SCATTER_POINTS, seed=0)
    return {
        "metrics": errors.error_metrics(predictions),
        "error_distribution": summaries.histogram(scored, "error", ERROR_BINS),
        "abs_error_distribution": summaries.histogram(scored, "abs_error", ABS_ERROR_BINS),
        "abs_error_percentiles": named_quantiles(scored, "abs_error", [0.5, 0.9]),
        "actual_vs_predicted": points.select("ATD", "prediction"),
        "axis": errors.axis_limits(scored),
        "residuals": residuals.select("prediction", "error"),
        "error_by_range": errors.error_by_range(predictions),
    }


#: Panels whose rows are told apart by other columns than text ones.
PANEL_KEYS = {"distribution": ["bin"], "error_distribution": ["bin"], "abs_error_distribution": ["bin"],
              "error_by_range": ["bin"], "by_hour": ["hour"], "by_weekday": ["day_of_week", "day_label"],
              "box_by_territory": ["territory"], "trips_by_territory": ["territory"],
              "numeric": ["column"], "categorical": ["column", "top"], "gaps": ["column"], "gaps_together": ["a", "b"],
              "by_relation": ["offered_equals_request", "column"],
              "percentiles": ["quantile"], "abs_error_percentiles": ["quantile"]}


def figures(panels: dict[str, DataFrame]) -> DataFrame:
    """All panels as one typed table: ``panel, key, figure, value``.

    A panel's key columns name its rows (``PANEL_KEYS``; other panels need no key) and every other column
    is a figure.
    """
    parts = []
    for name, df in panels.items():
        keys = PANEL_KEYS.get(name, [])
        rest = [c for c in df.columns if c not in keys]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in keys]).alias("key")
        rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in rest])
        parts.append(rows.unpivot(["key"], rest, "figure", "value").select(F.lit(name).alias("panel"), "key", "figure", "value"))
    return append_union(parts)
