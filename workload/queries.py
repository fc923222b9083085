"""Registered queries: every operator run over whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmeter import schemas
from tripmeter.functions import clock, values
from tripmeter.models import features as feats
from tripmeter.models import preprocess
from tripmeter.models.artifacts import artifact_dir, load_artifacts, load_preprocessing, publish
from tripmeter.models.boosting import Boosting
from tripmeter.models.training import Hyperparameters, Trained, catalogue, encoded_split, fit_model, score, train_variant
from tripmeter.operators import anomalies, cleaning, curves, errors, intervals, profile, quality, sampling, summaries
from tripmeter.operators.quantiles import named_quantiles, quantile_bin, quantile_trim
from tripmeter.operators.skew import join_facts, keep_frequent
from tripmeter.operators.wide import correlations_wide
from tripmeter.plans import clean as clean_plan
from tripmeter.plans import partials, reports
from tripmeter.plans.history import batch_rows, history_as_of, upsert_history, write_partitions
from tripmeter.plans.pipeline import ROW_KEYS, run_weekly
from tripmeter.plans.weekly import weekly_snapshot
from tripmeter.session import prepare, scratch_path
from tripmeter.sources import tables
from workload import testbed as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FLAGS = ["offered_equals_request", "offered_after_final"]
MISSING = ["missing_pickup", "missing_dropoff", "missing_rest_ts", "missing_courier_flow"]
DIMENSIONS = ["territory", "courier_flow", "geo_archetype", "merchant_surface", "hour"]

# The default settings of the models; tests put smaller ones in their place.
SETTINGS = Hyperparameters()

# Added to the number of a trip to make a new one.
NEW_TRIPS = 1_000_000_000

# Means of two-decimal numbers can end in an exact half at the seventh decimal, where the
# order of summation would decide the rounding; a nudge far above that noise settles it.
NUDGE = 1e-10


def tidy(df: DataFrame) -> DataFrame:
    """Doubles with six decimals (no negative zero), whole numbers as bigint, wall clocks."""

    def column(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            return (F.round(c.cast("double") + NUDGE, 6) + F.lit(0.0)).alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return c.cast("bigint").alias(name)
        if kind == "timestamp":
            return c.cast("timestamp_ntz").alias(name)
        return c

    return df.select(*[column(name, kind) for name, kind in df.dtypes])


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; its result gets comparable types."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(prepare(spark), sf_dir))

        QUERIES[name] = run
        return build

    return register


# ---------------------------------------------------------------- shared inputs


def snapshot(spark: SparkSession, d: str, countries: str | None = tb.COUNTRY) -> DataFrame:
    return weekly_snapshot(
        tb.trips(spark, d), tb.jobs(spark, d), tb.city(spark, d), tb.city_region(spark, d),
        tb.DS, countries,
    )


def history(spark: SparkSession, d: str) -> DataFrame:
    return tb.event_history(spark, d)


_staged: dict[tuple, dict[str, StructType]] = {}
_trained: dict[tuple, tuple[Trained, str]] = {}


def input_state(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and change times of a table's files; it differs once the table is replaced."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def staged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Distinct and flagged trips, stored once per application and state of the events table.

    The reports, profiles and models all start from the stored result of the cleaning
    job, as they would from the weekly table; ``clean_trips`` and ``clean_table_job`` run
    the cleaning itself.  If the stored tables are gone they are written again.
    """
    key = (spark.sparkContext.applicationId, input_state(spark, f"{d}/events.parquet"))
    try:
        known = _staged.get(key, {}).items()
        stored = [spark.read.schema(schema).parquet(path) for path, schema in known]
    except AnalysisException:
        stored = []
    if not stored:
        path = scratch_path(spark, "trips")
        stored = clean_plan.stage_trips(
            spark, history(spark, d), tb.UTC_OFFSET, path, keep=ROW_KEYS
        )
        _staged[key] = {
            f"{path}/{name}": df.schema for name, df in zip(("prepared", "flagged"), stored)
        }
    return stored[0], stored[1]


def prepared(spark: SparkSession, d: str) -> DataFrame:
    """Typed and de-duplicated trips before imputation."""
    return staged(spark, d)[0]


def flagged(spark: SparkSession, d: str) -> DataFrame:
    """Imputed trips with an offer time, before the validity filters."""
    return staged(spark, d)[1]


def clean(spark: SparkSession, d: str) -> DataFrame:
    return clean_plan.valid_trips(flagged(spark, d))


def selected(spark: SparkSession, d: str) -> DataFrame:
    return reports.selected_trips(clean(spark, d))


_kept: dict[tuple, tuple[str, StructType]] = {}


def stored(spark: SparkSession, d: str, name: str, make: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A derived table that several panels read, written once per application and state of the events table."""
    key = (spark.sparkContext.applicationId, name, input_state(spark, f"{d}/events.parquet"))
    if key in _kept and tables.table_exists(spark, _kept[key][0]):
        path, schema = _kept[key]
        return spark.read.schema(schema).parquet(path)
    rows, path = make(spark, d), scratch_path(spark, name)
    rows.write.parquet(path)
    _kept[key] = path, rows.schema
    return spark.read.schema(rows.schema).parquet(path)


def trimmed(spark: SparkSession, d: str) -> DataFrame:
    return stored(spark, d, "trimmed", lambda spark, d: clean_plan.trimmed_trips(clean(spark, d)))


def keyed(spark: SparkSession, d: str) -> DataFrame:
    return feats.with_trip_key(clean(spark, d), ROW_KEYS)


def frame(spark: SparkSession, d: str, variant: str) -> DataFrame:
    return feats.feature_frame(keyed(spark, d), feats.FEATURE_SETS[variant])


def split(spark: SparkSession, d: str, variant: str) -> DataFrame:
    return feats.split_frame(frame(spark, d, variant))


def published(spark: SparkSession, d: str, variant: str) -> tuple[Trained, str]:
    """A trained variant and the folder its artifacts are published in, once per state of the events."""
    key = (
        spark.sparkContext.applicationId, variant, SETTINGS,
        input_state(spark, f"{d}/events.parquet"),
    )
    if key not in _trained or load_artifacts(spark, _trained[key][1], variant) is None:
        trained = train_variant(spark, keyed(spark, d), variant, scratch_path(spark, "train"), SETTINGS)
        folder = artifact_dir(scratch_path(spark, "models"), "eu", "2024-02-05")
        publish(trained, folder)
        _trained[key] = trained, folder
    return _trained[key]


def published_all(spark: SparkSession, d: str) -> dict[str, tuple[Trained, str]]:
    """All variants, trained side by side."""
    keyed(spark, d)  # stages the trips once, for all of them
    with ThreadPoolExecutor(len(feats.FEATURE_SETS)) as pool:
        made = pool.map(lambda variant: published(spark, d, variant), feats.FEATURE_SETS)
        return dict(zip(feats.FEATURE_SETS, made, strict=True))


def predicted(spark: SparkSession, d: str) -> DataFrame:
    """Clean trips with the mean of their courier flow as prediction."""
    return stored(spark, d, "predicted", flow_means)


def flow_means(spark: SparkSession, d: str) -> DataFrame:
    trips = keyed(spark, d)
    means = trips.groupBy("courier_flow").agg(
        F.avg("ATD").alias("prediction"), F.count("*").alias("_rows")
    )
    return join_facts(trips, means, ["courier_flow"], "_rows", null_safe=True).drop("_rows")


# ------------------------------------------------------- scans, sources and sinks


@query("scan_country_table")
def _(spark, d):
    base = scratch_path(spark, "country")
    path = tables.table_path(base, "stage", tables.WEEKLY_TABLE.format(country="eu"))
    tables.replace_table(snapshot(spark, d), path)
    return tables.read_country(spark, base, "eu", "stage")


@query("schema_created")
def _(spark, d):
    """The weekly table in a schema of its own; creating the schema again leaves it as it is."""
    location = scratch_path(spark, "stage")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, name, location)
    snapshot(spark, d).write.saveAsTable(f"{name}.weekly")
    tables.ensure_schema(spark, name, location)
    return spark.table(f"{name}.weekly")


@query("history_asof")
def _(spark, d):
    path = scratch_path(spark, "history")
    write_partitions(tb.event_history(spark, d), path)
    stored = tables.read_table(spark, path)
    return (
        history_as_of(stored, "2024-01-22")
        .groupBy("batch_date")
        .agg(F.count("*").alias("n"), F.countDistinct("delivery_trip_uuid").alias("trips"))
    )


@query("csv_round_trip")
def _(spark, d):
    path = scratch_path(spark, "clean-csv")
    columns = schemas.CLEAN_TRIPS.fieldNames()
    tables.write_csv(clean(spark, d).select(*columns), path)
    return tables.load_trips(spark, path)


@query("append_sink")
def _(spark, d):
    path = scratch_path(spark, "append")
    week = snapshot(spark, d)
    tables.append_rows(week, path)
    tables.append_rows(week, path)
    return tables.read_table(spark, path).groupBy("delivery_trip_uuid").agg(F.count("*").alias("n"))


@query("snapshot_replace")
def _(spark, d):
    path = scratch_path(spark, "replace")
    tables.replace_table(snapshot(spark, d, "ASIA"), path)
    tables.replace_table(snapshot(spark, d), path)
    return tables.read_table(spark, path).select("delivery_trip_uuid", "country_name")


@query("create_if_absent")
def _(spark, d):
    path = scratch_path(spark, "absent")
    tables.create_if_absent(snapshot(spark, d), path)
    tables.create_if_absent(snapshot(spark, d, "ASIA"), path)
    return tables.read_table(spark, path).select("delivery_trip_uuid", "country_name")


@query("append_union")
def _(spark, d):
    parts = [snapshot(spark, d, name) for name in ("EUROPE", "ASIA")]
    return tables.append_union(parts).select("delivery_trip_uuid", "country_name", "territory")


@query("weekly_snapshot")
def _(spark, d):
    return snapshot(spark, d)


@query("weekly_snapshot_all_countries")
def _(spark, d):
    return (
        snapshot(spark, d, None)
        .groupBy("country_name")
        .agg(
            F.count("*").alias("trips"),
            F.count("territory").alias("with_territory"),
            F.avg("atd").alias("avg_atd"),
        )
    )


@query("weekly_snapshot_null_territory")
def _(spark, d):
    return snapshot(spark, d).where("territory IS NULL")


@query("corrected_duration")
def _(spark, d):
    trips = tb.trips(spark, d)
    ends = [F.col("order_final_state_timestamp_local"), F.col("restaurant_offered_timestamp_utc")]
    return trips.select(
        "delivery_trip_uuid",
        clock.elapsed_minutes(*ends).alias("literal"),
        clock.elapsed_minutes(*ends, local_offset_hours=tb.UTC_OFFSET).alias("corrected"),
    )


@query("weekly_job")
def _(spark, d):
    inputs = {
        "trips": tb.trips(spark, d), "jobs": tb.jobs(spark, d),
        "city": tb.city(spark, d), "region": tb.city_region(spark, d),
    }
    base = scratch_path(spark, "weekly")
    now = dt.datetime(2024, 1, 1, 12)
    run_weekly(spark, inputs, base, "stage", "eu", tb.COUNTRY, tb.DS, now)
    return run_weekly(spark, inputs, base, "stage", "eu", tb.COUNTRY, tb.DS, now).drop(
        "inserted_at", "updated_at"
    )


@query("upsert_history")
def _(spark, d):
    """Second run of a batch: all trips come again, changed, and as many new ones."""
    path = scratch_path(spark, "upsert")
    week = scratch_path(spark, "week")
    tables.replace_table(snapshot(spark, d, None), week)
    everything = tables.read_table(spark, week)
    changed = everything.withColumns({
        "atd": F.col("atd") + 1,
        "territory": F.lit(None).cast("string"),
        "driver_uuid": F.lit(-1).cast(everything.schema["driver_uuid"].dataType),
    })
    second = changed.unionByName(changed.withColumn("delivery_trip_uuid", F.col("delivery_trip_uuid") + NEW_TRIPS))
    upsert_history(spark, path, everything, tb.DS, dt.datetime(2024, 1, 1))
    upsert_history(spark, path, everything, "1996-03-18", dt.datetime(2024, 1, 1))
    return upsert_history(spark, path, second, tb.DS, dt.datetime(2024, 1, 2)).select(
        "batch_date", "week_start", "week_end", "delivery_trip_uuid", "driver_uuid", "territory",
        "pickup_distance_km", "dropoff_distance_km", "atd", "inserted_at", "updated_at",
    )


@query("batch_rows")
def _(spark, d):
    return batch_rows(snapshot(spark, d, None), tb.DS).select(
        "batch_date", "week_start", "week_end", "delivery_trip_uuid", "pickup_distance_km",
        "dropoff_distance_km", "atd",
    )


@query("artifacts_round_trip")
def _(spark, d):
    """Published artifacts give the same held-out predictions as the trained model."""
    trained, folder = published(spark, d, "pre_assign")
    model, rows = load_artifacts(spark, folder, "pre_assign")
    again = model.transform(rows).select("trip_key", F.col("prediction").alias("loaded"))
    absent = load_preprocessing(spark, folder, "post_assign") is None
    return trained.test_predictions().join(again, "trip_key").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("prediction") == F.col("loaded")).alias("equal"),
        F.lit(absent).alias("other_variant_absent"),
    )


# ---------------------------------------------------- projections and predicates


@query("typed_trips")
def _(spark, d):
    return clean_plan.typed_trips(history(spark, d), tb.UTC_OFFSET)


@query("lenient_parse")
def _(spark, d):
    """Unreadable numbers and timestamps become NULL."""
    events = tb.table(spark, d, "events")
    odd = F.col("event_id") % 2 == 0
    text = F.when(odd, F.col("value").cast("string")).otherwise(F.col("event_type"))
    stamp = F.when(odd, F.col("ts").cast("string")).otherwise(F.col("event_type"))
    return events.select(
        "event_id",
        values.to_number(text).alias("number"),
        clock.parse_wall_clock(stamp).alias("stamp"),
    )


@query("clean_trips")
def _(spark, d):
    return clean_plan.clean_trips(history(spark, d), tb.UTC_OFFSET, keep=ROW_KEYS)


@query("clean_table_job")
def _(spark, d):
    path = scratch_path(spark, "job")
    _, rows = clean_plan.stage_trips(
        spark, history(spark, d), tb.UTC_OFFSET, path, keep=ROW_KEYS
    )
    return clean_plan.valid_trips(rows)


@query("exploration_clean")
def _(spark, d):
    return clean_plan.trimmed_trips(clean(spark, d))


@query("stage_counts")
def _(spark, d):
    return clean_plan.stage_counts(history(spark, d), tb.UTC_OFFSET)


@query("column_types")
def _(spark, d):
    return profile.column_types(prepared(spark, d))


@query("sentinel_rows")
def _(spark, d):
    return anomalies.marked_missing(prepared(spark, d)).select(
        "delivery_trip_uuid", "batch_date", "courier_flow"
    )


@query("sentinel_replace")
def _(spark, d):
    flow = values.replace_marker(F.col("courier_flow"))
    return prepared(spark, d).groupBy(flow.alias("courier_flow")).agg(F.count("*").alias("n"))


@query("drop_missing_offer")
def _(spark, d):
    kept = cleaning.drop_incomplete(prepared(spark, d), ["restaurant_offered_timestamp_local"])
    return kept.select("delivery_trip_uuid", "batch_date", "restaurant_offered_timestamp_local")


@query("anomaly_negative")
def _(spark, d):
    return anomalies.negative_target(flagged(spark, d)).select(
        "delivery_trip_uuid", "batch_date", "ATD"
    )


@query("anomaly_zero")
def _(spark, d):
    return anomalies.zero_target(flagged(spark, d)).select(
        "delivery_trip_uuid", "batch_date", "ATD"
    )


@query("anomaly_offer_after_final")
def _(spark, d):
    return anomalies.offered_after_final(
        prepared(spark, d), ["delivery_trip_uuid", "batch_date", *anomalies.EVIDENCE]
    )


@query("anomaly_request_after_final")
def _(spark, d):
    trips = tb.trips(spark, d).withColumn(
        anomalies.OFFERED, clock.utc_to_local(F.col("restaurant_offered_timestamp_utc"), 0)
    )
    return anomalies.requested_after_final(
        trips, ["delivery_trip_uuid", anomalies.REQUEST, anomalies.OFFERED, anomalies.FINAL]
    )


@query("anomaly_target_equals_difference")
def _(spark, d):
    return anomalies.target_equals_difference(
        prepared(spark, d).withColumn("ATD", F.round("ATD")),
        "diff_offered_minus_request",
        ["delivery_trip_uuid", "batch_date", "ATD"],
    )


@query("valid_offer")
def _(spark, d):
    valid = anomalies.valid_offer(prepared(spark, d))
    return valid.groupBy("valid_offered").agg(F.count("*").alias("n"))


@query("slice_filter")
def _(spark, d):
    choices = {
        "territory": ["T1", "T2"], "courier_flow": ["click", "purchase", values.MISSING_WORD],
        "geo_archetype": ["G0", "G1"], "merchant_surface": ["M0", "M3"],
    }
    return reports.selected_trips(clean(spark, d), choices, (6, 18)).select(
        "delivery_trip_uuid", "batch_date", *schemas.CATEGORIES, "hour", "day_label",
        "total_distance",
    )


@query("slice_filter_empty")
def _(spark, d):
    choices = {c: [] if c == "territory" else ["x"] for c in schemas.CATEGORIES}
    chosen = reports.selected_trips(clean(spark, d), choices)
    return chosen.select("delivery_trip_uuid", "ATD", "hour")


@query("slice_all_options")
def _(spark, d):
    chosen = selected(spark, d)
    return chosen.agg(F.count("*").alias("n"), F.sum("ATD").alias("total"))


@query("quantile_trim")
def _(spark, d):
    events = tb.table(spark, d, "events").select("event_id", "value")
    return quantile_trim(events, "value")


@query("numeric_columns")
def _(spark, d):
    trips = clean(spark, d)
    return trips.select(*profile.numeric_columns(trips)).agg(
        *[F.count(c).alias(c) for c in profile.numeric_columns(trips)]
    )


# -------------------------------------------------------------------------- joins


@query("join_jobs_cities")
def _(spark, d):
    """Job and place of every trip: inner by effect, region optional."""
    jobs = tb.jobs(spark, d).join(tb.city(spark, d), "city_id")
    placed = jobs.join(tb.city_region(spark, d), "city_id", "left")
    trips = tb.trips(spark, d).select("delivery_trip_uuid", "geo_archetype")
    joined = trips.join(placed, F.col("delivery_trip_uuid") == F.col("job_uuid"))
    return joined.groupBy("country_name", "territory").agg(
        F.count("*").alias("trips"), F.sum("pickup_distance").alias("pickup_metres")
    )


@query("rate_and_count")
def _(spark, d):
    trips = anomalies.time_flags(prepared(spark, d))
    return profile.rates_and_counts(trips, schemas.CATEGORIES, FLAGS)


@query("rare_strata")
def _(spark, d):
    frequent = keep_frequent(frame(spark, d, "pre_assign"), ["strata"], feats.MORE_THAN)
    return frequent.groupBy("strata").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------- aggregations


@query("kpi")
def _(spark, d):
    return summaries.kpis(selected(spark, d))


@query("kpi_empty")
def _(spark, d):
    return summaries.kpis(selected(spark, d).where("ATD < 0"))


@query("kpi_by_territory")
def _(spark, d):
    return summaries.kpis_by(clean(spark, d), ["territory"])


@query("snapshot_kpi_by_territory")
def _(spark, d):
    """KPIs over the stored weekly table, as the weekly job leaves it."""
    path = scratch_path(spark, "week")
    snapshot(spark, d, None).select("country_name", "territory", F.col("atd").cast("double").alias("ATD")).write.parquet(path)
    return summaries.kpis_by(spark.read.parquet(path), ["country_name", "territory"])


@query("trips_by_territory")
def _(spark, d):
    return summaries.counts_by(selected(spark, d), "territory")


@query("median_by_category")
def _(spark, d):
    return summaries.medians_by(clean(spark, d), schemas.CATEGORIES)


@query("avg_by_hour")
def _(spark, d):
    return summaries.mean_by(selected(spark, d), ["hour"])


@query("avg_by_weekday")
def _(spark, d):
    return summaries.mean_by_weekday(clean(spark, d), "eater_request_timestamp_local")


@query("avg_by_hour_flag")
def _(spark, d):
    trips = flagged(spark, d).withColumn(
        "hour", clock.hour_of_day(F.col("eater_request_timestamp_local"))
    )
    return summaries.mean_by(trips, ["hour", "offered_after_final"])


@query("profile_numeric")
def _(spark, d):
    return profile.profile_numeric(prepared(spark, d), [*schemas.DISTANCES, "ATD"])


@query("profile_numeric_by_flag")
def _(spark, d):
    return profile.profile_numeric(flagged(spark, d), ["ATD"], ["offered_equals_request"])


@query("profile_categorical")
def _(spark, d):
    return profile.profile_categorical(
        prepared(spark, d), [*schemas.CATEGORIES, "delivery_trip_uuid"]
    )


@query("null_rates")
def _(spark, d):
    return profile.null_rates(prepared(spark, d))


@query("missing_rate_by_dim")
def _(spark, d):
    trips = anomalies.missing_flags(prepared(spark, d)).withColumn(
        "hour", clock.hour_of_day(F.col("eater_request_timestamp_local"))
    )
    return profile.rates_by_dimension(trips, MISSING[1:], DIMENSIONS)


@query("flag_rates")
def _(spark, d):
    return profile.flag_rates(anomalies.time_flags(prepared(spark, d)), FLAGS)


@query("corr_flags")
def _(spark, d):
    return profile.correlations(anomalies.missing_flags(prepared(spark, d)), MISSING)


@query("corr_wide")
def _(spark, d):
    """Correlations of all pairs of the components of the vectors, as many as the longest one has."""
    vectors = tb.table(spark, d, "embeddings")
    width = vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    parts = vectors.select(*[F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(width)])
    return correlations_wide(parts, parts.columns)


@query("corr_matrix")
def _(spark, d):
    trips = trimmed(spark, d)
    return profile.correlations(trips, profile.numeric_columns(trips), absolute=True)


@query("corr_logs")
def _(spark, d):
    logs = {f"log_{c}": values.log1p_or_null(F.col(c)) for c in [*schemas.DISTANCES, "ATD"]}
    return profile.correlations(clean(spark, d).withColumns(logs), list(logs))


@query("diff_match_rate")
def _(spark, d):
    return anomalies.match_rates(prepared(spark, d))


@query("decile_means")
def _(spark, d):
    trips = clean(spark, d)
    return tables.append_union([
        summaries.mean_by_quantile_bin(trips, c, "ATD", 10).select(
            F.lit(c).alias("column"), "bin", "mean", "n"
        )
        for c in schemas.DISTANCES
    ])


@query("log_decile_means")
def _(spark, d):
    names = [*schemas.DISTANCES, "ATD"]
    logs = clean(spark, d).withColumns({c: values.log1p_or_null(F.col(c)) for c in names})
    return tables.append_union([
        summaries.mean_by_quantile_bin(logs, c, "ATD", 10).select(
            F.lit(c).alias("column"), "bin", "mean", "n"
        )
        for c in schemas.DISTANCES
    ])


@query("quantile_bins")
def _(spark, d):
    events = tb.table(spark, d, "events").select("event_id", "value")
    return quantile_bin(events, "value", 10)


@query("quantiles")
def _(spark, d):
    return named_quantiles(flagged(spark, d), "ATD", [0.99, 0.98, 0.97, 0.95, 0.9, 0.5])


@query("filter_options")
def _(spark, d):
    return summaries.filter_options(clean(spark, d), schemas.CATEGORIES)


@query("dq_report")
def _(spark, d):
    trips = prepared(spark, d)
    return quality.dq_report(trips)


@query("dq_report_missing_column")
def _(spark, d):
    return quality.dq_report(prepared(spark, d).drop("dropoff_distance"))


@query("dq_messages")
def _(spark, d):
    return quality.warning_messages(quality.dq_report(prepared(spark, d)))


@query("constraint_report")
def _(spark, d):
    return quality.job_constraints(tb.all_jobs(spark, d))


@query("trip_constraints")
def _(spark, d):
    return quality.trip_constraints(tb.trips(spark, d))


@query("history_constraints")
def _(spark, d):
    rows = history(spark, d).withColumns({
        "week_start": clock.days_before(F.col("batch_date"), 7), "week_end": F.col("batch_date")
    })
    return quality.history_constraints(rows)


def counted_run(spark: SparkSession, d: str) -> DataFrame:
    """The table of stage counts after one cleaning run that counts while it writes."""
    metrics = scratch_path(spark, "metrics")
    clean_plan.stage_trips(
        spark, history(spark, d), tb.UTC_OFFSET, scratch_path(spark, "counted"), keep=ROW_KEYS, metrics=metrics, run=tb.DS
    )
    return tables.read_table(spark, metrics)


@query("observed_rows")
def _(spark, d):
    """Clean rows and their total duration, counted while the cleaning job wrote its tables."""
    return counted_run(spark, d).select(F.col("clean_rows").alias("rows_seen"), F.col("clean_total").alias("total_atd"))


@query("stage_metrics")
def _(spark, d):
    """Rows at every stage of a run, from the table of counts."""
    return counted_run(spark, d).unpivot(["run"], list(clean_plan.STAGES), "stage", "rows")


@query("text_lengths")
def _(spark, d):
    return quality.text_lengths(
        tb.table(spark, d, "documents"), {"text": 2000, "lang": 2, "source": 8}
    )


@query("uniqueness_report")
def _(spark, d):
    return quality.repeated_keys(tb.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_report")
def _(spark, d):
    return quality.duplicate_report(tb.event_trips(spark, d))


@query("histogram")
def _(spark, d):
    return summaries.histogram(selected(spark, d), "ATD", reports.OVERVIEW_BINS)


@query("density_curve")
def _(spark, d):
    """Smooth density of the durations of all clean trips."""
    return curves.density_curve(clean(spark, d), "ATD")


@query("density_curve_by_flow")
def _(spark, d):
    """The same for every courier flow, on a grid of its own that ends at its values."""
    return curves.density_curve(clean(spark, d), "ATD", ["courier_flow"], points=60, cut=0.0)


@query("auto_histogram")
def _(spark, d):
    """Histograms with as many bins as the data ask for: a skewed column, one of two values, a constant one."""
    trips = clean(spark, d).withColumn("constant", F.lit(4.0))
    return tables.append_union([
        curves.auto_histogram(trips, c).withColumn("column", F.lit(c)) for c in ("ATD", "pickup_distance", "missing_distance", "constant")
    ])


@query("mean_interval_by_hour")
def _(spark, d):
    return intervals.bootstrap_mean(keyed(spark, d).withColumn("hour", clock.hour_of_day(F.col("eater_request_timestamp_local"))), "ATD", feats.KEY, ["hour"])


@query("missing_rate_interval")
def _(spark, d):
    """Rate of trips whose distance was missing, by territory, with its interval."""
    return intervals.bootstrap_mean(keyed(spark, d), "missing_distance", feats.KEY, ["territory"])


@query("slope_interval")
def _(spark, d):
    trips = keyed(spark, d)
    return tables.append_union([
        intervals.bootstrap_slope(trips, c, "ATD", feats.KEY).withColumn("column", F.lit(c)) for c in schemas.DISTANCES
    ])


@query("kpi_from_partials")
def _(spark, d):
    """KPIs by territory over all batches of the history, read from the counts that upserts keep beside it."""
    path, week = scratch_path(spark, "partials"), scratch_path(spark, "week")
    tables.replace_table(snapshot(spark, d, None), week)
    everything = tables.read_table(spark, week)
    now = dt.datetime(2024, 1, 1)
    for ds, rows in ((tb.DS, everything), ("1996-03-18", everything), (tb.DS, everything.withColumn("atd", F.col("atd") + 1))):
        partials.upsert_with_partials(spark, path, rows, ds, partials.FIGURES, ["territory"], now)
    counts = partials.read_partials(spark, partials.partials_path(path))
    return partials.kpis_of_partials(counts, "atd", {"median": 0.5, "p90": 0.9}, ["territory"])


@query("histogram_detail")
def _(spark, d):
    trips = clean(spark, d)
    return tables.append_union([
        summaries.histogram(trips, c, 100).select(F.lit(c).alias("column"), "bin", "count")
        for c in ["pickup_distance", "dropoff_distance", "ATD"]
    ])


@query("log_histogram")
def _(spark, d):
    logs = clean(spark, d).withColumn("log_atd", values.log1p_or_null(F.col("ATD")))
    return summaries.histogram(logs, "log_atd", 50)


@query("pairwise_panel")
def _(spark, d):
    """Correlations and trends of all pairs of logged numbers, a histogram of each, and the sampled points."""
    columns = [*schemas.DISTANCES, "ATD"]
    trips = feats.with_trip_key(trimmed(spark, d), ROW_KEYS)
    panel = reports.pairwise(trips, columns, 20, feats.KEY)
    no_bin, nobody = F.lit(-1).alias("bin"), F.lit(None).cast("string").alias("b")
    trends = panel["trends"].withColumn("n", F.col("n").cast("double"))
    return tables.append_union([
        panel["correlations"].select(F.lit("correlation").alias("part"), "a", "b", no_bin, F.col("corr").alias("value")),
        trends.unpivot(["a", "b"], ["slope", "intercept", "r2", "n"], "part", "value").select("part", "a", "b", no_bin, "value"),
        panel["histograms"].select(F.lit("histogram").alias("part"), "a", nobody, "bin", F.col("count").cast("double").alias("value")),
        panel["points"].unpivot([feats.KEY], columns, "a", "value").select(
            F.lit("point").alias("part"), "a", F.col(feats.KEY).alias("b"), no_bin, "value"
        ),
    ])


@query("density_by_category")
def _(spark, d):
    return summaries.density_by(trimmed(spark, d), "ATD", "courier_flow", 50)


@query("box_stats")
def _(spark, d):
    return summaries.box_stats(selected(spark, d), "ATD", "territory")


@query("box_stats_by_flag")
def _(spark, d):
    return summaries.box_stats(flagged(spark, d), "ATD", "offered_equals_request")


@query("ols_trend")
def _(spark, d):
    trips = clean(spark, d)
    return tables.append_union([
        summaries.ols_trend(trips, c).withColumn("column", F.lit(c)) for c in schemas.DISTANCES
    ])


@query("axis_limits")
def _(spark, d):
    return errors.axis_limits(predicted(spark, d))


# ------------------------------------------------- windows, duplicates, imputation


@query("impute_group_median")
def _(spark, d):
    filled = cleaning.impute_group_median(prepared(spark, d), "territory", schemas.DISTANCES)
    return filled.select(*ROW_KEYS, "territory", *schemas.DISTANCES)


@query("group_medians")
def _(spark, d):
    return cleaning.group_medians(prepared(spark, d), "territory", schemas.DISTANCES)


@query("duplicate_rows")
def _(spark, d):
    return cleaning.duplicate_members(tb.event_trips(spark, d))


@query("duplicate_keys")
def _(spark, d):
    line = tb.table(spark, d, "lineitem")
    return cleaning.duplicate_members(line, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copies"
    )


@query("dedup_exact")
def _(spark, d):
    return cleaning.drop_exact_duplicates(tb.event_trips(spark, d))


@query("dedup_by_key")
def _(spark, d):
    """One whole row per business key, the first by part, supplier and ship date."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    line = tb.table(spark, d, "lineitem").select(*columns)
    return cleaning.first_by_key(line, columns[:2], columns[2:])


# ---------------------------------------------------------------- sorts and samples


@query("worst_trips")
def _(spark, d):
    scored = errors.with_errors(predicted(spark, d))
    return errors.top_errors(scored, "trip_key", 20).select(
        "trip_key", "ATD", "prediction", "error", "abs_error"
    )


@query("trips_by_error")
def _(spark, d):
    scored = errors.rows_by_error(errors.with_errors(predicted(spark, d)))
    return scored.select("trip_key", "abs_error")


@query("first_rows")
def _(spark, d):
    return clean(spark, d).orderBy("delivery_trip_uuid", "batch_date").limit(5).select(
        "delivery_trip_uuid", "batch_date", "ATD"
    )


@query("sample_points")
def _(spark, d):
    trips = keyed(spark, d)
    return sampling.sample_rows(trips, F.col(feats.KEY), reports.SCATTER_POINTS).select(
        feats.KEY, "dropoff_distance", "pickup_distance", "ATD"
    )


# ---------------------------------------------------------------- scalar functions


@query("time_flags")
def _(spark, d):
    return anomalies.time_flags(prepared(spark, d)).select(*ROW_KEYS, *FLAGS)


@query("missing_flags")
def _(spark, d):
    return anomalies.missing_flags(prepared(spark, d)).select(*ROW_KEYS, *MISSING)


@query("time_diffs")
def _(spark, d):
    return anomalies.time_differences(prepared(spark, d)).select(
        *ROW_KEYS, *anomalies.TIME_DIFFERENCES
    )


@query("calendar_parts")
def _(spark, d):
    ts = F.col("ts").cast("timestamp_ntz")
    hour = clock.hour_of_day(ts)
    sine, cosine = clock.hour_angle(hour)
    return tb.table(spark, d, "events").select(
        "event_id",
        hour.alias("hour"),
        clock.weekday_number(ts).alias("day_of_week"),
        clock.weekday_label(clock.weekday_number(ts)).alias("day_label"),
        clock.weekend_flag(ts).alias("is_weekend"),
        clock.three_hour_slot(hour).alias("hour_bin"),
        sine.alias("hour_sin"),
        cosine.alias("hour_cos"),
        clock.as_date(ts).alias("day"),
        clock.days_before(clock.as_date(ts), 7).alias("week_before"),
        clock.utc_to_local(ts, tb.UTC_OFFSET).alias("local_ts"),
    )


@query("value_functions")
def _(spark, d):
    value = F.col("value")
    shifted = value - 2
    return tb.table(spark, d, "events").select(
        "event_id",
        values.log1p_or_null(shifted).alias("log_shifted"),
        values.stored_km((value * 100).cast("decimal(10,1)")).alias("km"),
        values.display_number(value).alias("shown"),
        values.title_label(F.concat(F.lit("event_"), F.col("event_type"))).alias("label"),
        values.text_key(
            F.when(F.col("user_id") % 7 != 0, F.col("user_id")), F.col("event_type")
        ).alias("key"),
    )


# ------------------------------------------------------------------ features, models


@query("features_pre")
def _(spark, d):
    return frame(spark, d, "pre_assign")


@query("features_post")
def _(spark, d):
    return frame(spark, d, "post_assign")


@query("log_columns")
def _(spark, d):
    return clean(spark, d).select(
        *ROW_KEYS,
        *[values.log1p_or_null(F.col(c)).alias(f"log_{c}") for c in [*schemas.DISTANCES, "ATD"]],
    )


@query("dummies_drop_first")
def _(spark, d):
    trips = clean(spark, d).select(*ROW_KEYS, *schemas.CATEGORIES)
    return feats.drop_first_dummies(trips, schemas.CATEGORIES, feats.label_lists(trips, schemas.CATEGORIES))


@query("dummies_sparse")
def _(spark, d):
    trips = clean(spark, d).select(*ROW_KEYS, *schemas.CATEGORIES)
    sparse = feats.sparse_dummies(trips, schemas.CATEGORIES, scratch_path(spark, "labels"))
    return sparse.withColumn("indices", F.array_join(F.col("indices").cast("array<string>"), ","))


@query("linear_fit")
def _(spark, d):
    """Linear regression of the duration on both distances, without regularisation."""
    rows = clean(spark, d).na.drop(subset=schemas.DISTANCES)
    assembled = VectorAssembler(inputCols=schemas.DISTANCES, outputCol="features").transform(rows)
    fitted = LinearRegression(featuresCol="features", labelCol="ATD", regParam=0.0, solver="normal").fit(assembled)
    values_of = [fitted.intercept, *fitted.coefficients.toArray().tolist()]
    names = ["intercept", *schemas.DISTANCES]
    return rows.agg(F.count("*").alias("n"), *[F.lit(float(v)).alias(c) for c, v in zip(names, values_of)])


@query("boosted_tree")
def _(spark, d):
    """One tree of two levels over the distances of all clean trips, missing ones included: splits, gains, leaf weights."""
    assembled = VectorAssembler(inputCols=schemas.DISTANCES, outputCol="features", handleInvalid="keep").transform(keyed(spark, d))
    model = Boosting(rounds=1, depth=2, learning_rate=1.0, l2=1.0, bins=16).fit(assembled)
    threshold = F.when(F.col("feature") >= 0, F.col("threshold"))
    return model.nodes(spark).select("node", "feature", threshold.alias("threshold"), "missing_left", "gain", "weight")


@query("performance_trained")
def _(spark, d):
    """Held-out metrics of the published best models, as loaded, next to those of the training run."""
    parts = []
    for variant, (trained, folder) in published_all(spark, d).items():
        model, rows = load_artifacts(spark, folder, variant)
        again = errors.regression_metrics(model.transform(rows)).select(
            F.lit(variant).alias("variant"), "n", F.col("mae").alias("_mae"), F.col("rmse").alias("_rmse")
        )
        told = trained.metrics.where(F.col("model") == trained.best).select("variant", "mae", "rmse")
        least = trained.metrics.groupBy("variant").agg(F.min("rmse").alias("least"))
        same = (F.abs(F.col("mae") - F.col("_mae")) < 1e-9) & (F.abs(F.col("rmse") - F.col("_rmse")) < 1e-9)
        parts.append(again.join(told, "variant").join(least, "variant").select(
            "variant", F.col("n").alias("held_out"), same.alias("metrics_recomputed"),
            (F.col("rmse") == F.col("least")).alias("least_rmse"),
        ))
    return tables.append_union(parts)


@query("strat_split")
def _(spark, d):
    return split(spark, d, "pre_assign").select(feats.KEY, "strata", "split")


@query("scaled_features")
def _(spark, d):
    """Scaled numbers of all split rows; constants come from the training part."""
    features = feats.POST_ASSIGN
    path = scratch_path(spark, "scaled")
    split(spark, d, "post_assign").write.parquet(path)
    rows = spark.read.parquet(path)
    constants = preprocess.scaling(rows.where("split = 'train'"), features)
    return rows.select(
        feats.KEY,
        "split",
        *[
            ((values.log1p_or_null(F.col(c)) - mean) / std).alias(c)
            for c, (mean, std) in constants.items()
        ],
    )


@query("encoded_features")
def _(spark, d):
    """Column sums of all encoded vectors, by part of the split and feature name."""
    features = feats.POST_ASSIGN
    model, rows = encoded_split(spark, keyed(spark, d), features, scratch_path(spark, "encoded"))
    names = preprocess.encoded_names(model, features)
    labels = F.array(*[F.lit(n) for n in names])
    parts = rows.select("split", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return parts.groupBy("split", labels[F.col("position")].alias("feature")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query("encoded_feature_names")
def _(spark, d):
    """Names of the vector places, read from the stored table of labels."""
    path = scratch_path(spark, "split")
    split(spark, d, "pre_assign").write.parquet(path)
    train = spark.read.parquet(path).where("split = 'train'")
    return preprocess.LabelTable.fit(train, feats.PRE_ASSIGN, scratch_path(spark, "labels")).names(spark)


@query("encoded_by_joins")
def _(spark, d):
    """Column sums of the vectors that the stored labels give, by part of the split and feature name."""
    path = scratch_path(spark, "split")
    split(spark, d, "post_assign").write.parquet(path)
    rows = spark.read.parquet(path)
    table = preprocess.LabelTable.fit(rows.where("split = 'train'"), feats.POST_ASSIGN, scratch_path(spark, "labels"))
    vectors = table.encode(rows, "split")
    parts = vectors.select("split", F.posexplode(vector_to_array("features")).alias("position", "value"))
    sums = parts.groupBy("split", "position").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sums.join(table.names(spark), "position").select("split", "feature", "n", "total")


@query("train_select_pre")
def _(spark, d):
    trained, _ = published(spark, d, "pre_assign")
    return errors.rank_models(trained.metrics)


@query("train_select_post")
def _(spark, d):
    trained, _ = published(spark, d, "post_assign")
    return errors.best_model(trained.metrics)


@query("batch_score")
def _(spark, d):
    """Every clean trip, also those of strata too rare to train on; NULL where a feature is missing."""
    trained, _ = published(spark, d, "pre_assign")
    rows = frame(spark, d, "pre_assign")
    return score(trained.preprocessing, trained.best_model, rows).select(
        feats.KEY, "ATD", "prediction"
    )


@query("batch_score_coverage")
def _(spark, d):
    """Which trips the batch scoring gives a prediction; the preprocessing alone decides that."""
    features = feats.PRE_ASSIGN
    path = scratch_path(spark, "split")
    split(spark, d, features.name).write.parquet(path)
    train = spark.read.parquet(path).where("split = 'train'")
    fitted = preprocess.fit_preprocessing(train, features)
    linear = PipelineModel([LinearRegression(featuresCol="features", labelCol="ATD").fit(
        preprocess.encode(fitted, train).select("features", "ATD")
    )])
    scored = score(fitted, linear, frame(spark, d, features.name))
    return scored.select(feats.KEY, F.col("prediction").isNotNull().alias("scored"))


@query("batch_score_linear")
def _(spark, d):
    """Predictions of the linear model on the distances for every clean trip, also of strata it never saw."""
    features = feats.FeatureSet("distances", tuple(schemas.DISTANCES), (), (), ())
    path = scratch_path(spark, "split")
    split(spark, d, "pre_assign").write.parquet(path)
    train = spark.read.parquet(path).where("split = 'train'")
    fitted = preprocess.fit_preprocessing(train, features)
    model = fit_model(catalogue(SETTINGS)["linear"], preprocess.encode(fitted, train).select("features", "ATD"))
    scored = score(fitted, model, frame(spark, d, "pre_assign"))
    return scored.select(feats.KEY, F.round(F.col("prediction") + NUDGE, 4).alias("prediction"))


@query("models_ranked")
def _(spark, d):
    """Three simple predictors in order of their error."""
    rows = predicted(spark, d)
    mean = rows.agg(F.avg("ATD").alias("m")).scalar()
    candidates = {"flow_mean": rows, "overall_mean": rows.withColumn("prediction", mean), "zero": rows.withColumn("prediction", F.lit(0.0))}
    return errors.rank_models(tables.append_union([
        errors.regression_metrics(df).withColumn("model", F.lit(name)) for name, df in candidates.items()
    ])).select("place", "model", "mae", "rmse", "n")


@query("error_metrics")
def _(spark, d):
    return errors.error_metrics(predicted(spark, d))


@query("regression_metrics")
def _(spark, d):
    return errors.regression_metrics(predicted(spark, d))


@query("model_ranking")
def _(spark, d):
    """Two simple predictors compared and the better one chosen."""
    rows = predicted(spark, d)
    mean = rows.agg(F.avg("ATD").alias("m")).scalar()
    candidates = {"flow_mean": rows, "overall_mean": rows.withColumn("prediction", mean)}
    metrics = tables.append_union([
        errors.regression_metrics(df).withColumn("model", F.lit(name))
        for name, df in candidates.items()
    ])
    return errors.best_model(metrics)


@query("error_by_quintile")
def _(spark, d):
    return errors.error_by_range(predicted(spark, d), 5)


@query("error_rows")
def _(spark, d):
    return errors.with_errors(predicted(spark, d)).select(
        "trip_key", "ATD", "prediction", "error", "abs_error"
    )


@query("error_histogram")
def _(spark, d):
    scored = errors.with_errors(predicted(spark, d))
    return summaries.histogram(scored, "error", reports.ERROR_BINS).select("bin", "count")


# ------------------------------------------------------------------------- reports


@query("report_overview")
def _(spark, d):
    return reports.figures(reports.overview(selected(spark, d)))


@query("report_exploration")
def _(spark, d):
    path = scratch_path(spark, "selected")
    shown = ["hour", "eater_request_timestamp_local", "territory", *schemas.DISTANCES, "ATD"]
    reports.selected_trips(keyed(spark, d)).select(feats.KEY, *shown).write.parquet(path)
    return reports.figures(reports.exploration(spark.read.parquet(path), F.col(feats.KEY)))


@query("exploration_profile")
def _(spark, d):
    """The exploration in one result: profiles, gaps, time relations and what trimming leaves."""
    first, marked = staged(spark, d)
    return reports.figures(reports.exploration_profile(first, marked, clean(spark, d)))


@query("report_performance")
def _(spark, d):
    return reports.figures(reports.performance(predicted(spark, d), F.col(feats.KEY)))


@query("report_trained")
def _(spark, d):
    """The performance panels of the published best model over its held-out rows."""
    _, folder = published(spark, d, "pre_assign")
    model, rows = load_artifacts(spark, folder, "pre_assign")
    path = scratch_path(spark, "held-out")
    model.transform(rows).select(feats.KEY, "ATD", "prediction").write.parquet(path)
    return reports.figures(reports.performance(spark.read.parquet(path), F.col(feats.KEY)))
