"""Places over sorted ranges, quotas of any number of strata, and the encoding by a stored table of labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripmeter.models import features as feats
from tripmeter.models import preprocess
from tripmeter.operators.errors import rank_models
from tripmeter.operators.ranks import ranked
from tripmeter.operators.sampling import split_quotas
from tripmeter.operators.summaries import pair_trends
from tripmeter.plans import clean as clean_plan
from tripmeter.plans import reports
from tripmeter.sources import tables
from workload import queries, testbed

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_with_ties_missing_values_and_clashing_names(spark, path):
    rows = [(i % 3, None if i % 7 == 0 else f"n{i % 11}", i, i) for i in range(200)]
    df = spark.createDataFrame(rows, "part int, row string, k0 int, place int")
    got = {r.k0: r["rank"] for r in ranked(df, ["part", "row", "k0"], f"{path}/r", descending=["part"]).collect()}
    order = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or "", r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}


def test_places_of_an_empty_table(spark, path):
    assert ranked(spark.createDataFrame([], "a int"), ["a"], f"{path}/r").count() == 0


def test_quotas_of_many_strata(spark):
    """Most strata share one remainder, so the names decide; the window over all of them is gone."""
    n = 60_000
    sizes = spark.range(n).select(F.concat(F.lit("s"), "id").alias("s"), (F.col("id") % 3 * 5 + 11).alias("n"))
    quotas = split_quotas(sizes, "s", "n", 0.2)
    frame = sizes.toPandas()
    frame["whole"] = np.floor(np.round(frame.n * 0.2, 9)).astype(int)
    frame["remainder"] = np.round(frame.n * 0.2 - frame.whole, 9)
    spare = int(np.ceil(round(frame.n.sum() * 0.2, 9)) - frame.whole.sum())
    frame = frame.sort_values(["remainder", "s"], ascending=[False, True]).reset_index(drop=True)
    want = dict(zip(frame.s, frame.whole + (frame.index < spare).astype(int)))
    assert {r.s: r._quota for r in quotas.collect()} == want
    windows = [line for line in plan(quotas).splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("[part#" in line for line in windows)


def encoded(spark, path, features):
    queries.split(spark, FOLDER, features.name).write.parquet(f"{path}/split")
    rows = spark.read.parquet(f"{path}/split")
    return rows, rows.where("split = 'train'")


def test_both_encodings_are_equal(spark, path):
    features = feats.POST_ASSIGN
    rows, train = encoded(spark, path, features)
    model = preprocess.fit_preprocessing(train, features)
    table = preprocess.LabelTable.fit(train, features, f"{path}/labels")
    names = [r.feature for r in table.names(spark).orderBy("position").collect()]
    assert names == preprocess.encoded_names(model, features)
    strange = rows.withColumn("territory", F.when(F.col("hour_sin") > 0, F.lit("new")).otherwise(F.col("territory")))
    for frame in (rows, strange):
        here = preprocess.encode(model, frame).select("trip_key", vector_to_array("features").alias("a"))
        there = table.encode(frame, "trip_key").select("trip_key", vector_to_array("features").alias("b"))
        both = here.join(there, "trip_key", "full").collect()
        assert len(both) == here.count() == there.count() > 0
        assert all(r.a == r.b for r in both)


def test_a_million_labels(spark, path):
    """Names and vectors without a label on the driver; one label holds a third of the rows."""
    n = 1_000_000
    features = feats.FeatureSet("wide", ("x",), ("label",), (), ("turn",))
    label = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), "id"))
    train = spark.range(n * 3 // 2).select("id", label.alias("label"), (F.col("id") % 10).cast("double").alias("x"), F.lit(0.5).alias("turn"))
    table = preprocess.LabelTable.fit(train, features, path)
    assert table.labels == n + 1 and table.size == n + 3
    names = table.names(spark)
    assert names.agg(F.count("*"), F.countDistinct("position"), F.min("position"), F.max("position")).first() == (n + 3, n + 3, 0, n + 2)
    some = table.encode(train.where("id IN (0, 1, 999999)"), "id").collect()
    by_name = {r.position: r.feature for r in names.where("position < 5 OR position > 999998").collect()}
    wanted = {0: "cat__label_hot", 1: "cat__label_v1", 999999: "cat__label_hot"}
    assert by_name[0] == "num__x" and by_name[n + 2] == "cyc__turn"
    for row in some:
        at = [int(i) for i in row.features.indices]
        assert at[0] == 0 and at[-1] == n + 2 and row.features.size == n + 3
        assert names.where(F.col("position") == at[1]).first().feature == wanted[row.id]


def test_the_write_counts_its_stages(spark, path):
    """The counts equal those of a pass of their own, runs add up in the table, and the tables are the same."""
    history = testbed.event_history(spark, FOLDER)
    kept = queries.ROW_KEYS
    for run in ("first", "second"):
        got = clean_plan.stage_trips(spark, history, 6, f"{path}/{run}", keep=kept, metrics=f"{path}/metrics", run=run)
    want = clean_plan.stage_counts(history, 6).first().asDict()
    stored = tables.read_table(spark, f"{path}/metrics").collect()
    assert sorted(r.run for r in stored) == ["first", "second"]
    for row in stored:
        assert {c: row[c] for c in clean_plan.STAGES} == want
    plain = clean_plan.stage_trips(spark, history, 6, f"{path}/plain", keep=kept)
    for one, other in zip(got, plain):
        assert one.columns == other.columns
        assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0
    empty = clean_plan.stage_trips(spark, history.limit(0), 6, f"{path}/empty", metrics=f"{path}/none", run="empty")
    assert empty[1].count() == 0
    assert tables.read_table(spark, f"{path}/none").first()[1:] == (0, 0, 0, 0, 0, None)


def test_pair_trends_against_a_fit(spark):
    frame = pd.DataFrame({"x": [1.0, 2.0, 4.0, None, 5.0], "y": [2.0, 3.0, 9.0, 1.0, None], "c": [7.0] * 5})
    got = {(r.a, r.b): r for r in pair_trends(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "x double, y double, c double"), ["x", "y", "c"]).collect()}
    slope, intercept = np.polyfit([1, 2, 4], [2, 3, 9], 1)
    assert np.allclose([got["y", "x"].slope, got["y", "x"].intercept, got["y", "x"].n], [slope, intercept, 3])
    assert got["c", "x"].slope == 0 and got["c", "x"].n == 4


def test_ranked_models_break_ties_by_name(spark):
    metrics = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model string, rmse double")
    assert [(r.place, r.model) for r in rank_models(metrics).collect()] == [(1, "c"), (2, "a"), (3, "b")]


def test_figures_keep_missing_values(spark):
    panels = {"axis": spark.createDataFrame([(None, 2)], "low double, high int")}
    assert sorted((r.panel, r.key, r.figure, r.value) for r in reports.figures(panels).collect()) == [
        ("axis", "", "high", 2.0), ("axis", "", "low", None)
    ]
