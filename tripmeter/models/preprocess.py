"""Fitted preprocessing: log and standardise numbers, one-hot categories, assemble.

Two forms give the same vectors.  :func:`fit_preprocessing` is a storable MLlib pipeline whose labels pass
through the driver; :class:`LabelTable` keeps the labels in a stored table and builds sparse vectors by joins,
so any number of labels will do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripmeter.functions.values import MISSING_KEY_TEXT, any_null, log1p_or_null
from tripmeter.models.features import FeatureSet
from tripmeter.operators.ranks import ranked
from tripmeter.sources.tables import append_union

FEATURES = "features"
COMPLETE = "_complete"


def scaling(train: DataFrame, features: FeatureSet) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of ln(1+x) per numeric column, NULLs skipped.

    One pass; a constant column is divided by 1.
    """
    logs = train.select(*[log1p_or_null(F.col(c)).alias(c) for c in features.numeric])
    stats = logs.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
        for c in features.numeric
    ]).first()
    return {c: (stats[c]["mean"] or 0.0, stats[c]["std"] or 1.0) for c in features.numeric}


def scaled(column: str) -> str:
    return f"{column}_scaled"


def _scaler(constants: dict[str, tuple[float, float]], features: FeatureSet) -> SQLTransformer:
    """The fitted scaling as a storable stage, with missing categories spelled out."""
    scaled_columns = [
        f"(CASE WHEN `{c}` > -1 THEN log1p(`{c}`) END - ({mean!r}D)) / {std!r}D"
        f" AS `{scaled(c)}`"
        for c, (mean, std) in constants.items()
    ]
    labels = [
        f"coalesce(`{c}`, '{MISSING_KEY_TEXT}') AS `{c}_label`" for c in features.categorical
    ]
    return SQLTransformer(
        statement=f"SELECT *, {', '.join([*scaled_columns, *labels])} FROM __THIS__"
    )


def fit_preprocessing(train: DataFrame, features: FeatureSet) -> PipelineModel:
    """Fit on training rows only.

    Unknown categories give all zeros; a missing category seen in training is a category
    of its own.  The vector holds numbers, categories, flags and cyclical parts in turn.
    """
    scaler = _scaler(scaling(train, features), features)
    coding = _one_hot(features) if features.categorical else []
    assembler = VectorAssembler(
        inputCols=[
            *[scaled(c) for c in features.numeric],
            *[f"{c}_onehot" for c in features.categorical],
            *features.binary,
            *features.cyclical,
        ],
        outputCol=FEATURES,
        handleInvalid="skip",
    )
    return Pipeline(stages=[scaler, *coding, assembler]).fit(train)


def _one_hot(features: FeatureSet) -> list[StringIndexer | OneHotEncoder]:
    indexer = StringIndexer(
        inputCols=[f"{c}_label" for c in features.categorical],
        outputCols=[f"{c}_index" for c in features.categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in features.categorical],
        outputCols=[f"{c}_onehot" for c in features.categorical],
        dropLast=True,
    )
    return [indexer, encoder]


def encoded_names(model: PipelineModel, features: FeatureSet) -> list[str]:
    """Names of the vector positions."""
    labels = model.stages[1].labelsArray if features.categorical else []
    onehot = [
        f"cat__{c}_{label}" for c, values in zip(features.categorical, labels) for label in values
    ]
    return [
        *[f"num__{c}" for c in features.numeric],
        *onehot,
        *[f"bin__{c}" for c in features.binary],
        *[f"cyc__{c}" for c in features.cyclical],
    ]


def encode(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Rows with the feature vector, for training and evaluation: rows that lack a feature are dropped."""
    return model.transform(frame)


def encode_all(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """All rows with the feature vector and whether it is complete; a missing feature is NaN in it."""
    *first, assembler = model.stages
    rows = PipelineModel(first).transform(frame)
    inputs = [F.col(c) for c in assembler.getInputCols()]
    keeping = assembler.copy().setHandleInvalid("keep")
    return keeping.transform(rows.withColumn(COMPLETE, ~any_null(*inputs)))


@dataclass(frozen=True)
class LabelTable:
    """The fitted one-hot encoding as a stored table: ``column, label, position``.

    Positions are those of the MLlib form: numbers, then the labels of each category in order, flags,
    cyclical parts.  Only the scaling constants and the number of labels reach the driver.
    """

    features: FeatureSet
    constants: dict[str, tuple[float, float]]
    labels: int
    path: str

    @classmethod
    def fit(cls, train: DataFrame, features: FeatureSet, path: str) -> LabelTable:
        """Number the labels of the training rows by sorted ranges; writes below ``path``."""
        places = F.array(*[F.lit(c) for c in features.categorical])
        texts = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_KEY_TEXT)).alias(c) for c in features.categorical]
        distinct = train.select(*texts).unpivot([], list(features.categorical), "column", "label").distinct()
        ordered = distinct.withColumn("place", F.array_position(places, F.col("column")))
        numbered = ranked(ordered, ["place", "label"], f"{path}/ranges", into="place_of_all")
        position = F.col("place_of_all") - 1 + len(features.numeric)
        numbered.select("column", "label", position.alias("position")).write.parquet(f"{path}/labels")
        spark = train.sparkSession
        count = spark.read.parquet(f"{path}/labels").count()
        return cls(features, scaling(train, features), count, path)

    @property
    def size(self) -> int:
        """Length of the vectors."""
        return len(self.features.numeric) + self.labels + len(self.features.binary) + len(self.features.cyclical)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/labels")

    def names(self, spark: SparkSession) -> DataFrame:
        """``position, feature``: the name of every place of the vector."""
        labels = self.table(spark).select(
            "position", F.concat_ws("_", F.lit("cat_"), "column", "label").alias("feature")
        )
        tail = [*[f"bin__{c}" for c in self.features.binary], *[f"cyc__{c}" for c in self.features.cyclical]]
        first, n = len(self.features.numeric), F.col("n")
        fixed = [
            *[F.struct(F.lit(i).cast("long").alias("position"), F.lit(f"num__{c}").alias("feature"))
              for i, c in enumerate(self.features.numeric)],
            *[F.struct((n + first + i).alias("position"), F.lit(name).alias("feature")) for i, name in enumerate(tail)],
        ]
        # A column set has a fixed number of names; where they stand follows from the stored table.
        named = labels.agg(F.count("*").alias("n")).select(F.inline(F.array(*fixed)))
        return append_union([labels, named])

    def encode(self, frame: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and the sparse vector of each row; rows that lack a feature are dropped.

        A label not seen in training gives zeros.  Frequent labels are left to the adaptive join.
        """
        features, spark = self.features, frame.sparkSession
        out, labels = frame, self.table(spark)
        for c in features.categorical:
            own = labels.where(F.col("column") == c).select(F.col("label").alias(f"_{c}"), F.col("position").alias(f"_at_{c}"))
            text = F.coalesce(F.col(c).cast("string"), F.lit(MISSING_KEY_TEXT))
            out = out.join(own, text == F.col(f"_{c}"), "left")
        numbers = [(log1p_or_null(F.col(c)) - F.lit(mean)) / F.lit(std) for c, (mean, std) in self.constants.items()]
        tail = [F.col(c).cast("double") for c in (*features.binary, *features.cyclical)]
        found = F.array_compact(F.array(*[F.col(f"_at_{c}") for c in features.categorical]))
        first, after = len(features.numeric), len(features.numeric) + self.labels
        whole = out.where(~any_null(*numbers, *tail))
        indices = F.concat(
            F.array(*[F.lit(i) for i in range(first)]), found.cast("array<int>"),
            F.array(*[F.lit(after + i) for i in range(len(tail))]),
        )
        values = F.concat(F.array(*numbers), F.transform(found, lambda _: F.lit(1.0)), F.array(*tail))
        # A sparse vector is a struct of these four fields; reading it from JSON gives it the vector type.
        parts = F.struct(
            F.lit(0).alias("type"), F.lit(self.size).alias("size"), indices.alias("indices"), values.alias("values")
        )
        typed = F.from_json(F.to_json(F.struct(parts.alias("v"))), StructType([StructField("v", VectorUDT())]))
        return whole.select(*keep, typed["v"].alias(FEATURES))
