from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmeter.models.training import Hyperparameters  # noqa: E402
from tripmeter.session import prepare  # noqa: E402
from workload import queries  # noqa: E402

# The registered training queries run the default settings; here smaller ones do.
queries.SETTINGS = Hyperparameters(
    forest_trees=5, forest_depth=4, boosted_rounds=3, boosted_depth=3, deep_rounds=3, deep_depth=3
)

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)
