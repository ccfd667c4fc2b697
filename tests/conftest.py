from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tallgrove.session import SETTINGS, ship

    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield ship(session)
    session.stop()


@pytest.fixture(scope="session")
def churn(spark):
    """Labelled features with a label that models can learn; stored once."""
    from tallgrove.sources import features
    from tallgrove.sources.tables import snapshot

    return snapshot(features.with_planted_label(features.churn_view(spark, CHECK)))


@pytest.fixture(scope="session")
def forest(churn):
    from tallgrove.operators.training import train_forest
    from tallgrove.sources import features

    params = {
        "HAS_ID": 1, "DEPENDENT_VARIABLE": features.LABEL, "SEED": 2, "TREES_NUM": 15, "TRY_NUM": 5,
    }
    return train_forest(churn, params, max_depth=5)
