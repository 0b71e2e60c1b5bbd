from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package and the test clients.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from clickloom.session import builder

    session = (
        builder(
            "tests",
            {
                "spark.sql.shuffle.partitions": "8",
                "spark.ui.enabled": "false",
                "spark.driver.memory": "4g",
                "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            },
        )
        .master("local[8]")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def skew_settings(spark):
    """No broadcast, and thresholds at which small data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    """All rows as tuples, sorted, nulls first."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, str(v)) for v in row])
