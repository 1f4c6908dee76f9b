from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of named values."""
    def evaluate(column, **values):
        schema = ", ".join(
            f"{k} {'array<string>' if isinstance(v, list) else 'map<string,array<string>>' if isinstance(v, dict) else 'bigint' if isinstance(v, int) else 'string'}"
            for k, v in values.items()
        )
        df = spark.createDataFrame([tuple(values.values())], schema) if values else spark.range(1)
        return df.select(column.alias("out")).first()["out"]

    return evaluate
