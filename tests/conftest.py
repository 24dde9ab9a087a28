import os
import sys
from datetime import UTC, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import configure  # noqa: E402
from tidelog.sources.topic import TOPIC_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def topic(spark):
    """A topic from payloads: text, bytes or None; offsets count up."""

    def build(values, keys=None, name="t", partitions=1, start=0):
        def raw(x):
            return x.encode() if isinstance(x, str) else x

        rows = [
            (
                raw(keys[i]) if keys else None,
                raw(v),
                name,
                i % partitions,
                start + i // partitions,
                datetime.fromtimestamp(1704067200 + i, UTC),
            )
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, TOPIC_SCHEMA)

    return build
