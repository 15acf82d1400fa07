import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("trafficlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def event(spark):
    """Builds an event DataFrame from dicts; fields left out get an ordinary value."""
    from decimal import Decimal

    from trafficlake.schema import EVENT_SCHEMA, READINGS

    ordinary = {
        "sensor_id": 1,
        "timestamp": "2026-01-08T10:11:12.123456+00:00",
        "zone": "Centre-Ville",
        "road_type": "rue",
        "vehicle_count": 100,
        "average_speed": 55,
        "occupancy_rate": 35,
        "event": None,
    }

    def build(*rows, **repeated):
        data = [{**ordinary, **repeated, **row} for row in rows]
        data = [r | {c: Decimal(str(r[c])) for c in READINGS if r[c] is not None} for r in data]
        return spark.createDataFrame([tuple(r[f] for f in EVENT_SCHEMA.names) for r in data], EVENT_SCHEMA)

    return build


@pytest.fixture
def plan(capsys):
    """Text of a DataFrame's physical plan."""

    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text
