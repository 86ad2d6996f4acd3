import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "meterflow-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Physical plan text of a frame."""
    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text


MEASURES = "global_active_power double, global_reactive_power double, voltage double, " \
    "global_intensity double, sub_metering_1 double, sub_metering_2 double, sub_metering_3 double"


@pytest.fixture
def make_readings(spark):
    """Readings from (sensor, seconds after the epoch or None, load) rows."""
    from pyspark.sql import functions as F

    def make(rows):
        plain = spark.createDataFrame(rows, "sensor_id int, seconds double, load double")
        return plain.select(
            "sensor_id",
            F.timestamp_millis((F.col("seconds") * 1000).cast("long")).alias("timestamp"),
            F.col("load").alias("global_active_power"),
            F.lit(0.5).alias("global_reactive_power"),
            (F.col("load") + 230).alias("voltage"),
            (F.col("load") * 4).alias("global_intensity"),
            F.lit(1.0).alias("sub_metering_1"),
            F.col("load").alias("sub_metering_2"),
            F.lit(None).cast("double").alias("sub_metering_3"),
        )

    return make
