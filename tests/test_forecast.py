import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.operators.forecast import (
    PREDICTIONS, forecast_features, forecast_score, forecast_trend,
)
from meterflow.operators.ranges import BY_DATE
from meterflow.sources import tables


@pytest.fixture
def loads(spark):
    def make(series):
        rows = [(s, i, float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, "sensor_id int, start_time int, avg_global_active_power double")

    return make


def test_features_are_the_newest_thirty_oldest_first(loads):
    row = forecast_features(loads({1: range(50), 2: range(29)}), min_points=30).collect()
    assert [(r.sensor_id, r.last_time) for r in row] == [(1, 49)]
    assert row[0].features == [float(v) for v in range(20, 50)]


def test_short_sensors_have_short_vectors(loads):
    got = forecast_features(loads({1: range(50), 2: [1, 2]})).collect()
    assert {r.sensor_id: len(r.features) for r in got} == {1: 30, 2: 2}


def test_features_are_32_bit(loads):
    frame = forecast_features(loads({1: [0.1] * 30}))
    assert dict(frame.dtypes)["features"] == "array<float>"
    assert frame.first().features[0] == float(np.float32(0.1))


def test_trend_is_the_least_squares_line(loads):
    noisy = np.random.default_rng(3).uniform(2, 9, 40)
    row = forecast_trend(loads({5: noisy})).first()
    slope, level = np.polyfit(np.arange(30), noisy[-30:], 1)
    expected = [max(0.0, level + slope * (29 + h)) for h in range(1, 7)]
    assert [row[c] for c in PREDICTIONS] == pytest.approx(expected)
    assert row.prediction_time == 39


def test_trend_is_never_negative(loads):
    row = forecast_trend(loads({1: np.arange(30)[::-1]})).first()
    assert [row[c] for c in PREDICTIONS] == [0.0] * 6


def test_trend_of_a_single_point_is_flat(loads):
    row = forecast_trend(loads({1: [4.0]})).first()
    assert [row[c] for c in PREDICTIONS] == [4.0] * 6


def test_scorer_calls_the_model_on_batches(loads):
    def load_model():
        import numpy

        def predict(batch):
            assert batch.dtype == numpy.float32 and batch.shape[1:] in ((30, 1), (5, 1))
            return batch[:, -1, :] * numpy.array([1, -1, 2, 3, 4, 5])

        return predict

    features = forecast_features(loads({1: range(30), 2: range(40), 3: range(5)}))
    got = forecast_score(features, load_model, F.lit(123)).orderBy("sensor_id").collect()
    assert [tuple(r) for r in got] == [
        (1, 123, 29.0, 0.0, 58.0, 87.0, 116.0, 145.0),
        (2, 123, 39.0, 0.0, 78.0, 117.0, 156.0, 195.0),
        (3, 123, 4.0, 0.0, 8.0, 12.0, 16.0, 20.0),
    ]


def test_minutes_without_a_load_do_not_count(spark, loads):
    gap = F.when(F.col("start_time") % 3 != 1, F.col("avg_global_active_power"))
    rows = loads({1: range(40), 2: range(2)}).withColumn("avg_global_active_power", gap)
    features = {r.sensor_id: r.features for r in forecast_features(rows).collect()}
    kept = [float(v) for v in range(40) if v % 3 != 1]
    assert features == {1: kept[-30:], 2: [0.0]}
    assert {r.sensor_id: r.prediction1 for r in forecast_trend(rows).collect()}[2] == 0.0


def test_features_group_on_the_partitioning_of_the_window(loads, plan):
    text = plan(forecast_features(loads({1: range(40)})))
    assert text.count("Exchange") == 1


def test_since_prunes_folders_and_changes_no_forecast(spark, tmp_path, plan):
    path = str(tmp_path / "view")
    view = spark.range(400).selectExpr(
        "cast(id % 2 + 1 as int) as sensor_id", "cast(id % 7 as double) as avg_global_active_power",
        "timestamp_seconds(1700000040 + id * 1800) as start_time")
    # A third sensor fell silent early and has its last values in the older folders.
    silent = view.limit(40).withColumn("sensor_id", F.lit(3))
    tables.write_by_date(view.unionByName(silent), path, "start_time")
    stored = spark.read.parquet(path)
    since = F.lit("2023-11-20 00:00:00").cast("timestamp")
    pruned = forecast_trend(stored, since=since, partitions=BY_DATE)
    assert "PartitionFilters: [isnotnull(date" in plan(pruned)
    whole = forecast_trend(stored)
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() == 3
