from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterflow.operators.keyed import retain_recent
from meterflow.operators.ranges import BY_DATE, BY_MINUTE, between, range_of, time_range
from meterflow.plans import reports
from meterflow.plans.serving import merged_view
from meterflow.sources import tables


@pytest.fixture
def table(spark):
    return spark.sql("""
      select timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, m) as timestamp,
        cast(m as double) as global_active_power, cast(m % 3 as double) as global_reactive_power,
        230.0D + m as voltage
      from (select explode(sequence(0, 4000, 1)) as m)""")


def minutes(frame):
    start = datetime(2024, 1, 10)
    return [int((r.timestamp - start).total_seconds() // 60) for r in frame.collect()]


def test_voltage_takes_five_minutes_half_open(table):
    got = reports.voltage_range(table, "2024-01-10 00:10:00")
    assert sorted(minutes(got)) == [10, 11, 12, 13, 14] and got.columns == ["timestamp", "voltage"]


def test_power_factor_is_ordered_and_null_at_no_power(table):
    rows = reports.power_factor(table, "2024-01-10 00:00:00", datetime(2024, 1, 10, 1))
    assert minutes(rows) == list(range(60))
    first, fourth = rows.collect()[0], rows.collect()[4]
    assert first.power_factor is None and fourth.power_factor == pytest.approx(4 / 17 ** 0.5)


def test_high_power_threshold_is_strict(table):
    got = reports.high_power(table, 7.0, "2024-01-10 00:00:00", 10)
    assert minutes(got) == [8, 9] and got.columns == ["timestamp", "global_active_power"]


@pytest.mark.parametrize("start, end", [
    ("2024-01-10 01:00:00", "2024-01-10 01:00:00"), ("2024-01-10 02:00:00", "2024-01-10 01:00:00"),
    ("2024-13-10 02:00:00", "2024-01-10 01:00:00"), ("soon", "later"), (None, "2024-01-10"),
])
def test_bad_ranges_are_errors(table, start, end):
    with pytest.raises(ValueError):
        reports.power_factor(table, start, end)


def test_bad_length_is_an_error(table):
    with pytest.raises(ValueError):
        reports.voltage_range(table, "2024-01-10 00:00:00", 0)


def test_date_layout_prunes_folders_and_pushes_the_range(spark, table, tmp_path, plan):
    path = str(tmp_path / "t")
    tables.write_by_date(table, path)
    stored = spark.read.parquet(path)
    got = time_range(stored, *range_of("2024-01-11 00:00:00", "2024-01-11 00:03:00"),
                     partitions=BY_DATE)
    text = plan(got)
    assert "PartitionFilters: [isnotnull(date" in text and "GreaterThanOrEqual(timestamp" in text
    assert sorted(minutes(got)) == [1440, 1441, 1442]
    assert len(got.inputFiles()) >= 1
    report = reports.voltage_range(stored, "2024-01-11 23:58:00", partitions=BY_DATE)
    assert sorted(minutes(report)) == [2878, 2879, 2880, 2881, 2882]
    assert "ReadSchema: struct<timestamp:timestamp_ntz,voltage:double>" in plan(report)


def test_calendar_layout_keeps_zeros_and_prunes(spark, table, tmp_path, plan):
    path = str(tmp_path / "t")
    tables.write_by_minute(time_range(table, *range_of("2024-01-10 23:50:00", minutes=20)), path)
    columns = "timestamp timestamp_ntz, global_active_power double, voltage double"
    stored = tables.read_by_minute(spark, path, columns)
    assert {r.month for r in stored.select("month").collect()} == {"01"}
    for frame in (stored, spark.read.parquet(path)):
        got = reports.voltage_range(frame, "2024-01-10 23:58:00", partitions=BY_MINUTE)
        assert sorted(minutes(got)) == [1438, 1439, 1440, 1441, 1442]
        assert "PartitionFilters: []" not in plan(got)
    assert (tmp_path / "t/year=2024/month=01/day=11/hour=00/minute=05").is_dir()


def test_catalog_table_repair_and_drop(spark, table, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("DROP TABLE IF EXISTS readings_by_date")
    tables.declare_table(spark, "readings_by_date", path, dict(table.dtypes), {"date": "date"})
    tables.write_by_date(table, path)
    tables.repair_partitions(spark, "readings_by_date")
    stored = spark.table("readings_by_date")
    assert stored.count() == 4001
    assert tables.drop_before(spark, "readings_by_date", "2024-01-12") == 2
    tables.repair_partitions(spark, "readings_by_date")
    kept = spark.table("readings_by_date")
    assert kept.agg(F.min("date").cast("string")).first()[0] == "2024-01-12"
    assert kept.count() == 4001 - 2 * 1440
    assert tables.partition_columns(spark, "readings_by_date") == ["date"]


def test_recent_rows_of_a_dated_table_read_its_newest_days(spark, table, tmp_path, plan):
    path = str(tmp_path / "t")
    tables.write_by_date(table, path)
    assert tables.newest_day(spark, path) == "2024-01-12"
    newest = tables.newest_time(spark, path)
    assert newest == table.agg(F.max("timestamp")).first()[0]
    stored = spark.read.parquet(path)
    got = retain_recent(stored, 3600, newest, partitions=BY_DATE)
    assert "PartitionFilters: [isnotnull(date" in plan(got)
    assert sorted(minutes(got)) == list(range(3941, 4001))


def test_a_column_that_is_merely_called_date(table):
    odd = table.withColumn("date", F.lit("2001-01-01").cast("date"))
    assert reports.voltage_range(odd, "2024-01-10 00:00:00", 1).count() == 1


@pytest.mark.parametrize("bounds", [
    ("2024-01-10T02:00:00+02:00", "2024-01-10T02:01:00+02:00"),
    ("2024-01-10T00:00:00Z", "2024-01-10T00:01:00Z"), ("2024-01-10 00:00:00", "2024-01-10 00:01"),
])
def test_offsets_of_bounds_are_converted(table, bounds):
    assert time_range(table, *range_of(*bounds)).count() == 1
    instants = table.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert time_range(instants, *range_of(*bounds)).count() == 1


def test_one_bound_with_an_offset_is_an_error():
    with pytest.raises(ValueError, match="offset"):
        range_of("2024-01-10 00:00:00", "2024-01-10T00:01:00Z")


def test_days_do_not_depend_on_the_session_zone(spark, table, tmp_path):
    path = str(tmp_path / "t")
    instants = table.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    tables.write_by_date(instants, path)
    bounds = range_of("2024-01-10T22:30:00Z", "2024-01-10T22:31:00Z")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Bucharest")
    try:
        stored = spark.read.parquet(path)
        assert time_range(stored, *bounds, partitions=BY_DATE).count() == 1
        other = str(tmp_path / "other")
        tables.write_by_date(stored.drop("date"), other)
        assert spark.read.parquet(other).groupBy("date").count().exceptAll(
            stored.groupBy("date").count()).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_partitions_are_an_error(table):
    with pytest.raises(ValueError):
        between(table, partitions="hour")


def test_catalog_table_over_the_calendar_layout(spark, table, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_minute(time_range(table, *range_of("2024-01-10 00:00:00", minutes=11)), path)
    spark.sql("DROP TABLE IF EXISTS readings_by_minute")
    tables.declare_table(
        spark, "readings_by_minute", path, dict(table.dtypes),
        dict.fromkeys(["year", "month", "day", "hour", "minute"], "string"))
    assert spark.table("readings_by_minute").count() == 0
    tables.repair_partitions(spark, "readings_by_minute")
    got = reports.power_factor(spark.table("readings_by_minute"), "2024-01-10 00:09:00",
                               "2024-01-10 01:00:00")
    assert minutes(got) == [9, 10]


def test_newest_first_within_a_key(spark):
    rows = spark.createDataFrame([(2, 1), (1, 1), (1, 3), (1, 2)], "sensor_id int, timestamp int")
    got = [tuple(r) for r in tables.newest_first(rows.coalesce(1)).collect()]
    assert got == [(1, 3), (1, 2), (1, 1), (2, 1)]


@pytest.mark.parametrize("horizon", ["2024-01-09 00:00:00", "2024-01-10 00:30:00",
                                     "2024-01-12 00:00:00", "2024-02-01 00:00:00"])
def test_merged_view_does_not_depend_on_the_horizon(table, horizon):
    view = table.withColumnRenamed("timestamp", "start_time")
    batch, speed = view.withColumn("only_batch", F.lit(1)), view.withColumn("only_speed", F.lit(1))
    got = merged_view(batch, speed, horizon)
    assert got.columns == view.columns and got.count() == 4001
    assert got.select("start_time").distinct().count() == 4001


def test_merged_view_takes_each_side_of_the_horizon_from_one_layer(table):
    view = table.select(F.col("timestamp").alias("start_time"))
    got = merged_view(view.withColumn("layer", F.lit("batch")), view.withColumn("layer", F.lit("speed")),
                      datetime(2024, 1, 10, 1))
    assert got.filter("layer = 'batch'").count() == 60
    assert got.filter("layer = 'speed'").agg(F.min("start_time")).first()[0] == datetime(2024, 1, 10, 1)
