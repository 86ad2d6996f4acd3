"""The registered queries: every operator over the whole ``events`` table."""

from pyspark.sql import functions as F

from meterflow.functions.columns import calendar_parts, clamp
from meterflow.operators import forecast, keyed, minutes
from meterflow.operators.ranges import BY_DATE, BY_MINUTE, range_of, time_range
from meterflow.plans import live, reports, timeline
from meterflow.plans.derived import (
    ONCE,
    live_topic,
    naive,
    read_slices,
    rounded,
    sliced_topic,
    write_slices,
)
from meterflow.plans.serving import (
    merged_stored_view,
    merged_view,
    publish_batch_view,
    stored_batch_view,
)
from meterflow.schema import BATCH_VIEW, BOUNDS, MEASURES, SPEED_VIEW
from meterflow.session import work_folder, written
from meterflow.sources import events as source
from meterflow.sources import history, tables
from meterflow.sources.stores import read_store
from meterflow.streaming import jobs

# Range of the reports: four whole weeks inside the month the events cover.
START, END = "2024-01-02 00:00:00", "2024-01-30 00:00:00"
MINUTES = 28 * 24 * 60
HORIZON = "2024-01-15 00:00:00"

AVERAGES = sorted({name for name, fn, _ in SPEED_VIEW + BATCH_VIEW if fn == "avg"})


def parse_readings(spark, sf_dir):
    records = source.as_records(source.events(spark, sf_dir))
    parsed = source.parse_records(records).withColumnRenamed("offset", "event_id")
    return naive(parsed, "timestamp")


def encode_messages(spark, sf_dir):
    records = source.as_records(source.events(spark, sf_dir))
    fields = ["time", *MEASURES]
    text = records.select(
        F.col("offset").alias("event_id"),
        F.col("key").cast("string").alias("key"),
        F.json_tuple(F.col("value").cast("string"), *fields).alias(*fields),
    )
    return text.withColumns({f: F.col(f).cast("double") for f in fields})


def history_text(spark, sf_dir):
    """Readings as the text of a historical file, with dates that are none, markers for "no
    value" in several columns, and text that only looks like a number."""
    rows = source.readings(spark, sf_dir)
    capitalised = {m: m.capitalize() for m in MEASURES}
    text = rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("timestamp", "d/M/yyyy").alias("Date"),
        F.date_format("timestamp", "HH:mm:ss").alias("Time"),
        *[F.col(m).cast("string").alias(capitalised[m]) for m in MEASURES],
    )

    def spoil(column, every, place, value):
        bad = F.col("event_id").cast("bigint") % every == place
        return F.when(bad, value).otherwise(F.col(column))

    unknown = F.col("Sub_metering_1").cast("double") % 10 == 0
    return text.withColumns({
        "Voltage": F.when(unknown, "?").otherwise(F.col("Voltage")),
        "Date": spoil("Date", 37, 5, "31/2/2024"),
        "Global_intensity": spoil("Global_intensity", 41, 7, "nan"),
        "Sub_metering_2": spoil("Sub_metering_2", 43, 11, "1.5d"),
        "Sub_metering_3": spoil("Sub_metering_3", 47, 13, "N/A"),
        "Global_reactive_power": spoil("Global_reactive_power", 53, 17, ""),
    })


def import_clean(spark, sf_dir):
    clean = history.import_history(history_text(spark, sf_dir))
    return naive(clean.withColumn("event_id", F.col("event_id").cast("bigint")), "timestamp")


def import_file(spark, sf_dir):
    """The same by way of delimited files."""
    folder = work_folder(spark, "history")
    history_text(spark, sf_dir).write.csv(folder, header=True, sep=";", mode="overwrite")
    clean = history.import_history(history.read_history(spark, folder, sep=";"))
    return naive(clean.withColumn("event_id", F.col("event_id").cast("bigint")), "timestamp")


def import_counts(spark, sf_dir):
    return history.import_counts(history_text(spark, sf_dir))


def calendar(spark, sf_dir):
    rows = source.readings(spark, sf_dir)
    minute = F.window("timestamp", "1 minute").start
    return rows.select("event_id", minute.alias("minute_start")).select(
        "*", *calendar_parts("minute_start")
    )


def clamp_readings(spark, sf_dir):
    rows = source.readings(spark, sf_dir)
    return rows.select(
        "event_id", *[clamp(F.col(m), *BOUNDS[m]).alias(m) for m in MEASURES]
    )


def speed_minute(spark, sf_dir):
    return rounded(minutes.speed_minutes(source.readings(spark, sf_dir)), AVERAGES, 9)


def speed_day(spark, sf_dir):
    daily = minutes.speed_minutes(source.readings(spark, sf_dir), size="1 day")
    return rounded(daily, AVERAGES, 9)


def batch_minute(spark, sf_dir):
    return rounded(minutes.batch_minutes(source.readings(spark, sf_dir)), AVERAGES, 9)


def partials_minute(spark, sf_dir):
    partials = minutes.minute_partials(source.readings(spark, sf_dir))
    return rounded(minutes.speed_from_partials(partials), AVERAGES, 9)


def stored_speed(spark, live):
    """The speed layer's store after all micro-batches, and the schema of its rows."""
    root, checkpoint = work_folder(spark, "speed"), work_folder(spark, "speed-progress")
    jobs.await_all([jobs.start_speed(live, checkpoint, root, trigger=ONCE)])
    return root, jobs.speed_stream(live).schema


def stream_speed_minute(spark, sf_dir):
    """Three micro-batches."""
    root, schema = stored_speed(spark, sliced_topic(spark, sf_dir))
    stored = read_store(spark, root, schema).drop("date")
    return rounded(naive(stored, "start_time", "end_time"), AVERAGES, 9)


def stored_batches(spark, live):
    """The batch layer's folder after all micro-batches."""
    root, checkpoint = work_folder(spark, "batch"), work_folder(spark, "batch-progress")
    jobs.await_all([jobs.start_batch(live, checkpoint, root, trigger=ONCE)])
    return root


def stream_batch_minute(spark, sf_dir):
    """Four micro-batches that cut through the minutes."""
    view = stored_batch_view(spark, stored_batches(spark, live_topic(spark, sf_dir, 4)))
    return rounded(naive(view, "timestamp"), AVERAGES, 9)


def folded_batch_minute(spark, sf_dir):
    """The same micro-batches merged into a plain table by date, one row per sensor and minute."""
    root, path = stored_batches(spark, live_topic(spark, sf_dir, 4)), work_folder(spark, "view")
    publish_batch_view(spark, root, path, by_sensor=True)
    view = spark.read.parquet(path).drop("date")
    return rounded(naive(view, "start_time", "end_time"), AVERAGES, 9)


def stored_raw(spark, live):
    """Stored raw readings after all micro-batches."""
    path, checkpoint = work_folder(spark, "raw"), work_folder(spark, "raw-progress")
    jobs.await_all([jobs.start_raw(live, checkpoint, path, trigger=ONCE)])
    return spark.read.schema(live.schema).parquet(path).drop("date")


def stream_drop_repeats(spark, sf_dir):
    """Every message sent twice, read once."""
    stored = stored_raw(spark, live_topic(spark, sf_dir, 1, copies=2))
    once = jobs.stored_once(stored.withColumnRenamed("offset", "event_id"), ["event_id"])
    return naive(once, "timestamp")


def stream_raw_once(spark, sf_dir):
    """Three micro-batches in time order, with repeats across them and late readings."""
    stored = stored_raw(spark, sliced_topic(spark, sf_dir, late=1))
    once = jobs.stored_once(stored.withColumnRenamed("offset", "event_id"), ["event_id"])
    return naive(once, "timestamp")


def stream_raw_readings(spark, sf_dir):
    live = source.parse_records(source.as_records(source.events_stream(spark, sf_dir)))
    return naive(stored_raw(spark, live).withColumnRenamed("offset", "event_id"), "timestamp")


def dedupe_last_write(spark, sf_dir):
    rows = source.readings(spark, sf_dir).withColumn(
        "minute_start", F.window("timestamp", "1 minute").start
    )
    return keyed.dedupe_last_write(rows, ["sensor_id", "minute_start"], ["event_id"])


def dedupe_sensor_day(spark, sf_dir):
    rows = source.readings(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    return keyed.dedupe_last_write(rows, ["sensor_id", "day"], ["event_id"])


def dated(spark, sf_dir, name="readings", rows=source.readings, ts="timestamp"):
    """Derived rows as a table by date: its path and a frame that reads it."""
    path = work_folder(spark, name)
    tables.write_by_date(rows(spark, sf_dir), path, ts)
    return path, spark.read.parquet(path)


def sensor_table(spark, name, rows):
    """The dimension of all sensors of a derived table, stored."""
    return written(keyed.sensors(rows), f"{name}-sensors")


def retained(spark, sf_dir, seconds):
    """On a table by date; only its newest days are read."""
    path, rows = dated(spark, sf_dir)
    newest = tables.newest_time(spark, path)
    return keyed.retain_recent(rows, seconds, newest, partitions=BY_DATE).drop("date")


def retain_recent(spark, sf_dir):
    return retained(spark, sf_dir, 86400)


def retain_300s(spark, sf_dir):
    return retained(spark, sf_dir, 300)


def sensor_dim(spark, sf_dir):
    return keyed.sensors(source.readings(spark, sf_dir))


def voltage_range(spark, sf_dir):
    return reports.voltage_range(source.readings(spark, sf_dir), START, MINUTES)


def voltage_5_minutes(spark, sf_dir):
    return reports.voltage_range(source.readings(spark, sf_dir), "2024-01-01 00:00:00")


def power_factor(spark, sf_dir):
    return reports.power_factor(source.readings(spark, sf_dir), START, END)


def high_power(spark, sf_dir):
    return reports.high_power(source.readings(spark, sf_dir), 1.5, START, MINUTES)


def batch_power_factor(spark, sf_dir):
    """The power-factor report on a stored batch view, named in the catalog for a while."""
    view = minutes.batch_minutes(source.readings(spark, sf_dir))
    path = work_folder(spark, "batch-view")
    tables.write_by_date(view, path)
    name = "meter_batch_" + path.rsplit("-", 1)[-1]
    tables.declare_table(spark, name, path, dict(view.dtypes), {"date": "date"})
    try:
        tables.repair_partitions(spark, name)
        report = reports.power_factor(spark.table(name), START, END, partitions=BY_DATE)
        report = written(report, "report").orderBy(*report.columns[:3])
    finally:
        spark.sql(f"DROP TABLE {name}")
    return rounded(report, report.columns[1:], 9)


def calendar_layout(spark, sf_dir):
    """Hourly rows of the batch view by way of year/month/day/hour/minute folders."""
    view = minutes.batch_minutes(source.readings(spark, sf_dir), size="1 hour")
    path = work_folder(spark, "calendar")
    tables.write_by_minute(view, path)
    columns = ", ".join(f"{name} {kind}" for name, kind in view.dtypes)
    stored = tables.read_by_minute(spark, path, columns)
    rows = time_range(stored, *range_of(START, END), partitions=BY_MINUTE)
    return rounded(rows, AVERAGES, 9)


def pruned_range(spark, sf_dir):
    _, rows = dated(spark, sf_dir)
    return time_range(rows, *range_of(START, END), partitions=BY_DATE).drop("date")


def latest_n(spark, sf_dir):
    rows = source.readings(spark, sf_dir).select(
        "sensor_id", "event_id", "timestamp", "global_active_power"
    )
    return keyed.latest_n(rows, 30, order=["timestamp", "event_id"])


def two_weeks_before(newest):
    return F.lit(newest) - F.expr("INTERVAL 14 DAYS")


def nameless(spark, sf_dir):
    """Loads with a null sensor in place of every 97th id."""
    return source.readings(spark, sf_dir).select(
        F.when(F.col("sensor_id") % 97 != 0, F.col("sensor_id")).alias("sensor_id"),
        "timestamp", "event_id", "global_active_power",
    )


def latest_n_since(spark, sf_dir):
    """The same rows, on a table by date and with a null sensor; older rows are read only for
    sensors with few rows in the last two weeks, which the stored sensor dimension names."""
    path, stored = dated(spark, sf_dir, "nameless", nameless)
    known = sensor_table(spark, "nameless", stored)
    since = two_weeks_before(tables.newest_time(spark, path))
    return keyed.latest_n_since(
        stored, 30, since, known, order=["timestamp", "event_id"], partitions=BY_DATE
    ).drop("date")


def forecast_input(spark, sf_dir):
    """Minute averages per sensor, the input of all forecasts."""
    return minutes.speed_minutes(source.readings(spark, sf_dir))


def forecast_features(spark, sf_dir):
    vectors = forecast.forecast_features(forecast_input(spark, sf_dir))
    return vectors.select(
        "sensor_id", "last_time", F.posexplode("features").alias("place", "value")
    ).withColumn("value", F.round(F.col("value").cast("double"), 6))


def forecast_trend(spark, sf_dir):
    return rounded(
        forecast.forecast_trend(forecast_input(spark, sf_dir)), forecast.PREDICTIONS, 6
    )


def forecast_stored(spark, sf_dir):
    """The forecast on a stored minute view: two weeks of folders, and older ones only for
    sensors that lack rows, appended to a table of predictions."""
    target = work_folder(spark, "predictions")
    path, stored = dated(spark, sf_dir, "minutes", forecast_input, "start_time")
    known = sensor_table(spark, "minutes", stored)
    since = two_weeks_before(tables.newest_time(spark, path, "start_time"))
    predictions = forecast.forecast_trend(stored, since=since, known=known, partitions=BY_DATE)
    tables.append_to(predictions, "parquet", {"path": target})
    return rounded(spark.read.parquet(target), forecast.PREDICTIONS, 6)


def short_sensors(spark, sf_dir):
    """Minutes of a finer sensor, one per user and kind of event, most with few minutes; every
    fifth reading has no load, so some minutes have none."""
    rows = source.as_readings(source.events(spark, sf_dir), keep=["event_type"])
    load = F.when(F.col("event_id") % 5 != 0, F.col("global_active_power"))
    return minutes.speed_minutes(rows.withColumns({
        "sensor_id": F.concat_ws("-", "sensor_id", "event_type"), "global_active_power": load,
    }))


def forecast_short(spark, sf_dir):
    view = short_sensors(spark, sf_dir)
    return rounded(forecast.forecast_trend(view), forecast.PREDICTIONS, 9)


def forecast_short_score(spark, sf_dir):
    vectors = forecast.forecast_features(short_sensors(spark, sf_dir))
    return rounded(forecast.forecast_score(vectors, line_model), forecast.PREDICTIONS, 6)


def line_model():
    """The least-squares line as a model for whole batches of vectors."""
    # Nested, so that tasks get the function itself and need no package installed.
    import numpy as np

    def predict(batch):
        loads = batch[:, :, 0].astype(np.float64)
        place = np.arange(-loads.shape[1], 0.0)
        centred = place - place.mean()
        spread = centred @ centred
        slope = loads @ centred / spread if spread else np.zeros(len(loads))
        level = loads.mean(axis=1) - slope * place.mean()
        return level[:, None] + slope[:, None] * np.arange(6.0)

    return predict


def forecast_score(spark, sf_dir):
    """The scorer with a user model."""
    vectors = forecast.forecast_features(forecast_input(spark, sf_dir))
    return rounded(forecast.forecast_score(vectors, line_model), forecast.PREDICTIONS, 6)


def merged(spark, sf_dir):
    """Batch view up to an hour past the horizon, speed view from an hour before it."""
    rows = source.readings(spark, sf_dir)
    hour = F.expr("INTERVAL 1 HOUR")
    horizon = F.lit(HORIZON).cast("timestamp_ntz")
    batch = minutes.speed_from_partials(
        minutes.minute_partials(rows.filter(F.col("timestamp") < horizon + hour))
    )
    speed = minutes.speed_minutes(rows.filter(F.col("timestamp") >= horizon - hour))
    return rounded(merged_view(batch, speed, HORIZON), AVERAGES, 9)


def merged_stored(spark, sf_dir):
    """Stored layers: the batch layer has seen two of three micro-batches, the speed layer all."""
    topic = write_slices(spark, sf_dir)
    batch = stored_batches(spark, read_slices(spark, topic, upto=2))
    speed, schema = stored_speed(spark, read_slices(spark, topic))
    view = merged_stored_view(spark, batch, speed, schema)
    return rounded(naive(view, "start_time", "end_time"), AVERAGES, 9)


QUERIES = {
    "parse_readings": parse_readings,
    "encode_readings": encode_messages,
    "import_clean": import_clean,
    "import_file": import_file,
    "import_counts": import_counts,
    "calendar_parts": calendar,
    "clamp_readings": clamp_readings,
    "speed_minute": speed_minute,
    "speed_day": speed_day,
    "batch_minute": batch_minute,
    "partials_minute": partials_minute,
    "stream_speed_minute": stream_speed_minute,
    "stream_batch_minute": stream_batch_minute,
    "folded_batch_minute": folded_batch_minute,
    "stream_drop_repeats": stream_drop_repeats,
    "stream_raw_once": stream_raw_once,
    "stream_raw_readings": stream_raw_readings,
    "dedupe_last_write": dedupe_last_write,
    "dedupe_sensor_day": dedupe_sensor_day,
    "retain_recent": retain_recent,
    "retain_300s": retain_300s,
    "sensor_dim": sensor_dim,
    "voltage_range": voltage_range,
    "voltage_5_minutes": voltage_5_minutes,
    "power_factor": power_factor,
    "high_power": high_power,
    "batch_power_factor": batch_power_factor,
    "calendar_layout": calendar_layout,
    "pruned_range": pruned_range,
    "latest_n": latest_n,
    "latest_n_since": latest_n_since,
    "forecast_features": forecast_features,
    "forecast_trend": forecast_trend,
    "forecast_stored": forecast_stored,
    "forecast_score": forecast_score,
    "forecast_short": forecast_short,
    "forecast_short_score": forecast_short_score,
    "merged_view": merged,
    "merged_stored": merged_stored,
    **timeline.QUERIES,
    **live.QUERIES,
}
