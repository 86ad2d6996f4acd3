"""SQL over the given tables that each registered query must agree with."""

from meterflow.operators.forecast import PREDICTIONS
from meterflow.plans.registry import END, START

# Fixed values, written out here so that a wrong list in the engine does not pass unseen.
MEASURES = [
    "global_active_power", "global_reactive_power", "voltage", "global_intensity",
    "sub_metering_1", "sub_metering_2", "sub_metering_3",
]
SPEED_COLUMNS = """round(avg(global_active_power), 9) AS avg_global_active_power,
      max(global_active_power) AS max_global_active_power,
      min(global_active_power) AS min_global_active_power,
      round(avg(global_reactive_power), 9) AS avg_global_reactive_power,
      round(avg(voltage), 9) AS avg_voltage, max(voltage) AS max_voltage,
      round(avg(global_intensity), 9) AS avg_global_intensity,
      sum(sub_metering_1) AS total_sub_metering_1, sum(sub_metering_2) AS total_sub_metering_2,
      sum(sub_metering_3) AS total_sub_metering_3"""
BATCH_COLUMNS = """round(avg(global_active_power), 9) AS global_active_power,
      round(avg(global_reactive_power), 9) AS global_reactive_power,
      round(avg(voltage), 9) AS voltage, round(avg(global_intensity), 9) AS global_intensity,
      sum(sub_metering_1) AS sub_metering_1, sum(sub_metering_2) AS sub_metering_2,
      sum(sub_metering_3) AS sub_metering_3"""
LIMITS = {
    "global_active_power": (0.08, 10.7), "global_reactive_power": (0.0, 1.15),
    "voltage": (223.0, 251.0), "global_intensity": (0.4, 46.4), "sub_metering_1": (0.0, 78.0),
    "sub_metering_2": (0.0, 78.0), "sub_metering_3": (0.0, 20.0),
}

READINGS = """readings AS (
  SELECT event_id, user_id::INT AS sensor_id, epoch_us(ts) // 1000 AS "time", ts AS "timestamp",
    value / 50 AS global_active_power,
    k / 100.0::DOUBLE AS global_reactive_power,
    223.0::DOUBLE + k * 0.28::DOUBLE AS voltage,
    value / 10 AS global_intensity,
    k::DOUBLE AS sub_metering_1,
    (user_id % 79)::DOUBLE AS sub_metering_2,
    (event_id % 21)::DOUBLE AS sub_metering_3
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

WITH = f"WITH {READINGS}"
ALL = ", ".join(MEASURES)
PARTS = {"year": "%Y", "month": "%m", "day": "%d", "hour": "%H", "minute": "%M"}
RANGE = f"\"timestamp\" >= TIMESTAMP '{START}' AND \"timestamp\" < TIMESTAMP '{END}'"


def _speed(unit="minute", rows="readings"):
    return f"""SELECT sensor_id, start_time, start_time + INTERVAL 1 {unit} AS end_time,
      {SPEED_COLUMNS}
    FROM (SELECT *, date_trunc('{unit}', "timestamp")::TIMESTAMP AS start_time FROM {rows})
    GROUP BY sensor_id, start_time"""


def _batch(unit="minute"):
    return f"""SELECT unit_start AS "timestamp", {BATCH_COLUMNS}
    FROM (SELECT *, date_trunc('{unit}', "timestamp")::TIMESTAMP AS unit_start FROM readings)
    GROUP BY unit_start"""


CALENDAR_PARTS = ", ".join(
    f"strftime(\"timestamp\", '{fmt}') AS \"{name}\"" for name, fmt in PARTS.items()
)

MILLISECONDS = f"""SELECT event_id, sensor_id, "time",
    date_trunc('millisecond', "timestamp")::TIMESTAMP AS "timestamp", {ALL} FROM readings"""

HISTORY = """SELECT event_id,
    CASE WHEN event_id % 37 <> 5 THEN date_trunc('second', "timestamp")::TIMESTAMP END
      AS "timestamp",
    global_active_power,
    CASE WHEN event_id % 53 <> 17 THEN global_reactive_power END AS global_reactive_power,
    CASE WHEN sub_metering_1 % 10 <> 0 THEN voltage END AS voltage,
    CASE WHEN event_id % 41 <> 7 THEN global_intensity END AS global_intensity,
    sub_metering_1,
    CASE WHEN event_id % 43 <> 11 THEN sub_metering_2 END AS sub_metering_2,
    CASE WHEN event_id % 47 <> 13 THEN sub_metering_3 END AS sub_metering_3 FROM readings"""
COMPLETE = " AND ".join(
    f"{m} IS NOT NULL"
    for m in ("global_reactive_power", "voltage", "global_intensity", "sub_metering_2",
              "sub_metering_3"))

RECENT = """recent AS (
  SELECT sensor_id, start_time, load, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY start_time DESC) AS rank
    FROM (SELECT sensor_id, date_trunc('minute', "timestamp")::TIMESTAMP AS start_time,
            avg(global_active_power) AS load
          FROM readings GROUP BY 1, 2))
  WHERE rank <= 30)"""


def _trend(load, recent=RECENT, digits=6):
    steps = ", ".join(
        f"round(greatest(0, level + slope * {step}), {digits}) AS {name}"
        for step, name in enumerate(PREDICTIONS)
    )
    return f"""{WITH}, {recent}
  SELECT sensor_id, prediction_time, {steps} FROM (
    SELECT sensor_id, max(start_time) AS prediction_time,
      CASE WHEN count(*) > 1 THEN regr_slope({load}, -rank) ELSE 0 END AS slope,
      CASE WHEN count(*) > 1 THEN regr_intercept({load}, -rank) ELSE avg({load}) END AS level
    FROM recent GROUP BY sensor_id)"""


def _last_write(key, expression):
    return f"""{WITH} SELECT * FROM (
    SELECT *, {expression} AS {key} FROM readings)
  QUALIFY row_number() OVER (PARTITION BY sensor_id, {key} ORDER BY event_id DESC) = 1"""


def _retained(seconds):
    return f"""{WITH} SELECT * FROM readings WHERE "timestamp" >
    (SELECT max("timestamp") FROM readings) - INTERVAL {seconds} SECONDS"""


def _latest(rows):
    return f"""SELECT sensor_id, event_id, "timestamp", global_active_power,
    row_number() OVER (PARTITION BY sensor_id
      ORDER BY "timestamp" DESC, event_id DESC)::INT AS rank
  FROM {rows} QUALIFY rank <= 30"""


IMPORTED = f"""{WITH} SELECT * FROM ({HISTORY})
    WHERE "timestamp" IS NOT NULL AND {COMPLETE}"""

# The same readings with one null sensor in place of every 97th id.
NULL_SENSOR = """nameless AS (SELECT
    CASE WHEN sensor_id % 97 <> 0 THEN sensor_id END AS sensor_id, event_id, "timestamp",
    global_active_power FROM readings)"""

# Minutes of one sensor per user and kind of event, every fifth reading without a load.
SHORT = """recent AS (
  SELECT sensor_id, start_time, load, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY start_time DESC) AS rank
    FROM (SELECT readings.sensor_id || '-' || event_type AS sensor_id,
            date_trunc('minute', "timestamp")::TIMESTAMP AS start_time,
            avg(CASE WHEN readings.event_id % 5 <> 0 THEN global_active_power END) AS load
          FROM readings JOIN events USING (event_id) GROUP BY 1, 2)
    WHERE load IS NOT NULL)
  WHERE rank <= 30)"""

CLOSED = """(SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 MINUTE"""

ORACLE = {
    "parse_readings": f"{WITH} {MILLISECONDS}",
    "encode_readings": f"""{WITH} SELECT event_id, sensor_id::VARCHAR AS key,
        "time"::DOUBLE AS "time", {ALL} FROM readings""",
    "import_clean": IMPORTED,
    "import_file": IMPORTED,
    "import_counts": f"""{WITH} SELECT count(*) AS rows_read,
        count_if("timestamp" IS NOT NULL AND {COMPLETE})::BIGINT AS rows_kept,
        count_if("timestamp" IS NULL)::BIGINT AS bad_timestamp,
        count_if("timestamp" IS NOT NULL AND NOT ({COMPLETE}))::BIGINT AS missing_value
        FROM ({HISTORY})""",
    "calendar_parts": f"""{WITH} SELECT event_id,
        date_trunc('minute', "timestamp")::TIMESTAMP AS minute_start, {CALENDAR_PARTS}
        FROM readings""",
    "clamp_readings": f"{WITH} SELECT event_id, "
        + ", ".join(f"least(greatest({m}, {lo}::DOUBLE), {hi}::DOUBLE) AS {m}"
                    for m, (lo, hi) in LIMITS.items())
        + " FROM readings",
    "speed_minute": f"{WITH} {_speed()}",
    "speed_day": f"{WITH} {_speed('day')}",
    "batch_minute": f"{WITH} {_batch()}",
    "partials_minute": f"{WITH} {_speed()}",
    "stream_speed_minute": f"{WITH} SELECT * FROM ({_speed()}) WHERE end_time <= {CLOSED}",
    "stream_batch_minute": f"{WITH} {_batch()}",
    "folded_batch_minute": f"{WITH} {_speed()}",
    "stream_drop_repeats": f"{WITH} {MILLISECONDS}",
    "stream_raw_once": f"{WITH} {MILLISECONDS}",
    "stream_raw_readings": f"{WITH} {MILLISECONDS}",
    "dedupe_last_write": _last_write(
        "minute_start", "date_trunc('minute', \"timestamp\")::TIMESTAMP"),
    "dedupe_sensor_day": _last_write("day", '"timestamp"::DATE'),
    "retain_recent": _retained(86400),
    "retain_300s": _retained(300),
    "sensor_dim": f"{WITH} SELECT DISTINCT sensor_id FROM readings",
    "voltage_range": f'{WITH} SELECT "timestamp", voltage FROM readings WHERE {RANGE}',
    "voltage_5_minutes": f"""{WITH} SELECT "timestamp", voltage FROM readings
        WHERE "timestamp" >= TIMESTAMP '2024-01-01 00:00:00'
          AND "timestamp" < TIMESTAMP '2024-01-01 00:05:00'""",
    "power_factor": f"""{WITH} SELECT "timestamp", global_active_power, global_reactive_power,
        global_active_power / nullif(sqrt(global_active_power * global_active_power
          + global_reactive_power * global_reactive_power), 0) AS power_factor
        FROM readings WHERE {RANGE} ORDER BY "timestamp" """,
    "high_power": f"""{WITH} SELECT "timestamp", global_active_power FROM readings
        WHERE global_active_power > 1.5 AND {RANGE} ORDER BY "timestamp" """,
    "batch_power_factor": f"""{WITH}, batch AS (
        SELECT date_trunc('minute', "timestamp")::TIMESTAMP AS minute_start,
          avg(global_active_power) AS p, avg(global_reactive_power) AS q
        FROM readings GROUP BY 1)
        SELECT minute_start AS "timestamp", round(p, 9) AS global_active_power,
          round(q, 9) AS global_reactive_power,
          round(p / nullif(sqrt(p * p + q * q), 0), 9) AS power_factor
        FROM batch WHERE {RANGE.replace('"timestamp"', 'minute_start')}
        ORDER BY minute_start""",
    "calendar_layout": f"""{WITH} SELECT *, {CALENDAR_PARTS} FROM ({_batch('hour')})
        WHERE {RANGE}""",
    "pruned_range": f"{WITH} SELECT * FROM readings WHERE {RANGE}",
    "latest_n": f"{WITH} {_latest('readings')}",
    "latest_n_since": f"{WITH}, {NULL_SENSOR} {_latest('nameless')}",
    "forecast_features": f"""{WITH}, {RECENT}
        SELECT sensor_id, max(start_time) OVER (PARTITION BY sensor_id) AS last_time,
          (count(*) OVER (PARTITION BY sensor_id) - rank)::INT AS place, round(load::FLOAT::DOUBLE, 6) AS "value"
        FROM recent""",
    "forecast_trend": _trend("load"),
    "forecast_stored": _trend("load"),
    "forecast_score": _trend("load::FLOAT::DOUBLE"),
    "forecast_short": _trend("load", SHORT, 9),
    "forecast_short_score": _trend("load::FLOAT::DOUBLE", SHORT),
    "merged_view": f"{WITH} {_speed()}",
    "merged_stored": f"{WITH} SELECT * FROM ({_speed()}) WHERE end_time <= {CLOSED}",
}


# -- histories and streams of them

MINUTE = """date_trunc('minute', "timestamp")::TIMESTAMP"""
LOADS = f"""loads AS (
  SELECT sensor_id, {MINUTE} AS start_time, avg(global_active_power) AS load
  FROM readings GROUP BY 1, 2)"""

# The line through each hour's minutes, carried on from the end of the hour.
PREDICTED = f"""{LOADS}, lines AS (
  SELECT sensor_id, date_trunc('hour', start_time)::TIMESTAMP + INTERVAL 1 HOUR AS prediction_time,
    CASE WHEN count(*) > 1 THEN regr_slope(load, place) ELSE 0 END AS slope,
    CASE WHEN count(*) > 1 THEN regr_intercept(load, place) ELSE avg(load) END AS level
  FROM (SELECT *, extract('minute' FROM start_time) - 60.0::DOUBLE AS place FROM loads)
  GROUP BY 1, 2),
predictions AS (
  SELECT sensor_id, prediction_time, {", ".join(
      f"greatest(0, level + slope * {step}) AS {name}" for step, name in enumerate(PREDICTIONS))}
  FROM lines)"""

NEWEST = "(SELECT date_trunc('millisecond', max(ts)) FROM events)"
MILLIS = """millis AS (SELECT * REPLACE (date_trunc('millisecond', "timestamp")::TIMESTAMP
  AS "timestamp") FROM readings)"""


def _sessions(rows, seconds):
    return f"""SELECT sensor_id, min("timestamp") AS start_time, max("timestamp") AS last_time,
      count(*) AS readings, round(sum(global_active_power), 9) AS total_load,
      max(global_active_power) AS max_load
    FROM (SELECT *, sum(opens) OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id) AS n
      FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (PARTITION BY sensor_id
          ORDER BY "timestamp", event_id) > INTERVAL {seconds} SECONDS, false)::INT AS opens
        FROM {rows}))
    GROUP BY sensor_id, n"""


def _sliding(size):
    """The speed view of so many minutes up to each minute, from sums and counts of minutes."""
    sums, columns = [], []
    for part in SPEED_COLUMNS.replace("round(", "").replace(", 9)", "").split(","):
        call, name = part.strip().split(" AS ")
        fn, measure = call.rstrip(")").split("(")
        if fn == "avg":
            sums += [f"sum({measure}) AS {name}_s", f"count({measure}) AS {name}_n"]
            columns.append(f"round(sum({name}_s) OVER upto / sum({name}_n) OVER upto, 9) "
                           f"AS {name}")
        else:
            sums.append(f"{fn}({measure}) AS {name}")
            columns.append(f"{fn}({name}) OVER upto AS {name}")
    return f"""SELECT sensor_id, start_time, {", ".join(columns)}
    FROM (SELECT sensor_id, {MINUTE} AS start_time, {", ".join(sums)} FROM readings GROUP BY 1, 2)
    WINDOW upto AS (PARTITION BY sensor_id ORDER BY start_time
      RANGE BETWEEN INTERVAL {size - 1} MINUTES PRECEDING AND CURRENT ROW)"""


def _arrivals(slices, behind):
    """Readings by the slice they arrive in, some ``behind`` and some twice, and whether their
    minute was closed by the newest time of the slices up to two before."""
    return f"""span AS (
      SELECT epoch(date_trunc('second', min(ts))) AS begin,
        greatest(1.0::DOUBLE, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE) AS seconds
      FROM events),
    slots AS (
      SELECT millis.*, greatest(0, least({slices - 1}, floor(
        (epoch(date_trunc('minute', "timestamp")) - begin) / seconds * {slices})))::INT AS slot
      FROM millis, span),
    arrivals AS (
      SELECT *, unnest(CASE WHEN event_id % 7 = 0 THEN [own, following] ELSE [own] END) AS slice
      FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN following ELSE slot END AS own
        FROM (SELECT *, least(slot + {behind}, {slices - 1}) AS following FROM slots))),
    marks AS (
      SELECT s.slice, max(a."timestamp") - INTERVAL 1 MINUTE AS watermark
      FROM (SELECT DISTINCT slice FROM arrivals) s
      LEFT JOIN arrivals a ON a.slice <= s.slice - 2 GROUP BY s.slice),
    routed AS (
      SELECT arrivals.*, coalesce({MINUTE} + INTERVAL 1 MINUTE <= watermark, false) AS late
      FROM arrivals JOIN marks USING (slice))"""


def _active(unit):
    return f"""SELECT '{unit}' AS span, date_trunc('{unit}', "timestamp")::DATE AS start,
      count(DISTINCT sensor_id) AS sensors FROM readings GROUP BY 2"""


def _ranges(*ranges):
    """(start, end) of accepted report ranges, or only the start of those that are refused."""
    rows = []
    for number, (start, *end) in enumerate(ranges):
        count = f"""(SELECT count(*) FROM readings WHERE "timestamp" >= TIMESTAMP '{start}'
          AND "timestamp" < TIMESTAMP '{end[0]}')""" if end else "0::BIGINT"
        rows.append(f"SELECT {number} AS number, '{start}' AS start, {bool(end)} AS accepted, "
                    f"{count} AS readings")
    return " UNION ALL ".join(rows)


STEPS = ", ".join(f"{{'step': {i}, 'value': {name}}}" for i, name in enumerate(PREDICTIONS, 1))
CLOSED_MINUTE = f"date_trunc('minute', {NEWEST}) - INTERVAL 1 MINUTE"

ORACLE |= {
    "asof_forecast": f"""{WITH}, {PREDICTED}
        SELECT event_id, readings.sensor_id, "timestamp", global_active_power, prediction_time,
          round(prediction1, 9) AS prediction1
        FROM readings ASOF LEFT JOIN predictions
          ON readings.sensor_id = predictions.sensor_id AND "timestamp" >= prediction_time""",
    "usage_sessions": f"{WITH} {_sessions('readings', 1800)}",
    "stream_sessions": f"""{WITH}, {MILLIS} SELECT * FROM ({_sessions('millis', 1800)})
        WHERE last_time + INTERVAL 1800 SECONDS <= {CLOSED}""",
    "filled_minutes": f"""{WITH}, {LOADS}
        SELECT sensor_id, start_time + k * INTERVAL 1 MINUTE AS start_time,
          round(CASE WHEN k = 0 THEN load ELSE load + (following - load)
            * ((k * 60000000) / (n * 60000000)) END, 9) AS avg_global_active_power, k > 0 AS filled
        FROM (SELECT *, unnest(generate_series(0, CASE WHEN n <= 60 THEN n - 1 ELSE 0 END)) AS k
          FROM (SELECT *, lead(load) OVER by_time AS following, (epoch(lead(start_time) OVER by_time)
              - epoch(start_time))::BIGINT // 60 AS n
            FROM loads WINDOW by_time AS (PARTITION BY sensor_id ORDER BY start_time)))""",
    "sliding_load": f"{WITH} {_sliding(15)}",
    "load_quantiles": f"""{WITH} SELECT sensor_id, count(global_active_power) AS n,
        true AS within_one_percent FROM readings GROUP BY sensor_id""",
    "fleet_quantiles": f"""{WITH} SELECT date_trunc('month', "timestamp")::DATE AS "month",
        count(global_active_power) AS n, true AS within_one_percent FROM readings GROUP BY 1""",
    "active_sensors": f"{WITH} " + " UNION ALL ".join(map(_active, ("day", "week", "month"))),
    "checked_ranges": f"{WITH} " + _ranges(
        ("2024-01-02 00:00:00", "2024-01-30 00:00:00"),
        ("2024-01-05 12:00:00", "2024-01-06 12:00:00"), ("2024-01-30 00:00:00",),
        ("2024-01-05 12:00:00",), ("2024-01-05 12:00:00",), ("last Tuesday",),
        ("2024-02-30 00:00:00",), ("2024-01-05 12:00:00",)),
    "timeless_minutes": f"""{WITH}, timed AS (SELECT * FROM readings WHERE event_id % 7 <> 0)
        {_speed('minute', 'timed')}""",
    "late_readings": f"""{WITH}, {MILLIS}, {_arrivals(4, 2)}
        SELECT event_id, sensor_id, "timestamp", late FROM routed""",
    "late_minutes": f"""{WITH}, {MILLIS}, {_arrivals(4, 2)},
        kept AS (SELECT * FROM routed WHERE NOT late) {_speed('minute', 'kept')}""",
    "live_sensors": f"""{WITH}, {MILLIS}
        SELECT sensor_id, min("timestamp") AS first_time, max("timestamp") AS last_time,
          max_by(global_active_power, "timestamp") AS load
        FROM (SELECT *, sum(opens) OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id) AS n
          FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (PARTITION BY sensor_id
              ORDER BY "timestamp", event_id) > INTERVAL 300 SECONDS, false)::INT AS opens
            FROM millis))
        GROUP BY sensor_id, n HAVING max("timestamp") + INTERVAL 300 SECONDS <= {CLOSED}""",
    "speed_live": f"{WITH} {_speed()}",
    "scored_forecast": f"""{WITH}, {PREDICTED}, steps AS (
        SELECT sensor_id, prediction_time + (s.step - 1) * INTERVAL 1 MINUTE AS "minute", s.step,
          s.value AS predicted
        FROM (SELECT *, unnest([{STEPS}]) AS s FROM predictions))
        SELECT steps.sensor_id, "minute", step, round(predicted, 9) AS predicted, "time",
          global_active_power AS load
        FROM steps LEFT JOIN readings
          ON steps.sensor_id = readings.sensor_id AND "minute" = {MINUTE}
        WHERE "time" IS NOT NULL OR "minute" <= {CLOSED_MINUTE}""",
}
