"""Jobs for spark-submit: see ``run.py --help``."""

import argparse
import importlib

from pyspark.sql import functions as F

from meterflow.operators.forecast import forecast_features, forecast_score, forecast_trend
from meterflow.operators.minutes import speed_minutes
from meterflow.operators.ranges import BY_DATE, BY_MINUTE, time_literal
from meterflow.plans import reports, serving
from meterflow.schema import CALENDAR
from meterflow.session import build_session
from meterflow.sources import history, tables
from meterflow.sources.messages import encode_readings, parse_readings, read_messages
from meterflow.streaming import jobs


def pairs(texts):
    return dict(text.split("=", 1) for text in texts or [])


def live_readings(spark, args):
    options = pairs(args.option)
    schema = args.schema or None
    sensor = F.expr(args.sensor).cast("int") if args.sensor else None
    return parse_readings(read_messages(spark, args.source, options, schema), sensor)


def run_speed(spark, args):
    """Raw readings and the speed view, side by side."""
    readings = live_readings(spark, args)
    trigger = {"availableNow": True} if args.once else None
    raw, speed = f"{args.checkpoint}/raw", f"{args.checkpoint}/speed"
    if args.sink:
        queries = [
            jobs.start_append(readings.drop("timestamp"), raw, args.sink,
                              pairs(args.raw_option), trigger=trigger, name="raw"),
            jobs.start_append(jobs.speed_stream(readings), speed, args.sink,
                              pairs(args.speed_option), trigger=trigger, name="speed"),
        ]
    else:
        queries = [
            jobs.start_raw(readings, raw, f"{args.out}/raw", args.retention, trigger, "raw"),
            jobs.start_speed(readings, speed, f"{args.out}/speed", trigger=trigger, name="speed"),
        ]
    jobs.await_all(queries)


def run_batch(spark, args):
    """Partials of the batch view."""
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    readings = live_readings(spark, args)
    jobs.await_all([jobs.start_batch(readings, args.checkpoint, args.out, trigger=trigger)])


def speed_schema(spark):
    """The columns of the speed view."""
    nothing = parse_readings(spark.createDataFrame([], "value string"))
    return speed_minutes(nothing).schema


def run_merged(spark, args):
    """One view over both stored layers."""
    view = serving.merged_stored_view(
        spark, args.batch, args.speed, speed_schema(spark), args.delay
    )
    tables.write_by_date(view, args.out, "start_time", mode="overwrite")


def run_send(spark, args):
    """Readings as JSON messages to a topic or any other sink."""
    records = encode_readings(spark.read.parquet(args.path))
    tables.append_to(records, args.sink, pairs(args.sink_option))


def run_declare(spark, args):
    """Name a folder written by this program in the catalog."""
    stored = spark.read.parquet(args.path)
    parts = {"date": "date"} if "date" in stored.columns else dict.fromkeys(CALENDAR, "string")
    columns = {name: kind for name, kind in stored.dtypes if name not in parts}
    tables.declare_table(spark, args.table, args.path, columns, parts)
    tables.repair_partitions(spark, args.table)


def run_expire(spark, args):
    """Drop the days of a catalog table before a date, files included."""
    print(tables.drop_before(spark, args.table, args.before))


def run_publish(spark, args):
    """The batch view as a plain table by date."""
    serving.publish_batch_view(
        spark, args.root, args.out, args.start, args.end, args.by_sensor
    )


def run_backfill(spark, args):
    """Historical text files into a table by date."""
    text = history.read_history(spark, args.csv, args.sep)
    if args.counts:
        history.import_counts(text, args.format).show()
    clean = history.import_history(text, args.format, args.strict)
    write = tables.write_by_minute if args.by_minute else tables.write_by_date
    write(clean, args.out)


def batch_table(spark, args):
    """The table of a report, and how it is partitioned by time."""
    if args.path:
        return spark.read.parquet(args.path), args.partitions
    if args.repair:
        tables.repair_partitions(spark, args.table)
    columns = tables.partition_columns(spark, args.table)
    known = {("date",): BY_DATE, tuple(CALENDAR): BY_MINUTE}.get(tuple(columns))
    return spark.table(args.table), args.partitions or known


def give(rows, args):
    """Store the whole result; print some of it only if asked to."""
    if args.sink:
        tables.append_to(rows, args.sink, pairs(args.sink_option))
    else:
        rows.write.mode("overwrite").format(args.out_format).save(args.out)
    if args.show:
        rows.show(args.show, truncate=False)


def run_voltage(spark, args):
    """Voltage in the minutes after a start."""
    table, parts = batch_table(spark, args)
    give(reports.voltage_range(table, args.start, args.minutes, parts), args)


def run_power_factor(spark, args):
    """Power factor from a start to an end."""
    table, parts = batch_table(spark, args)
    give(reports.power_factor(table, args.start, args.end, parts), args)


def run_high_power(spark, args):
    """Rows above a load in the minutes after a start."""
    table, parts = batch_table(spark, args)
    give(reports.high_power(table, args.min_power, args.start, args.minutes, parts), args)


def user_model(name):
    """The function ``module:function`` that makes a model for ``forecast_score``."""
    module, _, function = name.partition(":")

    def load_model():
        return getattr(importlib.import_module(module), function)()

    return load_model


def run_forecast(spark, args):
    """The next six minutes of every sensor from its last thirty, stamped with now."""
    table, parts = batch_table(spark, args)
    if "sensor_id" not in table.columns:
        table = table.withColumn("sensor_id", F.lit(1))
    recent = {
        "since": time_literal(table, args.since, args.time) if args.since else None,
        "known": spark.read.parquet(args.sensors) if args.sensors else None,
        "partitions": parts,
    }
    now = F.current_timestamp()
    if args.model:
        vectors = forecast_features(table, args.time, args.value, **recent)
        predictions = forecast_score(vectors, user_model(args.model), now)
    else:
        predictions = forecast_trend(
            table, args.time, args.value, prediction_time=now, **recent
        )
    give(predictions, args)


def parser():
    top = argparse.ArgumentParser(prog="run.py", description=__doc__)
    commands = top.add_subparsers(required=True, metavar="command")

    def command(name, run, *parents):
        sub = commands.add_parser(name, help=run.__doc__, parents=parents)
        sub.set_defaults(run=run)
        return sub

    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--source", default="kafka", help="source format")
    stream.add_argument("--option", action="append", metavar="K=V", help="source option")
    stream.add_argument("--schema", help="schema of a file source")
    stream.add_argument("--sensor", help="SQL expression for the sensor id, such as "
                                         "\"cast(key as string)\"; 1 if left out")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--once", action="store_true", help="stop when the source is read")

    table = argparse.ArgumentParser(add_help=False)
    where = table.add_mutually_exclusive_group(required=True)
    where.add_argument("--table", help="catalog table")
    where.add_argument("--path", help="Parquet folder")
    table.add_argument("--repair", action="store_true", help="look for new partitions first")
    table.add_argument("--partitions", choices=[BY_DATE, BY_MINUTE],
                       help="how the folder is partitioned by time; a catalog table tells")
    result = table.add_mutually_exclusive_group(required=True)
    result.add_argument("--out", help="folder for the result")
    result.add_argument("--sink", help="format of a sink to append the result to")
    table.add_argument("--out-format", default="parquet")
    table.add_argument("--sink-option", action="append", metavar="K=V")
    table.add_argument("--show", type=int, help="also print so many rows")

    speed = command("speed", run_speed, stream)
    target = speed.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder for Parquet tables")
    target.add_argument("--sink", help="format of a keyed store or another sink")
    speed.add_argument("--raw-option", action="append", metavar="K=V", help="sink option")
    speed.add_argument("--speed-option", action="append", metavar="K=V", help="sink option")
    speed.add_argument("--retention", default="300s", help="lifetime of raw files under --out")
    batch = command("batch", run_batch, stream)
    batch.add_argument("--out", required=True)
    batch.add_argument("--every", default="1 minute")
    merged = command("merged", run_merged)
    merged.add_argument("--batch", required=True, help="folder of the batch layer")
    merged.add_argument("--speed", required=True, help="folder of the speed layer")
    merged.add_argument("--delay", default="1 minute", help="how late readings may come")
    merged.add_argument("--out", required=True)
    send = command("send", run_send)
    send.add_argument("--path", required=True, help="Parquet folder of readings")
    send.add_argument("--sink", required=True, help="format, such as kafka")
    send.add_argument("--sink-option", action="append", metavar="K=V")
    declare = command("declare", run_declare)
    declare.add_argument("--table", required=True)
    declare.add_argument("--path", required=True)
    expire = command("expire", run_expire)
    expire.add_argument("--table", required=True)
    expire.add_argument("--before", required=True, help="first day to keep")
    publish = command("publish", run_publish)
    publish.add_argument("--root", required=True)
    publish.add_argument("--out", required=True)
    publish.add_argument("--start")
    publish.add_argument("--end")
    publish.add_argument("--by-sensor", action="store_true", help="one row per sensor and window")
    backfill = command("backfill", run_backfill)
    backfill.add_argument("--csv", required=True)
    backfill.add_argument("--out", required=True)
    backfill.add_argument("--sep", default=",")
    backfill.add_argument("--format", default=history.DAY_FIRST)
    backfill.add_argument("--strict", action="store_true", help="fail on a bad date")
    backfill.add_argument("--counts", action="store_true", help="print what is left out")
    backfill.add_argument("--by-minute", action="store_true", help="calendar folders")
    voltage = command("voltage", run_voltage, table)
    voltage.add_argument("--start", required=True)
    voltage.add_argument("--minutes", type=int, default=5)
    factor = command("power-factor", run_power_factor, table)
    factor.add_argument("--start", required=True)
    factor.add_argument("--end", required=True)
    high = command("high-power", run_high_power, table)
    high.add_argument("--min-power", type=float, required=True)
    high.add_argument("--start", required=True)
    high.add_argument("--minutes", type=int, required=True)
    predict = command("forecast", run_forecast, table)
    predict.add_argument("--time", default="timestamp")
    predict.add_argument("--value", default="global_active_power")
    predict.add_argument("--since", help="read older rows only for sensors that need them")
    predict.add_argument("--sensors", help="Parquet folder of all sensor ids, for --since")
    predict.add_argument("--model", metavar="MODULE:FUNCTION",
                         help="makes the model; the built-in trend if left out")
    return top


def main(argv=None):
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
