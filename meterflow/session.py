"""Session settings and the shared folder for derived tables."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from meterflow.sources import files

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State off the JVM heap, uploaded as change logs. The number of rows in it is not kept: that
# would read each row before it is written.
STATE_SETTINGS = {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# For state far larger than memory: a join's four stores of a partition in one, rows flushed to disk
# when a micro-batch ends, so that only stores of running tasks hold some in memory, and the MB that
# all stores of an executor share. With change logs instead each store would keep its unflushed rows.
BOUNDED_STATE = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "240",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
}

# Spark settings the jobs are designed for. Cluster-specific sizes (executors, memory,
# shuffle partitions) stay with the submitter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INT96 carries no usable min/max statistics, so range filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    **STATE_SETTINGS,
    "spark.ui.enabled": "false",
}


def build_session(app="meterflow", master=None, **settings):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_state_off_heap(spark):
    """State of streams that start from here on, also in a session built elsewhere; a stream
    that has a checkpoint keeps the store it began with."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def bounded_state(spark):
    """Streams started within keep their state in bounded memory; the settings of the session are
    as before afterwards, and sizes in MB that it has stay. State has to be in RocksDB."""
    before = {key: spark.conf.get(key, None) for key in BOUNDED_STATE}
    for key, value in BOUNDED_STATE.items():
        if before[key] is None or not key.endswith("MB"):
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_roots = {}


def session_folder(spark):
    """The folder of this session's derived tables and stream progress; it goes when the
    session's JVM ends.

    It lies under ``spark.checkpoint.dir``, which all executors share. Only a local session
    may fall back to a folder of this machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared:
            root = f"{shared.rstrip('/')}/meterflow/{app}-{uuid.uuid4().hex}"
        elif spark.conf.get("spark.master", "").startswith("local"):
            root = tempfile.mkdtemp(prefix="meterflow-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        files.remove_at_exit(spark, root)
        _roots[app] = root
    return _roots[app]


def work_folder(spark, name):
    """A new folder for a derived table or stream checkpoint of this session."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame, name):
    """The frame as a table in the shared folder: computed once, safe from lost executors,
    and of a size the planner knows when it chooses a join."""
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    frame.write.parquet(folder, mode="overwrite")
    return spark.read.schema(frame.schema).parquet(folder)
