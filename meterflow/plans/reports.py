"""Time-range reports over the batch table (minute rows stamped with ``timestamp``).

Ordered reports break ties by the measures, which also lets the sort split a timestamp that
holds very many rows. ``partitions`` tells how the table is partitioned by time, see
``ranges.between``.
"""

from pyspark.sql import functions as F

from meterflow.functions import columns
from meterflow.operators.ranges import range_of, time_range


def voltage_range(table, start, minutes=5, partitions=None):
    """Voltage in the minutes after ``start``, in no particular order."""
    rows = time_range(table, *range_of(start, minutes=minutes), partitions=partitions)
    return rows.select("timestamp", "voltage")


def power_factor(table, start, end, partitions=None):
    """Active and reactive power and their power factor from ``start`` to ``end``."""
    rows = time_range(table, *range_of(start, end), partitions=partitions)
    factor = columns.power_factor(F.col("global_active_power"), F.col("global_reactive_power"))
    return rows.select(
        "timestamp", "global_active_power", "global_reactive_power",
        factor.alias("power_factor"),
    ).orderBy("timestamp", "global_active_power", "global_reactive_power")


def high_power(table, min_power, start, minutes, partitions=None):
    """Rows above ``min_power`` in the minutes after ``start``."""
    rows = time_range(table, *range_of(start, minutes=minutes), partitions=partitions)
    return (
        rows.filter(F.col("global_active_power") > min_power)
        .select("timestamp", "global_active_power")
        .orderBy("timestamp", "global_active_power")
    )
