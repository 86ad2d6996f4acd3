"""Column names, types and bounds shared by every layer."""

from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# The measures of one reading and the range a sensor can report.
BOUNDS = {
    "global_active_power": (0.08, 10.7),
    "global_reactive_power": (0.0, 1.15),
    "voltage": (223.0, 251.0),
    "global_intensity": (0.4, 46.4),
    "sub_metering_1": (0.0, 78.0),
    "sub_metering_2": (0.0, 78.0),
    "sub_metering_3": (0.0, 20.0),
}
MEASURES = list(BOUNDS)

# The aggregates of the speed view (output column, function, measure).
SPEED_VIEW = [
    ("avg_global_active_power", "avg", "global_active_power"),
    ("max_global_active_power", "max", "global_active_power"),
    ("min_global_active_power", "min", "global_active_power"),
    ("avg_global_reactive_power", "avg", "global_reactive_power"),
    ("avg_voltage", "avg", "voltage"),
    ("max_voltage", "max", "voltage"),
    ("avg_global_intensity", "avg", "global_intensity"),
    ("total_sub_metering_1", "sum", "sub_metering_1"),
    ("total_sub_metering_2", "sum", "sub_metering_2"),
    ("total_sub_metering_3", "sum", "sub_metering_3"),
]

# The batch view averages the mains measures and totals the sub-meters,
# and keeps the names of the readings.
BATCH_VIEW = [
    ("global_active_power", "avg", "global_active_power"),
    ("global_reactive_power", "avg", "global_reactive_power"),
    ("voltage", "avg", "voltage"),
    ("global_intensity", "avg", "global_intensity"),
    ("sub_metering_1", "sum", "sub_metering_1"),
    ("sub_metering_2", "sum", "sub_metering_2"),
    ("sub_metering_3", "sum", "sub_metering_3"),
]

# Calendar partition columns and their zero-padded formats.
CALENDAR = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm"}

# Text a historical file uses for "no value" in any column.
NA_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Length of the forecast input and of its output.
FORECAST_INPUT = 30
FORECAST_STEPS = 6

# One JSON message: epoch milliseconds and the measures; every field may be missing.
MESSAGE = StructType(
    [StructField("time", LongType())] + [StructField(m, DoubleType()) for m in MEASURES]
)
