import pytest
from pyspark.sql import functions as F

from meterflow.schema import MEASURES
from meterflow.sources.history import import_counts, import_history, read_history, typed_history

HEADER = "Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;" \
    "Sub_metering_1;Sub_metering_2;Sub_metering_3"
LINES = [
    "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000",
    "16/12/2006;17:25:00;?;?;?;?;?;?;?",
    "16/12/2006;17:26:00;5.374;0.498;233.290;23.000;0.000;2.000;",
    "nonsense;17:27:00;5.374;0.498;233.290;23.000;0.000;2.000;17.000",
    "17/12/2006;00:00:00;1;2;3;4;5;6;7",
    "17/12/2006;00:01:00;nan;2;3;4;5;6;7",
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "history.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(tmp_path)


def test_rows_with_any_null_are_left_out(spark, folder):
    clean = import_history(read_history(spark, folder, sep=";"))
    assert clean.columns == ["timestamp", *MEASURES]
    rows = clean.withColumn("timestamp", F.col("timestamp").cast("string")).collect()
    assert sorted(map(tuple, rows)) == [
        ("2006-12-16 17:24:00", 4.216, 0.418, 234.84, 18.4, 0.0, 1.0, 17.0),
        ("2006-12-17 00:00:00", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0),
    ]


def test_counts_tell_why(spark, folder):
    counts = import_counts(read_history(spark, folder, sep=";")).first().asDict()
    assert counts == {"rows_read": 6, "rows_kept": 2, "bad_timestamp": 1, "missing_value": 3}


def test_strict_import_fails_on_a_bad_date(spark, folder):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        import_history(read_history(spark, folder, sep=";"), strict=True).collect()


def test_further_columns_take_part_in_the_null_check(spark, tmp_path):
    lines = [HEADER + ";Room", LINES[0] + ";hall", LINES[0] + ";NA", LINES[0] + ";"]
    (tmp_path / "h.csv").write_text("\n".join(lines) + "\n")
    text = read_history(spark, str(tmp_path), sep=";")
    assert [r.room for r in import_history(text).collect()] == ["hall"]
    assert typed_history(text).count() == 3


def test_files_with_other_column_orders_are_refused_by_name(spark, tmp_path):
    swapped = HEADER.replace("Voltage", "X").replace("Global_active_power", "Voltage").replace(
        "X", "Global_active_power")
    (tmp_path / "a.csv").write_text("\n".join([HEADER, LINES[0]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([swapped, LINES[4]]) + "\n")
    with pytest.raises(Exception, match="(?s)CSV header.*\\.csv"):
        import_history(read_history(spark, str(tmp_path), sep=";")).collect()


def test_every_text_is_parsed_once(spark, folder, plan):
    text = plan(import_history(read_history(spark, folder, sep=";")))
    assert text.count("try_to_timestamp") <= 1 or text.count("gettimestamp") <= 1
    assert "Generate inline" in text
    before_generate = text.split("Generate inline")[1]
    assert "isnotnull" not in before_generate.split("FileScan")[0]
