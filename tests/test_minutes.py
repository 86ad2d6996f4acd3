from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterflow.operators.minutes import (
    batch_from_partials, batch_minutes, minute_partials, speed_from_partials, speed_minutes,
)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_speed_view_by_hand(make_readings):
    readings = make_readings([
        (1, 0.0, 1.0), (1, 59.999, 3.0), (1, 60.0, 7.0), (2, 30.0, 5.0), (1, 30.0, None),
    ])
    got = speed_minutes(readings).orderBy("sensor_id", "start_time").collect()
    first = got[0].asDict()
    assert (first.pop("end_time") - first.pop("start_time")).total_seconds() == 60
    assert first == {
        "sensor_id": 1,
        "avg_global_active_power": 2.0, "max_global_active_power": 3.0,
        "min_global_active_power": 1.0, "avg_global_reactive_power": 0.5,
        "avg_voltage": 232.0, "max_voltage": 233.0, "avg_global_intensity": 8.0,
        "total_sub_metering_1": 3.0, "total_sub_metering_2": 4.0, "total_sub_metering_3": None,
    }
    assert [(r.sensor_id, r.avg_global_active_power) for r in got] == [(1, 2.0), (1, 7.0), (2, 5.0)]


def test_batch_view_covers_all_sensors(make_readings):
    readings = make_readings([(1, 0.0, 1.0), (1, 1.0, 1.0), (2, 2.0, 4.0)])
    row = batch_minutes(readings).first()
    assert list(row.asDict()) == [
        "timestamp", "global_active_power", "global_reactive_power", "voltage",
        "global_intensity", "sub_metering_1", "sub_metering_2", "sub_metering_3"]
    assert (row.global_active_power, row.sub_metering_1, row.sub_metering_2) == (2.0, 3.0, 6.0)
    # An average of the per-sensor averages would be 2.5.
    assert rows(batch_from_partials(minute_partials(readings))) == rows(batch_minutes(readings))


def test_reading_without_time_is_in_no_window(make_readings):
    got = speed_minutes(make_readings([(1, None, 1.0), (1, 0.001, 2.0)])).collect()
    assert [(r.avg_global_active_power, r.total_sub_metering_1) for r in got] == [(2.0, 1.0)]


def test_window_without_values_has_null_aggregates(make_readings):
    row = speed_from_partials(minute_partials(make_readings([(1, 0.0, None)]))).first()
    assert row.avg_global_active_power is None and row.total_sub_metering_3 is None
    assert row.total_sub_metering_1 == 1.0


def test_window_size_is_a_parameter(make_readings):
    readings = make_readings([(1, 0.0, 1.0), (1, 299.0, 3.0), (1, 300.0, 9.0)])
    got = speed_minutes(readings, size="5 minutes").orderBy("start_time").collect()
    assert [r.avg_global_active_power for r in got] == [2.0, 9.0]


reading = st.tuples(
    st.integers(1, 2), st.integers(0, 150).map(float),
    st.one_of(st.none(), st.integers(0, 8).map(float)), st.integers(0, 3),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=25))
def test_partials_of_any_split_merge_to_the_same_view(make_readings, drawn):
    whole = make_readings([r[:3] for r in drawn])
    merged = None
    for batch in sorted({r[3] for r in drawn}):
        part = minute_partials(make_readings([r[:3] for r in drawn if r[3] == batch]))
        merged = part if merged is None else merged.unionByName(part)
    assert rows(speed_from_partials(merged)) == rows(speed_minutes(whole))
    assert rows(batch_from_partials(merged)) == rows(batch_minutes(whole))


def test_one_shuffle_with_partial_aggregation(make_readings, plan):
    text = plan(speed_minutes(make_readings([(1, 0.0, 1.0)])))
    assert text.count("Exchange") == 1 and "partial_avg" in text
    assert "Python" not in text and "Expand" not in text
