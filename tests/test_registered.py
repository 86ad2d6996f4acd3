import os
import subprocess
import sys

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from meterflow.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return check.tables(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    same, ours, theirs, note = check.compare(spark, con, name, SMALL)
    assert same, (ours, theirs, note)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name, shuffles", [
    ("parse_readings", 0), ("encode_readings", 0), ("import_clean", 0), ("clamp_readings", 0),
    ("calendar_parts", 0), ("voltage_range", 0), ("speed_minute", 1), ("batch_minute", 1),
    ("partials_minute", 1), ("dedupe_last_write", 1), ("sensor_dim", 1), ("power_factor", 1),
    ("high_power", 1), ("latest_n", 2), ("forecast_features", 2), ("forecast_trend", 2),
    ("merged_view", 2), ("usage_sessions", 1), ("filled_minutes", 2), ("sliding_load", 2),
    ("timeless_minutes", 1), ("asof_forecast", 4), ("load_quantiles", 3),
])
def test_plans_stay_in_the_jvm_and_shuffle_as_little_as_they_can(spark, plan, name, shuffles):
    text = plan(queries()[name](spark, SMALL))
    assert text.count("Exchange") == shuffles
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_reports_read_only_their_columns(spark, plan):
    high, voltage = (plan(queries()[n](spark, SMALL)) for n in ("high_power", "voltage_range"))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in high
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in voltage


def entry_without(*blocked):
    """Names of the queries of an entry that cannot import some modules."""
    code = "import sys\n" + "".join(f"sys.modules[{name!r}] = None\n" for name in blocked)
    code += "from __spark_entry__ import queries, oracle_sql\n"
    code += "print(*sorted(queries()), '|', *sorted(oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert not done.returncode, done.stderr
    return [names.split() for names in done.stdout.split("|")]


@pytest.mark.parametrize("blocked", ["public_tokenizers", "corpus_pipeline", "meterflow.llm"])
def test_the_other_queries_stay_without_the_text_operators(blocked):
    names, sql = entry_without(blocked)
    assert set(names) == set(sql) == set(QUERIES)


@pytest.mark.parametrize("name", [
    "retain_300s", "pruned_range", "retain_recent", "latest_n_since", "forecast_stored"])
def test_changed_tables_change_the_result(spark, tmp_path, name):
    """A derived table of an earlier run does not answer for the tables as they are now."""
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    path = str(tmp_path / "events.parquet")
    events.write.parquet(path)
    before = queries()[name](spark, str(tmp_path)).count()
    first = events.orderBy("event_id").limit(20).cache()
    first.count()
    first.write.mode("overwrite").parquet(path)
    assert queries()[name](spark, str(tmp_path)).count() <= min(before, 20)
