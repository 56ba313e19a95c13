from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from tidewarden.operators import quality as q
from tidewarden.schemas import SCHEMAS

NOW = at("2024-03-01 12:00:00")


def facts(spark, points):
    data = [(s, m, t, Decimal(str(v)), "x", t, late, run) for s, m, t, v, late, run in points]
    return spark.createDataFrame(data, SCHEMAS["fact_observation"])


@pytest.fixture(scope="module")
def metric(spark):
    data = [(1, "a", "u", True, Decimal(0), Decimal(10)), (2, "b", "u", True, Decimal(0), None), (3, "c", "u", False, None, None)]
    return spark.createDataFrame(
        data, "metric_id long, metric_code string, unit_canonical string, is_active boolean, "
              "min_expected decimal(18,6), max_expected decimal(18,6)")


@pytest.fixture(scope="module")
def station(spark):
    return spark.createDataFrame([(1, True, False), (2, True, False), (3, False, False)],
                                 "station_id long, is_current boolean, is_smoketest boolean")


def test_status_evaluation(spark):
    cases = [
        (1, 1, "<=", "critical", "pass"), (2, 1, "<=", "critical", "fail"), (2, 1, "<=", "warning", "warn"),
        (1, 1, ">=", "warning", "pass"), (0, 1, ">=", "critical", "fail"), (1, 1, "=", "critical", "pass"),
        (2, 1, "=", "warning", "warn"), (1, 1, "<>", "critical", "fail"), (1, 1, "~", "warning", "warn"),
        (None, 1, "<=", "critical", "fail"), (None, 1, "=", "warning", "warn"), (1, 1, "<", None, "warn"),
    ]
    df = spark.createDataFrame(cases, "metric int, threshold int, op string, severity string, expected string")
    status = q.check_status(F.col("metric"), F.col("threshold"), F.col("op"), F.col("severity"))
    assert df.where(status != F.col("expected")).count() == 0


def test_metrics_on_a_small_fact_table(spark, metric, station):
    hour = timedelta(hours=1)
    fact = facts(spark, [
        (1, 1, NOW, 5, False, "r1"), (1, 2, NOW - 3 * hour, 5, True, "r1"), (1, 3, NOW, 11, False, "r2"),
        (2, 1, NOW - hour, 11, False, "r2"), (2, 2, NOW - hour, -1, True, "r2"),
    ])
    one = lambda df: df.first()[q.METRIC]
    assert one(q.freshness_minutes(fact, NOW)) == Decimal("180.00")
    # Station 1: one of two active metrics at its latest time; station 2: both.
    assert one(q.completeness_pct(fact, metric)) == 75.0
    assert one(q.late_rate_pct(fact)) == 40.0
    assert rows(q.late_rate_by_run(fact)) == [("r1", 50.0), ("r2", 33.333333)]
    assert one(q.out_of_range(fact, metric)) == 2
    assert one(q.stations_missing_metric(fact, station, metric)) == 2
    assert one(q.late_rate_pct(fact.limit(0))) is None
    assert one(q.freshness_minutes(fact.limit(0), NOW)) is None
    assert rows(q.orphans(fact, station.where("station_id = 1"), metric, spark.createDataFrame([("r1",)], "run_id string"))) == [
        ("metric", 0, 0), ("run", 1, 3), ("station", 1, 2)
    ]


def test_runner_keeps_going_on_a_null_metric_and_binds_templates(spark, metric, station):
    fact = facts(spark, [(1, 1, NOW, 5, True, "r1")])
    fact.createOrReplaceTempView("template_facts")
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    checks = [
        q.CheckDefinition(1, "late_data_rate_pct", "warning", 5, "<="),
        q.CheckDefinition(2, "fact_duplicate_key_count", "critical", 0, "="),
        q.CheckDefinition(3, "rows_of_run", "critical", 1, ">=", True,
                          "SELECT count(*) AS metric_value FROM template_facts WHERE ingest_run_id = :run_id"),
        q.CheckDefinition(4, "switched_off", "critical", 1, ">=", False),
    ]
    tables = q.Checked(fact, fact, station, metric)
    set_wise = q.CheckDefinition(5, "rows_by_run", "critical", 1, ">=", True,
                                 "SELECT ingest_run_id AS run_id, count(*) AS metric_value FROM template_facts GROUP BY ALL")
    results = q.run_checks(runs, [*checks, set_wise], tables, NOW).unionByName(
        q.template_checks(runs, checks, NOW))
    assert rows(results, "run_id", "check_name", "status", "reason") == [
        ("r1", "fact_duplicate_key_count", "pass", None), ("r1", "late_data_rate_pct", "warn", None),
        ("r1", "rows_by_run", "pass", None), ("r1", "rows_of_run", "pass", None),
        ("r2", "fact_duplicate_key_count", "pass", None), ("r2", "late_data_rate_pct", "warn", "null_metric"),
        ("r2", "rows_by_run", "fail", "null_metric"), ("r2", "rows_of_run", "fail", None),
    ]
    assert q.new_check_results(results, results).count() == 0
    with pytest.raises(ValueError, match="unknown"):
        q.run_checks(runs, [q.CheckDefinition(9, "unknown", "critical", 1, "=")], tables, NOW)


def test_template_with_several_rows_is_an_error(spark):
    check = q.CheckDefinition(1, "two", "critical", 1, "=", True,
                              "SELECT id AS metric_value FROM range(2) WHERE :run_id IS NOT NULL")
    with pytest.raises(Exception, match="several rows"):
        q.template_metrics(spark.createDataFrame([("r1",)], "run_id string"), check).collect()


def test_value_xor_and_null_rates(spark):
    raw = spark.createDataFrame([(1, None), (None, "x"), (None, None), (1, "x")], "value_num int, value_text string")
    assert q.value_xor_violations(raw).first()[0] == 2
    assert rows(q.null_rates(raw, ["value_num", "value_text"])) == [("value_num", 2, 4, 50.0), ("value_text", 2, 4, 50.0)]


def test_contract_violations_with_aliases(spark):
    metric = spark.createDataFrame([(1, "temp_air_c", "°C", ["air_temp_c"])],
                                   "metric_id long, metric_code string, unit_canonical string, aliases array<string>")
    raw = spark.createDataFrame([("temp_air_c", "°C"), ("air_temp_c", "°F"), ("air_temp_c", None), ("other", "x")],
                                "metric_code string, unit string")
    assert rows(q.contract_violations(raw, metric)) == [("air_temp_c", "unit_mismatch", 2), ("other", "unknown_metric", 1)]


def test_schema_drift(spark):
    raw = spark.createDataFrame(
        [(NOW, "s", '{"a": 1, "b": "x"}'), (NOW, "s", '{"a": "1", "c": [1]}'), (NOW, "s", "not json"),
         (NOW, "s", None), (NOW, "s", "[1]"), (NOW, "t", '{"a": 2, "b": "y"}'), (NOW, "t", "{}")],
        "ingested_at timestamp, source string, source_payload string")
    contract = spark.createDataFrame([("a", "BIGINT"), ("b", "STRING")], "field string, type string")
    got = rows(q.schema_drift(raw, contract), "source", "field", "drift", "n_rows")
    assert got == [
        ("s", "<malformed>", "added", 2), ("s", "a", "missing", 2), ("s", "a", "retyped", 1),
        ("s", "b", "missing", 3), ("s", "c", "added", 1),
        ("t", "a", "missing", 1), ("t", "b", "missing", 1),
    ]


def test_catalogue_reads_active_rows_only(spark):
    row = (1, "c", "critical", Decimal(1), "=", None, True)
    catalogue = spark.createDataFrame([row, (*row[:-1], False)], SCHEMAS["ops_dq_check_definition"])
    assert [d.name for d in q.active_definitions(catalogue)] == ["c"]
