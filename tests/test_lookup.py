from datetime import datetime, timedelta, timezone
from decimal import Decimal

from conftest import rows
from tidewarden.functions.lookup import constant_frame, metric_limits


def test_constants_have_a_known_size(spark):
    small = constant_frame(spark, [(1, "a")], "k int, v string")
    joined = spark.range(0, 10**6).selectExpr("CAST(id AS INT) AS k").join(small, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_times_keep_their_instant(spark):
    zoned = datetime(2024, 1, 1, 12, tzinfo=timezone(timedelta(hours=5)))
    df = constant_frame(spark, [(zoned, Decimal("1.5")), (None, None)], "t timestamp, d decimal(18,6)")
    assert rows(df.selectExpr("date_format(t, 'HH:mm')", "d")) == [("07:00", Decimal("1.500000")), (None, None)]


def test_limits_by_code_then_alias(spark):
    metric = spark.createDataFrame(
        [(1, "a", ["b", "c"]), (2, "d", None), (3, "e", ["c"])], "metric_id long, metric_code string, aliases array<string>")
    limits = {"b": 1, "c": 2, "a": 3, "x": 9}
    expected = [(1, "a", Decimal(3)), (3, "e", Decimal(2))]
    assert rows(metric_limits(metric, limits, "limit")) == expected
    frame = spark.createDataFrame([(k, float(v)) for k, v in limits.items()], "metric_code string, threshold double")
    assert rows(metric_limits(metric, frame, "limit")) == expected
