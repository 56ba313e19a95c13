"""Directions against a plain version, and the access functions."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewarden.functions import access
from tidewarden.operators import quality
from tidewarden.operators.circular import arcs, turn


def test_turns_go_the_short_way(spark):
    cases = [(350, 10, -20), (10, 350, 20), (0, 180, 180), (180, 0, 180), (90, 90, 0), (0, 359, 1), (720, 1, -1), (1, 720, 1), (270, 89, -179)]
    df = spark.createDataFrame([(Decimal(a), Decimal(b), Decimal(c)) for a, b, c in cases], "a decimal(18,6), b decimal(18,6), c decimal(18,6)")
    assert df.where(turn(F.col("a") - F.col("b")) != F.col("c")).count() == 0


def plain(values):
    angles = sorted({Decimal(str(v)) % 360 for v in values if v is not None})
    angles = sorted({a + 360 if a < 0 else a for a in angles})
    if not angles:
        return None
    gaps = [b - a for a, b in zip(angles, angles[1:])] + [360 - angles[-1] + angles[0]]
    return 360 - max(gaps)


def test_arcs_agree_with_sorted_gaps(spark):
    rng = random.Random(5)
    keys = {
        1: [rng.randrange(350, 371) for _ in range(40)], 2: [rng.uniform(0, 360) for _ in range(500)], 3: [5.5] * 30, 4: [None],
        5: [0, 180], 6: [359.999999, 0], 7: [k / 2 for k in range(720)], 8: [-10, 370, 730, None], 9: [10.25, 10.75, 10.5],
    }
    data = [(k, None if v is None else Decimal(str(round(v, 6)))) for k, values in keys.items() for v in values]
    got = arcs(spark.createDataFrame(data, "k int, v decimal(18,6)"), ["k"], "v", "arc")
    want = {k: plain([None if v is None else round(v, 6) for v in values]) for k, values in keys.items()}
    assert {r.k: r.arc for r in got.collect()} == {k: w for k, w in want.items() if w is not None}


def test_access_functions_follow_the_user(spark):
    grants = spark.createDataFrame([("ana", "analyst", "N", None), ("bob", "analyst", None, 2), ("o'ps", "ops", None, None), ("nil", None, None, None)],
                                   "user_id string, role string, region string, station_id long")
    access.register_access_functions(spark, grants)
    spark.createDataFrame([(1, "N"), (2, "S"), (3, None)], "station_id long, region string").createOrReplaceTempView("places")

    def seen(user):
        access.as_user(spark, user)
        return [s for (s,) in rows(spark.sql("SELECT station_id FROM places WHERE can_access_station(station_id, region)"))]

    assert {u: seen(u) for u in ("ana", "bob", "o'ps", "nil", "x' OR '1'='1", None)} == {
        "ana": [1], "bob": [2], "o'ps": [1, 2, 3], "nil": [], "x' OR '1'='1": [], None: []}
    access.as_user(spark, "bob")
    roles = spark.sql("SELECT is_role('analyst') AS a, is_role('ops') AS b").first()
    assert (roles.a, roles.b) == (True, False)


@pytest.mark.parametrize("template, per_run", [
    ("SELECT 1 AS metric_value WHERE 'a' = :run_id", True), ("SELECT ':run_id' AS metric_value", False), ("SELECT 1 -- :run_id", False),
    ("SELECT 1 /* :run_id\n:run_id */", False), ('SELECT 1 AS `:run_id`, "it\'s :run_id"', False), ("SELECT ':run_id', :run_id", True),
    ("SELECT :run_identity", False), ("SELECT 'it\\'s' || :run_id", True),
])
def test_only_a_parameter_is_bound(template, per_run):
    assert quality.CheckDefinition(1, "t", "warning", 1, "=", True, template).per_run is per_run
