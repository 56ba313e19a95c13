import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewarden.operators import security


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "dim_station": spark.createDataFrame(
            [(1, "N", False), (2, "N", False), (3, "S", False), (4, None, True)],
            "station_id long, region string, is_smoketest boolean"),
        "fact_observation": spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30), (4, 40)], "station_id long, v int"),
        "raw_observations": spark.createDataFrame([(1,)], "id long"),
        "dim_metric": spark.createDataFrame([(1,), (2,)], "metric_id long"),
        "authz_user_access": spark.createDataFrame(
            [("region", "analyst", "N", None), ("station", "analyst", None, 3), ("both", "analyst", "N", None),
             ("both", "analyst", None, 1), ("both", "analyst", None, 3), ("both", "analyst", None, 3),
             ("ops", "ops", None, None)],
            "user_id string, role string, region string, station_id long"),
    }


@pytest.mark.parametrize(("user", "stations", "facts"), [
    ("region", [1, 2], 3), ("station", [3], 1), ("both", [1, 2, 3], 4), ("ops", [1, 2, 3, 4], 5), ("anon", [], 0),
])
def test_scope(tables, user, stations, facts):
    assert rows(security.secure("dim_station", tables, user), "station_id") == [(s,) for s in stations]
    assert security.secure("fact_observation", tables, user).count() == facts


def test_facts_of_all_users_are_facts(tables):
    fact = tables["fact_observation"]
    for user in ("region", "station", "both", "ops", "anon"):
        assert security.secure("fact_observation", tables, user).exceptAll(fact).count() == 0


def test_role_gates(tables):
    seen = {
        (t, u): security.secure(t, tables, u).count()
        for t in ("raw_observations", "dim_metric", "authz_user_access") for u in ("region", "ops", "anon")
    }
    assert seen == {
        ("raw_observations", "region"): 0, ("raw_observations", "ops"): 1, ("raw_observations", "anon"): 0,
        ("dim_metric", "region"): 2, ("dim_metric", "ops"): 2, ("dim_metric", "anon"): 0,
        ("authz_user_access", "region"): 1, ("authz_user_access", "ops"): 1, ("authz_user_access", "anon"): 0,
    }


def test_public_metadata_opens_stations_but_no_facts(tables):
    public = F.col("is_smoketest")
    assert rows(security.secure("dim_station", tables, "anon", public), "station_id") == [(4,)]
    assert security.secure("fact_observation", tables, "anon", public).count() == 0


def test_audit_passes_and_can_fail(tables):
    passing = rows(security.access_audit(tables, "anon", "station", "ops", F.col("is_smoketest")))
    assert len(passing) == 10 and {r for _, r in passing} == {"PASS"}
    # A region grant widens the scope beyond the granted station ids.
    verdicts = dict(rows(security.access_audit(tables, "anon", "both", "region", F.lit(False))))
    failed = {name for name, result in verdicts.items() if result == "FAIL"}
    assert failed == {"anon_reads_stations", "analyst_station_scope", "analyst_fact_scope", "ops_reads_raw"}
