"""Grant-filtered reads.

These are data operators: they return what a user may see. They do not stop anybody
who can read the files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Who may read which table.
#   ops             role ops
#   ops_or_analyst  role ops or analyst
#   self            own rows
#   station         stations in scope
#   fact            rows whose station is in scope
READ_POLICIES = {
    "authz_user_access": "self",
    "dim_metric": "ops_or_analyst",
    "dim_station": "station",
    "fact_observation": "fact",
    "ops_anomaly": "ops",
    "ops_anomaly_detector_run": "ops",
    "ops_anomaly_type": "ops_or_analyst",
    "ops_dq_check_definition": "ops",
    "ops_dq_check_run": "ops",
    "ops_incident": "ops",
    "ops_incident_anomaly": "ops",
    "ops_job_run": "ops",
    "raw_observations": "ops",
}


def has_role(grants: DataFrame, user: str, *roles: str) -> Column:
    """Whether ``user`` holds one of ``roles``: an uncorrelated EXISTS, evaluated once."""
    held = grants.where((F.col("user_id") == user) & F.col("role").isin(*roles))
    return held.select(F.lit(1)).exists()


def visible_stations(
    station: DataFrame, grants: DataFrame, user: str, public: Column | None = None
) -> DataFrame:
    """Stations ``user`` may see: all for ops, else those granted by id or by region.

    Two equality joins with distinct grants replace an OR join; neither repeats a
    station. ``public`` marks metadata open to everybody, also without grants.
    """
    own = grants.where(F.col("user_id") == user)
    by_id = own.select("station_id").distinct().withColumn("_by_id", F.lit(True))
    by_region = own.select("region").distinct().withColumn("_by_region", F.lit(True))
    flagged = station.join(by_id, "station_id", "left").join(by_region, "region", "left")
    allowed = has_role(grants, user, "ops") | F.col("_by_id").isNotNull() | F.col("_by_region").isNotNull()
    if public is not None:
        allowed = allowed | public
    return flagged.where(allowed).select(*station.columns)


def visible_facts(fact: DataFrame, station: DataFrame, grants: DataFrame, user: str) -> DataFrame:
    """Facts of the stations in scope."""
    scope = visible_stations(station, grants, user).select("station_id")
    return fact.join(scope, "station_id", "left_semi").select(*fact.columns)


def secure(
    name: str,
    tables: Mapping[str, DataFrame],
    user: str,
    public_stations: Column | None = None,
) -> DataFrame:
    """Table ``name`` as ``user`` sees it; an empty frame where nothing is allowed."""
    df, grants = tables[name], tables["authz_user_access"]
    policy = READ_POLICIES[name]
    if policy == "self":
        return df.where(F.col("user_id") == user)
    if policy == "station":
        return visible_stations(df, grants, user, public_stations)
    if policy == "fact":
        return visible_facts(df, tables["dim_station"], grants, user)
    roles = ("ops",) if policy == "ops" else ("ops", "analyst")
    return df.where(has_role(grants, user, *roles))


def access_audit(
    tables: Mapping[str, DataFrame],
    anonymous: str,
    analyst: str,
    ops: str,
    public_stations: Column,
) -> DataFrame:
    """One row ``(check_name, result)`` per access rule, PASS or FAIL.

    ``analyst`` is a user with grants by station. Counts and set differences are
    computed on the secured frames, each as one scalar.
    """
    spark = tables["dim_station"].sparkSession

    def seen(table: str, user: str) -> DataFrame:
        return secure(table, tables, user, public_stations if user == anonymous else None)

    def any_row(df: DataFrame) -> Column:
        return df.select(F.lit(1)).exists()

    granted = tables["authz_user_access"].where(F.col("user_id") == analyst).select("station_id").distinct()
    stations = seen("dim_station", analyst).select("station_id").distinct()
    fact_stations = seen("fact_observation", analyst).select("station_id")
    own_users = seen("authz_user_access", ops).select("user_id").distinct()
    two_stations = tables["dim_station"].select("station_id").distinct().limit(2)

    def size(df: DataFrame) -> Column:
        return df.agg(F.count("*")).scalar()

    rules = {
        "precond_stations": size(two_stations) >= 2,
        "precond_facts": any_row(tables["fact_observation"]),
        "anon_no_facts": ~any_row(seen("fact_observation", anonymous)),
        "anon_reads_stations": any_row(seen("dim_station", anonymous)),
        "analyst_no_raw": ~any_row(seen("raw_observations", analyst)),
        "analyst_station_scope": (size(granted) > 0)
        & (size(stations) == size(granted))
        & ~any_row(stations.subtract(granted)),
        "analyst_fact_scope": any_row(fact_stations) & ~any_row(fact_stations.subtract(granted)),
        "ops_reads_facts": any_row(seen("fact_observation", ops)),
        "ops_reads_raw": any_row(seen("raw_observations", ops)),
        "grants_isolated": (size(own_users) == 1) & (own_users.agg(F.max("user_id")).scalar() == ops),
    }
    one_row = spark.range(1)
    verdicts = one_row.select(
        *[F.when(rule, "PASS").otherwise("FAIL").alias(name) for name, rule in rules.items()]
    )
    return verdicts.unpivot([], list(rules), "check_name", "result")
