"""Access rules as functions of the session, for use in SQL by its current user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GRANTS, USER = "access_grants", "access_user"


def register_access_functions(spark: SparkSession, grants: DataFrame) -> None:
    """``is_role(wanted)`` and ``can_access_station(station, area)`` over ``grants`` for the session's user.

    Both are SQL functions, whose bodies Spark puts into the query. The user's roles are one
    uncorrelated lookup, evaluated once; the two ways in which a station is granted become joins by
    equality. Nothing pairs stations with grants. The user is the session variable that
    :func:`as_user` sets; without one nothing is visible.
    """
    grants.createOrReplaceTempView(GRANTS)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {USER} STRING")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION is_role(wanted STRING) RETURNS BOOLEAN
        RETURN array_contains((SELECT collect_set(role) FROM {GRANTS} WHERE user_id = {USER}), wanted)""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION can_access_station(station BIGINT, area STRING) RETURNS BOOLEAN
        RETURN is_role('ops')
            OR station IN (SELECT station_id FROM {GRANTS} WHERE user_id = {USER})
            OR area IN (SELECT region FROM {GRANTS} WHERE user_id = {USER})""")


def as_user(spark: SparkSession, user: str | None) -> None:
    """Queries built from now on are those of ``user``; the name is bound, not put into the text."""
    spark.sql(f"SET VAR {USER} = :who", args={"who": user})
