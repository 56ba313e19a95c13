"""Directions in degrees, which wrap at 360."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FULL = 360


def turn(difference: Column) -> Column:
    """The difference of two directions the short way round, above -180 and up to 180."""
    half = F.lit(FULL // 2)
    return half - F.pmod(half - difference, F.lit(FULL))


def arcs(rows: DataFrame, keys: Sequence[str], direction: str, name: str) -> DataFrame:
    """Length of the smallest arc that holds all directions of a key: 360 less the largest gap.

    Directions are reduced to distinct ones on the map side, however many rows a key has. Gaps are
    looked for inside sectors of one degree and then between the edges of a key's sectors,
    so no task sorts more than one sector's values. Nulls are left out; one direction has arc 0.
    """
    angle, sector = F.col("_angle"), F.col("_sector")
    distinct = rows.where(F.col(direction).isNotNull()).select(*keys, F.pmod(F.col(direction), F.lit(FULL)).alias("_angle")).distinct()
    dealt = distinct.withColumn("_sector", F.floor(angle).cast("int"))
    inside = Window.partitionBy(*keys, "_sector").orderBy("_angle")
    edges = (
        dealt.withColumn("_step", angle - F.lag(angle).over(inside))
        .groupBy(*keys, "_sector")
        .agg(F.max("_step").alias("_inner"), F.min("_angle").alias("_low"), F.max("_angle").alias("_high"))
    )
    around = Window.partitionBy(*keys).orderBy("_sector")
    gaps = edges.withColumn("_outer", F.col("_low") - F.lag("_high").over(around))
    over_north = FULL - F.max("_high") + F.min("_low")
    return gaps.groupBy(*keys).agg(
        (FULL - F.greatest(over_north, F.max("_outer"), F.max("_inner"))).alias(name)
    )
