"""Merges as pure functions: latest-wins upsert, insert-or-ignore, history.

Plain Parquet has no ``MERGE INTO``. Every merge here is one plan over target and
source, safe for hot keys: whatever is reduced per key is reduced on the map side
before the shuffle, so copies of one key never meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    Planned as a group limit on both sides of the exchange: every map task sends
    at most ``n`` rows per key. Columns not used later are pruned from the scan.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; ``order`` names the columns that decide, nulls oldest."""
    return first_per_key(rows, keys, [F.desc_nulls_last(c) for c in order])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str], newest_wins: bool = False
) -> DataFrame:
    """Merge ``source`` over ``target``; source rows win, later ones over earlier ones.

    With ``newest_wins`` a target row that is newer by ``order`` stays, so batches may
    arrive in any order. Where the target holds all columns of ``order`` the result does
    not depend on that order at all; a target row without one is older on a tie.

    Result: the merged rows plus ``action`` (kept / inserted / updated) and the
    statement counts ``n_inserted`` and ``n_updated``: of several source rows for a
    new key, the first counts as an insert and the rest as updates. One exchange
    carries everything; the winner is a combined ``max_by``.
    """
    columns = target.columns
    payload = [c for c in columns if c not in keys]
    extra_order = [c for c in order if c not in columns]
    target_rows = target.withColumns(
        {"_is_source": F.lit(False), **{c: F.lit(None).cast(source.schema[c].dataType) for c in extra_order}}
    )
    source_rows = source.select(*columns, *extra_order, F.lit(True).alias("_is_source"))
    ranked = [*order, "_is_source"] if newest_wins else ["_is_source", *order]
    merged = (
        target_rows.unionByName(source_rows)
        .groupBy(*keys)
        .agg(
            F.max_by(F.struct(*payload), F.struct(*ranked)).alias("_row"),
            F.count_if(~F.col("_is_source")).alias("_n_target"),
            F.count_if("_is_source").alias("_n_source"),
        )
    )
    is_new = (F.col("_n_target") == 0).cast("bigint")
    action = (
        F.when(F.col("_n_source") == 0, "kept").when(F.col("_n_target") == 0, "inserted").otherwise("updated")
    )
    return merged.select(
        *keys,
        *[F.col(f"_row.{c}").alias(c) for c in payload],
        action.alias("action"),
        is_new.alias("n_inserted"),
        (F.col("_n_source") - is_new).alias("n_updated"),
    )


def upsert_counts(merged: DataFrame) -> DataFrame:
    """Statement counters of an :func:`upsert`. Nothing is ever counted as deduped:
    a repeated key is an update."""
    touched = merged.where(F.col("action") != "kept")
    return touched.agg(
        F.coalesce(F.sum("n_inserted"), F.lit(0)).cast("bigint").alias("rows_inserted"),
        F.coalesce(F.sum("n_updated"), F.lit(0)).cast("bigint").alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deduped"),
    )


def insert_or_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Source rows that a sequence of "insert, on conflict do nothing" would store.

    The first source row per key in ``order``, unless the target has the key. Keys are
    not null (nullable parts have a stand-in column for this). The reduced source
    keeps its partitioning for the anti join, so it is shuffled once; of the target
    only the key columns are read.
    """
    known = target.select(*keys)
    return first_per_key(source, keys, order).join(known, list(keys), "left_anti").select(*source.columns)


def history(
    changes: DataFrame, key: str, attributes: Sequence[str], valid_from: str, bucket: Column | None = None
) -> DataFrame:
    """Type-2 history from a change feed: versions with ``valid_from``, ``valid_to``, ``is_current``.

    A change that repeats the attributes of the one before it opens no version.
    Rows of one key and instant are reduced first (largest attributes win), so
    their order in the feed does not matter. ``bucket`` (default: the day) bounds the
    task size for a key with very many changes, see :func:`neighbour`.
    """
    bucket = F.to_date(valid_from) if bucket is None else bucket
    # A maximum over the attributes as one value combines before the exchange.
    points = (
        changes.groupBy(key, valid_from)
        .agg(F.max(F.struct(*attributes)).alias("_attributes"))
        .withColumn("_bucket", bucket)
    )
    compared = neighbour(points, key, valid_from, "_attributes", "_before", back=True)
    opened = compared.where(F.col("_before").isNull() | ~F.col("_attributes").eqNullSafe(F.col("_before")))
    opened = opened.select(key, valid_from, "_attributes", "_bucket")
    closed = neighbour(opened, key, valid_from, valid_from, "valid_to", back=False)
    return closed.select(
        key,
        *[F.col(f"_attributes.{a}").alias(a) for a in attributes],
        F.col(valid_from).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def neighbour(df: DataFrame, key: str, time: str, value: str, name: str, back: bool) -> DataFrame:
    """``lag`` / ``lead`` of ``value`` per key in two levels, so no task holds a whole key.

    Inside each ``(key, _bucket)`` a window gives the neighbour. The rows at a
    bucket's edge take the edge value of the nearest other bucket of the key, found
    with a window over one summary row per bucket.
    """
    inner = Window.partitionBy(key, "_bucket").orderBy(time)
    step = F.lag if back else F.lead
    edge = F.max_by if back else F.min_by
    outer = Window.partitionBy(key).orderBy("_bucket")
    edges = (
        df.groupBy(key, "_bucket")
        .agg(edge(F.col(value), F.col(time)).alias("_edge"))
        .select(key, "_bucket", step("_edge").over(outer).alias("_edge"))
    )
    return (
        df.withColumn(name, step(value).over(inner))
        .join(edges, [key, "_bucket"], "left")
        .withColumn(name, F.coalesce(name, "_edge"))
        .drop("_edge")
    )
