"""Small constants as literals or as frames whose size the optimizer knows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timezone
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DecimalType, StructType, TimestampType

from tidewarden.schemas import DECIMAL


def constant_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Frame over driver constants.

    Built from an Arrow table, so it is planned as a local relation with a known
    size: joins with it become broadcast joins by the usual threshold, without a
    hint. (A frame from a Python list has unknown, i.e. huge, estimated size.)
    """
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns: dict[str, list[Any]] = {}
    for i, field in enumerate(struct.fields):
        values = [row[i] for row in rows]
        if isinstance(field.dataType, DecimalType):
            step = Decimal(1).scaleb(-field.dataType.scale)
            values = [None if v is None else Decimal(str(v)).quantize(step) for v in values]
        if isinstance(field.dataType, TimestampType):
            # As everywhere in PySpark, a datetime without a zone is local time.
            values = [None if v is None else v.astimezone(timezone.utc) for v in values]
        columns[field.name] = values
    return spark.createDataFrame(pa.Table.from_pydict(columns, schema=to_arrow_schema(struct)), struct)


def metric_limits(metric: DataFrame, config: Mapping[str, Any] | DataFrame, name: str) -> DataFrame:
    """``(metric_id, metric_code, name)`` of the metrics that have a configured limit.

    A metric is looked up by its code, then by the names in an ``aliases`` array. The
    configuration is a mapping, which becomes one literal map, or a
    ``(metric_code, threshold)`` frame. Both sides are as small as the dictionary.
    """
    names = metric.select("metric_id", "metric_code", F.posexplode(metric_names(metric)).alias("_nth", "_name"))
    if isinstance(config, DataFrame):
        pairs = config.select(F.col("metric_code").alias("_name"), F.col("threshold").cast(DECIMAL).alias(name))
        found = names.join(pairs, "_name")
    else:
        found = names.withColumn(name, _config_lookup(config, F.col("_name")))
    return (
        found.where(F.col(name).isNotNull())
        .groupBy("metric_id", "metric_code")
        .agg(F.min_by(name, "_nth").alias(name))
    )


def metric_names(metric: DataFrame) -> Column:
    """All names of a metric: the code first, then the aliases if the frame has them."""
    codes = F.array("metric_code")
    if "aliases" in metric.columns:
        codes = F.array_distinct(F.concat(codes, F.coalesce("aliases", F.array().cast("array<string>"))))
    return codes


def _config_lookup(config: Mapping[str, Any], code: Column) -> Column:
    entries: list[Column] = []
    for key, value in config.items():
        entries += [F.lit(key), F.lit(Decimal(str(value))).cast(DECIMAL)]
    if not entries:
        return F.lit(None).cast(DECIMAL)
    return F.try_element_at(F.create_map(*entries), code)
