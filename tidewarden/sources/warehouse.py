"""Tables on Parquet: one folder per table, explicit schemas, three ways of writing.

* **merged** tables (facts) are partitioned by day; a merge reads and replaces only
  the days its batch touches (dynamic partition overwrite, staged and then moved). The
  newest rows of every series are kept beside them, in buckets that are merged alike.
* **log** tables (raw, ledger, incidents) only grow; their current state is a fold on
  read, so nothing is updated in place and a rerun adds equal rows.
* **insert-only** tables (anomalies, links, check results) get rows that an
  insert-or-ignore found new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tidewarden.functions.lookup import constant_frame
from tidewarden.operators.ledger import ledger_state
from tidewarden.operators.merge import first_per_key, latest_wins, upsert
from tidewarden.operators.series import SERIES, newest_rows
from tidewarden.operators.transform import TIES
from tidewarden.schemas import KEYS, SCHEMAS
from tidewarden.session import shared_folder

# Partition column and the time it is the day of.
DAYS = {
    "raw_observations": ("observed_date", "observed_at"),
    "fact_observation": ("observed_date", "observed_at"),
    "ops_anomaly": ("detected_date", "detected_at"),
}
# The summary of the series is dealt over so many buckets; a merge replaces those of the series it touches.
HEADS, HEAD_BUCKETS = "series_head", 64
# One order decides between rows of a fact key, in a batch, across batches and in the summary.
FACT_ORDER = ["ingested_at", *TIES]


def partition_of(name: str) -> tuple[StructField, Column] | None:
    """Partition column of a table and how a row gets it."""
    if name in DAYS:
        column, time = DAYS[name]
        return StructField(column, DateType()), F.to_date(time)
    if name == HEADS:
        return StructField("bucket", IntegerType()), F.pmod(F.xxhash64(*SERIES), F.lit(HEAD_BUCKETS)).cast("int")
    return None


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage where a result is used several times; survives lost executors.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_counted(df: DataFrame, purpose: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`staged`, with aggregates of the rows that the write computes on its way: no
    second job reads them. Without ``metrics`` it is the number of rows, ``n``."""
    seen = Observation()
    named = metrics or {"n": F.count(F.lit(1))}
    out = staged(df.observe(seen, *[c.alias(name) for name, c in named.items()]), purpose)
    return out, seen.get


def few_values(df: DataFrame, column: str, limit: int = 200) -> list | None:
    """The values of a column if there are at most ``limit``, else None."""
    found = [r[0] for r in df.select(column).distinct().limit(limit + 1).collect()]
    return found if len(found) <= limit else None


def touched_days(batch: DataFrame, day: Column, partition: str) -> Column:
    """Partition filter for the days of a batch, as a list of literals: exactly these
    partitions are read or replaced. It has a value per calendar day, not per row."""
    return F.col(partition).isin([r.d for r in batch.select(day.alias("d")).distinct().collect()])


class Warehouse:
    """The stored tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored_schema(self, name: str) -> StructType:
        fields = list(SCHEMAS[name].fields)
        if name == "ops_incident":
            fields.append(StructField("version_at", SCHEMAS[name]["created_at"].dataType))
        if part := partition_of(name):
            fields.append(part[0])
        return StructType(fields)

    def stored(self, name: str) -> DataFrame:
        """Rows as written, with the partition column; empty before the first write."""
        schema = self.stored_schema(name)
        if not self._written(name):
            return constant_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def _written(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self, name: str) -> DataFrame:
        """Current state of a table."""
        if name == "ops_job_run":
            return ledger_state(self.stored("ops_job_event"))
        if name == "raw_observations":
            return self.current_raw(F.lit(True))
        if name == "ops_run_day":
            # A rerun notes its days again.
            return self.stored(name).groupBy("run_id", "observed_date").agg(F.max("n_rows").alias("n_rows"))
        if name == "ops_anomaly_detector_run":
            # Attempts of a rerun have later starts; of one attempt the end comes after the start.
            rows = self.stored(name).withColumn("_closed", F.col("status") != "started")
            folded = latest_wins(rows, ["run_id", "detector_name"], ["started_at", "_closed"])
            return folded.select(*SCHEMAS[name].fieldNames())
        if name == "ops_incident":
            folded = latest_wins(self.stored(name), ["incident_id"], ["version_at"])
            return folded.select(*SCHEMAS[name].fieldNames())
        return self.stored(name).select(*SCHEMAS[name].fieldNames())

    def heads(self) -> DataFrame:
        """The summary of the series. Facts from before there was one are summarised first."""
        if not self._written(HEADS) and self._written("fact_observation"):
            self.rebuild_heads()
        return self.stored(HEADS).select(*SCHEMAS[HEADS].fieldNames())

    def rebuild_heads(self) -> None:
        """The summary of the series anew from all facts."""
        self._write(HEADS, newest_rows(self.stored("fact_observation")), "overwrite")

    def current_raw(self, days: Column, runs: DataFrame | None = None) -> DataFrame:
        """Newest raw row per key on the given days.

        With ``runs`` (``run_id``) only keys that these runs wrote are folded. Few runs become
        a filter of the scan, so files and row groups of other runs are skipped.
        """
        rows = self.stored("raw_observations").where(days)
        if runs is not None:
            few = few_values(runs, "run_id")
            mine = rows.where(F.col("ingest_run_id").isin(few)) if few is not None else rows.join(
                runs.select(F.col("run_id").alias("ingest_run_id")), "ingest_run_id", "left_semi")
            keys = KEYS["raw_observations"]
            rows = rows.join(mine.select(*keys).distinct(), keys, "left_semi")
        newest = latest_wins(rows, KEYS["raw_observations"], ["ingested_at", "ingest_run_id", "value_num", "value_text"])
        return newest.select(*SCHEMAS["raw_observations"].fieldNames())

    def append(self, name: str, df: DataFrame) -> None:
        self._write(name, df, "append")

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace a whole unpartitioned table, e.g. a dimension. Not with a frame read from it."""
        self._write(name, df, "overwrite")

    def merge_facts(self, facts: DataFrame, newest_wins: bool = False) -> None:
        """Upsert facts into the days they touch, and their newest rows into the summary.

        ``facts`` has one row per key. A merge that is repeated changes nothing.
        """
        self._merge_days(facts, newest_wins)
        self._merge_heads(facts, newest_wins)

    def _merge_heads(self, facts: DataFrame, newest_wins: bool) -> None:
        """Two rows per series of the batch meet the stored two of the same buckets.

        A row of the batch that is not among its series' newest two cannot be among the
        merged two, so the facts are read no further.
        """
        part, bucket = partition_of(HEADS)
        fresh = staged(newest_rows(facts).withColumn(part.name, bucket), "fresh-heads")
        touched = [r[0] for r in fresh.select(part.name).distinct().collect()]
        columns = SCHEMAS[HEADS].fieldNames()
        target = self.stored(HEADS).where(F.col(part.name).isin(touched)).select(*columns)
        merged = upsert(target, fresh.select(*columns), KEYS["fact_observation"], FACT_ORDER, newest_wins)
        self._write(HEADS, first_per_key(merged.select(*columns), SERIES, [F.desc("observed_at")], 2), "overwrite")

    def _merge_days(self, facts: DataFrame, newest_wins: bool) -> None:
        name = "fact_observation"
        partition, time = DAYS[name]
        days = touched_days(facts, F.to_date(time), partition)
        columns = SCHEMAS[name].fieldNames()
        target = self.stored(name).where(days).select(*columns)
        merged = upsert(target, facts, KEYS[name], FACT_ORDER, newest_wins)
        self._write(name, merged.select(*columns), "overwrite")

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        stored, part = self.stored_schema(name), partition_of(name)
        if part:
            # Even-sized output per day or bucket: a hot one is split, quiet ones share a task.
            df = df.withColumn(part[0].name, part[1]).hint("rebalance", part[0].name)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in stored.fields])
        writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        if part:
            writer = writer.partitionBy(part[0].name)
        writer.parquet(self.path(name))
        self.spark.catalog.refreshByPath(self.path(name))
