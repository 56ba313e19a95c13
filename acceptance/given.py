"""The given tables and the canonical tables derived from them, as Spark plans.

``acceptance/ctes.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructType, TimestampType

from tidewarden.functions.lookup import constant_frame
from tidewarden.functions.clock import minutes
from tidewarden.operators.detectors import DetectorConfig
from tidewarden.operators.quality import CheckDefinition
from tidewarden.operators.transform import latest_facts, to_facts
from tidewarden.schemas import DECIMAL
from tidewarden.settings import ANOMALY_TYPES, INGEST_JOB, TRANSFORM_JOB, PayloadMetric
from tidewarden.session import shared_folder
from tidewarden.sources.warehouse import staged

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

METRIC_ROWS = [
    (1, "click", "USD", "numeric", 0, 150, True),
    (2, "purchase", "USD", "numeric", 0, 150, True),
    (3, "signup", "USD", "numeric", 0, 200, True),
    (4, "view", "USD", "numeric", 0, 100, False),
]
GRANT_ROWS = [
    ("ana", "analyst", "ASIA", None),
    ("bob", "analyst", None, 1),
    ("bob", "analyst", None, 2),
    ("bob", "analyst", None, 3),
    ("opsy", "ops", None, None),
]
JUMPS = {"click": 50, "purchase": 50, "signup": 50}
EPSILONS = {"click": 100, "purchase": 100, "signup": 100}
DETECTION = DetectorConfig(
    silent_after=12 * 60, stale_after=2 * 1440, jump_lookback=3 * 1440, spike=JUMPS, drop=JUMPS,
    flatline=EPSILONS, flatline_window=15 * 1440, flatline_points=6,
)
CHECKS = [
    CheckDefinition(1, "fact_freshness_minutes", "critical", 120, "<="),
    CheckDefinition(2, "metric_completeness_pct", "warning", 20, ">="),
    CheckDefinition(3, "late_data_rate_pct", "warning", 5, "<="),
    CheckDefinition(4, "late_data_rate_pct_all_time", "critical", 10, "<="),
    CheckDefinition(5, "raw_duplicate_key_count", "warning", 0, "="),
    CheckDefinition(6, "fact_duplicate_key_count", "critical", 0, "="),
    CheckDefinition(7, "stations_missing_any_metric_count_latest_hour", "warning", 0, "<>"),
    CheckDefinition(8, "value_out_of_range_count", "warning", 0, "<=", is_active=False),
]
DOCUMENT_METRICS = (
    PayloadMetric("click", "click_series", "USD"),
    PayloadMetric("purchase", "purchase_series", "USD"),
    PayloadMetric("signup", "signup_series", "USD"),
    PayloadMetric("error", "error_series", "code", "text"),
)
DOCUMENT_TIME = datetime(2024, 1, 30, 12, 0, tzinfo=timezone.utc)

ROWS_PER_FILE = 50_000


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine returns alike: naive UTC times, doubles for decimals."""
    casts = {TimestampType: "timestamp_ntz", DecimalType: "double"}
    return df.select(
        *[F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else f.name
          for f in df.schema.fields]
    )


class Given:
    """Tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        # All times are zoned; one zone makes the casts from naive Parquet times exact.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def load(self, name: str) -> DataFrame:
        rows = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return _zoned(rows)

    # --- dimensions -----------------------------------------------------------

    @cached_property
    def station_core(self) -> DataFrame:
        """Stations without state and region: a projection of one scan, so its size is known."""
        key = F.col("c_custkey")
        return self.load("customer").select(
            key.alias("station_id"),
            key.cast("string").alias("station_external_id"),
            F.col("c_name").alias("station_name"),
            F.when(key % 29 != 0, -90 + key % 180).cast(DECIMAL).alias("lat"),
            (-180 + key % 360).cast(DECIMAL).alias("lon"),
            (key % 11 != 0).alias("is_current"),
            (key % 13 == 0).alias("is_smoketest"),
            "c_nationkey",
        )

    @cached_property
    def station(self) -> DataFrame:
        nation = self.load("nation").join(self.load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        places = nation.select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region"))
        return self.station_core.join(places, F.col("c_nationkey") == F.col("n_nationkey")).drop(
            "c_nationkey", "n_nationkey"
        )

    @cached_property
    def metric(self) -> DataFrame:
        return constant_frame(
            self.spark, METRIC_ROWS,
            f"metric_id bigint, metric_code string, unit_canonical string, value_type string, "
            f"min_expected {DECIMAL}, max_expected {DECIMAL}, is_active boolean",
        )

    @cached_property
    def grants(self) -> DataFrame:
        return constant_frame(
            self.spark, GRANT_ROWS, "user_id string, role string, region string, station_id bigint"
        )

    @cached_property
    def unit_factors(self) -> DataFrame:
        return constant_frame(
            self.spark, [("cents", "USD", 0.01, 0), ("USD", "USD", 1, 0)],
            "unit string, unit_canonical string, factor decimal(9,6), offset decimal(9,6)",
        )

    # --- raw and facts --------------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        return raw_from_events(self.load("events"))

    @cached_property
    def fact(self) -> DataFrame:
        return latest_facts(self.raw, self.station_core, self.metric, ["ingested_at", "id"])

    @cached_property
    def stored_fact(self) -> DataFrame:
        """The facts as a written table, for queries that read them several times."""
        return staged(self.fact, "fact")

    @cached_property
    def fact_rows(self) -> DataFrame:
        """Facts before repeated keys are merged."""
        return to_facts(self.raw, self.station_core, self.metric)

    @cached_property
    def as_of(self) -> Column:
        return self.load("events").agg(F.max("ts")).scalar()

    @cached_property
    def day_runs(self) -> DataFrame:
        """Ledger with one ingest run per day of events."""
        days = self.load("events").select(F.to_date("ts").alias("day")).distinct()
        return days.select(
            F.concat(F.lit("ev-"), F.col("day").cast("string")).alias("run_id"),
            F.lit(INGEST_JOB).alias("job_name"),
            F.when(F.dayofmonth("day") % 7 == 0, "failed").otherwise("succeeded").alias("status"),
            F.date_add("day", 1).cast("timestamp").alias("started_at"),
            F.lit(None).cast("string").alias("parent_run_id"),
        )

    # --- ledger, checks, anomalies, incidents ---------------------------------

    @cached_property
    def runs(self) -> DataFrame:
        orders, line = self.load("orders"), self.load("lineitem")
        ingest = orders.select(
            F.concat(F.lit("i-"), F.col("o_orderkey")).alias("run_id"),
            F.lit(INGEST_JOB).alias("job_name"),
            F.when(F.col("o_orderstatus") == "P", "failed").otherwise("succeeded").alias("status"),
            F.col("o_orderdate").alias("started_at"),
            F.lit(None).cast("string").alias("parent_run_id"),
            (F.col("o_orderkey") % 10).alias("digit"),
        )
        transform = line.select(
            F.concat_ws(
                "-", F.lit("t"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
            ).alias("run_id"),
            F.lit(TRANSFORM_JOB).alias("job_name"),
            F.when(F.col("l_returnflag") == "R", "failed").otherwise("succeeded").alias("status"),
            F.col("l_shipdate").alias("started_at"),
            F.concat(F.lit("i-"), F.col("l_orderkey")).alias("parent_run_id"),
            (F.col("l_orderkey") % 10).alias("digit"),
        )
        return ingest.unionByName(transform)

    @cached_property
    def run_events(self) -> DataFrame:
        empty = {c: F.lit(None).cast("bigint") for c in ("rows_inserted", "rows_updated", "rows_deduped")}
        empty |= {c: F.lit(None).cast("timestamp") for c in ("watermark_from", "watermark_to")}
        runs = self.runs.withColumns({**empty, "error_message": F.lit(None).cast("string")})
        started = runs.withColumns({"status": F.lit("started"), "event_at": F.col("started_at")})
        ended = runs.where("digit <> 0").withColumn("event_at", F.col("started_at") + minutes(60))
        return started.unionByName(ended).drop("started_at", "digit")

    @cached_property
    def check_results(self) -> DataFrame:
        line = self.load("lineitem")
        return line.select(
            F.concat(F.lit("i-"), F.col("l_orderkey")).alias("run_id"),
            F.concat(F.lit("check_"), F.col("l_suppkey") % 8).alias("check_name"),
            F.when(F.col("l_returnflag") == "A", "pass")
            .when(F.col("l_returnflag") == "N", "warn").otherwise("fail").alias("status"),
            F.when(F.col("l_partkey") % 400 != 0, F.col("l_shipdate")).alias("evaluated_at"),
            F.col("l_extendedprice").cast(DECIMAL).alias("metric_value"),
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        )

    @cached_property
    def anomaly(self) -> DataFrame:
        return anomalies_from_events(self.load("events"))

    @cached_property
    def anomaly_types(self) -> DataFrame:
        return constant_frame(self.spark, [(t,) for t in ANOMALY_TYPES], "anomaly_type string")

    @cached_property
    def incident(self) -> DataFrame:
        key, status, opened = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
        kind = F.element_at(F.array(*[F.lit(t) for t in ANOMALY_TYPES]), (key % 5 + 1).cast("int"))
        return self.load("orders").select(
            key.cast("string").alias("incident_id"),
            F.when(status == "O", "open").when(status == "F", "resolved").otherwise("acknowledged").alias("status"),
            F.when(key % 17 != 0, opened).alias("opened_at"),
            opened.alias("created_at"),
            F.when(status == "F", opened + minutes(2 * 1440)).alias("resolved_at"),
            F.when(status.isin("F", "P") & (key % 3 != 0), opened + minutes(1440)).alias("acknowledged_at"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.lower(F.substring("o_orderpriority", 3, 20)))
            .alias("severity"),
            kind.alias("anomaly_type"),
            F.col("o_custkey").alias("station_id"),
            F.when(kind != "silent_station", key % 4 + 1).alias("metric_id"),
            opened.alias("last_seen_at"),
        )

    # --- shapes for the reshaping operators -----------------------------------

    @cached_property
    def documents(self) -> DataFrame:
        """One document per user and day with at most 24 hourly slots.

        The slots are aggregated first, so the arrays are short by construction
        however many events a user has.
        """
        events = self.load("events")
        slots = events.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(
            *[F.max(F.when(F.col("event_type") == m.code, F.col("value"))).alias(m.code) for m in DOCUMENT_METRICS]
        )
        rows = slots.groupBy("user_id", F.to_date("hour").alias("day")).agg(
            F.array_sort(F.collect_list(F.struct("hour", *[m.code for m in DOCUMENT_METRICS]))).alias("s")
        )
        user = F.col("user_id")
        series = {m.field: F.col(f"s.{m.code}") for m in DOCUMENT_METRICS}
        series["error_series"] = F.transform("s.error", lambda v: v.cast("string"))
        series["click_series"] = F.when(user % 7 == 0, F.slice("s.click", 1, 10)).otherwise(F.col("s.click"))
        return rows.select(
            user.cast("string").alias("station_external_id"),
            "day",
            (-90 + user % 180).cast("double").alias("latitude"),
            (-180 + user % 360).cast("double").alias("longitude"),
            F.struct(
                F.transform("s.hour", lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm")).alias("time"),
                *[c.alias(f) for f, c in series.items()],
            ).alias("hourly"),
            F.create_map(
                F.lit("click_series"), F.lit("USD"),
                F.lit("purchase_series"), F.lit(""),
                F.lit("error_series"), F.lit("text"),
            ).alias("hourly_units"),
        )

    @cached_property
    def wide(self) -> DataFrame:
        line = self.load("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax",
        )
        return line.distinct()

    @cached_property
    def station_changes(self) -> DataFrame:
        station = self.station.select("station_id", "station_name", "region")
        moved = F.concat(F.lit("NEW "), F.col("region"))

        def version(rows: DataFrame, day: str, region: Column) -> DataFrame:
            return rows.select(
                "station_id", "station_name", region.alias("region"), F.lit(day).cast("timestamp").alias("valid_from")
            )

        first = version(station, "2024-01-01", F.col("region"))
        second = version(station.where("station_id % 5 = 0"), "2024-01-15", moved)
        third = version(station.where("station_id % 15 = 0"), "2024-01-20", moved)
        return first.unionByName(second).unionByName(third)


def _zoned(rows: DataFrame) -> DataFrame:
    naive = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else rows


def stored_after(props: Column) -> Column:
    """How long after its time an event's row is stored."""
    return minutes(F.get_json_object(props, "$.k").cast("int") * 15)


def raw_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw observations of an event frame; row by row, so it serves streams too. ``keep`` names event columns to carry."""
    key, ts = F.col("event_id"), F.col("ts")
    no_number = (key % 50 == 0) | (key % 101 == 0)
    has_text = ((key % 50 == 0) | (key % 97 == 0)) & (key % 101 != 0)
    return events.select(
        key.alias("id"),
        F.lit("events").alias("source"),
        F.col("user_id").cast("string").alias("station_external_id"),
        F.date_trunc("hour", ts).alias("observed_at"),
        F.col("event_type").alias("metric_code"),
        F.when(~no_number, F.col("value").cast(DECIMAL)).alias("value_num"),
        F.when(has_text, F.col("value").cast("string")).alias("value_text"),
        F.when(key % 10 == 0, "cents").otherwise("USD").alias("unit"),
        F.col("props").alias("source_payload"),
        (ts + stored_after(F.col("props"))).alias("ingested_at"),
        F.concat(F.lit("ev-"), F.to_date(ts).cast("string")).alias("ingest_run_id"),
        *keep,
    )


def ordered_event_stream(g: Given, parts: int = 4, late: bool = False) -> DataFrame:
    """The events as a stream of micro-batches, each with the events that arrived in one span of time.

    ``late``: an event arrives when its row is stored, hours after its time, and not when it happens. Every span is
    written as the same number of files, which is what a micro-batch takes: many events are many files.
    """
    folder = shared_folder(g.spark, "events")
    events = g.spark.read.schema(SCHEMAS["events"]).parquet(f"{g.sf_dir}/events.parquet")
    arrival = F.col("ts") + stored_after(F.col("props")) if late else F.col("ts")
    first, last = events.agg(F.min(arrival), F.max(arrival)).first()
    edges = [first + (last - first) * k / parts for k in range(1, parts)]
    within = []
    for low, high in zip([None, *edges], [*edges, None]):
        after, before = F.lit(True) if low is None else arrival >= F.lit(low), F.lit(True) if high is None else arrival < F.lit(high)
        within.append(after & before)
    sizes = events.agg(*[F.count_if(span) for span in within]).first()
    # Rows are dealt round, so with so many rows to a file none stays empty.
    files = max(1, min(sizes) // ROWS_PER_FILE)
    for span in within:
        # Written one after the other: a file source takes older files first.
        rows = events.where(span)
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.mode("append").parquet(folder)
    reader = g.spark.readStream.schema(StructType.fromDDL(SCHEMAS["events"]))
    return _zoned(reader.option("maxFilesPerTrigger", files).parquet(folder))


def anomalies_from_events(events: DataFrame) -> DataFrame:
    """Anomalies of an event frame; row by row, so it serves streams too."""
    kind = F.col("event_type")
    named = (
        F.when(kind == "click", "spike").when(kind == "view", "drop").when(kind == "signup", "flatline")
        .when(kind == "purchase", "stale_data").when(kind == "error", "silent_station")
    )
    metric_id = F.when(kind != "error", F.col("event_id") % 5 + 1)
    return events.select(
        F.col("event_id").alias("anomaly_id"),
        named.alias("anomaly_type"),
        F.col("ts").alias("detected_at"),
        F.col("user_id").alias("station_id"),
        metric_id.alias("metric_id"),
        F.coalesce(metric_id, F.lit(-1)).alias("metric_id_dedup"),
        F.date_trunc("hour", "ts").alias("detected_hour"),
        F.when(kind == "error", "high").otherwise("medium").alias("severity"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, a file or a folder of files, as a stream."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(StructType.fromDDL(SCHEMAS["events"]))
    # A pattern, because a stream takes a plain path for a folder only.
    stream = reader.parquet(f"{sf_dir.rstrip('/')}/{{events.parquet}}")
    return _zoned(stream)
