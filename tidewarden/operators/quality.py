"""Data-quality metrics, status evaluation and the set-wise check runner."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewarden.functions.clock import Instant, elapsed_minutes, instant
from tidewarden.functions.lookup import constant_frame
from tidewarden.functions.text import digest
from tidewarden.operators.merge import insert_or_ignore
from tidewarden.operators.series import last_seen_by_series, newest_observation, since
from tidewarden.operators.transform import metric_lookup
from tidewarden.schemas import DECIMAL, KEYS, SCHEMAS

METRIC = "metric_value"


def _percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` of two counts; null for an empty whole."""
    ratio = F.lit(100) * part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return F.round(ratio, 6)


# --- one-row metrics ---------------------------------------------------------


def freshness_minutes(fact: DataFrame, as_of: Instant = None) -> DataFrame:
    """Age of the series that has been quiet the longest."""
    oldest = last_seen_by_series(fact).agg(F.min("last_observed_at").alias("oldest"))
    return oldest.select(F.round(elapsed_minutes(instant(as_of), F.col("oldest")), 2).alias(METRIC))


def completeness_pct(fact: DataFrame, metric: DataFrame) -> DataFrame:
    """Mean over stations of the share of active metrics present at the station's latest time.

    A metric is present then exactly if its own latest time is the station's, so the
    series maxima suffice.
    """
    active = metric.where("is_active").select("metric_id", F.lit(True).alias("_active"))
    latest = last_seen_by_series(fact).join(active, "metric_id", "left")
    present = latest.groupBy("station_id", "last_observed_at").agg(F.count("_active").alias("_present"))
    per_station = present.groupBy("station_id").agg(F.max_by("_present", "last_observed_at").alias("_present"))
    n_active = metric.where("is_active").agg(F.count("*")).scalar()
    totals = per_station.agg(F.sum("_present").alias("present"), F.count("*").alias("stations"))
    return totals.select(_percent(F.col("present"), F.col("stations") * n_active).alias(METRIC))


def late_rate_pct(fact: DataFrame) -> DataFrame:
    """Share of late facts over all time."""
    return fact.agg(_percent(F.count_if("is_late"), F.count("is_late")).alias(METRIC))


def late_rate_by_run(fact: DataFrame) -> DataFrame:
    """Share of late facts per ingest run."""
    rate = _percent(F.count_if("is_late"), F.count("is_late"))
    return fact.groupBy(F.col("ingest_run_id").alias("run_id")).agg(rate.alias(METRIC))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    return repeated.agg(F.count("*").alias(METRIC))


def stations_missing_metric(fact: DataFrame, station: DataFrame, metric: DataFrame) -> DataFrame:
    """Monitored stations without every active metric in the newest hour.

    Counts distinct metrics per station instead of pairing stations with metrics.
    """
    hour = F.date_trunc("hour", newest_observation(fact))
    active = metric.where("is_active").select("metric_id")
    seen = (
        since(fact, "observed_at", hour, "observed_date")
        .join(active, "metric_id", "left_semi")
        .groupBy("station_id")
        .agg(F.count_distinct("metric_id").alias("_seen"))
    )
    expected = station.where("is_current AND NOT is_smoketest").select("station_id")
    n_active = active.agg(F.count("*")).scalar()
    missing = expected.join(seen, "station_id", "left").where(F.coalesce("_seen", F.lit(0)) < n_active)
    return missing.agg(F.count("*").alias(METRIC))


def out_of_range(fact: DataFrame, metric: DataFrame) -> DataFrame:
    """Facts outside the expected range of their metric. A warning, so nothing is removed."""
    limits = metric.select("metric_id", "min_expected", "max_expected")
    value = F.col("value_num")
    outside = (value < F.col("min_expected")) | (value > F.col("max_expected"))
    return fact.join(limits, "metric_id").agg(F.count_if(outside).alias(METRIC))


def value_xor_violations(raw: DataFrame) -> DataFrame:
    """Raw rows with both or neither of the numeric and the text value."""
    both_or_neither = F.col("value_num").isNotNull() == F.col("value_text").isNotNull()
    return raw.agg(F.count_if(both_or_neither).alias(METRIC))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all in one pass: ``(column_name, n_null, n_rows, null_pct)``."""
    counts = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["n_rows"], list(columns), "column_name", "n_null")
    return long.select(
        "column_name", "n_null", "n_rows", _percent(F.col("n_null"), F.col("n_rows")).alias("null_pct")
    )


def contract_violations(raw: DataFrame, metric: DataFrame) -> DataFrame:
    """Raw rows by code whose metric is unknown or whose unit is not the canonical one.

    Reduced to (code, unit) counts before the dictionary is looked up.
    """
    by_code = raw.groupBy("metric_code", "unit").agg(F.count("*").alias("n_rows"))
    units = metric_lookup(metric).join(metric.select("metric_id", "unit_canonical"), "metric_id")
    joined = by_code.join(units.select("metric_code", "unit_canonical"), "metric_code", "left")
    problem = F.when(F.col("unit_canonical").isNull(), "unknown_metric").when(
        ~F.col("unit").eqNullSafe(F.col("unit_canonical")), "unit_mismatch"
    )
    flagged = joined.withColumn("problem", problem).where(F.col("problem").isNotNull())
    return flagged.groupBy("metric_code", "problem").agg(F.sum("n_rows").alias("n_rows"))


def orphans(fact: DataFrame, station: DataFrame, metric: DataFrame, runs: DataFrame) -> DataFrame:
    """Facts whose station, metric or run does not exist: ``(reference, n_keys, n_rows)``.

    Facts are counted per key first; the anti join then sees one row per key.
    """
    links = (
        ("station", "station_id", station.select("station_id")),
        ("metric", "metric_id", metric.select("metric_id")),
        ("run", "ingest_run_id", runs.select(F.col("run_id").alias("ingest_run_id"))),
    )
    parts = []
    for name, column, known in links:
        per_key = fact.groupBy(column).agg(F.count("*").alias("_n"))
        lost = per_key.join(known, column, "left_anti")
        parts.append(
            lost.agg(F.count("*").alias("n_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows")).select(
                F.lit(name).alias("reference"), "n_keys", "n_rows"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def schema_drift(raw: DataFrame, contract: DataFrame, payload: str = "source_payload") -> DataFrame:
    """Differences between the payload fields seen and the contract, per day and source.

    ``contract`` has ``(field, type)``. ``drift`` is ``added`` (not in the contract),
    ``retyped`` (other type than agreed) or ``missing`` (agreed, absent in some row);
    ``n_rows`` counts the rows concerned. Payloads that are no JSON object count as
    the added field ``<malformed>``.
    """
    spark = raw.sparkSession
    parsed = raw.select(
        F.to_date("ingested_at").alias("day"), "source", F.try_parse_json(payload).alias("_v"), F.col(payload).alias("_p")
    )
    is_object = F.schema_of_variant("_v").startswith("OBJECT")
    fields = parsed.where(is_object).lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
    seen = fields.select("day", "source", F.col("key").alias("field"), F.schema_of_variant("value").alias("type"))
    broken = parsed.where(F.col("_p").isNotNull() & ~F.coalesce(is_object, F.lit(False))).select(
        "day", "source", F.lit("<malformed>").alias("field"), F.lit("NONE").alias("type")
    )
    counts = seen.unionByName(broken).groupBy("day", "source", "field", "type").agg(F.count("*").alias("n_rows"))
    agreed = contract.select("field", F.col("type").alias("agreed_type"))
    compared = counts.join(agreed, "field", "left")
    drift = F.when(F.col("agreed_type").isNull(), "added").when(F.col("type") != F.col("agreed_type"), "retyped")
    surplus = compared.withColumn("drift", drift).where(F.col("drift").isNotNull())

    # Absent fields: rows of the day less the rows that have the field. The contract is
    # attached to each day as an array, so days are not paired with it by a join.
    days = parsed.groupBy("day", "source").agg(F.count("_p").alias("_rows"))
    listed = contract.agg(F.collect_list("field")).scalar()
    wanted = days.select("day", "source", "_rows", F.explode(listed).alias("field"))
    present = counts.groupBy("day", "source", "field").agg(F.sum("n_rows").alias("_seen"))
    absent = wanted.join(present, ["day", "source", "field"], "left").withColumn(
        "n_rows", F.col("_rows") - F.coalesce("_seen", F.lit(0))
    )
    missing = absent.where("n_rows > 0").select(
        "day", "source", "field", F.lit("missing").alias("drift"), "n_rows"
    )
    return surplus.select("day", "source", "field", "drift", "n_rows").unionByName(missing)


# --- evaluation --------------------------------------------------------------


def check_status(metric: Column, threshold: Column, operator: Column, severity: Column) -> Column:
    """pass / warn / fail. An unknown operator or a null metric does not pass; what does
    not pass fails only if the check is critical."""
    passed = (
        F.when(operator == "<=", metric <= threshold)
        .when(operator == ">=", metric >= threshold)
        .when(operator == "=", metric == threshold)
        .otherwise(False)
    )
    failed = F.when(severity == "critical", "fail").otherwise("warn")
    return F.when(F.coalesce(passed, F.lit(False)), "pass").otherwise(failed)


# The parameter of a template, or a literal, a quoted name or a comment, in which the same text is no parameter.
_PARAMETER = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|(?P<parameter>(?<![\w:]):run_id\b)""", re.DOTALL
)


class CheckDefinition(NamedTuple):
    """One row of the check catalogue.

    ``sql_template`` is used for names that have no built-in metric. With a ``:run_id``
    parameter it returns one row with ``metric_value`` for that run. Without one it
    returns ``(run_id, metric_value)`` for all runs, which is a single query however
    many runs there are.
    """

    check_id: int
    name: str
    severity: str
    threshold: float
    operator: str
    is_active: bool = True
    sql_template: str | None = None

    @property
    def built_in(self) -> bool:
        return self.name in TABLE_METRICS or self.name in RUN_METRICS

    @property
    def per_run(self) -> bool:
        """Whether the template has a parameter to bind for each run."""
        found = not self.built_in and self.sql_template and _PARAMETER.finditer(self.sql_template)
        return any(m["parameter"] for m in found or ())


def active_definitions(catalogue: DataFrame) -> list[CheckDefinition]:
    """Active rows of a stored catalogue, which is edited by hand: a check is a part of the plan."""
    rows = (
        catalogue.where("is_active")
        .select(
            "dq_check_id", "check_name", "severity", "threshold_value", "threshold_operator",
            "is_active", "check_sql_template",
        )
        .collect()
    )
    return [CheckDefinition(*row) for row in rows]


@dataclass(frozen=True)
class Checked:
    """Tables the built-in checks look at."""

    raw: DataFrame
    fact: DataFrame
    station: DataFrame
    metric: DataFrame
    heads: DataFrame | None = None  # stored summary of the series, instead of the facts where it suffices

    @property
    def newest(self) -> DataFrame:
        return self.fact if self.heads is None else self.heads


TableMetric = Callable[[Checked, Instant], DataFrame]

# Metrics of whole tables: the same value for every run checked now.
TABLE_METRICS: Mapping[str, TableMetric] = {
    "fact_freshness_minutes": lambda t, now: freshness_minutes(t.newest, now),
    "metric_completeness_pct": lambda t, now: completeness_pct(t.newest, t.metric),
    "late_data_rate_pct_all_time": lambda t, now: late_rate_pct(t.fact),
    "raw_duplicate_key_count": lambda t, now: duplicate_keys(t.raw, KEYS["raw_observations"]),
    "fact_duplicate_key_count": lambda t, now: duplicate_keys(t.fact, KEYS["fact_observation"]),
    "stations_missing_any_metric_count_latest_hour": lambda t, now: stations_missing_metric(
        t.fact, t.station, t.metric
    ),
    "value_out_of_range_count": lambda t, now: out_of_range(t.fact, t.metric),
}

# Metrics of one run: ``(run_id, metric_value)`` for all runs in one aggregate.
RUN_METRICS: Mapping[str, Callable[[Checked], DataFrame]] = {
    "late_data_rate_pct": lambda t: late_rate_by_run(t.fact),
}


def template_metrics(runs: DataFrame, definition: CheckDefinition) -> DataFrame:
    """``(run_id, metric_value)`` of a ``:run_id`` template for all runs, as one query.

    The template becomes a table function of the session with a parameter, called for the runs'
    column: the same text in a literal or a comment stays text. A template that returns
    several rows for a run is an error, one that returns none gives a null metric.
    """
    spark, function = runs.sparkSession, f"check_{definition.check_id}_{uuid.uuid4().hex}"
    body = _PARAMETER.sub(lambda m: f"{function}.run_id" if m["parameter"] else m[0], definition.sql_template)
    spark.sql(
        f"""CREATE TEMPORARY FUNCTION {function}(run_id STRING) RETURNS TABLE ({METRIC} {DECIMAL})
            RETURN SELECT CAST({METRIC} AS {DECIMAL}) FROM (\n{body}\n)"""
    )
    rows = spark.sql(
        f"SELECT r.run_id, f.{METRIC} FROM {{runs}} AS r LEFT JOIN LATERAL {function}(r.run_id) AS f", runs=runs.select("run_id")
    )
    spark.sql(f"DROP TEMPORARY FUNCTION {function}")  # the query holds its body by now
    several = F.raise_error(F.lit(f"check {definition.name} returned several rows for a run"))
    metric = F.max(METRIC)
    return rows.groupBy("run_id").agg(F.when(F.count("*") > 1, several).otherwise(metric).alias(METRIC))


def template_checks(runs: DataFrame, definitions: Sequence[CheckDefinition], as_of: Instant = None) -> DataFrame:
    """Results of the ``:run_id`` templates for every run."""
    wide = runs.select("run_id")
    active = [d for d in definitions if d.is_active and d.per_run]
    for d in active:
        wide = _attach(wide, template_metrics(runs, d), d.name)
    return _results(wide, active, as_of)


def check_results(
    runs: DataFrame, definition: CheckDefinition, tables: Checked, as_of: Instant = None
) -> DataFrame:
    """Results of one check for every run."""
    if definition.per_run:
        return template_checks(runs, [definition], as_of)
    return run_checks(runs, [definition], tables, as_of)


def run_checks(
    runs: DataFrame, definitions: Sequence[CheckDefinition], tables: Checked, as_of: Instant = None
) -> DataFrame:
    """Results of the active set-wise checks for every run, as one plan.

    Whole-table metrics are scalars, computed once; per-run metrics are one aggregate
    each, joined on the run. ``runs`` has one row per ``run_id``. Per-run templates
    are left to :func:`template_checks`.
    """
    active = [d for d in definitions if d.is_active and not d.per_run]
    wide = runs.select("run_id")
    for d in active:
        if d.name in TABLE_METRICS:
            wide = wide.withColumn(d.name, TABLE_METRICS[d.name](tables, as_of).scalar().cast(DECIMAL))
        elif d.name in RUN_METRICS:
            wide = _attach(wide, RUN_METRICS[d.name](tables), d.name)
        elif d.sql_template:
            wide = _attach(wide, runs.sparkSession.sql(d.sql_template), d.name)
        else:
            raise ValueError(f"check {d.name!r} has neither a built-in metric nor a template")
    return _results(wide, active, as_of)


def _attach(wide: DataFrame, per_run: DataFrame, name: str) -> DataFrame:
    metric = per_run.select("run_id", F.col(METRIC).cast(DECIMAL).alias(name))
    return wide.join(metric, "run_id", "left")


def _results(wide: DataFrame, active: Sequence[CheckDefinition], as_of: Instant) -> DataFrame:
    if not active:
        return empty_results(wide.sparkSession)
    long = wide.select("run_id", F.inline(F.array(*[_check_row(d) for d in active])))
    return long.select(
        digest(F.col("run_id"), F.col("check_name")).alias("dq_run_id"),
        "run_id",
        "check_name",
        check_status(F.col(METRIC), F.col("threshold"), F.col("operator"), F.col("severity")).alias("status"),
        instant(as_of).alias("evaluated_at"),
        METRIC,
        "threshold",
        F.when(F.col(METRIC).isNull(), "null_metric").alias("reason"),
        "dq_check_id",
    )


def _check_row(d: CheckDefinition) -> Column:
    return F.struct(
        F.lit(d.check_id).alias("dq_check_id"),
        F.lit(d.name).alias("check_name"),
        F.col(d.name).alias(METRIC),
        F.lit(str(d.threshold)).cast(DECIMAL).alias("threshold"),
        F.lit(d.operator).alias("operator"),
        F.lit(d.severity).alias("severity"),
    )


def new_check_results(stored: DataFrame, results: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Results to insert: first per run and check, unless stored already."""
    return insert_or_ignore(stored, results, KEYS["ops_dq_check_run"], order or [F.asc("evaluated_at")])


def empty_results(spark: SparkSession) -> DataFrame:
    return constant_frame(spark, [], SCHEMAS["ops_dq_check_run"])
