"""Text helpers: formatting, identities, JSON details."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewarden.settings import MESSAGE_LIMIT

NO_VALUE = "—"


def utc_text(moment: Column, pattern: str = "yyyy-MM-dd HH:mm", suffix: str = "") -> Column:
    """Display text of a timestamp in the session zone (UTC); nulls become a dash."""
    text = F.concat(F.date_format(moment, pattern), F.lit(suffix)) if suffix else F.date_format(moment, pattern)
    return F.coalesce(text, F.lit(NO_VALUE))


def words(code: Column) -> Column:
    """``silent_station`` -> ``Silent Station``."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def incident_title(anomaly_type: Column, station_id: Column, metric_id: Column) -> Column:
    """Title of a new incident; a missing metric prints as ``None``."""
    return F.concat(
        anomaly_type, F.lit(" @ station "), _printed(station_id), F.lit(" metric "), _printed(metric_id)
    )


def _printed(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def first_text(*candidates: Column) -> Column:
    """First candidate that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def clip(message: Column, limit: int = MESSAGE_LIMIT) -> Column:
    return F.substring(message, 1, limit)


def details_json(*fields: Column) -> Column:
    """JSON object that keeps null members."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def digest(*parts: Column) -> Column:
    """128-bit hex identity of a natural key. Parts are written with their length, so that
    no separator in a text and no null can make two keys alike."""
    texts = [p.cast("string") for p in parts]
    printed = [F.coalesce(F.concat(F.char_length(t), F.lit(":"), t), F.lit("~")) for t in texts]
    return F.substring(F.sha2(F.concat(*printed), 256), 1, 32)
