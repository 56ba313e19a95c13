from tidewarden.functions.clock import elapsed_minutes, elapsed_seconds, hours, instant, minutes
from tidewarden.functions.lookup import constant_frame, metric_limits
from tidewarden.functions.text import clip, details_json, digest, first_text, incident_title, utc_text, words

__all__ = [
    "clip", "constant_frame", "details_json", "digest", "elapsed_minutes", "elapsed_seconds",
    "first_text", "hours", "incident_title", "instant", "metric_limits", "minutes", "utc_text", "words",
]
