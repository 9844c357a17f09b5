"""Schemas, and column expressions that operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocabulary as V

TEXT_FIELDS = ("event_id", "pipeline_id", "repository_id", "analysis_name", "analysis_type", "service_name", "branch", "commit_sha", "stage", "event_type", "event_timestamp", "status")

#: What is inside a message.
PAYLOAD = ", ".join(f"{k} string" for k in TEXT_FIELDS)
#: A decoded event: ``ts`` and ``received`` in epoch ms, ``seq`` the order of arrival.
EVENT = f"{PAYLOAD}, ts long, received long, seq long"
METRIC = "metric_type string, pipeline_id string, service_name string, window_start_ms long, window_end_ms long, value double, performance_band string, sample_count long, detail string, received long"
ALERT = "alert_type string, payload string"
METRIC_COLUMNS = [c.strip().split()[0] for c in METRIC.split(",")]
METRIC_KEY = ["metric_type", "pipeline_id", "window_start_ms", "window_end_ms"]


def is_failure() -> Column:
    return F.coalesce(F.upper("status") == "FAILURE", F.lit(False))


def is_success() -> Column:
    return F.coalesce(F.upper("status") == "SUCCESS", F.lit(False))


def is_terminal() -> Column:
    t = F.col("event_type")
    return t.endswith("_SUCCESS") | t.endswith("_FAILED") | t.endswith("_FAILURE")


def window_start(ts: str, size: int) -> Column:
    """The start of the tumbling window of ``size`` ms, aligned to the epoch."""
    return F.col(ts) - F.pmod(F.col(ts), F.lit(size))


def earliest(of: str = "received") -> Column:
    """The smallest positive value of a group, else 0."""
    return F.coalesce(F.min(F.when(F.col(of) > 0, F.col(of))), F.lit(0).cast("long"))


def last_by(column: str, order: str = "seq") -> Column:
    """A group's last value by order of arrival; a null that came last stays null."""
    return F.max_by(F.col(column), F.col(order))


def band(metric_type: str | None, value: Column) -> Column:
    """The performance band of a value of one metric, or by the column metric_type."""
    if metric_type is None:
        out = F.lit("N/A")
        for name in V.BANDS:
            out = F.when(F.col("metric_type") == name, band(name, value)).otherwise(out)
        return out
    if metric_type not in V.BANDS:
        return F.lit("N/A")
    limits, kind = V.BANDS[metric_type]
    out = F.lit(V.BAND_NAMES[3])
    for limit, name in zip(reversed(limits), reversed(V.BAND_NAMES[:3]), strict=True):
        holds = value >= limit if kind == "at_least" else value <= limit if kind == "at_most" else value < limit
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def metric_rows(df: DataFrame, metric_type: str | None, value: Column, *, service: str = "service_name", start: Column | str = "window_start_ms", end: Column | str = "window_end_ms", samples: Column | str = "sample_count", detail: Column | None = None, received: Column | str = "received", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the shape of METRIC, after the columns ``keep``; without a type, by the column metric_type."""
    at = lambda c: F.col(c) if isinstance(c, str) else c
    v = value.cast("double")
    return df.select(
        *keep, (F.col("metric_type") if metric_type is None else F.lit(metric_type)).alias("metric_type"), F.coalesce("pipeline_id", F.lit("")).alias("pipeline_id"), F.coalesce(F.col(service), F.lit("")).alias("service_name"),
        at(start).cast("long").alias("window_start_ms"), at(end).cast("long").alias("window_end_ms"), v.alias("value"), band(metric_type, v).alias("performance_band"), at(samples).cast("long").alias("sample_count"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"), at(received).cast("long").alias("received"),
    )
