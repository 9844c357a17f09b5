"""Late events, by a watermark that follows the order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import earliest, last_by, metric_rows, window_start
from .runs import RUN, highest_before

#: By source metric: the types it counts and the size of its windows.
SOURCES = {
    V.DEPLOYMENT_FREQUENCY: (("DEPLOY_SUCCESS",), V.DEPLOY_WINDOW),
    V.CHANGE_FAILURE_RATE: (("DEPLOY_SUCCESS", "DEPLOY_FAILED"), V.FAILURE_WINDOW),
    V.HEALTH_SCORE: (V.HEALTH_TYPES, V.HEALTH_WINDOW),
}


def arrival_watermark(events: DataFrame, delay: int = V.OUT_OF_ORDER, run: int = RUN) -> DataFrame:
    """Events with ``watermark``: the latest event time of all earlier arrivals less ``delay``; null for the first."""
    more = ("number",) if "number" in events.columns else ("ts",)
    return highest_before(events, [], "ts", "seq", more, run).withColumn("watermark", F.col("_before") - delay).drop("_before")


def truly_late(events: DataFrame, lateness: int = V.ALLOWED_LATENESS, delay: int = V.OUT_OF_ORDER) -> DataFrame:
    """Events whose window and grace had passed when they came, once for each metric that would count them."""
    marked = arrival_watermark(events, delay)
    each = [F.when(F.col("event_type").isin(*types), F.struct(F.lit(name).alias("source_metric"), (window_start("ts", size) + size).alias("window_end_ms"))) for name, (types, size) in SOURCES.items()]
    spread = marked.withColumn("_m", F.explode(F.array_compact(F.array(*each)))).select("*", "_m.*").drop("_m")
    return spread.where(F.col("watermark") >= F.col("window_end_ms") + lateness)


def on_time(events: DataFrame, source: str, lateness: int = V.ALLOWED_LATENESS, delay: int = V.OUT_OF_ORDER) -> DataFrame:
    """The events that a metric's windows count, late ones within their grace included."""
    types, size = SOURCES[source]
    marked = arrival_watermark(events, delay).where(F.col("event_type").isin(*types))
    return marked.where(F.col("watermark").isNull() | (F.col("watermark") < window_start("ts", size) + size + lateness)).drop("watermark")


def audit(late: DataFrame) -> DataFrame:
    """(alert_type, payload, at_ms): a document for each truly late event."""
    iso = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    body = F.struct("source_metric", "event_id", "pipeline_id", "service_name", "event_type", iso("ts").alias("event_time"), iso("watermark").alias("watermark_time"), F.lit(True).alias("late"))
    return late.select(F.lit(V.LATE_EVENT).alias("alert_type"), F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"), F.col("received").alias("at_ms"))


def late_counts(late: DataFrame, metric_type: str = V.DEPLOYMENT_FREQUENCY_LATE, size: int = V.LATE_COUNT_WINDOW) -> DataFrame:
    """Late events of each pipeline and window of their arrival."""
    counted = late.withColumn("window_start_ms", window_start("received", size)).groupBy("pipeline_id", "window_start_ms").agg(F.count(F.lit(1)).alias("sample_count"), last_by("service_name").alias("service_name"), earliest().alias("first"))
    return metric_rows(counted, metric_type, F.col("sample_count"), end=F.col("window_start_ms") + size, received="first")


def watermark_rows(events: DataFrame, delay: int = V.OUT_OF_ORDER) -> DataFrame:
    """The job's watermark after all events, as a metric row."""
    top = events.agg(F.max("ts").alias("top"), F.count(F.lit(1)).alias("n")).where("top IS NOT NULL").withColumns({"pipeline_id": F.lit("GLOBAL"), "service_name": F.lit(""), "none": F.lit(0)})
    return metric_rows(top, V.WATERMARK, F.col("top") - delay, start="none", end="none", samples=F.lit(1), received=F.lit(None))
