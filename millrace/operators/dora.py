"""The four delivery metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import earliest, is_failure, last_by, metric_rows, window_start
from .route import of_types
from .runs import row_before


def failed_deploy() -> Column:
    return (F.col("event_type") == "DEPLOY_FAILED") | is_failure()


def _by_window(events: DataFrame, size: int) -> DataFrame:
    return events.withColumn("window_start_ms", window_start("ts", size)).groupBy("pipeline_id", "window_start_ms").agg(
        F.count(F.lit(1)).alias("sample_count"), F.sum(F.when(failed_deploy(), 1).otherwise(0)).alias("failed"), last_by("service_name").alias("service_name"), earliest().alias("received")
    ).withColumn("window_end_ms", F.col("window_start_ms") + size)


def deployment_frequency(events: DataFrame, size: int = V.DEPLOY_WINDOW) -> DataFrame:
    """Successful deployments of each pipeline and window: the count itself."""
    return metric_rows(_by_window(of_types(events, "DEPLOY_SUCCESS"), size), V.DEPLOYMENT_FREQUENCY, F.col("sample_count"))


def change_failure_rate(events: DataFrame, size: int = V.FAILURE_WINDOW) -> DataFrame:
    """Percent of finished deployments of each pipeline and window that failed."""
    return metric_rows(_by_window(of_types(events, "DEPLOY_SUCCESS", "DEPLOY_FAILED"), size), V.CHANGE_FAILURE_RATE, F.col("failed") * F.lit(100.0) / F.col("sample_count"))


def both_by_window(events: DataFrame, size: int = V.DEPLOY_WINDOW) -> DataFrame:
    """Deployment frequency and change failure rate from one pass over the deployments: the rows of both."""
    own = of_types(events, "DEPLOY_SUCCESS", "DEPLOY_FAILED").withColumn("window_start_ms", window_start("ts", size))
    ok = F.col("event_type") == "DEPLOY_SUCCESS"
    first = lambda when: F.coalesce(F.min(F.when(when & (F.col("received") > 0), F.col("received"))), F.lit(0).cast("long"))
    sums = own.groupBy("pipeline_id", "window_start_ms").agg(
        F.sum(ok.cast("long")).alias("ok"), F.max_by(F.when(ok, F.col("service_name")), F.when(ok, F.col("seq"))).alias("ok_service"), first(ok).alias("ok_received"),
        F.count(F.lit(1)).alias("n"), F.sum(F.when(failed_deploy(), 1).otherwise(0)).alias("failed"), last_by("service_name").alias("service"), first(F.lit(True)).alias("any_received"),
    )
    one = lambda name, value, n, service, received: F.struct(F.lit(name).alias("metric_type"), value.cast("double").alias("value"), F.col(n).alias("sample_count"), F.col(service).alias("service_name"), F.col(received).alias("received"))
    rate = F.col("failed") * F.lit(100.0) / F.col("n")
    each = F.array(one(V.DEPLOYMENT_FREQUENCY, F.col("ok"), "ok", "ok_service", "ok_received"), one(V.CHANGE_FAILURE_RATE, rate, "n", "service", "any_received"))
    rows = sums.select("pipeline_id", "window_start_ms", F.inline(each)).where("sample_count > 0").withColumn("window_end_ms", F.col("window_start_ms") + size)
    return metric_rows(rows, None, F.col("value"))


def _since_start(events: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Rows of type ``end`` right after one of type ``start`` with the same keys, by arrival.

    Each type that is left either sets or clears what is pending, so something is
    pending just when the row before has set it.
    """
    before = row_before(events.select("pipeline_id", "commit_sha", "service_name", "event_type", "ts", "received", "seq"), keys, ["event_type", "ts", "received"], "seq")
    paired = before.select("*", F.col("_before.event_type").alias("_type"), F.col("_before.ts").alias("window_start_ms"), F.col("_before.received").alias("_received")).drop("_before")
    return paired.where((F.col("event_type") == end) & (F.col("_type") == start)).withColumns({"window_end_ms": F.col("ts"), "minutes": (F.col("ts") - F.col("window_start_ms")) / F.lit(60000.0)})


def lead_time(events: DataFrame) -> DataFrame:
    """Minutes from a commit's last started build to its successful deployment; a failed one forgets the build."""
    pairs = _since_start(of_types(events, "BUILD_STARTED", "DEPLOY_SUCCESS", "DEPLOY_FAILED"), ["pipeline_id", "commit_sha"], "BUILD_STARTED", "DEPLOY_SUCCESS")
    return metric_rows(pairs, V.LEAD_TIME, F.col("minutes"), samples=F.lit(1), received="_received")


def recovery_time(events: DataFrame) -> DataFrame:
    """Minutes from a pipeline's latest failed build to its next successful one."""
    pairs = _since_start(of_types(events, "BUILD_FAILED", "BUILD_SUCCESS"), ["pipeline_id"], "BUILD_FAILED", "BUILD_SUCCESS")
    return metric_rows(pairs, V.RECOVERY_TIME, F.col("minutes"), samples=F.lit(1), received="_received")
