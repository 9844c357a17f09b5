"""Windowed metrics with Spark's own windows, and a stream into a sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import vocabulary as V
from ..functions.columns import is_terminal, metric_rows
from ..operators.dora import failed_deploy
from ..operators.health import detail, samples, score, stage_sums


def _windowed(events: DataFrame, size: int, lateness: int, delay: int):
    timed = events.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", f"{lateness + delay} milliseconds")
    return timed.groupBy("pipeline_id", F.window("event_time", f"{size} milliseconds").alias("w"))


def deployments(events: DataFrame, size: int = V.DEPLOY_WINDOW, lateness: int = V.ALLOWED_LATENESS, delay: int = V.OUT_OF_ORDER) -> dict[str, DataFrame]:
    """Deployment frequency and change failure rate from one state: both count the same events in the same windows.

    In update mode each batch gives the current totals of the windows it touched;
    rows later than the grace are dropped.
    """
    own = events.where(F.col("event_type").isin("DEPLOY_SUCCESS", "DEPLOY_FAILED"))
    first = F.min(F.when(F.col("received") > 0, F.col("received")))
    sums = _windowed(own, size, lateness, delay).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(failed_deploy(), 1).otherwise(0)).alias("failed"), F.sum(F.when(F.col("event_type") == "DEPLOY_SUCCESS", 1).otherwise(0)).alias("ok"),
        F.max_by("service_name", "seq").alias("service_name"), F.coalesce(first, F.lit(0)).alias("received"), F.max("seq").alias("seq"),
    ).withColumns({"window_start_ms": F.unix_millis("w.start"), "window_end_ms": F.unix_millis("w.end")})
    return {
        V.DEPLOYMENT_FREQUENCY: metric_rows(sums.where("ok > 0"), V.DEPLOYMENT_FREQUENCY, F.col("ok"), samples="ok", keep=("seq",)),
        V.CHANGE_FAILURE_RATE: metric_rows(sums, V.CHANGE_FAILURE_RATE, F.col("failed") * F.lit(100.0) / F.col("n"), samples="n", keep=("seq",)),
    }


def health(events: DataFrame, size: int = V.HEALTH_WINDOW, lateness: int = V.ALLOWED_LATENESS, delay: int = V.OUT_OF_ORDER) -> DataFrame:
    own = events.where(F.col("event_type").isin(*V.HEALTH_TYPES))
    done = is_terminal()
    sums = _windowed(own, size, lateness, delay).agg(
        *[c.alias(k) for k, c in stage_sums().items()], F.max_by(F.when(done, F.col("service_name")), F.when(done, F.col("seq"))).alias("service_name"),
        F.coalesce(F.min(F.when(done & (F.col("received") > 0), F.col("received"))), F.lit(0)).alias("received"), F.max("seq").alias("seq"),
    ).withColumns({"window_start_ms": F.unix_millis("w.start"), "window_end_ms": F.unix_millis("w.end")})
    return metric_rows(sums, V.HEALTH_SCORE, score(), samples=samples(), detail=detail(), keep=("seq",))


def job(rows: DataFrame, name: str, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    """A stream into a foreachBatch sink; restarted, it goes on where its checkpoint ends."""
    return rows.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}").foreachBatch(sink)
