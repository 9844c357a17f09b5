"""Live counters: a row for each event with what its window holds so far, and resets.

By order of arrival, an event whose window ends before an earlier arrival's is
dropped; only accepted events move the window on.  A window's reset comes when
it closes: counters take back a timer when a later window opens first, so a
pipeline has one reset at the end, while the health score has one for each window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import earliest, metric_rows, window_start
from .dora import failed_deploy
from .health import samples, score, stage_sums
from .late import arrival_watermark
from .route import of_types
from .runs import highest_before


def accepted(events: DataFrame, types: tuple[str, ...], size: int, gate: bool = False, delay: int = V.OUT_OF_ORDER) -> DataFrame:
    """Events of ``types`` that their window still takes, with its end.

    ``gate``: drop events whose window the watermark, modelled by the order of arrival
    of all events, of other types too, has passed.
    """
    marked = arrival_watermark(events, delay) if gate else events
    ended = of_types(marked, *types).withColumn("_end", window_start("ts", size) + size)
    if gate:
        ended = ended.where("watermark IS NULL OR watermark <= _end").drop("watermark")
    return highest_before(ended, ["pipeline_id"], "_end", "seq").where("_before IS NULL OR _end >= _before").drop("_before")


def _rows(own: DataFrame, metric_type: str, sums: dict[str, Callable], value: Column, count: Column, received: Callable[[Column], Column] | None, each: bool, empty: float) -> DataFrame:
    w = Window.partitionBy("pipeline_id", "_end").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    first = F.min(F.when(F.col("received") > 0, F.col("received"))).over(w) if received else F.col("received")
    running = own.select("pipeline_id", "service_name", "seq", "_end", first.alias("received"), *[c.alias(k) for k, c in sums(lambda c: c.over(w)).items()])
    zero = F.lit(0).cast("long")
    rows = metric_rows(running, metric_type, value, start=zero, end=zero, samples=count, keep=("seq", "_end"))
    closed = own.groupBy("pipeline_id", "_end").agg(F.max_by("service_name", "seq").alias("service_name"), F.max("seq").alias("_last"))
    if not each:
        closed = closed.groupBy("pipeline_id").agg(F.max_by(F.struct("_end", "service_name"), "_end").alias("s")).select("pipeline_id", "s._end", "s.service_name")
    resets = metric_rows(closed.withColumn("seq", F.lit(None).cast("long")), metric_type, F.lit(empty), start=zero, end=zero, samples=zero, received=F.lit(None).cast("long"), keep=("seq", "_end"))
    return rows.union(resets).withColumnRenamed("_end", "closes_ms")


def live_deployments(events: DataFrame, size: int = V.DEPLOY_WINDOW, gate: bool = False) -> DataFrame:
    """(seq, closes_ms, METRIC): successful deployments so far; seq is null for resets."""
    own = accepted(events, ("DEPLOY_SUCCESS",), size, gate)
    return _rows(own, V.DEPLOYMENT_FREQUENCY_LIVE, lambda over: {"n": over(F.count(F.lit(1)))}, F.col("n"), F.col("n"), None, False, 0.0)


def live_failure_rate(events: DataFrame, size: int = V.FAILURE_WINDOW, gate: bool = False) -> DataFrame:
    """(seq, closes_ms, METRIC): percent of finished deployments so far that failed."""
    own = accepted(events, ("DEPLOY_SUCCESS", "DEPLOY_FAILED"), size, gate)
    sums = lambda over: {"n": over(F.count(F.lit(1))), "failed": over(F.sum(F.when(failed_deploy(), 1).otherwise(0)))}
    return _rows(own, V.CHANGE_FAILURE_RATE_LIVE, sums, F.col("failed") * F.lit(100.0) / F.col("n"), F.col("n"), None, False, 0.0)


def live_health(events: DataFrame, size: int = V.HEALTH_WINDOW, gate: bool = False) -> DataFrame:
    """(seq, closes_ms, METRIC): the health score so far, a row for started events too."""
    own = accepted(events, V.HEALTH_TYPES, size, gate)
    return _rows(own, V.HEALTH_SCORE_LIVE, stage_sums, score(), samples(), earliest, True, 100.0)
