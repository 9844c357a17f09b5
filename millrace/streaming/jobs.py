"""The whole streaming job: every metric, pattern and audit of a stream of events into its sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import vocabulary as V
from ..functions.columns import METRIC_COLUMNS, metric_rows
from ..plans.sinks import MetricTable, annotations, to_sinks
from .processors import configure, with_state
from .windows import job

WATERMARK = "watermark"
#: The job's watermark report, and the state machines that make up the rest of it.
PARTS = (WATERMARK, "deploy_frequency", "change_failure_rate", "health_score", "lead_time", "mttr", "live_deployments", "live_cfr", "live_health_bands", "patterns")


def start(events: DataFrame, tables: str, checkpoints: str, annotate: Callable[[DataFrame], None] | None = None, parts: tuple[str, ...] = PARTS, trigger: dict | None = None) -> list[StreamingQuery]:
    """Starts a query for each part; each upserts into a table of its own below ``tables`` and appends its alerts there.

    A table for each part keeps writers apart, so no two queries merge into one
    table; ``metrics`` and ``alerts`` read them all.  ``annotate`` gets each batch's
    annotations; ``sinks.poster`` makes one that posts them.
    """
    spark = events.sparkSession
    configure(spark)
    queries = []
    for name in parts:
        table = MetricTable(spark, f"{tables.rstrip('/')}/metrics/{name}")

        def also(batch: DataFrame, batch_id: int) -> None:
            if annotate:
                kinds = F.when(F.col("kind") == "METRIC", F.col("metric_type")).when(F.col("metric_type").endswith("_TIMEOUT"), V.PATTERN_TIMEOUT).when(F.col("metric_type") == V.LATE_EVENT, V.LATE_DETECTED).otherwise(V.PATTERN_DETECTED)
                annotate(annotations(batch.withColumns({"metric_type": kinds, "value": F.coalesce("value", F.lit(0.0))}).select(*METRIC_COLUMNS)))

        if name == WATERMARK:
            queries.append(job(events.select("ts"), name, checkpoints, watermark_sink(table)).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
            continue
        sink = to_sinks(table, f"{tables.rstrip('/')}/alerts/{name}", also)
        queries.append(job(with_state(events, name), name, checkpoints, sink).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
    return queries


def metrics(spark, tables: str, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """The metric rows of all parts."""
    out = None
    for name in parts:
        own = MetricTable(spark, f"{tables.rstrip('/')}/metrics/{name}").read()
        out = own if out is None else out.union(own)
    return out


def alerts(spark, tables: str, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """(alert_type, payload, inserted_at) of all parts that have written any."""
    out = spark.createDataFrame([], "alert_type string, payload string, inserted_at long")
    for name in parts:
        path = f"{tables.rstrip('/')}/alerts/{name}"
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            out = out.union(spark.read.parquet(path).select(*out.columns))
    return out


def watermark_sink(table: MetricTable, delay: int = V.OUT_OF_ORDER) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: the watermark after a batch as a metric row, if the batch has moved it.

    A watermark moves with events only, so there is nothing to report while none come.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        top = batch.agg(F.max("ts")).first()[0]
        last = table.read().where(F.col("metric_type") == V.WATERMARK).agg(F.max("value")).first()[0]
        if top is None or last is not None and top - delay <= last:
            return
        rows = batch.sparkSession.createDataFrame([(top, "GLOBAL", "", 0)], "top long, pipeline_id string, service_name string, none long")
        rows = metric_rows(rows, V.WATERMARK, F.col("top") - delay, start="none", end="none", samples=F.lit(1), received=F.lit(None), keep=("top",))
        table.upsert(rows.withColumn("inserted_at", F.unix_millis(F.current_timestamp())), batch_id, "top")

    return write
