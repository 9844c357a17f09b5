"""The weighted health score of a pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import is_success, is_terminal, metric_rows, window_start


def stage_sums(over: Callable[[Column], Column] = lambda c: c) -> dict[str, Column]:
    """Finished events and successes of each stage; ``over`` makes the sums running ones."""
    out = {}
    for s in V.STAGES:
        done = is_terminal() & F.col("event_type").startswith(f"{s}_")
        out[f"{s}_n"] = over(F.sum(F.when(done, 1).otherwise(0)))
        out[f"{s}_ok"] = over(F.sum(F.when(done & is_success(), 1).otherwise(0)))
    return out


def rate(stage: str) -> Column:
    """Percent of a stage's finished events that succeeded; a stage without any counts as 100."""
    return F.when(F.col(f"{stage}_n") == 0, F.lit(100.0)).otherwise(F.col(f"{stage}_ok") * F.lit(100.0) / F.col(f"{stage}_n"))


def score() -> Column:
    parts = [rate(s) * F.lit(w) for s, w in V.HEALTH_WEIGHTS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def samples() -> Column:
    return F.expr(" + ".join(f"{s}_n" for s in V.STAGES))


def detail() -> Column:
    """The stages' rates as a JSON object with one decimal."""
    return F.format_string("{" + ",".join(f'"{s.lower()}":%.1f' for s in V.STAGES) + "}", *[rate(s) for s in V.STAGES])


def health_score(events: DataFrame, size: int = V.HEALTH_WINDOW) -> DataFrame:
    """The score of each pipeline and window with an event of a stage; started ones make a window but don't score."""
    done = is_terminal()
    own = events.where(F.col("event_type").isin(*V.HEALTH_TYPES)).withColumn("window_start_ms", window_start("ts", size))
    sums = own.groupBy("pipeline_id", "window_start_ms").agg(
        *[c.alias(k) for k, c in stage_sums().items()],
        F.max_by(F.when(done, F.col("service_name")), F.when(done, F.col("seq"))).alias("service_name"),
        F.coalesce(F.min(F.when(done & (F.col("received") > 0), F.col("received"))), F.lit(0)).alias("received"),
    )
    return metric_rows(sums, V.HEALTH_SCORE, score(), end=F.col("window_start_ms") + size, samples=samples(), detail=detail())


def band_changes(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Rows whose band isn't that of the pipeline's row before; rows without a band always stay."""
    before = F.lag("performance_band").over(Window.partitionBy("pipeline_id").orderBy(*order))
    first = F.row_number().over(Window.partitionBy("pipeline_id").orderBy(*order)) == 1
    return metrics.withColumns({"_before": before, "_first": first}).where(F.col("performance_band").isNull() | F.col("_first") | ~F.col("performance_band").eqNullSafe(F.col("_before"))).drop("_before", "_first")
