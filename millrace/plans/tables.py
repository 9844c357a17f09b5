"""The result tables: all metrics and all alerts of a set of events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import METRIC_COLUMNS, METRIC_KEY
from ..operators import dora, health, late, live, patterns


def upsert_latest(rows: DataFrame, order: str) -> DataFrame:
    """The last row of each key by ``order``: what an upsert of them all leaves. Partial maxima come before the shuffle."""
    rest = [c for c in rows.columns if c not in METRIC_KEY and c != order]
    last = rows.groupBy(*METRIC_KEY).agg(F.max_by(F.struct(*rest), order).alias("_r"), F.max(order).alias(order))
    return last.select(*METRIC_KEY, order, "_r.*").select(*rows.columns)


def metrics(events: DataFrame, delay: int = 5 * V.SECOND) -> DataFrame:
    """METRIC with ``inserted_at`` in ms: every metric's rows as upserts leave them.

    A row is written ``delay`` after its window closed or, for live rows, after the
    last event came, so that tables of the same events are the same.
    """
    closed = [dora.both_by_window(events), dora.lead_time(events), dora.recovery_time(events), health.health_score(events)]
    rows = [m.withColumn("inserted_at", F.col("window_end_ms") + delay) for m in closed]
    for m in (live.live_deployments(events), live.live_failure_rate(events), live.live_health(events)):
        increments = m.where("seq IS NOT NULL").select("seq", *METRIC_COLUMNS)
        rows.append(upsert_latest(increments, "seq").select(*METRIC_COLUMNS).withColumn("inserted_at", F.col("received") + delay))
    mark = late.watermark_rows(events)
    rows.append(mark.withColumn("inserted_at", F.col("value").cast("long") + V.OUT_OF_ORDER + delay))
    return reduce(DataFrame.union, rows)


def alerts(events: DataFrame) -> DataFrame:
    """(alert_type, payload, at_ms) of matches, timeouts and truly late events."""
    rows = [late.audit(late.truly_late(events))]
    for p in patterns.PATTERNS:
        rows += [patterns.alerts(patterns.matches(events, p), "matched_at_ms"), patterns.alerts(patterns.timeouts(events, p), "expired_at_ms")]
    return reduce(DataFrame.union, rows)
