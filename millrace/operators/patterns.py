"""Sequences of events within a time: one outcome, a match or a timeout, for each first event.

Events between the steps don't matter (relaxed contiguity), each step takes the
next event that fits, and an event may serve several sequences.  A match's last
event is less than ``within`` after its first; events with equal times follow each
other by arrival.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V


@dataclass(frozen=True)
class SequencePattern:
    name: str
    title: str
    timeout_text: str
    within: int
    steps: tuple[tuple[str, str], ...]

    def labels(self) -> list[str]:
        return [s for s, _ in self.steps]


ROLLBACK_CASCADE = SequencePattern(
    "DEPLOY_ROLLBACK_CASCADE", "Repeated Deploy Failure -> Rollback", "Repeated deploy failure did not roll back within the 10-minute window", 10 * V.MINUTE,
    (("first_failure", "DEPLOY_FAILED"), ("second_failure", "DEPLOY_FAILED"), ("rollback", "ROLLBACK_STARTED")),
)
DEPLOY_INSTABILITY = SequencePattern(
    "DEPLOY_INSTABILITY", "Deployment Instability (fail -> retry -> fail)", "Deploy failed and retried but the retry's outcome did not arrive within the 10-minute window", 10 * V.MINUTE,
    (("first_failure", "DEPLOY_FAILED"), ("retry_deploy", "DEPLOY_STARTED"), ("second_failure", "DEPLOY_FAILED")),
)
BUILD_OK_DEPLOY_BROKEN = SequencePattern(
    "BUILD_OK_DEPLOY_BROKEN", "Build Succeeded but Deploy Repeatedly Failed", "Build succeeded but deploy failures did not repeat a second time within the 15-minute window", 15 * V.MINUTE,
    (("build_ok", "BUILD_SUCCESS"), ("first_failure", "DEPLOY_FAILED"), ("second_failure", "DEPLOY_FAILED")),
)
PATTERNS = (ROLLBACK_CASCADE, DEPLOY_INSTABILITY, BUILD_OK_DEPLOY_BROKEN)
LIKELY_CAUSE = "Application build succeeded — repeated deploy failures point to infrastructure/configuration issues rather than code"

FIELDS = ("ts", "seq", "event_type", "event_timestamp")
#: Events of a pipeline that are ordered together: so many times ``within``.
SPAN = 256


def outcomes(events: DataFrame, pattern: SequencePattern) -> DataFrame:
    """(pipeline_id, service_name, branch, commit_sha, seq, step_1 .. step_n, matched, steps): each first event's outcome.

    A pipeline's time is cut into spans, and a span also gets the events up to
    ``within`` after it, which is all that its first events can reach; so a busy
    pipeline is many tasks.  Within a span, running windows from the end backwards
    find the next event of each step: one exchange and one sort for all steps.
    """
    span = SPAN * pattern.within
    types = {t for _, t in pattern.steps}
    own = events.where(F.col("event_type").isin(*types)).select("pipeline_id", "service_name", "branch", "commit_sha", *FIELDS)
    at = F.floor(F.col("ts") / span)
    spans = F.when(F.pmod("ts", F.lit(span)) < pattern.within, F.array(at, at - 1)).otherwise(F.array(at))
    dealt = own.withColumn("_span", F.explode(spans))
    w = Window.partitionBy("pipeline_id", "_span").orderBy(F.desc("ts"), F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    following: str | None = None
    for k in range(len(pattern.steps), 1, -1):
        fields = [F.col(f) for f in FIELDS] + ([F.col(following).alias("next")] if following else [])
        dealt = dealt.withColumn(f"_s{k}", F.last(F.when(F.col("event_type") == pattern.steps[k - 1][1], F.struct(*fields)), ignorenulls=True).over(w))
        following = f"_s{k}"
    starts = dealt.where((F.col("event_type") == pattern.steps[0][1]) & (F.col("_span") == at))
    step, path = [F.struct(*FIELDS)], "_s2"
    reached = F.lit(True)
    for _ in pattern.steps[1:]:
        reached = reached & F.coalesce(F.col(f"{path}.ts") - F.col("ts") < pattern.within, F.lit(False))
        step.append(F.when(reached, F.struct(*[F.col(f"{path}.{f}") for f in FIELDS])))
        path += ".next"
    found = starts.select("pipeline_id", "service_name", "branch", "commit_sha", "seq", *[s.alias(f"step_{k + 1}") for k, s in enumerate(step)])
    count = sum((F.col(f"step_{k + 1}").isNotNull().cast("int") for k in range(1, len(step))), F.lit(1))
    return found.withColumn("steps", count).withColumn("matched", F.col("steps") == len(step))


def _at(k: int, field: str) -> Column:
    return F.col(f"step_{k}.{field}")


def alert_fields(pattern: SequencePattern) -> dict[str, Column]:
    """What a match's alert says besides its names."""
    out = {f"{label}_ts": _at(k + 1, "event_timestamp") for k, label in enumerate(pattern.labels())}
    if pattern is ROLLBACK_CASCADE:
        out["cascade_duration_minutes"] = (_at(3, "ts") - _at(1, "ts")) / F.lit(60000.0)
    elif pattern is DEPLOY_INSTABILITY:
        out["failures"] = F.lit(2)
    else:
        out = {("build_success_ts" if k == "build_ok_ts" else k): c for k, c in out.items()} | {"likely_cause": F.lit(LIKELY_CAUSE)}
    return out


def matches(events: DataFrame, pattern: SequencePattern) -> DataFrame:
    """The matches as flat rows: one for each alert."""
    found = outcomes(events, pattern).where("matched")
    sequence = F.array(*[F.struct(F.lit(label).alias("step"), _at(k + 1, "event_type").alias("event"), _at(k + 1, "event_timestamp").alias("ts")) for k, label in enumerate(pattern.labels())])
    return found.select(
        F.lit(pattern.name).alias("alert_type"), F.lit(pattern.title).alias("pattern_name"), "pipeline_id", "service_name", "branch", "commit_sha", *[c.alias(k) for k, c in alert_fields(pattern).items()],
        sequence.alias("matched_sequence"), "seq", _at(len(pattern.steps), "ts").alias("matched_at_ms"),
    )


def timeouts(events: DataFrame, pattern: SequencePattern) -> DataFrame:
    """The partial matches that expired, as flat rows."""
    labels = F.array(*[F.lit(x) for x in pattern.labels()])
    return outcomes(events, pattern).where("NOT matched").select(
        F.lit(f"{pattern.name}_TIMEOUT").alias("alert_type"), F.lit(pattern.timeout_text).alias("description"), "pipeline_id", "service_name",
        F.slice(labels, F.lit(1), F.col("steps")).alias("matched_steps"), (_at(1, "ts") + pattern.within).alias("expired_at_ms"), "seq",
    )


def alerts(rows: DataFrame, at: str) -> DataFrame:
    """(alert_type, payload, at_ms) of matches or timeouts."""
    fields = [c for c in rows.columns if c not in ("seq", "matched_at_ms")]
    return rows.select("alert_type", F.to_json(F.struct(*fields)).alias("payload"), F.col(at).alias("at_ms"))


def alert_metric(alerts: DataFrame, metric_type: str) -> DataFrame:
    """Alerts as metric rows that only carry the document, for annotations."""
    none = lambda t: F.lit(None).cast(t)
    return alerts.select(
        F.lit(metric_type).alias("metric_type"), none("string").alias("pipeline_id"), none("string").alias("service_name"), none("long").alias("window_start_ms"), none("long").alias("window_end_ms"),
        F.lit(0.0).alias("value"), none("string").alias("performance_band"), F.lit(0).cast("long").alias("sample_count"), F.col("payload").alias("detail"), none("long").alias("received"),
    )
