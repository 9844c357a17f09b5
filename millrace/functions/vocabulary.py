"""Fixed values of the delivery model: event types, windows, weights and thresholds."""

from __future__ import annotations

STAGES = ("BUILD", "TEST", "SONARQUBE", "PACKAGE", "DEPLOY")
OUTCOMES = ("STARTED", "SUCCESS", "FAILED")

DORA_TYPES = ("BUILD_STARTED", "BUILD_SUCCESS", "BUILD_FAILED", "DEPLOY_STARTED", "DEPLOY_SUCCESS", "DEPLOY_FAILED")
HEALTH_TYPES = tuple(f"{s}_{o}" for s in STAGES for o in OUTCOMES)
PATTERN_TYPES = ("BUILD_SUCCESS", "DEPLOY_STARTED", "DEPLOY_FAILED", "ROLLBACK_STARTED")

#: Weight of each stage in the health score.
HEALTH_WEIGHTS = {"BUILD": 0.35, "TEST": 0.25, "SONARQUBE": 0.15, "PACKAGE": 0.10, "DEPLOY": 0.15}

SECOND, MINUTE, HOUR, DAY = 1_000, 60_000, 3_600_000, 86_400_000
DEPLOY_WINDOW = DAY
FAILURE_WINDOW = DAY
HEALTH_WINDOW = 30 * MINUTE
LATE_COUNT_WINDOW = 10 * MINUTE
OUT_OF_ORDER = 30 * SECOND
ALLOWED_LATENESS = 5 * HOUR

DEPLOYMENT_FREQUENCY = "DEPLOYMENT_FREQUENCY"
LEAD_TIME = "LEAD_TIME_FOR_CHANGES"
CHANGE_FAILURE_RATE = "CHANGE_FAILURE_RATE"
RECOVERY_TIME = "MEAN_TIME_TO_RECOVERY"
HEALTH_SCORE = "PIPELINE_HEALTH_SCORE"
DEPLOYMENT_FREQUENCY_LIVE = "DEPLOYMENT_FREQUENCY_LIVE"
CHANGE_FAILURE_RATE_LIVE = "CHANGE_FAILURE_RATE_LIVE"
HEALTH_SCORE_LIVE = "PIPELINE_HEALTH_SCORE_LIVE"
WATERMARK = "WATERMARK"
PATTERN_DETECTED = "FAILURE_PATTERN_DETECTED"
PATTERN_TIMEOUT = "PATTERN_TIMEOUT"
LATE_DETECTED = "LATE_EVENT_DETECTED"
DEPLOYMENT_FREQUENCY_LATE = "DEPLOYMENT_FREQUENCY_LATE_EVENTS"
CHANGE_FAILURE_RATE_LATE = "CHANGE_FAILURE_RATE_LATE_EVENTS"
HEALTH_SCORE_LATE = "PIPELINE_HEALTH_SCORE_LATE_EVENTS"
LATE_EVENT = "LATE_EVENT"

#: By metric: thresholds of Elite, High and Medium, and whether larger is better.
BANDS = {
    DEPLOYMENT_FREQUENCY: ((1.0, 1.0 / 7.0, 1.0 / 30.0), "at_least"),
    DEPLOYMENT_FREQUENCY_LIVE: ((1.0, 1.0 / 7.0, 1.0 / 30.0), "at_least"),
    LEAD_TIME: ((60.0, 1440.0, 10080.0), "under"),
    RECOVERY_TIME: ((60.0, 1440.0, 10080.0), "under"),
    CHANGE_FAILURE_RATE: ((5.0, 10.0, 15.0), "at_most"),
    CHANGE_FAILURE_RATE_LIVE: ((5.0, 10.0, 15.0), "at_most"),
    HEALTH_SCORE: ((85.0, 70.0, 50.0), "at_least"),
    HEALTH_SCORE_LIVE: ((85.0, 70.0, 50.0), "at_least"),
}
BAND_NAMES = ("Elite", "High", "Medium", "Low")

#: Metrics that are annotated whatever their band; the health score only when Low or Elite.
ANNOTATED = (
    PATTERN_DETECTED, PATTERN_TIMEOUT, LATE_DETECTED, DEPLOYMENT_FREQUENCY_LATE, CHANGE_FAILURE_RATE_LATE, HEALTH_SCORE_LATE,
    DEPLOYMENT_FREQUENCY, LEAD_TIME, CHANGE_FAILURE_RATE, RECOVERY_TIME,
)
#: The first tag of annotations; a deployment sets its own.
ANNOTATION_TAG = "delivery-metrics"
