from __future__ import annotations

import random

import pytest
from helpers import BASE, MIN, SEC, event, rows

from millrace.functions import vocabulary as V
from millrace.functions.columns import band
from millrace.operators import dora, health, late, live
from millrace.sources.readers import from_rows
from pyspark.sql import functions as F

W = 10 * SEC
ALIGNED = BASE - BASE % (10 * MIN)


def frame(spark, *events):
    return from_rows(spark, events)


def test_deployment_frequency_counts_windows(spark):
    e = frame(spark, event("DEPLOY_SUCCESS", 0), event("DEPLOY_SUCCESS", SEC), event("DEPLOY_FAILED", 2 * SEC), event("DEPLOY_SUCCESS", 3 * SEC, service="svc-b"), event("BUILD_STARTED", 3 * SEC), event("DEPLOY_SUCCESS", 10 * SEC, service="svc-b"))
    got = rows(dora.deployment_frequency(e, W).orderBy("window_start_ms"), "value", "sample_count", "service_name", "performance_band", "received")
    assert got == [(3.0, 3, "svc-b", "Elite", BASE + 5), (1.0, 1, "svc-b", "Elite", BASE + 10 * SEC + 5)]


def test_deployment_frequency_ignores_failures(spark):
    assert not rows(dora.deployment_frequency(frame(spark, event("DEPLOY_FAILED", 0), event("DEPLOY_FAILED", SEC))), "value")


def test_deployment_frequency_history_and_unset_received(spark):
    e = [event("DEPLOY_SUCCESS", o * SEC, received=0) for o in (0, 1, 2, 15, 16)]
    assert rows(dora.deployment_frequency(frame(spark, *e), W).orderBy("window_start_ms"), "value", "received") == [(3.0, 0), (2.0, 0)]


@pytest.mark.parametrize(("second", "percent", "name"), [("DEPLOY_FAILED", 50.0, "Low"), ("DEPLOY_SUCCESS", 0.0, "Elite")])
def test_change_failure_rate(spark, second, percent, name):
    e = frame(spark, event("DEPLOY_SUCCESS", 0), event(second, 10 * SEC))
    assert rows(dora.change_failure_rate(e, 7 * V.DAY), "value", "performance_band", "sample_count") == [(percent, name, 2)]


def test_a_failed_status_fails_whatever_the_type(spark):
    assert rows(dora.change_failure_rate(frame(spark, event("DEPLOY_SUCCESS", 0, status="failure"))), "value") == [(100.0,)]


def test_lead_time(spark):
    one = lambda *e: rows(dora.lead_time(frame(spark, *e)), "value", "sample_count", "window_start_ms", "received")
    assert one(event("BUILD_STARTED", 0), event("DEPLOY_SUCCESS", 20 * MIN)) == [(20.0, 1, BASE, BASE + 5)]
    assert one(event("BUILD_STARTED", 0, sha="a"), event("DEPLOY_SUCCESS", 20 * MIN, sha="b")) == []
    assert [r[0] for r in one(event("BUILD_STARTED", 0, sha="a"), event("DEPLOY_FAILED", 5 * MIN, sha="a"), event("BUILD_STARTED", 10 * MIN, sha="b"), event("DEPLOY_SUCCESS", 25 * MIN, sha="b"))] == [15.0]
    assert [r[0] for r in one(event("BUILD_STARTED", 0, sha=None), event("DEPLOY_SUCCESS", MIN, sha=None))] == [1.0]
    assert one(event("BUILD_STARTED", 0), event("DEPLOY_SUCCESS", MIN), event("DEPLOY_SUCCESS", 2 * MIN))[0][0] == 1.0


def test_recovery_time(spark):
    one = lambda *e: rows(dora.recovery_time(frame(spark, *e)), "value", "performance_band")
    assert one(event("BUILD_FAILED", 0), event("BUILD_SUCCESS", 45 * MIN)) == [(45.0, "Elite")]
    assert one(event("BUILD_FAILED", 0)) == []
    assert one(event("BUILD_FAILED", 0), event("BUILD_FAILED", 30 * MIN), event("BUILD_SUCCESS", 40 * MIN)) == [(10.0, "Elite")]


@pytest.mark.parametrize(
    ("metric", "values"),
    [
        (V.DEPLOYMENT_FREQUENCY, [(2.0, "Elite"), (1.0, "Elite"), (0.99, "High"), (1 / 7, "High"), (0.14, "Medium"), (1 / 30, "Medium"), (0.01, "Low")]),
        (V.LEAD_TIME, [(30.0, "Elite"), (60.0, "High"), (200.0, "High"), (1440.0, "Medium"), (10080.0, "Low"), (20000.0, "Low")]),
        (V.CHANGE_FAILURE_RATE_LIVE, [(5.0, "Elite"), (5.1, "High"), (10.0, "High"), (15.0, "Medium"), (15.1, "Low")]),
        (V.HEALTH_SCORE, [(85.0, "Elite"), (84.9, "High"), (70.0, "High"), (50.0, "Medium"), (49.9, "Low")]),
        (V.WATERMARK, [(1.0, "N/A")]),
    ],
)
def test_bands(spark, metric, values):
    df = spark.createDataFrame([(metric, v) for v, _ in values], "metric_type string, value double")
    assert [r[0] for r in df.select(band(metric, F.col("value"))).collect()] == [n for _, n in values]
    assert [r[0] for r in df.select(band(None, F.col("value"))).collect()] == [n for _, n in values]


def scored(spark, *types):
    e = [event(t, i * SEC, base=ALIGNED) for i, t in enumerate(types)]
    return rows(health.health_score(frame(spark, *e), 10 * MIN), "value", "performance_band", "sample_count", "detail", "service_name")


def test_health_scores(spark):
    four = ("BUILD", "TEST", "SONARQUBE", "PACKAGE")
    assert scored(spark, *[f"{s}_SUCCESS" for s in four])[0][:3] == (100.0, "Elite", 4)
    got = scored(spark, "BUILD_SUCCESS", "BUILD_FAILED", "TEST_SUCCESS", "SONARQUBE_SUCCESS", "PACKAGE_SUCCESS")[0]
    assert got[0] == pytest.approx(82.5) and '"build":50.0' in got[3]
    assert scored(spark, "BUILD_SUCCESS", "BUILD_SUCCESS", "DEPLOY_FAILED", "DEPLOY_SUCCESS")[0][0] == pytest.approx(92.5)
    assert scored(spark, *[f"{s}_FAILED" for s in four])[0][:2] == (pytest.approx(15.0), "Low")
    assert scored(spark, "BUILD_STARTED")[0][:3] == (100.0, "Elite", 0) and scored(spark, "BUILD_STARTED")[0][4] == ""


def test_health_goes_by_status(spark):
    e = frame(spark, event("BUILD_FAILED", 0, status="success"), event("TEST_SUCCESS", 0, status=None), event("TEST_SUCCESS", SEC, status="failure"))
    assert rows(health.health_score(e), "value")[0][0] == pytest.approx(100 - 12.5)


def test_band_changes(spark):
    df = spark.createDataFrame([("p", i, b) for i, b in enumerate(["Low", "Low", "Elite", None, None, "Elite", "Elite"])], "pipeline_id string, at int, performance_band string")
    assert [r["at"] for r in health.band_changes(df, ["at"]).orderBy("at").collect()] == [0, 2, 3, 4, 5]


def increments(df):
    got = df.orderBy(F.col("seq").asc_nulls_last(), "closes_ms").collect()
    return [(r["value"], r["sample_count"]) for r in got if r["seq"] is not None], sum(r["seq"] is None for r in got)


def test_live_counters(spark):
    deploys = lambda *o: increments(live.live_deployments(frame(spark, *[event("DEPLOY_SUCCESS", x * SEC) for x in o]), W))
    assert deploys(0, 1, 2) == ([(1.0, 1), (2.0, 2), (3.0, 3)], 1)
    assert deploys(0, 1, 15) == ([(1.0, 1), (2.0, 2), (1.0, 1)], 1)
    assert deploys(15, 5, 16) == ([(1.0, 1), (2.0, 2)], 1)
    rate = lambda *e: increments(live.live_failure_rate(frame(spark, *[event(t, x * SEC) for t, x in e]), W))
    assert rate(("DEPLOY_SUCCESS", 0), ("DEPLOY_FAILED", 1)) == ([(0.0, 1), (50.0, 2)], 1)
    assert rate(("DEPLOY_SUCCESS", 0), ("DEPLOY_FAILED", 1), ("DEPLOY_FAILED", 15)) == ([(0.0, 1), (50.0, 2), (100.0, 1)], 1)
    assert rate(("DEPLOY_SUCCESS", 15), ("DEPLOY_FAILED", 5), ("DEPLOY_SUCCESS", 16)) == ([(0.0, 1), (0.0, 2)], 1)


def test_live_gate_follows_all_events(spark):
    """A build moves the watermark past the window of a deployment that comes after it."""
    for between, n in (("DEPLOY_SUCCESS", 2), ("BUILD_STARTED", 1)):
        e = frame(spark, event("DEPLOY_SUCCESS", 0), event(between, 15 * SEC + V.OUT_OF_ORDER), event("DEPLOY_SUCCESS", SEC))
        assert len(increments(live.live_deployments(e, W, gate=True))[0]) == n


def test_live_health(spark):
    own = lambda *e: increments(live.live_health(frame(spark, *[event(t, x * SEC) for t, x in e]), W))
    near = lambda got: ([(pytest.approx(v), n) for v, n in got[0]], got[1])
    assert own(("BUILD_SUCCESS", 0), ("BUILD_FAILED", 1)) == near(([(100.0, 1), (82.5, 2)], 1))
    assert own(("BUILD_SUCCESS", 0), ("BUILD_FAILED", 1), ("BUILD_SUCCESS", 15)) == near(([(100.0, 1), (82.5, 2), (100.0, 1)], 2))
    assert own(("BUILD_SUCCESS", 15), ("BUILD_FAILED", 5), ("BUILD_SUCCESS", 16)) == near(([(100.0, 1), (100.0, 2)], 1))


def test_watermark_in_runs_equals_a_plain_one(spark):
    offsets = [5, 3, 9, 2, 14, 1, 20, 18, 40, 4]
    e = frame(spark, *[event("DEPLOY_SUCCESS", o * MIN) for o in offsets])
    got = [r[0] for r in late.arrival_watermark(e, 0, run=3).orderBy("seq").select("watermark").collect()]
    assert got == [None] + [BASE + max(offsets[:i]) * MIN for i in range(1, len(offsets))]


def test_truly_late_events_and_grace(spark):
    start = BASE - BASE % V.DAY
    far = V.DAY + 5 * V.HOUR + V.OUT_OF_ORDER
    for ahead, expected in ((far - 1, 0), (far, 1)):
        e = frame(spark, event("DEPLOY_SUCCESS", 0, base=start), event("TEST_STARTED", ahead, base=start), event("DEPLOY_SUCCESS", 1, base=start, event_id="late", received=start + ahead))
        found = late.truly_late(e).where(F.col("source_metric") == V.DEPLOYMENT_FREQUENCY)
        assert found.count() == expected
        assert rows(dora.deployment_frequency(late.on_time(e, V.DEPLOYMENT_FREQUENCY)), "value") == [(2.0 - expected,)]
    payload = late.audit(found).first()["payload"]
    assert '"event_id":"late"' in payload and '"late":true' in payload
    assert rows(late.late_counts(found), "value", "sample_count") == [(1.0, 1)]


@pytest.mark.parametrize("run", [1, 3, 1000])
def test_runs_make_no_difference(spark, run):
    """What came before a row, for keys whose rows fall into many runs, runs of runs included."""
    from millrace.operators.runs import highest_before, row_before

    pick = random.Random(run)
    rows = [(pick.choice(["a", "b", None]), i, pick.randrange(100)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, seq long, v long").repartition(3)
    high, last = {}, {}
    want = {}
    for k, i, v in rows:
        want[i] = (high.get(k), last.get(k))
        high[k], last[k] = max(v, high.get(k, v)), v
    assert {r["seq"]: r["_before"] for r in highest_before(df, ["k"], "v", "seq", (), run).collect()} == {i: x for i, (x, _) in want.items()}
    got = row_before(df, ["k"], ["v"], "seq", run).collect()
    assert {r["seq"]: r["_before"] and r["_before"]["v"] for r in got} == {i: x for i, (_, x) in want.items()}
