from __future__ import annotations

import json
import random

import pytest
from helpers import BASE, MIN, event

from millrace.operators import patterns as P
from millrace.sources.readers import from_rows
from millrace.streaming.machines import Patterns

DF, DS, RB, BS, BF = "DEPLOY_FAILED", "DEPLOY_STARTED", "ROLLBACK_STARTED", "BUILD_SUCCESS", "BUILD_FAILED"


def run(spark, pattern, *events):
    df = from_rows(spark, [event(t, int(m * MIN), pipeline=(more or ["p"])[0]) for t, m, *more in events])
    return P.matches(df, pattern).collect(), P.timeouts(df, pattern).collect()


@pytest.mark.parametrize(
    ("pattern", "events", "matched", "expired"),
    [
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 2), (RB, 4)], 1, 1),
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 2)], 0, 2),
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 2), (RB, 12)], 0, 2),
        (P.ROLLBACK_CASCADE, [(DF, 0), ("BUILD_STARTED", 0.5), (DF, 2), (BS, 3), (RB, 4)], 1, 1),
        (P.ROLLBACK_CASCADE, [(DF, 0, "a"), (DF, 2, "a"), (RB, 4, "a"), (DF, 0, "b")], 1, 2),
        (P.ROLLBACK_CASCADE, [(DF, 0)], 0, 1),
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 2), (RB, 10)], 0, 2),
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 2), (RB, 10 - 1 / MIN)], 1, 1),
        (P.ROLLBACK_CASCADE, [(DF, 0), (DF, 0), (RB, 0)], 1, 1),
        (P.DEPLOY_INSTABILITY, [(DF, 0), (DS, 2), (DF, 4)], 1, 1),
        (P.DEPLOY_INSTABILITY, [(DF, 0), (DF, 2)], 0, 2),
        (P.DEPLOY_INSTABILITY, [(DF, 0), (DS, 5), (DF, 11)], 0, 2),
        (P.BUILD_OK_DEPLOY_BROKEN, [(BS, 0), (DF, 3), (DF, 6)], 1, 0),
        (P.BUILD_OK_DEPLOY_BROKEN, [(BF, 0), (DF, 3), (DF, 6)], 0, 0),
        (P.BUILD_OK_DEPLOY_BROKEN, [(BS, 0), (DF, 5), (DF, 16)], 0, 1),
    ],
)
def test_sequences(spark, pattern, events, matched, expired):
    found, late = run(spark, pattern, *events)
    assert (len(found), len(late)) == (matched, expired)


def test_what_alerts_say(spark):
    found, late = run(spark, P.ROLLBACK_CASCADE, (DF, 0), (DF, 2), (RB, 4))
    assert found[0]["cascade_duration_minutes"] == 4.0 and found[0]["alert_type"] == "DEPLOY_ROLLBACK_CASCADE" and found[0]["pipeline_id"] == "p"
    assert [s["step"] for s in found[0]["matched_sequence"]] == ["first_failure", "second_failure", "rollback"]
    assert late[0]["matched_steps"] == ["first_failure"] and late[0]["expired_at_ms"] == BASE + 12 * MIN
    assert run(spark, P.DEPLOY_INSTABILITY, (DF, 0), (DS, 2), (DF, 4))[0][0]["failures"] == 2
    assert "infrastructure" in run(spark, P.BUILD_OK_DEPLOY_BROKEN, (BS, 0), (DF, 3), (DF, 6))[0][0]["likely_cause"]
    df = from_rows(spark, [event(DF, 0), event(DF, 2 * MIN), event(RB, 4 * MIN)])
    payload = json.loads(P.alerts(P.matches(df, P.ROLLBACK_CASCADE), "matched_at_ms").first()["payload"])
    assert payload["rollback_ts"] == df.collect()[2]["event_timestamp"] and payload["cascade_duration_minutes"] == 4.0
    assert P.alert_metric(P.alerts(P.timeouts(df, P.ROLLBACK_CASCADE), "expired_at_ms"), "PATTERN_TIMEOUT").first()["value"] == 0.0


@pytest.mark.parametrize("span", [1, 2, 256])
def test_spans_and_machine_agree(spark, monkeypatch, span):
    """Cutting time changes nothing, and a record-at-a-time machine finds the same."""
    monkeypatch.setattr(P, "SPAN", span)
    pick = random.Random(span)
    events = [event(pick.choice([DF, DF, DS, RB, BS]), pick.randrange(0, 90) * MIN, pipeline=f"p{pick.randrange(3)}", seq=i) for i in range(240)]
    df = from_rows(spark, events)
    rows = []
    for key in {e["pipeline_id"] for e in events}:
        machine = Patterns()
        own = [e for e in events if e["pipeline_id"] == key]
        for e in own:
            machine.on_event(e, -(10**15))
        rows += machine.on_timer(0, max(e["ts"] for e in own) + 100 * MIN)
    expected = sorted((r["metric_type"], r["pipeline_id"], r["seq"], json.loads(r["detail"]).get("matched_steps") or 3) for r in rows if "TIMEOUT" in r["metric_type"])
    found = []
    for p in P.PATTERNS:
        found += [(r["alert_type"], r["pipeline_id"], r["seq"], r["matched_steps"]) for r in P.timeouts(df, p).collect()]
        assert P.matches(df, p).count() == sum(r["metric_type"] == p.name for r in rows)
    assert sorted(found, key=str) == sorted(expected, key=str)
