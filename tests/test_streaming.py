from __future__ import annotations

import json
import os
import random
import time

import pytest
from helpers import BASE, MIN, SEC, event

from millrace.functions import vocabulary as V
from millrace.functions.columns import EVENT
from millrace.operators import dora, late, live
from millrace.plans import dashboard
from millrace.plans.sinks import MetricTable, to_sinks
from millrace.sources.readers import from_rows
from millrace.streaming import machines as M
from millrace.streaming import jobs, processors, windows


def stream(spark, path, events):
    """Events as a stream: one file, so one batch, for each list."""
    names = [c.strip().split()[0] for c in EVENT.split(",")]
    path.mkdir()
    n = 0
    for i, group in enumerate(events):
        lines = []
        for e in group:
            lines.append(json.dumps({k: v for k, v in ({"seq": n} | e).items() if k in names}))
            n += 1
        (path / f"{i:03d}.json").write_text("\n".join(lines))
        os.utime(path / f"{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # files are taken in order of age
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(str(path))


def ran(df, tmp_path, name, mode="append"):
    found = []
    query = df.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).foreachBatch(lambda b, i: found.extend(r.asDict() for r in b.collect())).trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert query.exception() is None
    return found


def spaced(events):
    """A file, so a batch, for each event."""
    return [[e] for e in events]


def test_pairs_equal_batch(spark, tmp_path):
    pick = random.Random(3)
    events = [event(pick.choice(["BUILD_STARTED", "DEPLOY_SUCCESS", "DEPLOY_FAILED", "BUILD_FAILED", "BUILD_SUCCESS"]), i * MIN, pipeline=f"p{pick.randrange(2)}", sha=pick.choice(["a", "b", None]), seq=i) for i in range(120)]
    df = stream(spark, tmp_path / "in", [events[:60], events[60:]])
    for name, batch in (("lead_time", dora.lead_time), ("mttr", dora.recovery_time)):
        got = ran(processors.with_state(df, name), tmp_path, name)
        want = batch(from_rows(spark, events)).collect()
        key = lambda r: (r["pipeline_id"], r["window_start_ms"], r["window_end_ms"], r["value"], r["performance_band"], r["received"])
        assert sorted(map(key, got)) == sorted(map(key, want)) and want


def test_open_builds_go_in_time(spark, tmp_path):
    """A build that waits longer than its entry is kept has no lead time."""
    df = stream(spark, tmp_path / "in", [[event("BUILD_STARTED", 0, sha="a")], [event("DEPLOY_SUCCESS", MIN, sha="a")]])

    def values(name, keep_ms):
        """Of the first two batches: by the clock, a stream goes on without events."""
        found = []
        rows = processors.with_state(df, "lead_time", keep_ms=keep_ms)
        query = rows.writeStream.option("checkpointLocation", str(tmp_path / name)).foreachBatch(lambda b, i: found.extend((i, r["value"]) for r in [*b.collect(), {"value": None}])).start()
        for _ in range(300):
            if any(i >= 1 for i, _ in found):
                break
            time.sleep(0.2)
        query.stop()
        return [v for _, v in found if v is not None]

    assert values("kept", 3_600_000) == [1.0] and values("gone", 1) == []


def test_late_windows_fire_again_and_audit(spark, tmp_path):
    day = BASE - BASE % V.DAY
    make = lambda s=None: M.LateWindows(M.Deployments(), s)
    steps = [
        [event("DEPLOY_SUCCESS", 0, base=day), event("DEPLOY_SUCCESS", SEC, base=day)],
        [event("TEST_STARTED", V.DAY + MIN, base=day)],  # the day is over
        [event("TEST_STARTED", V.DAY + 2 * MIN, base=day)],
        [event("DEPLOY_SUCCESS", 2 * SEC, base=day)],  # within the grace
        [event("TEST_STARTED", V.DAY + 6 * V.HOUR, base=day)],
        [event("TEST_STARTED", V.DAY + 6 * V.HOUR + 1, base=day)],
        [event("DEPLOY_SUCCESS", 3 * SEC, base=day, event_id="late")],  # beyond it
        [event("TEST_STARTED", V.DAY + 7 * V.HOUR, base=day)],
    ]
    got = ran(processors.with_state(stream(spark, tmp_path / "in", steps), "deploy_frequency", make), tmp_path, "late")
    assert [(r["kind"], r["value"]) for r in got] == [("METRIC", 2.0), ("METRIC", 3.0), ("ALERT", None)]
    assert json.loads(got[-1]["detail"])["event_id"] == "late"


def test_patterns_stream(spark, tmp_path):
    events = [event("DEPLOY_FAILED", 0), event("DEPLOY_FAILED", 2 * MIN), event("ROLLBACK_STARTED", 4 * MIN), event("TEST_STARTED", 60 * MIN), event("TEST_STARTED", 61 * MIN)]
    got = ran(processors.with_state(stream(spark, tmp_path / "in", spaced(events)), "patterns"), tmp_path, "patterns")
    names = sorted(r["metric_type"] for r in got)
    assert names == ["DEPLOY_INSTABILITY_TIMEOUT", "DEPLOY_INSTABILITY_TIMEOUT", "DEPLOY_ROLLBACK_CASCADE", "DEPLOY_ROLLBACK_CASCADE_TIMEOUT"]


def test_live_stream_into_sinks(spark, tmp_path):
    events = [event("DEPLOY_SUCCESS", 0), event("DEPLOY_SUCCESS", SEC), event("DEPLOY_SUCCESS", 2 * SEC)]
    table = MetricTable(spark, str(tmp_path / "metrics"))
    rows = processors.with_state(stream(spark, tmp_path / "in", spaced(events)), "live_deployments")
    query = windows.job(rows, "live", str(tmp_path / "cp"), to_sinks(table, str(tmp_path / "alerts"))).trigger(availableNow=True).start()
    query.awaitTermination(180)
    got = table.read().collect()
    assert [(r["metric_type"], r["value"], r["window_start_ms"]) for r in got] == [(V.DEPLOYMENT_FREQUENCY_LIVE, 3.0, 0)]


def test_built_in_windows_update(spark, tmp_path):
    events = [event("DEPLOY_SUCCESS", 0), event("DEPLOY_FAILED", SEC), event("DEPLOY_SUCCESS", 2 * SEC)]
    df = stream(spark, tmp_path / "in", spaced(events))
    got = ran(windows.deployments(df)[V.CHANGE_FAILURE_RATE], tmp_path, "cfr", "update")
    assert [round(r["value"], 1) for r in got] == [0.0, 50.0, 33.3]
    assert [r["value"] for r in ran(windows.health(df), tmp_path, "health", "update")][-1] == pytest.approx(100 - 15 / 3)


@pytest.mark.parametrize("seed", range(3))
def test_live_machine_equals_batch(spark, seed):
    pick = random.Random(seed)
    events = [event(pick.choice(["DEPLOY_SUCCESS", "DEPLOY_FAILED"]), pick.randrange(60) * SEC + i * 500, status=pick.choice(["SUCCESS", "failure"]), seq=i) for i in range(80)]
    machine, got = M.Live(M.FailureRate(), size=10 * SEC, gate=False), []
    for e in events:
        got += machine.on_event(e, 0)
    want = live.live_failure_rate(from_rows(spark, events), 10 * SEC).where("seq IS NOT NULL").collect()
    assert sorted((r["seq"], r["value"], r["sample_count"]) for r in got) == sorted((r["seq"], r["value"], r["sample_count"]) for r in want)


def test_windows_machine_equals_batch(spark):
    """With the same watermark, what the machine leaves is what the batch form counts, and what it audits is what batch calls late."""
    pick = random.Random(5)
    start = BASE - BASE % V.DAY
    events = [event("DEPLOY_SUCCESS", i * 40 * MIN - (pick.random() < 0.2) * pick.randrange(60) * V.HOUR, base=start + 5 * V.DAY, seq=i) for i in range(200)]
    machine, got, top = M.LateWindows(M.Deployments()), [], None
    for e in events:
        mark = -1 if top is None else top - V.OUT_OF_ORDER
        got += machine.on_timer(mark, mark) + machine.on_event(e, mark)
        top = e["ts"] if top is None else max(top, e["ts"])
    got += machine.on_timer(top + 99 * V.DAY, top + 99 * V.DAY)
    df = from_rows(spark, events)
    last = {r["window_start_ms"]: r["value"] for r in got if r["kind"] == "METRIC"}
    want = {r["window_start_ms"]: r["value"] for r in dora.deployment_frequency(late.on_time(df, V.DEPLOYMENT_FREQUENCY)).collect()}
    assert last == want
    assert sum(r["kind"] == "ALERT" for r in got) == late.truly_late(df).where(f"source_metric = '{V.DEPLOYMENT_FREQUENCY}'").count() > 0


def test_band_change_machine():
    m = M.BandChange()
    assert [bool(m.on_event({"performance_band": b}, 0)) for b in ("Low", "Low", "Elite", None, None, "Elite")] == [True, False, True, True, True, True]


def test_health_bands_machine():
    m = M.MACHINES["live_health_bands"]()
    got = []
    for i, t in enumerate(["BUILD_SUCCESS", "TEST_SUCCESS", "BUILD_FAILED", "BUILD_FAILED", "BUILD_FAILED"]):
        got += m.on_event(event(t, i * SEC, seq=i), -1)
        m = M.MACHINES["live_health_bands"](json.loads(json.dumps(m.state)))
    assert [(r["performance_band"], r["seq"]) for r in got] == [("Elite", 0), ("High", 2)]


def test_whole_job(spark, tmp_path):
    """Metrics, annotations, the watermark and its panels over streamed tables; a second checkpoint adds to them."""
    events = [event("BUILD_STARTED", 0), event("DEPLOY_SUCCESS", MIN), event("BUILD_FAILED", 2 * MIN), event("BUILD_SUCCESS", 3 * MIN)]
    posted = []
    parts = ("watermark", "lead_time", "mttr", "live_deployments")
    out = str(tmp_path / "out")

    def run(name, some):
        began = int(time.time() * 1000)
        for q in jobs.start(stream(spark, tmp_path / name, spaced(some)), out, str(tmp_path / f"cp-{name}"), lambda a: posted.extend(r["text"] for r in a.collect()), parts, {"availableNow": True}):
            q.awaitTermination(180)
            assert q.exception() is None
        return began, {r["metric_type"]: r for r in jobs.metrics(spark, out, parts).collect()}

    began, got = run("in", events)
    assert {k: r["value"] for k, r in got.items()} == {V.WATERMARK: BASE + 3 * MIN - V.OUT_OF_ORDER, V.LEAD_TIME: 1.0, V.RECOVERY_TIME: 1.0, V.DEPLOYMENT_FREQUENCY_LIVE: 1.0}
    assert len(posted) == 2 and all(began <= r["inserted_at"] <= time.time() * 1000 for r in got.values())
    metrics, alerts = jobs.metrics(spark, out, parts), jobs.alerts(spark, out, parts)
    panels = {name: dashboard.panel(spark, name, metrics, alerts).collect() for name in ("watermark", "latency_trend", "latency_span", "latest_alerts")}
    assert panels["watermark"][0]["current_watermark"] == BASE + 3 * MIN - V.OUT_OF_ORDER
    # these events are received at once and written now, so the panels show how long that is
    assert panels["latency_trend"] and all(r["value"] > 0 for r in panels["latency_trend"]) and all(r["span_ms"] > 0 for r in panels["latency_span"])
    _, got = run("again", [event("BUILD_STARTED", 10 * MIN, sha="x"), event("DEPLOY_SUCCESS", 14 * MIN, sha="x")])
    leads = jobs.metrics(spark, out, parts).where(f"metric_type = '{V.LEAD_TIME}'").collect()
    assert sorted(r["value"] for r in leads) == [1.0, 4.0] and got[V.WATERMARK]["value"] == BASE + 14 * MIN - V.OUT_OF_ORDER


def test_the_watermark_only_rises(spark, tmp_path):
    table = MetricTable(spark, str(tmp_path / "metrics"))
    sink = jobs.watermark_sink(table)
    for i, top in enumerate((50_000, 40_000, None, 90_000)):
        sink(spark.createDataFrame([(top,)], "ts long"), i)
        assert [r["value"] for r in table.read().collect()] == [{0: 20_000, 3: 60_000}.get(i, 20_000)]


def test_heartbeats_are_few_and_spread(spark, tmp_path):
    """A batch of any number of events makes one heartbeat for each task."""
    events = [event("TEST_STARTED", i * SEC) for i in range(300)] + [event("DEPLOY_SUCCESS", 301 * SEC)]
    df = from_rows(spark, events).repartition(3)
    got = processors.with_heartbeats(df.select(*processors.NEEDED), df, ("DEPLOY_SUCCESS",)).collect()
    beats = [r for r in got if r["to"].startswith(processors.HEARTBEAT)]
    assert len(got) - len(beats) == 1 and 1 <= len(beats) <= 3 and len({r["to"] for r in beats}) == len(beats)
    assert max(r["at"] for r in beats).timestamp() * 1000 == BASE + 301 * SEC and next(r for r in got if r["to"] == "p" or r not in beats)["at"] is None
