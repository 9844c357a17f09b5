from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

from millrace.functions import vocabulary as V
from millrace.operators import route
from millrace.sources import generate, readers
from millrace.sources.decode import decode

NOW = 1_800_000_000_000


def decoded(spark, *values):
    df = spark.createDataFrame([(v, NOW, i) for i, v in enumerate(values)], "value string, received long, seq long")
    return {r["seq"]: r for r in decode(df).collect()}


def test_envelope_unknown_fields_and_drops(spark):
    got = decoded(spark, '{"event": {"pipeline_id": "a", "event_type": "X", "extra": 1}, "_meta": {}}', '{"pipeline_id": "b", "service_name": 5}', '{"event": null, "pipeline_id": "c"}', "not json", "", None, "[]", "5", '{"event_type": "X"}', '{"pipeline_id": ""}')
    assert {k: r["pipeline_id"] for k, r in got.items()} == {0: "a", 1: "b", 9: ""}
    assert got[1]["service_name"] == "5"


def test_times_need_a_zone(spark):
    stamp = lambda s: json.dumps({"pipeline_id": "a", "event_timestamp": s})
    got = decoded(spark, stamp("2026-07-08T23:07:00Z"), stamp("2026-07-09T01:07:00.250+02:00"), stamp("2026-07-08T23:07:00"), stamp("soon"), stamp(""), '{"pipeline_id": "a"}')
    assert [got[i]["ts"] for i in range(6)] == [1783552020000, 1783552020250, NOW, NOW, NOW, NOW]


def test_branches(spark):
    rows = [{"pipeline_id": "p", "event_type": t, "ts": 1_000_000, "received": 1_000_000 + late} for t, late in (("DEPLOY_FAILED", 0), ("TEST_SUCCESS", 40_000), ("ROLLBACK_STARTED", 30_000), ("OTHER", 0), (None, 90_000))]
    got = {r["event_type"]: (r["is_dora"], r["is_health"], r["is_pattern"], r["is_late"]) for r in route.routed(readers.from_rows(spark, rows)).collect()}
    assert got == {"DEPLOY_FAILED": (True, True, True, False), "TEST_SUCCESS": (False, True, False, True), "ROLLBACK_STARTED": (False, False, True, False), "OTHER": (False,) * 4}


def test_generators_and_files(spark, tmp_path):
    start = datetime(2026, 7, 1, tzinfo=UTC)
    made = list(generate.lifecycles(300, start))
    assert made == list(generate.lifecycles(300, start)) and len(made) == 300
    assert {m["event"]["event_type"] for m in made} <= set(V.HEALTH_TYPES)
    (tmp_path / "events.jsonl").write_text("\n".join(json.dumps(m) for m in made))
    got = readers.json_lines(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["event_id"] for r in got] == [m["event"]["event_id"] for m in made]
    assert len(generate.scenario("rollback_cascade", start, count=2)) == 2
    (tmp_path / "groups.json").write_text(json.dumps({"a": made[:3], "b": made[3:5]}))
    got = readers.grouped_json(spark, str(tmp_path / "groups.json")).orderBy("seq").collect()
    assert [r["event_id"] for r in got] == [m["event"]["event_id"] for m in made[:5]]


def test_lines_are_numbered_by_file_and_place(spark, tmp_path):
    """Whatever the sizes of the files, in which Spark deals them out, and however they are split."""
    line = lambda name, i: json.dumps({"pipeline_id": name, "event_id": f"{i}", "event_type": "X" * (i % 50)})
    for name, n in (("a", 2), ("b", 500), ("c", 30)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(line(name, i) for i in range(n)))
    want = [("a", i) for i in range(2)] + [("b", i) for i in range(500)] + [("c", i) for i in range(30)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (before, "5000", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = readers.json_lines(spark, str(tmp_path)).collect()
        assert [(r["pipeline_id"], int(r["event_id"])) for r in sorted(got, key=lambda r: r["seq"])] == want
        assert sorted(r["seq"] for r in got) == list(range(532))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_streamed_files_follow_their_times(spark, tmp_path):
    import os

    for k, name in enumerate("zya"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"pipeline_id": name, "event_id": str(i)}) for i in range(5)))
        os.utime(tmp_path / f"{name}.jsonl", (1_700_000_000 + k, 1_700_000_000 + k))
    found = []
    q = readers.json_lines(spark, str(tmp_path), stream=True).writeStream.foreachBatch(lambda b, i: found.extend(b.collect())).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r["pipeline_id"], r["event_id"]) for r in sorted(found, key=lambda r: r["seq"])] == [(n, str(i)) for n in "zya" for i in range(5)]


def test_events_between_the_steps_do_not_matter(spark, tmp_path):
    """Generated scenarios with other events between their steps, written to a file and read again, match as without them."""
    from millrace.operators import patterns

    start = datetime(2026, 7, 8, tzinfo=UTC)
    for name, p in zip(("rollback_cascade", "deploy_instability", "build_ok_deploy_broken"), patterns.PATTERNS, strict=True):
        for noise in ((), ("TEST_STARTED", "TEST_SUCCESS")):
            path = str(tmp_path / f"{name}{len(noise)}.jsonl")
            n, rate = generate.write_lines(generate.scenario(name, start, noise=noise), path)
            assert n == 3 + 2 * len(noise) and rate > 0
            events = readers.json_lines(spark, path)
            assert patterns.matches(events, p).count() == 1
        assert patterns.matches(readers.from_rows(spark, []), p).count() == 0


def corpus(zone="Z"):
    """Grouped messages: nine builds of a service 35 minutes before seven good and two failed deployments, an incident of 47 minutes, three deployments of another service after 20, and a late pair 2 apart."""
    start = datetime(2026, 7, 6, 9, tzinfo=UTC)

    def pair(pipeline, sha, day, minutes, end):
        at = start + timedelta(days=day)
        return [generate.message(t, at + timedelta(minutes=m), pipeline, "main", sha, day, k) for k, (t, m) in enumerate((("BUILD_STARTED", 0), (end, minutes)))]

    groups = {
        "history": sum((pair("kiln", f"k{i}", i % 4, 35, "DEPLOY_FAILED" if i in (3, 6) else "DEPLOY_SUCCESS") for i in range(1, 10)), []),
        "incident": [generate.message(t, start + timedelta(minutes=m), "kiln", "main", "k", 0, m) for t, m in (("BUILD_FAILED", 100), ("BUILD_SUCCESS", 147))],
        "other": sum((pair("loom", f"l{i}", i, 20, "DEPLOY_SUCCESS") for i in range(3)), []),
        "trigger": pair("anvil", "a", 8, 0, "DEPLOY_SUCCESS")[:1],
        "verification": pair("anvil", "b", 8, 2, "DEPLOY_SUCCESS"),
    }
    for m in sum(groups.values(), []):
        m["event"]["event_timestamp"] = m["event"]["event_timestamp"].removesuffix("Z") + zone
    return json.dumps(groups)


def test_sample_corpus(spark, tmp_path):
    """Eleven lead times, one recovery, no pattern; without a zone, times are those of arrival."""
    from pyspark.sql import functions as F

    from millrace.operators import dora, patterns

    (tmp_path / "with.json").write_text(corpus())
    (tmp_path / "without.json").write_text(corpus(""))
    events = readers.grouped_json(spark, str(tmp_path / "with.json"))
    assert sorted(r["value"] for r in dora.lead_time(events).collect()) == [2.0] + [20.0] * 3 + [35.0] * 7
    assert [(r["value"], r["performance_band"]) for r in dora.recovery_time(events).collect()] == [(47.0, "Elite")]
    assert all(patterns.matches(events, p).count() == 0 for p in patterns.PATTERNS)
    rates = {(r["pipeline_id"], r["window_start_ms"] // V.DAY): (r["value"], r["sample_count"]) for r in dora.change_failure_rate(events).collect()}
    assert sum(n for _, n in rates.values()) == 13 and sum(v * n / 100 for v, n in rates.values()) == 2
    events = readers.grouped_json(spark, str(tmp_path / "without.json"), F.lit(NOW).cast("long"))
    assert {r["ts"] for r in events.collect()} == {NOW} and {r["value"] for r in dora.lead_time(events).collect()} == {0.0}
