from __future__ import annotations

import glob
import os

import pytest
from helpers import MIN, SEC, event
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V
from millrace.plans import dashboard, queries, sinks, tables
from millrace.sources.readers import from_rows
from millrace.streaming.machines import metric

DATA = "/root/testdata/sf0.001"


def test_upsert_keeps_the_last_and_is_idempotent(spark, tmp_path):
    table = sinks.MetricTable(spark, str(tmp_path / "metrics"))
    assert table.read().count() == 0
    schema = "metric_type string, pipeline_id string, service_name string, window_start_ms long, window_end_ms long, value double, performance_band string, sample_count long, detail string, received long, inserted_at long, seq long"
    row = lambda value, seq, window=0: (V.DEPLOYMENT_FREQUENCY, "p", "s", window, window + 10, value, "Elite", 1, None, None, 1, seq)
    table.upsert(spark.createDataFrame([row(1.0, 1), row(3.0, 3), row(2.0, 2), row(9.0, 1, 10)], schema), 0)
    table.upsert(spark.createDataFrame([row(5.0, 0)], schema), 1)
    table.upsert(spark.createDataFrame([row(7.0, 0)], schema), 1)  # delivered again: nothing happens
    assert sorted(r["value"] for r in table.read().collect()) == [5.0, 9.0]
    # another stream's batches count from 0 again, and what it rewrites is forgotten after two versions
    for i in range(3):
        table.upsert(spark.createDataFrame([row(20.0 + i, 0)], schema), i, source="second")
        table.upsert(spark.createDataFrame([row(99.0, 0)], schema), 1)
    assert sorted(r["value"] for r in table.read().collect()) == [9.0, 22.0]
    assert len(os.listdir(tmp_path / "metrics" / "manifests")) <= 4 and len(os.listdir(tmp_path / "metrics" / "data")) <= 3


def test_buckets_hold_all_keys(spark, tmp_path):
    table = sinks.MetricTable(spark, str(tmp_path / "metrics"))
    rows = spark.range(500).selectExpr("'X' AS metric_type", "concat('p', id % 100) AS pipeline_id", "'' AS service_name", "id DIV 100 AS window_start_ms", "0L AS window_end_ms", "CAST(id AS DOUBLE) AS value", "'N/A' AS performance_band", "1L AS sample_count", "CAST(NULL AS STRING) AS detail", "CAST(NULL AS BIGINT) AS received", "1L AS inserted_at", "id AS seq")
    table.upsert(rows, 0)
    table.upsert(rows.where("id < 7").withColumn("value", F.lit(-1.0)), 1)
    got = table.read()
    assert got.count() == 500 and got.where("value = -1").count() == 7


def test_alerts_append_once_for_each_batch(spark, tmp_path):
    batch = spark.createDataFrame([("A", "{}"), ("B", ""), ("C", None)], "alert_type string, payload string")
    for i, source in ((0, "x"), (1, "x"), (1, "x"), (0, "y")):
        sinks.append_alerts(batch, str(tmp_path), i, source)
    assert [r["alert_type"] for r in spark.read.parquet(str(tmp_path)).collect()] == ["A", "A", "A"]


def test_annotations(spark):
    rows = [metric(V.HEALTH_SCORE, {"pipeline_id": "p"}, v) for v in (99.0, 75.0, 10.0)] + [metric(V.LEAD_TIME, {"pipeline_id": "p", "service_name": "s"}, 1.005), metric(V.WATERMARK, {}, 1.0)]
    df = spark.createDataFrame([tuple(r[k] for k in ("metric_type", "pipeline_id", "service_name", "window_start_ms", "window_end_ms", "value", "performance_band", "sample_count")) for r in rows], "metric_type string, pipeline_id string, service_name string, window_start_ms long, window_end_ms long, value double, performance_band string, sample_count long")
    got = sinks.annotations(df).collect()
    assert sorted(r["metric_type"] for r in got) == [V.LEAD_TIME, V.HEALTH_SCORE, V.HEALTH_SCORE]
    lead = next(r for r in got if r["metric_type"] == V.LEAD_TIME)
    assert lead["text"] == f"[{V.LEAD_TIME}] s — pipeline: p | value: 1.01 | band: Elite" and lead["tags"][1:] == ["lead-time-for-changes", "pipeline:p", "service:s", "band:Elite"]


def test_posting_failures_are_a_status(spark):
    df = spark.createDataFrame([(["a"], "text")], "tags array<string>, text string")
    got = sinks.post_annotations(df, "http://127.0.0.1:9", "key", timeout=1).collect()
    assert [r["sent"] for r in got] == [False]


def test_annotations_are_posted(spark):
    """To a server that fails the first time."""
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Server(BaseHTTPRequestHandler):
        found: list = []

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            Server.found.append((self.path, self.headers["Authorization"], body))
            self.send_response(503 if len(Server.found) == 1 else 200)
            self.end_headers()

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = spark.createDataFrame([(V.LEAD_TIME, "p", "s", 0, 1, 2.0, "Elite")], "metric_type string, pipeline_id string, service_name string, window_start_ms long, window_end_ms long, value double, performance_band string")
    sinks.poster(f"http://127.0.0.1:{server.server_port}", "key")(sinks.annotations(rows))
    server.shutdown()
    assert [f[:2] for f in Server.found] == [("/api/annotations", "Bearer key")] * 2
    assert Server.found[1][2]["text"] == f"[{V.LEAD_TIME}] s — pipeline: p | value: 2.00 | band: Elite"


def test_both_deployment_metrics_from_one_pass(spark):
    from millrace.operators import dora
    from millrace.sources.adapter import events

    e = events(spark, DATA)
    both = dora.both_by_window(e)
    apart = dora.deployment_frequency(e).union(dora.change_failure_rate(e))
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


def test_panels_run_on_tables(spark):
    e = from_rows(spark, [event("BUILD_STARTED", 0), event("DEPLOY_SUCCESS", MIN), event("DEPLOY_FAILED", 2 * MIN, sha="b"), event("DEPLOY_FAILED", 3 * MIN), event("ROLLBACK_STARTED", 4 * MIN), event("BUILD_FAILED", 5 * SEC), event("BUILD_SUCCESS", 5 * MIN)])
    metrics, alerts = tables.metrics(e), tables.alerts(e).withColumnRenamed("at_ms", "inserted_at")
    got = {name: dashboard.panel(spark, name, metrics, alerts).collect() for name in dashboard.PANELS}
    assert got["deploy_frequency"][0]["value"] == 1.0 and got["lead_time"][0]["value"] == 1.0
    assert got["alert_durations"][0]["duration_min"] == 2.0
    assert {r["alert_type"] for r in got["pattern_alerts"]} >= {"DEPLOY_ROLLBACK_CASCADE", "BUILD_OK_DEPLOY_BROKEN_TIMEOUT"}
    note = next(r["note"] for r in got["pattern_alerts"] if r["alert_type"] == "DEPLOY_ROLLBACK_CASCADE")
    assert note == "2.0 min to rollback"
    assert len(got["watermark"]) == 1 and got["window_history"][0]["is_window_closed"] is False


NAMES = ["deploy_frequency", "change_failure_rate", "lead_time", "mttr", "health_score", "live_health", "build_ok_deploy_broken_timeout", "truly_late_audit", "watermark_progress", "dash_latency_trend", "route_late", "dash_late_counts", "dash_pattern_alerts", "rollback_cascade", "annotation_rows"]


@pytest.mark.parametrize("name", NAMES)
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.queries()[name](spark, DATA)
    want = con.sql(queries.oracle_sql()[name])
    at = sorted(df.columns)
    assert df.count() or name in ("dash_late_counts", "rollback_cascade")  # the smallest table has none
    assert at == sorted(want.columns)
    mine = sorted(str([r[c] for c in at]) for r in df.collect())
    assert mine == sorted(str([dict(zip(want.columns, r, strict=True))[c] for c in at]) for r in want.fetchall())
