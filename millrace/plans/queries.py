"""The driver's queries on its table ``events``, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import band
from ..operators import dora, health, late, live, patterns, route
from ..sources.adapter import START, STAGE_OF, events
from . import dashboard, sinks, tables

#: Time is squeezed so much for patterns.
CLOCK = 60
ROW = ["metric_type", "pipeline_id", "service_name", "window_start_ms", "window_end_ms", "value", "performance_band", "sample_count", "detail", "received"]

Query = Callable[[SparkSession, str], DataFrame]


def _route(name: str) -> Query:
    return lambda s, d: route.branch(events(s, d, shuffled=name == "late"), name).select("event_id", "pipeline_id", "event_type", "status", "ts")


def _metric(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(events(s, d)).select(*ROW)


def _live(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda s, d: f(events(s, d, shuffled=True)).select("pipeline_id", F.coalesce("seq", F.lit(-1)).alias("seq"), "closes_ms", "value", "sample_count", "performance_band", F.coalesce("received", F.lit(0)).alias("received"))


def _band_changes(s: SparkSession, d: str) -> DataFrame:
    return health.band_changes(health.health_score(events(s, d)), ["window_start_ms"]).select("pipeline_id", "window_start_ms", "value", "performance_band")


def _bands(s: SparkSession, d: str) -> DataFrame:
    values = s.range(0, 20_001).select((F.col("id") / F.lit(2.0)).alias("value"))
    types = F.explode(F.array(*[F.lit(t) for t in [*V.BANDS, V.WATERMARK]])).alias("metric_type")
    return values.select("value", types).withColumn("band", band(None, F.col("value"))).groupBy("metric_type", "band").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def _match(p: patterns.SequencePattern) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        found = patterns.matches(events(s, d, CLOCK), p)
        return found.withColumn("matched_sequence", F.array_join(F.transform("matched_sequence", lambda x: F.concat_ws("|", x["step"], x["event"], x["ts"])), ","))

    return run


def _timeout(p: patterns.SequencePattern) -> Query:
    return lambda s, d: patterns.timeouts(events(s, d, CLOCK), p).select("alert_type", "description", "pipeline_id", "service_name", F.array_join("matched_steps", ",").alias("matched_steps"), "expired_at_ms", "seq")


def _late(s: SparkSession, d: str) -> DataFrame:
    return late.truly_late(events(s, d, shuffled=True)).select("source_metric", "event_id", "pipeline_id", "service_name", "event_type", "ts", "window_end_ms", "watermark")


def _late_counts(s: SparkSession, d: str) -> DataFrame:
    return late.late_counts(late.truly_late(events(s, d, shuffled=True)).where(F.col("source_metric") == V.HEALTH_SCORE)).select(*ROW)


def _on_time(s: SparkSession, d: str) -> DataFrame:
    return dora.deployment_frequency(late.on_time(events(s, d, shuffled=True), V.DEPLOYMENT_FREQUENCY)).select(*ROW)


def _watermark(s: SparkSession, d: str) -> DataFrame:
    return late.arrival_watermark(events(s, d, shuffled=True)).select("event_id", "seq", "ts", "watermark")


def _upsert(s: SparkSession, d: str) -> DataFrame:
    live_rows = live.live_deployments(events(s, d, shuffled=True)).where("seq IS NOT NULL")
    return tables.upsert_latest(live_rows.drop("closes_ms"), "seq").select(*ROW, "seq")


def _annotations(s: SparkSession, d: str) -> DataFrame:
    return sinks.annotations(tables.metrics(events(s, d))).select("metric_type", "pipeline_id", F.array_join("tags", ",").alias("tags"), "text", "time_ms")


def _panel(name: str) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        needs = dashboard.PANELS[name]
        metrics = alerts = None
        if "cicd_metrics" in needs:
            metrics = tables.metrics(events(s, d))
            if name == "late_counts":
                counts = late.late_counts(late.truly_late(events(s, d, shuffled=True)).where(F.col("source_metric") == V.DEPLOYMENT_FREQUENCY))
                metrics = counts.withColumn("inserted_at", F.col("window_end_ms") + 5000)
        if "cicd_alerts" in needs:
            own = late.audit(late.truly_late(events(s, d, shuffled=True))) if name == "truly_late" else tables.alerts(events(s, d, CLOCK))
            alerts = own.withColumnRenamed("at_ms", "inserted_at")
        return dashboard.panel(s, name, metrics, alerts)

    return run


PANELS = [p for p in dashboard.PANELS]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"route_{b}": _route(b) for b in ("dora", "health", "pattern", "late")}
    out |= {"deploy_frequency": _metric(dora.deployment_frequency), "change_failure_rate": _metric(dora.change_failure_rate), "lead_time": _metric(dora.lead_time), "mttr": _metric(dora.recovery_time), "health_score": _metric(health.health_score)}
    out |= {"health_band_changes": _band_changes, "performance_bands": _bands}
    out |= {"live_deploy_count": _live(live.live_deployments), "live_cfr": _live(live.live_failure_rate), "live_health": _live(live.live_health), "live_deploy_count_gated": _live(lambda e: live.live_deployments(e, gate=True))}
    for p in patterns.PATTERNS:
        out |= {p.name.lower().removeprefix("deploy_") if p is patterns.ROLLBACK_CASCADE else p.name.lower(): _match(p)}
        out |= {(p.name.lower().removeprefix("deploy_") if p is patterns.ROLLBACK_CASCADE else p.name.lower()) + "_timeout": _timeout(p)}
    out |= {"truly_late_audit": _late, "late_event_count": _late_counts, "deploy_frequency_on_time": _on_time, "watermark_progress": _watermark, "metric_upsert_latest": _upsert, "annotation_rows": _annotations}
    return out | {f"dash_{p}": _panel(p) for p in PANELS}


# --- the same in SQL ------------------------------------------------------------------


def _events_sql(clock: int = 1, shuffled: bool = False) -> str:
    stage = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STAGE_OF.items())
    ts = "epoch_us(ts) // 1000" if clock == 1 else f"{START} + CAST(floor((epoch_us(ts) // 1000 - {START}) / {clock}.0) AS BIGINT)"
    seq = "2 * event_id + CASE WHEN k BETWEEN 42 AND 44 THEN 801 ELSE 0 END" if shuffled else "event_id"
    return f"""
    raw AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE event_type {stage} END AS stage, CAST({ts} AS BIGINT) AS ms FROM events),
    ev AS (SELECT CAST(event_id AS VARCHAR) AS event_id, 'pipe-' || (user_id % 4) AS pipeline_id, 'svc-' || (user_id % 7) AS service_name, 'c' || (user_id % 64) AS commit_sha, k, stage,
        CASE WHEN stage = 'DEPLOY' AND k >= 85 THEN 'ROLLBACK_STARTED' ELSE stage || CASE k % 3 WHEN 0 THEN '_STARTED' WHEN 1 THEN '_SUCCESS' ELSE '_FAILED' END END AS event_type,
        'main' AS branch, CASE WHEN k % 20 = 19 THEN 'failure' WHEN k % 3 = 2 THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
        ms AS ts, CASE WHEN k % 10 = 7 THEN ms + 45000 WHEN k % 25 = 3 THEN 0 WHEN k % 25 = 4 THEN -1 ELSE ms + 5000 END AS received, CAST({seq} AS BIGINT) AS seq, event_id AS number FROM raw)"""


def _in(types) -> str:
    return "event_type IN (" + ", ".join(f"'{t}'" for t in types) + ")"


def _band_sql(metric_type: str, value: str = "value") -> str:
    limits, kind = V.BANDS[metric_type]
    op = {"at_least": ">=", "at_most": "<=", "under": "<"}[kind]
    return "CASE " + " ".join(f"WHEN {value} {op} {x!r}::DOUBLE THEN '{n}'" for x, n in zip(limits, V.BAND_NAMES, strict=False)) + " ELSE 'Low' END"


FAILED = "(event_type = 'DEPLOY_FAILED' OR upper(status) = 'FAILURE')"
TERMINAL = r"(event_type LIKE '%\_SUCCESS' ESCAPE '\' OR event_type LIKE '%\_FAILED' ESCAPE '\' OR event_type LIKE '%\_FAILURE' ESCAPE '\')"


#: The smallest positive time of arrival of a group, else 0.
FIRST = "coalesce(min(received) FILTER (WHERE received > 0), 0)"
NO_DETAIL = "CAST(NULL AS VARCHAR) AS detail"


def _fixed(value: str, digits: int) -> str:
    """A number as text with so many digits, halves rounded up by its decimal digits."""
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, {digits})) AS VARCHAR)"


def _windowed(metric_type: str, types, size: int, value: str, source: str = "ev") -> str:
    return f"""SELECT '{metric_type}' AS metric_type, pipeline_id, service_name, w AS window_start_ms, w + {size} AS window_end_ms, value, {_band_sql(metric_type)} AS performance_band, n AS sample_count, {NO_DETAIL}, received
    FROM (SELECT *, CAST({value} AS DOUBLE) AS value FROM (SELECT pipeline_id, ts - ts % {size} AS w, count(*) AS n, CAST(sum(CASE WHEN {FAILED} THEN 1 ELSE 0 END) AS BIGINT) AS failed, arg_max_null(service_name, seq) AS service_name, {FIRST} AS received
    FROM {source} WHERE {_in(types)} GROUP BY 1, 2))"""


def _paired(metric_type: str, types, keys: str) -> str:
    return f"""SELECT '{metric_type}' AS metric_type, pipeline_id, service_name, s AS window_start_ms, ts AS window_end_ms, value, {_band_sql(metric_type)} AS performance_band, CAST(1 AS BIGINT) AS sample_count, {NO_DETAIL}, r AS received
    FROM (SELECT *, (ts - s) / 60000.0::DOUBLE AS value FROM (SELECT *, lag(event_type) OVER w AS t, lag(ts) OVER w AS s, lag(received) OVER w AS r FROM ev WHERE {_in(types)} WINDOW w AS (PARTITION BY {keys} ORDER BY seq))
    WHERE event_type = '{types[1]}' AND t = '{types[0]}')"""


def _sums_sql(over: str = "") -> str:
    one = "CAST(sum(CASE WHEN {t} AND event_type LIKE '{s}\\_%' ESCAPE '\\' {more} THEN 1 ELSE 0 END) {over} AS BIGINT) AS {s}_{k}"
    return ", ".join(one.format(t=TERMINAL, s=s, more=more, over=over, k=k) for s in V.STAGES for k, more in (("n", ""), ("ok", "AND upper(status) = 'SUCCESS'")))


SCORE = " + ".join(f"(CASE WHEN {s}_n = 0 THEN 100.0::DOUBLE ELSE {s}_ok * 100.0::DOUBLE / {s}_n END) * {w!r}::DOUBLE" for s, w in V.HEALTH_WEIGHTS.items())
SAMPLES = " + ".join(f"{s}_n" for s in V.STAGES)
DETAIL = "'{" + " || ',".join(f"\"{s.lower()}\":' || " + _fixed(f"CASE WHEN {s}_n = 0 THEN 100.0::DOUBLE ELSE {s}_ok * 100.0::DOUBLE / {s}_n END", 1) for s in V.STAGES) + " || '}'"

DF_SQL = _windowed(V.DEPLOYMENT_FREQUENCY, ("DEPLOY_SUCCESS",), V.DEPLOY_WINDOW, "n")
CFR_SQL = _windowed(V.CHANGE_FAILURE_RATE, ("DEPLOY_SUCCESS", "DEPLOY_FAILED"), V.FAILURE_WINDOW, "failed * 100.0::DOUBLE / n")
LEAD_SQL = _paired(V.LEAD_TIME, ("BUILD_STARTED", "DEPLOY_SUCCESS", "DEPLOY_FAILED"), "pipeline_id, commit_sha")
MTTR_SQL = _paired(V.RECOVERY_TIME, ("BUILD_FAILED", "BUILD_SUCCESS"), "pipeline_id")
HEALTH_SQL = f"""SELECT '{V.HEALTH_SCORE}' AS metric_type, pipeline_id, coalesce(service_name, '') AS service_name, w AS window_start_ms, w + {V.HEALTH_WINDOW} AS window_end_ms, value, {_band_sql(V.HEALTH_SCORE)} AS performance_band, {SAMPLES} AS sample_count, {DETAIL} AS detail, received
    FROM (SELECT *, {SCORE} AS value FROM (SELECT pipeline_id, ts - ts % {V.HEALTH_WINDOW} AS w, {_sums_sql()}, arg_max_null(service_name, seq) FILTER (WHERE {TERMINAL}) AS service_name, coalesce(min(received) FILTER (WHERE received > 0 AND {TERMINAL}), 0) AS received
    FROM ev WHERE {_in(V.HEALTH_TYPES)} GROUP BY 1, 2))"""


def _live_sql(metric_type: str, types, size: int, sums: str, value: str, count: str, received: str, each: bool, empty: str, gate: bool = False, resets: bool = True) -> str:
    """CTEs that end in ``lv``: pipeline_id, seq, closes_ms, value, sample_count, received, service_name."""
    source = "ev" if not gate else f"(SELECT * FROM wmk WHERE watermark IS NULL OR watermark <= ts - ts % {size} + {size})"
    last = "SELECT pipeline_id, max(e) AS e FROM acc GROUP BY 1" if not each else "SELECT DISTINCT pipeline_id, e FROM acc"
    reset = f"UNION ALL SELECT pipeline_id, CAST(-1 AS BIGINT), e, {empty}::DOUBLE, CAST(0 AS BIGINT), CAST(0 AS BIGINT), NULL FROM ({last})" if resets else ""
    return f"""
    own AS (SELECT *, ts - ts % {size} + {size} AS e FROM {source} WHERE {_in(types)}),
    acc AS (SELECT * FROM (SELECT *, max(e) OVER (PARTITION BY pipeline_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM own) WHERE m IS NULL OR e >= m),
    run AS (SELECT pipeline_id, seq, e, service_name, {received} AS received, {sums} FROM acc WINDOW w AS (PARTITION BY pipeline_id, e ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    lv AS (SELECT pipeline_id, seq, e AS closes_ms, CAST({value} AS DOUBLE) AS value, CAST({count} AS BIGINT) AS sample_count, received, service_name FROM run {reset})"""


LIVE_ARGS = {
    "live_deploy_count": (V.DEPLOYMENT_FREQUENCY_LIVE, ("DEPLOY_SUCCESS",), V.DEPLOY_WINDOW, "count(*) OVER w AS n", "n", "n", "received", False, "0.0"),
    "live_cfr": (V.CHANGE_FAILURE_RATE_LIVE, ("DEPLOY_SUCCESS", "DEPLOY_FAILED"), V.FAILURE_WINDOW, f"count(*) OVER w AS n, CAST(sum(CASE WHEN {FAILED} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS failed", "failed * 100.0::DOUBLE / n", "n", "received", False, "0.0"),
    "live_health": (V.HEALTH_SCORE_LIVE, V.HEALTH_TYPES, V.HEALTH_WINDOW, _sums_sql("OVER w"), SCORE, SAMPLES, "min(received) FILTER (WHERE received > 0) OVER w", True, "100.0"),
}

WMK = f"wmk AS (SELECT *, max(ts) OVER (ORDER BY seq, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {V.OUT_OF_ORDER} AS watermark FROM ev)"
LATE = (
    "late AS ("
    + " UNION ALL ".join(f"SELECT *, '{name}' AS source_metric, ts - ts % {size} + {size} AS window_end_ms FROM wmk WHERE {_in(types)} AND watermark >= ts - ts % {size} + {size} + {V.ALLOWED_LATENESS}" for name, (types, size) in late.SOURCES.items())
    + ")"
)


def _outcome_sql(p: patterns.SequencePattern) -> str:
    """CTE ``outc``: each first event with the next event of each step, or nulls beyond the window; by running windows from the end."""
    (_, a), (_, b), (_, c) = p.steps
    return f"""
    pe AS (SELECT * FROM ev WHERE {_in(sorted({a, b, c}))}),
    s3 AS (SELECT *, first_value(CASE WHEN event_type = '{c}' THEN {{'ts': ts, 'seq': seq}} END IGNORE NULLS) OVER w AS n3 FROM pe WINDOW w AS (PARTITION BY pipeline_id ORDER BY ts, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    s2 AS (SELECT *, first_value(CASE WHEN event_type = '{b}' THEN {{'ts': ts, 'seq': seq, 'n': n3}} END IGNORE NULLS) OVER w AS n2 FROM s3 WINDOW w AS (PARTITION BY pipeline_id ORDER BY ts, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    outc AS (SELECT *, coalesce(n2.ts - ts < {p.within}, false) AS two, coalesce(n2.ts - ts < {p.within} AND n2.n.ts - ts < {p.within}, false) AS three, n2.ts AS ts2, n2.n.ts AS ts3 FROM s2 WHERE event_type = '{a}')"""


def _alerts_sql() -> str:
    """The alerts of all patterns: inserted_at, alert_type, pipeline_id, service_name, detail, note."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    out = []
    for p in patterns.PATTERNS:
        note = "((ts3 - ts) / 60000.0::DOUBLE) || ' min to rollback'" if p is patterns.ROLLBACK_CASCADE else "'failures=2'" if p is patterns.DEPLOY_INSTABILITY else quoted(patterns.LIKELY_CAUSE)
        found = " || ',' || ".join(f"'{{\"step\":\"{label}\",\"event\":\"{t}\",\"ts\":\"' || {_iso(ts)} || '\"}}'" for (label, t), ts in zip(p.steps, ("ts", "ts2", "ts3"), strict=True))
        one, two, _ = p.labels()
        steps = f"""CASE WHEN three THEN '[' || {found} || ']' WHEN two THEN '["{one}","{two}"]' ELSE '["{one}"]' END"""
        out.append(f"""SELECT CASE WHEN three THEN ts3 ELSE ts + {p.within} END AS inserted_at, CASE WHEN three THEN '{p.name}' ELSE '{p.name}_TIMEOUT' END AS alert_type, pipeline_id, service_name,
        CASE WHEN three THEN {quoted(p.title)} ELSE {quoted(p.timeout_text)} END AS detail, CASE WHEN three THEN {note} END AS note, {steps} AS matched_steps FROM (WITH {_outcome_sql(p)} SELECT * FROM outc)""")
    return " UNION ALL ".join(out)


def _iso(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def _metrics_sql() -> str:
    """CTEs that end in ``mt``: the table of metrics."""
    closed = " UNION ALL ".join(f"SELECT *, window_end_ms + 5000 AS inserted_at FROM ({q})" for q in (DF_SQL, CFR_SQL, LEAD_SQL, MTTR_SQL, HEALTH_SQL))
    lives = []
    for args in LIVE_ARGS.values():
        inner = _live_sql(*args, resets=False)
        lives.append(f"""SELECT '{args[0]}' AS metric_type, pipeline_id, service_name, CAST(0 AS BIGINT) AS window_start_ms, CAST(0 AS BIGINT) AS window_end_ms, value, {_band_sql(args[0])} AS performance_band, sample_count, {NO_DETAIL}, received, received + 5000 AS inserted_at
        FROM (WITH {inner} SELECT * FROM lv QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY seq DESC) = 1)""")
    mark = f"SELECT 'WATERMARK', 'GLOBAL', '', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(max(ts) - {V.OUT_OF_ORDER} AS DOUBLE), 'N/A', CAST(1 AS BIGINT), NULL, NULL, max(ts) + 5000 FROM ev"
    return f"mt AS ({closed} UNION ALL {' UNION ALL '.join(lives)} UNION ALL {mark})"


def oracle_sql() -> dict[str, str]:
    ev, ev_late, ev_fast = _events_sql(), _events_sql(shuffled=True), _events_sql(CLOCK)
    columns = "event_id, pipeline_id, event_type, status, ts"
    out = {f"route_{b}": f"WITH {ev} SELECT {columns} FROM ev WHERE {_in(t)}" for b, t in (("dora", V.DORA_TYPES), ("health", V.HEALTH_TYPES), ("pattern", V.PATTERN_TYPES))}
    out["route_late"] = f"WITH {ev_late} SELECT {columns} FROM ev WHERE ts > 0 AND received - ts > {V.OUT_OF_ORDER}"
    for name, q in (("deploy_frequency", DF_SQL), ("change_failure_rate", CFR_SQL), ("lead_time", LEAD_SQL), ("mttr", MTTR_SQL), ("health_score", HEALTH_SQL)):
        out[name] = f"WITH {ev} {q}"
    out["health_band_changes"] = f"""WITH {ev} SELECT pipeline_id, window_start_ms, value, performance_band FROM (SELECT *, lag(performance_band) OVER (PARTITION BY pipeline_id ORDER BY window_start_ms) AS before FROM ({HEALTH_SQL}))
        WHERE before IS DISTINCT FROM performance_band"""
    cases = " ".join(f"WHEN '{t}' THEN {_band_sql(t)}" for t in V.BANDS)
    types = ", ".join(f"'{t}'" for t in [*V.BANDS, V.WATERMARK])
    out["performance_bands"] = f"""SELECT metric_type, band, count(*) AS n, min(value) AS least, max(value) AS most FROM (SELECT metric_type, value, CASE metric_type {cases} ELSE 'N/A' END AS band
        FROM (SELECT CAST(i AS DOUBLE) / 2 AS value, unnest([{types}]) AS metric_type FROM range(0, 20001) t(i))) GROUP BY 1, 2"""
    for name, args in LIVE_ARGS.items():
        out[name] = f"WITH {ev_late}, {_live_sql(*args)} SELECT pipeline_id, seq, closes_ms, value, sample_count, {_band_sql(args[0])} AS performance_band, coalesce(received, 0) AS received FROM lv"
    args = LIVE_ARGS["live_deploy_count"]
    out["live_deploy_count_gated"] = f"WITH {ev_late}, {WMK}, {_live_sql(*args, gate=True)} SELECT pipeline_id, seq, closes_ms, value, sample_count, {_band_sql(args[0])} AS performance_band, coalesce(received, 0) AS received FROM lv"
    for p in patterns.PATTERNS:
        name = p.name.lower().removeprefix("deploy_") if p is patterns.ROLLBACK_CASCADE else p.name.lower()
        labels = p.labels()
        sequence = " || ',' || ".join(f"'{label}|{t}|' || {_iso(ts)}" for (label, t), ts in zip(p.steps, ("ts", "ts2", "ts3"), strict=True))
        times = [f"{_iso(t)} AS {'build_success' if label == 'build_ok' else label}_ts" for t, label in zip(("ts", "ts2", "ts3"), labels, strict=True)]
        if p is patterns.ROLLBACK_CASCADE:
            times.append("(ts3 - ts) / 60000.0::DOUBLE AS cascade_duration_minutes")
        elif p is patterns.DEPLOY_INSTABILITY:
            times.append("2 AS failures")
        else:
            times.append(f"'{patterns.LIKELY_CAUSE}' AS likely_cause")
        times.append(f"{sequence} AS matched_sequence")
        out[name] = f"WITH {ev_fast}, {_outcome_sql(p)} SELECT '{p.name}' AS alert_type, '{p.title}' AS pattern_name, pipeline_id, service_name, branch, commit_sha, {', '.join(times)}, seq, ts3 AS matched_at_ms FROM outc WHERE three"
        out[f"{name}_timeout"] = f"""WITH {ev_fast}, {_outcome_sql(p)} SELECT '{p.name}_TIMEOUT' AS alert_type, '{p.timeout_text.replace("'", "''")}' AS description, pipeline_id, service_name, CASE WHEN two THEN '{labels[0]},{labels[1]}' ELSE '{labels[0]}' END AS matched_steps,
            ts + {p.within} AS expired_at_ms, seq FROM outc WHERE NOT three"""
    out["truly_late_audit"] = f"WITH {ev_late}, {WMK}, {LATE} SELECT source_metric, event_id, pipeline_id, service_name, event_type, ts, window_end_ms, watermark FROM late"
    counted = f"""SELECT '{V.DEPLOYMENT_FREQUENCY_LATE}' AS metric_type, pipeline_id, service_name, w AS window_start_ms, w + {V.LATE_COUNT_WINDOW} AS window_end_ms, CAST(n AS DOUBLE) AS value, 'N/A' AS performance_band, n AS sample_count, {NO_DETAIL}, received
        FROM (SELECT pipeline_id, CAST(floor(received / {V.LATE_COUNT_WINDOW}.0) AS BIGINT) * {V.LATE_COUNT_WINDOW} AS w, count(*) AS n, arg_max_null(service_name, seq) AS service_name, {FIRST} AS received FROM late WHERE source_metric = '{{}}' GROUP BY 1, 2)"""
    out["late_event_count"] = f"WITH {ev_late}, {WMK}, {LATE} {counted.format(V.HEALTH_SCORE)}"
    out["deploy_frequency_on_time"] = f"WITH {ev_late}, {WMK}, ok AS (SELECT * FROM wmk WHERE watermark IS NULL OR watermark < ts - ts % {V.DEPLOY_WINDOW} + {V.DEPLOY_WINDOW} + {V.ALLOWED_LATENESS}) {_windowed(V.DEPLOYMENT_FREQUENCY, ('DEPLOY_SUCCESS',), V.DEPLOY_WINDOW, 'n', 'ok')}"
    out["watermark_progress"] = f"WITH {ev_late}, {WMK} SELECT event_id, seq, ts, watermark FROM wmk"
    out["metric_upsert_latest"] = f"""WITH {ev_late}, {_live_sql(*args, resets=False)} SELECT '{args[0]}' AS metric_type, pipeline_id, service_name, CAST(0 AS BIGINT) AS window_start_ms, CAST(0 AS BIGINT) AS window_end_ms, value, {_band_sql(args[0])} AS performance_band, sample_count, {NO_DETAIL}, received, seq
        FROM lv QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY seq DESC) = 1"""
    annotated = ", ".join(f"'{t}'" for t in V.ANNOTATED)
    mt = f"WITH {ev}, {_metrics_sql()}"
    out["annotation_rows"] = f"""{mt} SELECT metric_type, pipeline_id, '{V.ANNOTATION_TAG},' || replace(lower(metric_type), '_', '-') || ',pipeline:' || pipeline_id || ',service:' || service_name || ',band:' || performance_band AS tags,
        '[' || metric_type || '] ' || service_name || ' — pipeline: ' || pipeline_id || ' | value: ' || {_fixed('value', 2)} || ' | band: ' || performance_band AS text, window_end_ms AS time_ms
        FROM mt WHERE metric_type IN ({annotated}) OR metric_type = '{V.HEALTH_SCORE}' AND performance_band IN ('Low', 'Elite')"""
    series = mt + " SELECT window_end_ms // 1000 AS time_s, pipeline_id, value FROM mt WHERE metric_type = '{}'"
    closed = mt + " SELECT window_end_ms // 1000 AS time_s, pipeline_id || ' (window close)' AS series, value FROM mt WHERE metric_type = '{}'"
    lives = mt + " SELECT inserted_at, pipeline_id || ' (live)' AS series, value FROM mt WHERE metric_type = '{}'"
    out |= {
        "dash_watermark": f"{mt} SELECT value AS current_watermark FROM mt WHERE metric_type = 'WATERMARK' ORDER BY inserted_at DESC LIMIT 1",
        "dash_deploy_frequency": series.replace("{}", V.DEPLOYMENT_FREQUENCY), "dash_lead_time": series.replace("{}", V.LEAD_TIME), "dash_mttr": series.replace("{}", V.RECOVERY_TIME),
        "dash_cfr_live": lives.replace("{}", V.CHANGE_FAILURE_RATE_LIVE), "dash_health_live": lives.replace("{}", V.HEALTH_SCORE_LIVE),
        "dash_cfr_closed": closed.replace("{}", V.CHANGE_FAILURE_RATE), "dash_health_closed": closed.replace("{}", V.HEALTH_SCORE),
        "dash_live_values": f"{mt} SELECT inserted_at, metric_type, pipeline_id, service_name, value, performance_band, 86400 AS resets_after_s FROM mt WHERE metric_type = '{V.DEPLOYMENT_FREQUENCY_LIVE}' QUALIFY row_number() OVER (PARTITION BY metric_type, pipeline_id ORDER BY inserted_at DESC) = 1",
        "dash_window_history": f"""{mt} SELECT window_start_ms, window_end_ms, pipeline_id, service_name, value AS deploys_per_day, sample_count AS deploy_count, inserted_at AS computed_at, window_end_ms + {V.ALLOWED_LATENESS} AS alive_until_ms,
            coalesce((SELECT value FROM mt WHERE metric_type = 'WATERMARK') > window_end_ms + {V.ALLOWED_LATENESS}, false) AS is_window_closed FROM mt WHERE metric_type = '{V.DEPLOYMENT_FREQUENCY}' ORDER BY window_end_ms DESC, pipeline_id LIMIT 20""",
        "dash_truly_late": f"""WITH {ev_late}, {WMK}, {LATE} SELECT received AS computed_at, source_metric, event_id, pipeline_id, service_name, event_type, {_iso('ts')} AS event_time, {_iso('watermark')} AS watermark_time,
            ((watermark - ts) // 1000) || ' s behind the watermark; window and grace were over' AS reason FROM late ORDER BY received DESC, event_id, source_metric LIMIT 20""",
        "dash_latency_trend": f"{mt} SELECT inserted_at - inserted_at % 60000 AS minute_ms, metric_type, avg(CAST(inserted_at - received AS DOUBLE)) AS value FROM mt WHERE received IS NOT NULL GROUP BY 1, 2",
        "dash_completed_at": f"{mt} SELECT metric_type, strftime(make_timestamp(max(inserted_at) * 1000), '%Y-%m-%dT%H:%M:%SZ') AS max_inserted_at FROM mt WHERE metric_type NOT IN ('PIPELINE_HEALTH_SCORE', 'PIPELINE_HEALTH_SCORE_LIVE', 'PIPELINE_HEALTH_SCORE_LATE_EVENTS') GROUP BY 1",
        "dash_latency_span": f"{mt} SELECT metric_type, CAST(max(inserted_at) - min(received) AS DOUBLE) AS span_ms FROM mt WHERE received IS NOT NULL AND metric_type NOT IN ('PIPELINE_HEALTH_SCORE', 'PIPELINE_HEALTH_SCORE_LIVE') GROUP BY 1",
        "dash_late_counts": f"WITH {ev_late}, {WMK}, {LATE}, lc AS ({counted.format(V.DEPLOYMENT_FREQUENCY)}) SELECT window_start_ms, window_end_ms, pipeline_id, service_name, value AS late_event_count, window_end_ms + 5000 AS computed_at FROM lc ORDER BY window_end_ms DESC, pipeline_id LIMIT 20",
        "dash_latest_metrics": f"{mt} SELECT metric_type, pipeline_id, value, performance_band, inserted_at FROM mt ORDER BY inserted_at DESC, metric_type, pipeline_id, window_end_ms LIMIT 20",
        "dash_pattern_alerts": f"WITH {ev_fast} SELECT inserted_at AS computed_at, alert_type, pipeline_id, service_name, detail, note, matched_steps FROM ({_alerts_sql()}) ORDER BY inserted_at DESC, alert_type, pipeline_id, service_name, note, matched_steps LIMIT 30",
        "dash_latest_alerts": f"WITH {ev_fast} SELECT alert_type, pipeline_id, inserted_at FROM ({_alerts_sql()}) ORDER BY inserted_at DESC, alert_type, pipeline_id LIMIT 20",
        "dash_metric_counts": f"{mt} SELECT metric_type, count(*) AS n FROM mt GROUP BY 1",
        "dash_alert_durations": f"WITH {ev_fast}, {_outcome_sql(patterns.ROLLBACK_CASCADE)} SELECT ts3 AS inserted_at, pipeline_id AS pipeline, (ts3 - ts) / 60000.0::DOUBLE AS duration_min FROM outc WHERE three",
    }
    return out
