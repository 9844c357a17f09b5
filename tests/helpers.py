"""Events for tests: types at offsets from a fixed time."""

from __future__ import annotations

from datetime import UTC, datetime

BASE = 1_783_552_020_000  # 2026-07-08T23:07:00Z
SEC, MIN = 1_000, 60_000


def event(event_type: str, offset: int, status: str | None = None, pipeline: str | None = "p", service: str | None = "svc-a", sha: str | None = "same", base: int = BASE, **more) -> dict:
    ts = base + offset
    if status is None:
        status = "FAILURE" if event_type and event_type.endswith("_FAILED") else "SUCCESS"
    stamp = datetime.fromtimestamp(ts / 1000, UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    return {"event_id": f"{event_type}-{offset}", "pipeline_id": pipeline, "service_name": service, "branch": "main", "commit_sha": f"sha-{offset}" if sha == "own" else sha, "event_type": event_type, "event_timestamp": stamp, "status": status, "ts": ts, "received": ts + 5} | more


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
