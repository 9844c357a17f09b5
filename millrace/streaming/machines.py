"""Keyed state machines, free of Spark: what a key does with an event and with a timer.

A machine keeps its state in ``state``, a dict that JSON can hold, and gives rows
as dicts.  ``timers`` are the times at which it wants to be called; ``on_timer`` is
called for those that the watermark has passed.
"""

from __future__ import annotations

from typing import Any

from ..functions import vocabulary as V
from ..operators.patterns import LIKELY_CAUSE, PATTERNS, ROLLBACK_CASCADE, SequencePattern

Event = dict[str, Any]
Row = dict[str, Any]


def band_of(metric_type: str, value: float) -> str:
    if metric_type not in V.BANDS:
        return "N/A"
    limits, kind = V.BANDS[metric_type]
    for limit, name in zip(limits, V.BAND_NAMES, strict=False):
        if value >= limit if kind == "at_least" else value <= limit if kind == "at_most" else value < limit:
            return name
    return V.BAND_NAMES[-1]


def metric(metric_type: str, e: Event, value: float, start: int = 0, end: int = 0, samples: int = 1, received: int | None = None, detail: str | None = None) -> Row:
    return {
        "kind": "METRIC", "metric_type": metric_type, "pipeline_id": e.get("pipeline_id") or "", "service_name": e.get("service_name") or "", "window_start_ms": start, "window_end_ms": end,
        "value": float(value), "performance_band": band_of(metric_type, value), "sample_count": samples, "detail": detail, "received": received, "seq": e.get("seq"),
    }


def alert(alert_type: str, body: dict[str, Any], e: Event) -> Row:
    import json

    return {"kind": "ALERT", "metric_type": alert_type, "pipeline_id": e.get("pipeline_id"), "service_name": e.get("service_name"), "window_start_ms": None, "window_end_ms": None, "value": None, "performance_band": None, "sample_count": None, "detail": json.dumps(body), "received": e.get("received"), "seq": e.get("seq")}


def failed_deploy(e: Event) -> bool:
    return e["event_type"] == "DEPLOY_FAILED" or (e.get("status") or "").upper() == "FAILURE"


class Machine:
    """``timed``: event-time timers are needed, and late events must still come."""

    timed = False
    types: tuple[str, ...] = ()

    def __init__(self, state: dict[str, Any] | None = None) -> None:
        self.state = state if state is not None else self.empty()

    def empty(self) -> dict[str, Any]:
        return {}

    def on_event(self, e: Event, watermark: int) -> list[Row]:
        raise NotImplementedError

    def timers(self) -> set[int]:
        return set()

    def on_timer(self, at: int, watermark: int) -> list[Row]:
        return []


class LeadTime(Machine):
    types = ("BUILD_STARTED", "DEPLOY_SUCCESS", "DEPLOY_FAILED")

    def on_event(self, e: Event, watermark: int) -> list[Row]:
        key = repr(e.get("commit_sha"))  # tells a missing one from any text
        if e["event_type"] == "BUILD_STARTED":
            self.state[key] = [e["ts"], e.get("received")]
            return []
        start = self.state.pop(key, None)
        if start is None or e["event_type"] == "DEPLOY_FAILED":
            return []
        return [metric(V.LEAD_TIME, e, (e["ts"] - start[0]) / 60000.0, start[0], e["ts"], received=start[1])]


class RecoveryTime(Machine):
    types = ("BUILD_FAILED", "BUILD_SUCCESS")

    def on_event(self, e: Event, watermark: int) -> list[Row]:
        if e["event_type"] == "BUILD_FAILED":
            self.state["since"] = [e["ts"], e.get("received")]
            return []
        start = self.state.pop("since", None)
        return [] if start is None else [metric(V.RECOVERY_TIME, e, (e["ts"] - start[0]) / 60000.0, start[0], e["ts"], received=start[1])]


class Counter:
    """What a window holds of one metric: an accumulator, and its value."""

    metric_type = ""
    size = V.DAY
    types: tuple[str, ...] = ()
    empty_value = 0.0

    def new(self) -> dict[str, Any]:
        return {"n": 0, "failed": 0, "service": None, "received": 0}

    def counts(self, e: Event) -> bool:
        return True

    def add(self, acc: dict[str, Any], e: Event) -> None:
        if not self.counts(e):
            return
        self.tally(acc, e)
        acc["service"] = e.get("service_name")
        if (e.get("received") or 0) > 0:
            acc["received"] = min(acc["received"] or e["received"], e["received"])

    def tally(self, acc: dict[str, Any], e: Event) -> None:
        acc["n"] += 1
        acc["failed"] += failed_deploy(e)

    def value(self, acc: dict[str, Any]) -> float:
        raise NotImplementedError

    def samples(self, acc: dict[str, Any]) -> int:
        return acc["n"]


class Deployments(Counter):
    metric_type, live_type, types, size = V.DEPLOYMENT_FREQUENCY, V.DEPLOYMENT_FREQUENCY_LIVE, ("DEPLOY_SUCCESS",), V.DEPLOY_WINDOW

    def value(self, acc):
        return float(acc["n"])


class FailureRate(Counter):
    metric_type, live_type, types, size = V.CHANGE_FAILURE_RATE, V.CHANGE_FAILURE_RATE_LIVE, ("DEPLOY_SUCCESS", "DEPLOY_FAILED"), V.FAILURE_WINDOW

    def value(self, acc):
        return acc["failed"] * 100.0 / acc["n"] if acc["n"] else 0.0


class Health(Counter):
    metric_type, live_type, types, size = V.HEALTH_SCORE, V.HEALTH_SCORE_LIVE, V.HEALTH_TYPES, V.HEALTH_WINDOW
    empty_value = 100.0

    def new(self):
        return {"stages": {s: [0, 0] for s in V.STAGES}, "service": None, "received": 0}

    def counts(self, e):
        return not e["event_type"].endswith("_STARTED")

    def tally(self, acc, e):
        own = acc["stages"][e["event_type"].partition("_")[0]]
        own[0] += 1
        own[1] += (e.get("status") or "").upper() == "SUCCESS"

    def value(self, acc):
        total = 0.0
        for s, w in V.HEALTH_WEIGHTS.items():
            n, ok = acc["stages"][s]
            total += (100.0 if n == 0 else ok * 100.0 / n) * w
        return total

    def samples(self, acc):
        return sum(n for n, _ in acc["stages"].values())


class Live(Machine):
    """A row for each event with the open window's value, and a reset when it closes.

    ``each``: windows that a later one has replaced reset too, when their time comes.
    """

    timed = True

    def __init__(self, counter: Counter, state=None, size: int | None = None, each: bool = False, gate: bool = True) -> None:
        super().__init__(state)
        self.counter, self.size, self.each, self.gate, self.types = counter, size or counter.size, each, gate, counter.types

    def empty(self):
        return {"end": None, "acc": None, "due": []}

    def on_event(self, e, watermark):
        s, end = self.state, (e["ts"] // self.size + 1) * self.size
        if self.gate and watermark > end or s["end"] is not None and end < s["end"]:
            return []
        if s["end"] is None or end > s["end"] or s["acc"] is None:
            s["due"] = (s["due"] if self.each else []) + ([end] if end not in s["due"] or not self.each else [])
            s["end"], s["acc"] = end, self.counter.new()
        self.counter.add(s["acc"], e)
        received = s["acc"]["received"] if isinstance(self.counter, Health) else e.get("received")
        return [metric(self.counter.live_type, e, self.counter.value(s["acc"]), samples=self.counter.samples(s["acc"]), received=received or None)]

    def timers(self):
        return {end - 1 for end in self.state["due"]}

    def on_timer(self, at, watermark):
        s = self.state
        if at + 1 not in s["due"]:
            return []
        s["due"].remove(at + 1)
        service = (s["acc"] or {}).get("service")
        if s["end"] == at + 1:  # a window that a later one has replaced leaves that one's count alone
            s["acc"] = None
        return [metric(self.counter.live_type, {"pipeline_id": self.state.get("key"), "service_name": service}, self.counter.empty_value, samples=0)]


class LateWindows(Machine):
    """Windows that fire when the watermark passes them, again for each late event within the grace, and audit what comes after."""

    timed = True

    def __init__(self, counter: Counter, state=None, size: int | None = None, lateness: int = V.ALLOWED_LATENESS) -> None:
        super().__init__(state)
        self.counter, self.size, self.lateness, self.types = counter, size or counter.size, lateness, counter.types

    def empty(self):
        return {"open": {}}

    def on_event(self, e, watermark):
        end = (e["ts"] // self.size + 1) * self.size
        if watermark >= end + self.lateness:
            from ..sources.generate import epoch

            stamp = lambda ms: epoch(ms).isoformat(timespec="milliseconds").replace("+00:00", "Z")
            body = {"source_metric": self.counter.metric_type} | {k: e.get(k) for k in ("event_id", "pipeline_id", "service_name", "event_type")} | {"event_time": stamp(e["ts"]), "watermark_time": stamp(watermark), "late": True}
            return [alert(V.LATE_EVENT, body, e)]
        own = self.state["open"].setdefault(str(end), {"acc": self.counter.new(), "fired": False})
        self.counter.add(own["acc"], e)
        return [self.row(end, own["acc"], e.get("seq"))] if own["fired"] else []

    def row(self, end: int, acc: dict, seq: int | None = None) -> Row:
        e = {"pipeline_id": self.state.get("key"), "service_name": acc["service"], "seq": seq}
        return metric(self.counter.metric_type, e, self.counter.value(acc), end - self.size, end, self.counter.samples(acc), acc["received"] or None)

    def timers(self):
        return {int(end) if not w["fired"] else int(end) + self.lateness for end, w in self.state["open"].items()}

    def on_timer(self, at, watermark):
        out = []
        for end, w in sorted(self.state["open"].items()):
            if not w["fired"] and int(end) <= watermark:
                w["fired"] = True
                out.append(self.row(int(end), w["acc"]))
            if int(end) + self.lateness <= watermark:
                del self.state["open"][end]
        return out


class Patterns(Machine):
    """All patterns of a pipeline over one buffer that the watermark puts in order."""

    timed = True
    types = V.PATTERN_TYPES

    def __init__(self, state=None, patterns: tuple[SequencePattern, ...] = PATTERNS) -> None:
        super().__init__(state)
        self.patterns = patterns

    def empty(self):
        return {"buffer": [], "runs": []}

    def on_event(self, e, watermark):
        if e["ts"] >= watermark:
            self.state["buffer"].append({k: e.get(k) for k in ("ts", "seq", "event_type", "event_timestamp", "pipeline_id", "service_name", "branch", "commit_sha")})
        return []

    def timers(self):
        return {e["ts"] for e in self.state["buffer"]} | {run["events"][0]["ts"] + self.patterns[run["pattern"]].within for run in self.state["runs"]}

    def on_timer(self, at, watermark):
        s, out = self.state, []
        s["buffer"].sort(key=lambda e: (e["ts"], e["seq"] or 0))
        while s["buffer"] and s["buffer"][0]["ts"] <= watermark:
            e = s["buffer"].pop(0)
            out += self.expire(e["ts"]) + self.feed(e)
        return out + self.expire(watermark)

    def feed(self, e: Event) -> list[Row]:
        out, left = [], []
        for run in self.state["runs"]:
            p = self.patterns[run["pattern"]]
            if p.steps[len(run["events"])][1] == e["event_type"]:
                run["events"].append(e)
            if len(run["events"]) == len(p.steps):
                out.append(self.match(p, run["events"]))
            else:
                left.append(run)
        self.state["runs"] = left + [{"pattern": i, "events": [e]} for i, p in enumerate(self.patterns) if p.steps[0][1] == e["event_type"]]
        return out

    def expire(self, now: int) -> list[Row]:
        out, left = [], []
        for run in self.state["runs"]:
            p, first = self.patterns[run["pattern"]], run["events"][0]
            if first["ts"] + p.within <= now:
                body = {"alert_type": f"{p.name}_TIMEOUT", "description": p.timeout_text, "pipeline_id": first["pipeline_id"], "service_name": first["service_name"], "matched_steps": p.labels()[: len(run["events"])], "expired_at_ms": first["ts"] + p.within}
                out.append(alert(f"{p.name}_TIMEOUT", body, first))
            else:
                left.append(run)
        self.state["runs"] = left
        return out

    def match(self, p: SequencePattern, events: list[Event]) -> Row:
        first = events[0]
        body = {"alert_type": p.name, "pattern_name": p.title} | {k: first[k] for k in ("pipeline_id", "service_name", "branch", "commit_sha")}
        body |= {("build_success_ts" if label == "build_ok" else f"{label}_ts"): e["event_timestamp"] for label, e in zip(p.labels(), events, strict=True)}
        if p.name == ROLLBACK_CASCADE.name:
            body["cascade_duration_minutes"] = (events[-1]["ts"] - first["ts"]) / 60000.0
        elif p.name == "DEPLOY_INSTABILITY":
            body["failures"] = 2
        else:
            body["likely_cause"] = LIKELY_CAUSE
        body["matched_sequence"] = [{"step": label, "event": e["event_type"], "ts": e["event_timestamp"]} for label, e in zip(p.labels(), events, strict=True)]
        return alert(p.name, body, first)


class BandChange(Machine):
    """Passes rows whose band isn't the last passed one's; rows without a band always pass."""

    def on_event(self, e, watermark):
        if e.get("performance_band") is not None and e["performance_band"] == self.state.get("band"):
            return []
        self.state["band"] = e.get("performance_band")
        return [e]


class BandChanges(Machine):
    """The rows of another machine of the same key whose band has changed."""

    def __init__(self, inner, state=None) -> None:
        super().__init__(state)
        self.inner = inner(self.state["inner"] or None)
        self.state["inner"] = self.inner.state
        self.bands = BandChange(self.state["bands"])
        self.timed, self.types = self.inner.timed, self.inner.types

    def empty(self):
        return {"inner": {}, "bands": {}}

    def passed(self, rows):
        return [r for row in rows for r in self.bands.on_event(row, 0)]

    def on_event(self, e, watermark):
        return self.passed(self.inner.on_event(e, watermark))

    def timers(self):
        return self.inner.timers()

    def on_timer(self, at, watermark):
        self.inner.state["key"] = self.state.get("key")
        return self.passed(self.inner.on_timer(at, watermark))


MACHINES = {
    "lead_time": LeadTime,
    "mttr": RecoveryTime,
    "live_deployments": lambda s=None: Live(Deployments(), s),
    "live_cfr": lambda s=None: Live(FailureRate(), s),
    "live_health": lambda s=None: Live(Health(), s, each=True),
    "live_health_bands": lambda s=None: BandChanges(MACHINES["live_health"], s),
    "deploy_frequency": lambda s=None: LateWindows(Deployments(), s),
    "change_failure_rate": lambda s=None: LateWindows(FailureRate(), s),
    "health_score": lambda s=None: LateWindows(Health(), s),
    "patterns": Patterns,
}
