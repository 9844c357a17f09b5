"""State machines as stateful operators of Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import vocabulary as V
from .machines import MACHINES, Machine

OUT = "kind string, metric_type string, pipeline_id string, service_name string, window_start_ms long, window_end_ms long, value double, performance_band string, sample_count long, detail string, received long, seq long"
NAMES = [c.strip().split()[0] for c in OUT.split(",")]
NEEDED = ("pipeline_id", "event_id", "service_name", "branch", "commit_sha", "event_type", "event_timestamp", "status", "ts", "received", "seq")
HEARTBEAT = "__heartbeat__"
#: Keys that heartbeats are dealt over.
HEARTBEATS = 64
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class MachineProcessor(StatefulProcessor):
    """Runs a machine for each key; its state is one JSON value.

    Events are taken in order of arrival.  Timers that the machine no longer wants
    are deleted, so what fires is what it waits for.
    """

    def __init__(self, make: Callable[[dict | None], Machine]) -> None:
        self.make = make

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("state", StructType([StructField("json", StringType())]))

    def _machine(self, key: str) -> Machine:
        machine = self.make(json.loads(self.value.get()[0]) if self.value.exists() else None)
        machine.state["key"] = key
        return machine

    def _keep(self, machine: Machine) -> None:
        self.value.update((json.dumps(machine.state),))
        if machine.timed:
            wanted, there = machine.timers(), set(self.handle.listTimers())
            for t in there - wanted:
                self.handle.deleteTimer(t)
            for t in wanted - there:
                self.handle.registerTimer(t)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0].startswith(HEARTBEAT):
            for _ in rows:
                pass
            return
        machine = self._machine(key[0])
        watermark = timerValues.getCurrentWatermarkInMs() if machine.timed else -1
        out = []
        for r in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"])):
            out += machine.on_event(r.asDict(), watermark)
        self._keep(machine)
        for r in out:
            yield Row(**{k: r[k] for k in NAMES})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        machine = self._machine(key[0])
        out = machine.on_timer(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self._keep(machine)
        for r in out:
            yield Row(**{k: r[k] for k in NAMES})

    def close(self) -> None:
        pass


class Entries:
    """A machine's state as a map in the state store: an event changes its own entry only."""

    def __init__(self, entries) -> None:
        self.entries = entries

    def __setitem__(self, key: str, value: list) -> None:
        self.entries.updateValue((key,), tuple(value))

    def pop(self, key: str, default=None):
        if not self.entries.containsKey((key,)):
            return default
        value = self.entries.getValue((key,))
        self.entries.removeKey((key,))
        return list(value)


class MapProcessor(MachineProcessor):
    """Runs a machine whose state is (time, received) by name; entries go ``keep_ms`` after they were last written, if that is given."""

    def __init__(self, make: Callable[[dict | None], Machine], keep_ms: int | None = None) -> None:
        super().__init__(make)
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = Entries(handle.getMapState("entries", "name string", "ts long, received long", self.keep_ms))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        machine = self.make(self.entries)
        for r in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"])):
            for row in machine.on_event(r.asDict(), -1):
                yield Row(**{k: row[k] for k in NAMES})


#: Machines whose state grows with the names that are open.
MAPPED = ("lead_time",)


def with_state(events: DataFrame, name: str, make: Callable[[dict | None], Machine] | None = None, delay_ms: int = V.OUT_OF_ORDER, keep_ms: int | None = None) -> DataFrame:
    """The rows of a machine of MACHINES (or of ``make``) over a stream of events.

    Only what machines read goes to Python.  Timed machines need the watermark and
    all late events, but Spark drops rows behind the watermark: so an event has no
    time, and is never late, and rows of their own, which do nothing else, move the
    watermark.  ``keep_ms`` lets the builds of commits that are never deployed go.
    """
    mapped = make is None and name in MAPPED
    make = make or MACHINES[name]
    machine = make(None)
    own = events.where(F.col("event_type").isin(*machine.types)) if machine.types else events
    own = own.select(*[c for c in NEEDED if c in events.columns])
    if mapped:
        return own.groupBy("pipeline_id").transformWithState(MapProcessor(make, keep_ms), OUT, "Append", "ProcessingTime" if keep_ms else "None")
    if not machine.timed:
        return own.groupBy("pipeline_id").transformWithState(MachineProcessor(make), OUT, "Append", "None")
    rows = with_heartbeats(own, events, machine.types).withWatermark("at", f"{delay_ms} milliseconds")
    return rows.groupBy("to").transformWithState(MachineProcessor(make), OUT, "Append", "EventTime")


def with_heartbeats(own: DataFrame, events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(to, at, ...): wanted events without a time, and the latest time of each task's batch of all events, under one of HEARTBEATS keys."""
    names = own.columns
    wanted = F.col("event_type").isin(*types) if types else F.lit(True)
    rows = events.select(F.coalesce("pipeline_id", F.lit("")).alias("to"), F.lit(None).cast("timestamp").alias("at"), F.coalesce(wanted, F.lit(False)).alias("wanted"), *names)
    schema = rows.drop("wanted").schema

    def beats(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        key = f"{HEARTBEAT}{TaskContext.get().partitionId() % HEARTBEATS}"
        for b in batches:
            data = b.filter(b["wanted"]).drop_columns(["wanted"])
            if data.num_rows:
                yield data
            if (top := pc.max(b["ts"]).as_py()) is not None:
                beat = {"to": pa.array([key], data.schema.field("to").type), "at": pa.array([top * 1000], pa.int64()).cast(data.schema.field("at").type)}
                yield pa.RecordBatch.from_arrays([beat.get(f.name, pa.nulls(1, f.type)) for f in data.schema], schema=data.schema)

    return rows.mapInArrow(beats, schema)


def configure(spark: SparkSession) -> None:
    """The state store that keyed state needs."""
    spark.conf.set(*PROVIDER)


