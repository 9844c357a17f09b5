"""Sinks: upserted metric rows, appended alerts, annotations; for batches and foreachBatch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..functions.columns import METRIC, METRIC_COLUMNS, METRIC_KEY


class MetricTable:
    """Metric rows in Parquet, one for each key, in BUCKETS buckets by a hash of the key.

    An upsert merges a batch into the buckets that it touches, writes these anew, and
    then a manifest that names each bucket's folder.  Readers see whole manifests
    only.  A manifest also has the last batch of each source (a stream's query id,
    which a new checkpoint changes), so a batch that is delivered again does nothing
    and one of a new stream counts.  What the last two manifests don't name is deleted.
    One writer at a time.
    """

    BUCKETS = 32
    ROW = f"{METRIC}, inserted_at long"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, at = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json") and n[0] not in "._")

    def manifest(self, number: int | None = None) -> dict:
        found = self._numbers()
        if number is None and not found:
            return {"batches": {}, "buckets": {}}
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifests/{found[-1] if number is None else number}.json").first()[0]
        return json.loads(text)

    def _rows(self, buckets: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/data/{folder}/b={b}" for b, folder in sorted(buckets.items())]
        return self.spark.read.schema(self.ROW).parquet(*paths) if paths else self.spark.createDataFrame([], self.ROW)

    def read(self) -> DataFrame:
        return self._rows(self.manifest()["buckets"])

    def upsert(self, batch: DataFrame, number: int, order: str = "seq", source: str | None = None) -> None:
        """Rows of METRIC with ``inserted_at`` and ``order``; of a key's rows the last counts."""
        source = source or source_of(self.spark)
        before = self.manifest()
        if before["batches"].get(source, -1) >= number:
            return
        names = [*METRIC_COLUMNS, "inserted_at"]
        bucket = F.pmod(F.xxhash64(*METRIC_KEY), F.lit(self.BUCKETS)).cast("int")
        new = batch.select(*names, F.struct(F.lit(1), F.col(order).cast("long")).alias("_order"))
        touched = {str(r[0]) for r in new.select(bucket).distinct().collect()}
        old = self._rows({b: f for b, f in before["buckets"].items() if b in touched}).select(*names, F.struct(F.lit(0), F.lit(0).cast("long")).alias("_order"))
        rest = [c for c in names if c not in METRIC_KEY]
        merged = old.union(new).groupBy(*METRIC_KEY).agg(F.max_by(F.struct(*rest), "_order").alias("_r")).select(*METRIC_KEY, "_r.*").select(*names, bucket.alias("b"))
        folder = uuid.uuid4().hex
        if touched:
            merged.repartition("b").write.partitionBy("b").parquet(f"{self.path}/data/{folder}")
        done = {"batches": before["batches"] | {source: number}, "buckets": before["buckets"] | dict.fromkeys(touched, folder)}
        self._write(f"manifests/{(self._numbers() or [-1])[-1] + 1}.json", json.dumps(done))
        self._forget()

    def _write(self, name: str, text: str) -> None:
        """A file that appears as a whole."""
        fs, at = self._at(name)
        _, unfinished = self._at(name.replace("manifests/", "manifests/_"))
        out = fs.create(unfinished, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(unfinished, at):
            raise OSError(f"{self.path}/{name} could not be written")

    def _forget(self) -> None:
        numbers = self._numbers()
        kept = {f for n in numbers[-2:] for f in self.manifest(n)["buckets"].values()}
        for name in [f"data/{f}" for f in self._names("data") if f not in kept] + [f"manifests/{n}.json" for n in numbers[:-2]]:
            fs, at = self._at(name)
            fs.delete(at, True)


def source_of(spark: SparkSession) -> str:
    """The id of the streaming query whose batch this is; it stays the same as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def append_alerts(batch: DataFrame, path: str, batch_id: int, source: str | None = None) -> None:
    """Appends (alert_type, payload, ...) to a folder of its own for each source and batch: written again, not twice."""
    at = f"{path.rstrip('/')}/source={source or source_of(batch.sparkSession)}/batch={batch_id}"
    batch.where("payload IS NOT NULL AND payload <> ''").write.mode("overwrite").parquet(at)


def annotated(metrics: DataFrame) -> DataFrame:
    """The metric rows that are annotated."""
    t = F.col("metric_type")
    return metrics.where(t.isin(*V.ANNOTATED) | ((t == V.HEALTH_SCORE) & F.col("performance_band").isin("Low", "Elite")))


def annotations(metrics: DataFrame, tag: str = V.ANNOTATION_TAG) -> DataFrame:
    """(metric_type, pipeline_id, tags, text, time_ms) of the metric rows that are annotated."""
    named = lambda c: F.coalesce(F.col(c), F.lit("?"))
    text = F.format_string("[%s] %s — pipeline: %s | value: %.2f | band: %s", "metric_type", named("service_name"), named("pipeline_id"), "value", named("performance_band"))
    tags = F.array(F.lit(tag), F.translate(F.lower("metric_type"), "_", "-"), F.concat(F.lit("pipeline:"), named("pipeline_id")), F.concat(F.lit("service:"), named("service_name")), F.concat(F.lit("band:"), named("performance_band")))
    return annotated(metrics).select("metric_type", "pipeline_id", tags.alias("tags"), text.alias("text"), F.col("window_end_ms").alias("time_ms"))


def post_annotations(rows: DataFrame, url: str, key: str, timeout: float = 5.0, tries: int = 3) -> DataFrame:
    """(sent, status): each annotation posted from the executors, again if it can't be reached; a failure is a status, not an error."""

    def send(batches):
        import urllib.request

        import pyarrow as pa

        for b in batches:
            found = []
            for r in b.select(["tags", "text"]).to_pylist():
                request = urllib.request.Request(f"{url}/api/annotations", json.dumps(r).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"}, method="POST")
                for left in reversed(range(tries)):
                    try:
                        with urllib.request.urlopen(request, timeout=timeout) as answer:
                            found.append((answer.status == 200, str(answer.status)))
                        break
                    except OSError as e:
                        if not left:
                            found.append((False, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.bool_()), pa.array([x[1] for x in found], pa.string())], ["sent", "status"])

    return rows.mapInArrow(send, "sent boolean, status string")


def poster(url: str, key: str, timeout: float = 5.0) -> Callable[[DataFrame], None]:
    """A function that posts a batch's annotations, for ``jobs.start``."""
    return lambda rows: post_annotations(rows, url, key, timeout).write.format("noop").mode("overwrite").save()


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Appends to a database table; needs the database's driver on the class path. An upsert is the database's own, from a staging table."""
    rows.write.mode("append").jdbc(url, table, properties=properties)


def to_sinks(table: MetricTable, alert_path: str | None = None, also: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: rows with a ``kind`` of METRIC or ALERT go to their sinks, inserted at the time of writing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        table.upsert(batch.where("kind = 'METRIC'").withColumn("inserted_at", F.unix_millis(F.current_timestamp())), batch_id)
        if alert_path:
            append_alerts(batch.where("kind = 'ALERT'").select(F.col("metric_type").alias("alert_type"), F.col("detail").alias("payload"), F.unix_millis(F.current_timestamp()).alias("inserted_at")), alert_path, batch_id)
        if also:
            also(batch, batch_id)
        batch.unpersist()

    return write
