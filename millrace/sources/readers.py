"""Where messages and events come from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import EVENT
from .decode import decode


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def kafka_events(spark: SparkSession, servers: str, topic: str = "cicd-events", group: str = "millrace", received: Column | None = None) -> DataFrame:
    """A stream of a topic from its start; needs Spark's Kafka package on the class path.

    Arrival is ordered within a partition by offset, which is all that a topic promises.
    """
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("kafka.group.id", group).option("failOnDataLoss", "false").load()
    return decode(raw.select("value", (now_ms() if received is None else received).alias("received"), F.col("offset").alias("seq")))


def json_lines(spark: SparkSession, path: str, received: Column | None = None, stream: bool = False) -> DataFrame:
    """Events of files with a message on each line; a stream takes a file at a time.

    ``seq`` numbers the lines of all files, files by name and lines by place, however
    Spark deals them out.  In a stream, which can't know what is to come, files follow
    each other by their times, to the second, and lines by place.
    """
    reader = spark.readStream.format("text").schema("value string").option("maxFilesPerTrigger", 1) if stream else spark.read.format("text")
    lines = reader.load(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.unix_seconds("_metadata.file_modification_time").alias("at"))
    arrived = (now_ms() if received is None else received).alias("received")
    if stream:
        # a block's lines have places below its length in bytes, so places rise over blocks
        placed = lines.mapInArrow(_placed, "value string, block long, at long, line long")
        return decode(placed.select("value", arrived, (F.shiftleft("at", 32) + F.col("block") + F.col("line")).alias("seq")))
    lines = lines.withColumn("id", F.monotonically_increasing_id())
    # a block is read by one task in order, so its lines are numbered in a row
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")  # a row for each block of the files
    blocks = blocks.select(F.col("file").alias("of"), F.col("block").alias("from"), (before - F.col("first")).alias("add"))
    both = lines.join(blocks, (F.col("file") == F.col("of")) & (F.col("block") == F.col("from")))
    return decode(both.select("value", arrived, (F.col("id") + F.col("add")).alias("seq")))


def _placed(batches):
    """Lines with their number in their block of a file; a task reads a block in order."""
    import pyarrow as pa

    seen: dict[tuple, int] = {}
    for b in batches:
        number = []
        for at in zip(b["file"].to_pylist(), b["block"].to_pylist(), strict=True):
            number.append(seen.get(at, 0))
            seen[at] = number[-1] + 1
        yield pa.RecordBatch.from_arrays([b["value"], b["block"], b["at"], pa.array(number, pa.int64())], ["value", "block", "at", "line"])


def grouped_json(spark: SparkSession, path: str, received: Column | None = None) -> DataFrame:
    """Events of a document whose groups hold arrays of messages, in the order of the document."""
    groups = spark.read.option("wholetext", True).text(path)
    items = groups.select(F.posexplode(F.flatten(F.map_values(F.from_json("value", "map<string, array<string>>")))).alias("seq", "value"))
    return decode(items.select("value", (now_ms() if received is None else received).alias("received"), F.col("seq").cast("long").alias("seq")))


def from_rows(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """A bounded source in memory: dicts of EVENT's fields, in order of arrival."""
    names = [c.strip().split()[0] for c in EVENT.split(",")]
    return spark.createDataFrame([tuple(({"seq": i, "received": 0} | r).get(k) for k in names) for i, r in enumerate(rows)], EVENT)
