"""The driver's table ``events`` as delivery events.

Its five types of event stand for the stages; a number in ``props`` gives outcome,
status and rollbacks.  Most events are received five seconds after their time, some
more than the allowed disorder after it, and some have a time of arrival that isn't
positive.  ``clock`` squeezes time for patterns, which need density; ``shuffled``
delays the arrival of some events, as the table itself is in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START = 1_704_067_200_000
STAGE_OF = {"signup": "BUILD", "view": "TEST", "click": "SONARQUBE", "error": "PACKAGE", "purchase": "DEPLOY"}


def events(spark: SparkSession, sf_dir: str, clock: int = 1, shuffled: bool = False) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    stage = F.lit(None).cast("string")
    for kind, name in STAGE_OF.items():
        stage = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(stage)
    named = raw.select("event_id", "user_id", k.alias("k"), stage.alias("stage"), (ms if clock == 1 else F.lit(START) + F.floor((ms - START) / clock)).cast("long").alias("ts"))
    outcome = F.when(F.col("k") % 3 == 0, "STARTED").when(F.col("k") % 3 == 1, "SUCCESS").otherwise("FAILED")
    return named.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("pipe-"), (F.col("user_id") % 4).cast("string")).alias("pipeline_id"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 7).cast("string")).alias("service_name"),
        F.lit("main").alias("branch"),
        F.concat(F.lit("c"), (F.col("user_id") % 64).cast("string")).alias("commit_sha"),
        "stage",
        F.when((F.col("stage") == "DEPLOY") & (F.col("k") >= 85), "ROLLBACK_STARTED").otherwise(F.concat_ws("_", "stage", outcome)).alias("event_type"),
        F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_timestamp"),
        F.when(F.col("k") % 20 == 19, "failure").when(F.col("k") % 3 == 2, "FAILURE").otherwise("SUCCESS").alias("status"),
        "ts",
        F.when(F.col("k") % 10 == 7, F.col("ts") + 45_000).when(F.col("k") % 25 == 3, 0).when(F.col("k") % 25 == 4, -1).otherwise(F.col("ts") + 5000).alias("received"),
        (2 * F.col("event_id") + F.when(F.col("k").between(42, 44), 801).otherwise(0) if shuffled else F.col("event_id")).cast("long").alias("seq"),
        F.col("event_id").alias("number"),
    )
