"""Shared pieces: Arrow row passes, written tables, gapless numbering, components."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, \x20 and \x09-\x0D: also what bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of documents of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- passes over rows -----------------------------------------------------------------


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str, binary: tuple[str, ...] = ()) -> DataFrame:
    """Arrow batches of ``df`` through a function of column lists.

    ``make`` runs once in each task and returns the function, which takes a dict
    of lists and returns one for ``schema``; it may return rows for none, one or
    many input rows.  A returned function with an attribute ``close`` gives rows
    after the last batch.  Columns in ``binary`` arrive as UTF-8 bytes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    to = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for at in range(0, b.num_rows, 1000):  # bounds what Python holds at once
                part = b.slice(at, 1000)
                cols = {}
                for name, col in zip(part.schema.names, part.columns, strict=True):
                    if name in binary:
                        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
                    cols[name] = col.to_pylist()
                yield from batch(f(cols))
        if hasattr(f, "close"):
            yield from batch(f.close())
        f = b = part = cols = col = None
        give_back()

    def batch(out: dict[str, list]) -> Iterator[pa.RecordBatch]:
        made = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type) for f in to], schema=to)
        for at in range(0, made.num_rows, 20_000):
            yield made.slice(at, 20_000)

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system, as a Python worker lives on after a task and the allocators keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


# --- written tables -------------------------------------------------------------------

_own: dict[str, str] = {}
_places: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only in local mode where that is unset."""
    if at := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="millrace-")
        import shutil

        atexit.register(shutil.rmtree, _own["dir"], True)
    return "file://" + _own["dir"]


def settle(df: DataFrame, name: str, heavy: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again.

    The written table cuts the lineage: what is read again doesn't depend on an
    executor's disk, so a lost executor costs only the tasks it was running.
    After a ``heavy`` plan the driver collects its garbage, upon which Spark deletes
    the plan's shuffle files; else they'd stay until it happens to.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}/{name}"
    df.write.parquet(at)
    if heavy:
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(at)
    _places[id(out)] = at.rpartition("/")[0]
    atexit.register(_forget, spark, _places[id(out)])
    return out


def spread(df: DataFrame, by: str, name: str) -> DataFrame:
    """As ``settle``, with a folder for each value of ``by``, so that one value is read without the others."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(by).parquet(at)
    atexit.register(_forget, spark, at.rpartition("/")[0])
    return spark.read.schema(df.schema).parquet(at)


def unsettle(df: DataFrame) -> None:
    """Deletes the written table of a frame that ``settle`` returned and nothing reads any more."""
    if at := _places.pop(id(df), None):
        _forget(df.sparkSession, at)


def _forget(spark: SparkSession, at: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended; the folder's owner clears it
        pass


def spare(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- numbering ------------------------------------------------------------------------


def numbered(df: DataFrame, group: str, order: list[str], buckets: int, name: str = "slot") -> DataFrame:
    """A gapless number from 0 for the rows of each group, without a group's rows in one task.

    Rows fall into hashed buckets of their group by the columns ``order``, are
    numbered within a bucket, and get the rows of the earlier buckets as offset.
    The offsets are a row for each group and bucket, so ``buckets`` bounds them.
    Rows equal in all of ``order`` may swap numbers.
    """
    parts = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    w = Window.partitionBy(group, "_b").orderBy(*order)
    counted = parts.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counted.withColumn("_from", F.sum("_n").over(Window.partitionBy(group).orderBy("_b")) - F.col("_n")).select(F.col(group).alias("_g"), F.col("_b").alias("_gb"), "_from")
    local = parts.withColumn("_i", F.row_number().over(w) - 1)
    joined = local.join(before, (F.col(group).eqNullSafe(F.col("_g"))) & (F.col("_b") == F.col("_gb")))
    return joined.withColumn(name, (F.col("_from") + F.col("_i")).cast("long")).drop("_b", "_i", "_g", "_gb", "_from")


# --- components -----------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of (a, b) links.

    Alternates large-star and small-star: each round links every node to smaller
    ones, and the links shrink to stars round the smallest nodes, in rounds that
    grow with the logarithm of the nodes.  Every round is a written table, deleted
    when the next one stands; nothing but a row count comes to the driver.
    Aggregations are partial before they shuffle, and the joins are on plain keys,
    so adaptive execution splits those of a hub.
    """

    def lower(x: DataFrame) -> DataFrame:
        """Distinct links (a, b) with a > b."""
        return x.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()

    now = settle(lower(links), "links")
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = lower(both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        step = large.join(small, F.col("a") == F.col("k")).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s")).select("s.a", "s.b")
        now, last = settle(lower(step), "links"), now
        unsettle(last)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
        if before == (state["n"], state["h"]):
            break
        before = (state["n"], state["h"])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def tokenizer_path(name: str, path: str | None = None) -> str:
    """Where a vocabulary file lies: ``path`` if given, else the installed package's."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)
