"""What came before a row, for keys of any number of rows: within runs, and over what the runs leave."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places in the order whose rows one task takes together.
RUN = 50_000


def _same(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True)])


def _joined(own: DataFrame, runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    names = [*keys, "_run"]
    other = runs.select(*[F.col(k).alias(f"_of_{k}") for k in names], F.col("_before").alias(value))
    return own.join(other, _same(names, [f"_of_{k}" for k in names]), "left").drop(*[f"_of_{k}" for k in names])


def highest_before(rows: DataFrame, keys: list[str], value: str, order: str, more: tuple[str, ...] = (), run: int = RUN, levels: int = 2) -> DataFrame:
    """``rows`` with ``_before``: the highest ``value`` of the key's earlier rows by ``order``, and by ``more`` within the same place.

    A running maximum within runs of places, and over the runs' maxima, which are
    in runs again: a task orders RUN rows, or one for each RUN * RUN of a key.
    """
    own = rows.withColumn("_run", F.floor(F.col(order) / run))
    tops = own.groupBy(*keys, "_run").agg(F.max(value).alias("_top"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if levels > 1:
        tops = highest_before(tops.withColumnRenamed("_run", "_at"), keys, "_top", "_at", (), run, levels - 1).withColumnRenamed("_at", "_run")
    else:
        tops = tops.withColumn("_before", F.max("_top").over(earlier(Window.partitionBy(*keys).orderBy("_run"))))
    inside = F.max(value).over(earlier(Window.partitionBy(*keys, "_run").orderBy(order, *more)))
    both = _joined(own.withColumn("_inside", inside), tops, keys, "_earlier")
    return both.withColumn("_before", F.greatest("_inside", "_earlier")).drop("_run", "_inside", "_earlier")


def row_before(rows: DataFrame, keys: list[str], fields: list[str], order: str, run: int = RUN) -> DataFrame:
    """``rows`` with ``_before``: ``fields`` of the key's row before by ``order``, null for its first.

    The first row of a run has the last one of the key's run before, which is a row for
    each run.
    """
    own = rows.withColumn("_run", F.floor(F.col(order) / run))
    fields_of = F.struct(*fields)
    lasts = own.groupBy(*keys, "_run").agg(F.max_by(fields_of, order).alias("_last"))
    lasts = lasts.withColumn("_before", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_run")))
    inside = F.lag(fields_of).over(Window.partitionBy(*keys, "_run").orderBy(order))
    both = _joined(own.withColumn("_inside", inside), lasts, keys, "_earlier")
    return both.withColumn("_before", F.coalesce("_inside", "_earlier")).drop("_run", "_inside", "_earlier")
