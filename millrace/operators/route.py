"""Branches of the event stream, as predicates; an event may be in several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V


def in_branch(name: str) -> Column:
    """If an event belongs to ``dora``, ``health``, ``pattern`` or ``late``; never without a type."""
    if name == "late":
        return F.col("event_type").isNotNull() & (F.col("ts") > 0) & (F.col("received") - F.col("ts") > V.OUT_OF_ORDER)
    types = {"dora": V.DORA_TYPES, "health": V.HEALTH_TYPES, "pattern": V.PATTERN_TYPES}[name]
    return F.coalesce(F.col("event_type").isin(*types), F.lit(False))


def routed(events: DataFrame) -> DataFrame:
    """Events with a type, and a flag for each branch."""
    return events.where("event_type IS NOT NULL").withColumns({f"is_{b}": in_branch(b) for b in ("dora", "health", "pattern", "late")})


def branch(events: DataFrame, name: str) -> DataFrame:
    return events.where(in_branch(name))


def of_types(events: DataFrame, *types: str) -> DataFrame:
    return events.where(F.col("event_type").isin(*types))
