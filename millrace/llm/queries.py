"""Queries of this folder's operators, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bloom_lookup import op4_bloom_lookup
from .compact_windows import op9_compact_windows
from .host_rules import op5_host_rules
from .langid import op7_language
from .lattice import op3_lattice
from .mixing import op8_mixing
from .oracles import oracle_sql  # noqa: F401
from .packing import op6_packing
from .secret_scan import op1_secret_scan
from .sharding import op2_sharding
from .signature_tree import op10_jaccard_join


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_sharding, op3_lattice, op4_bloom_lookup, op5_host_rules, op6_packing, op7_language, op8_mixing, op9_compact_windows, op10_jaccard_join)}
