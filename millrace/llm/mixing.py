"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source's documents are dealt into shards by a seeded hash, lie there in a
seeded order, and are cut into blocks of equally many words.  The whole mix is a
number of blocks; Sainte-Lague apportionment (highest quotients of votes over odd
numbers) gives them to the sources by their targets, and a source's to its shards
by their words.  A shard takes all of its blocks as often as its quota holds them,
and the rest of the quota once more by a seeded permutation of its blocks.

Sources are rows of a table, so there may be any number of them: their order, the
level that targets stop at and the divisor of the highest quotients are found by
sums over it, and the driver gets numbers only.  A source's shards are planned by
one task.  A block has the same length in any table.

Nulls: a null text has no words and is never taken; a null source is a source,
the last.  Equal quotients go to the source first in order.  Repeated rows are rows
of their own; equal ones may swap what is taken.  A text of any length is counted
and cut whole.  Empty tables give no rows; columns other than doc_id, source and text
are carried by ``mixed_documents`` alone, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, map_rows, settle, spare

#: By a source's place in code point order, again and again.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK = 64
#: Words of a shard, which is ordered as a whole, at the least; more where the table has over MAX_SHARDS shards of them.
LEAST_SHARD = 1 << 16
MAX_SHARDS = 20_000
#: Sources that are numbered by one task, and the values that a search tries in one pass.
RANKED = 100_000
PROBES = 48


def sainte_lague(votes: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1), none over its cap; ties go to the first.

    Most seats are dealt at once by a divisor that can't give too many, the rest
    one by one.
    """
    v = np.asarray(votes, float)
    most = np.full(len(v), np.inf) if caps is None else np.asarray(caps, float)
    seats = int(min(seats, np.where(v > 0, most, 0).sum()))
    if not len(v) or seats <= 0 or v.max() <= 0:
        return [0] * len(v)
    rounded = lambda x: np.minimum(np.floor(v * x + 0.5), np.where(v > 0, most, 0))
    low, high = 0.0, seats / v[v > 0].min() * 2 + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if rounded(mid).sum() <= seats else (low, mid)
    given = np.maximum(rounded(low * (1 - 1e-12)), 0).astype(np.int64)
    queue = [(-v[i] / (2 * given[i] + 1), i) for i in range(len(v)) if v[i] > 0 and given[i] < most[i]]
    heapq.heapify(queue)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(queue, (-v[i] / (2 * given[i] + 1), i))
    return given.tolist()


def _seeded(seed: int, *of: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr((seed, *of)).encode(), digest_size=8).digest(), "little")


def shape(shards: list[tuple[int, int]], quota: int, block: int, seed: int, source: int, times: int = MOST_TIMES) -> list[tuple]:
    """(shard, blocks, full, extra, a, c) of a source's (shard, words): block b is taken ``full`` times, and once more if (a * b + c) mod blocks < extra."""
    blocks = [math.ceil(w / block) for _, w in shards]
    rows = []
    for (k, w), n, q in zip(shards, blocks, sainte_lague([w for _, w in shards], quota, [times * n for n in blocks]), strict=True):
        if n:
            # the last block may be short, so whole rounds take fewer words than their blocks
            full, rest = divmod(min(q * block, times * w), w)
            extra = min(n, round(rest / block))
            a = _seeded(seed, source, k, "a") % n
            while math.gcd(a, n) != 1:
                a = (a + 1) % n if n > 1 else 1
            rows.append((k, n, full, extra, a, _seeded(seed, source, k, "c") % n))
    return rows


def ranked(sums: DataFrame) -> DataFrame:
    """(source, n, i): sources with their places in code point order, null last."""
    many = -(-sums.count() // RANKED)
    dealt = settle(sums.withColumn("last", F.col("source").isNull()).repartitionByRange(max(1, many), "last", "source").withColumn("part", F.spark_partition_id()), "ranges")
    # a row for each RANKED sources
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    before = counts.select(F.col("part").alias("of"), (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("last", "source")) - 1
    return dealt.withColumn("own", own).join(F.broadcast(before), F.col("part") == F.col("of")).select("source", "n", (F.col("own") + F.col("before")).alias("i"))


def level(sources: DataFrame, times: int) -> float:
    """What a unit of weight gets of all words, where no source gets over ``times`` its own: the excess is shared until none is above."""
    whole = sources.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    if not whole["n"]:
        return 0.0
    at, last = whole["n"] / whole["w"], -1.0
    while at > last:
        over = F.col("n") * times < F.col("weight") * at
        r = sources.agg(F.sum(F.when(over, F.col("n") * times).otherwise(0)).alias("capped"), F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open")).first()
        if not r["open"]:  # rounding alone
            break
        at, last = max(at, (whole["n"] - r["capped"]) / r["open"]), at
    return at


def search(df: DataFrame, counted: Callable[[float | int], Column], low, high, most: int, whole: bool = False):
    """The neighbours (low, high) between which sum(counted(x)) rises over ``most``; PROBES values are tried in one pass."""
    while True:
        step = (high - low) // (PROBES + 1) if whole else (high - low) / (PROBES + 1)
        tried = sorted({x for x in ([low + step * k for k in range(1, PROBES + 1)] if not whole or step else range(low + 1, high)) if low < x < high})
        if not tried:
            return low, high
        sums = df.agg(*[F.sum(counted(x)).alias(f"s{k}") for k, x in enumerate(tried)]).first()
        for x, n in zip(tried, sums, strict=True):
            if (n or 0) <= most:
                low = max(low, x)
            else:
                high = min(high, x)


def quotas(sources: DataFrame, seats: int) -> DataFrame:
    """``sources`` (i, target, most) with ``quota``: ``seats`` by highest quotients target / (2 * seats + 1), none over its ``most``; ties go to the first."""
    held = F.when(F.col("target") > 0, F.col("most")).otherwise(0)
    ends = sources.agg(F.sum(held).alias("most"), F.min(F.when(F.col("target") > 0, F.col("target"))).alias("least"), F.max("i").alias("last")).first()
    seats = min(seats, ends["most"] or 0)
    given = lambda x: F.when(F.col("target") > 0, F.least(F.floor(F.col("target") * F.lit(float(x)) + 0.5), "most")).otherwise(0).cast("long")
    if not seats or seats == ends["most"]:
        return sources.withColumn("quota", held.cast("long") if seats else F.lit(0).cast("long"))
    low, high = search(sources, given, 0.0, 2 * seats / ends["least"] + 1, seats)
    rest = seats - sources.agg(F.sum(given(low))).first()[0]
    tied = given(high) > given(low)
    # the last place in order that gets one more
    first, _ = search(sources, lambda i: F.when(tied & (F.col("i") < i), 1).otherwise(0), 0, ends["last"] + 2, rest, whole=True)
    return sources.withColumn("quota", given(low) + F.when(tied & (F.col("i") < first), 1).otherwise(0))


def shapes(shards: DataFrame, block: int, seed: int, times: int) -> DataFrame:
    """(_ci, _ck, _blocks, _full, _extra, _a, _c): the plan of (i, shard, words, quota)."""
    names = ["_ci", "_ck", "_blocks", "_full", "_extra", "_a", "_c"]

    def make():
        state: dict = {"at": None, "quota": 0, "own": []}

        def flush(out):
            for r in shape(state["own"], state["quota"], block, seed, state["at"], times):
                for k, v in zip(names, (state["at"], *r), strict=True):
                    out[k].append(v)
            state["own"] = []

        def rows(cols):
            out = {k: [] for k in names}
            for i, k, words, quota in zip(*(cols[c] for c in ("i", "shard", "words", "quota")), strict=True):
                if i != state["at"]:
                    flush(out)
                    state["at"], state["quota"] = i, quota
                state["own"].append((k, words))
            return out

        def close():
            out = {k: [] for k in names}
            flush(out)
            return out

        rows.close = close
        return rows

    return map_rows(shards.select("i", "shard", "words", "quota").repartition("i").sortWithinPartitions("i", "shard"), make, "_ci long, _ck int, _blocks long, _full long, _extra long, _a long, _c long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = MOST_TIMES, block: int = BLOCK, seed: int = 8) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first, shape) of each row of (doc_id, source, text).

    ``taken``: words of the document in the mix, repeats counted.  ``first`` is the
    place of its first word in its shard and ``shape`` the shard's block length,
    blocks and choice, from which ``mixed_documents`` cuts the texts.  The joins
    with sources and shards are left to Spark: it broadcasts small tables only.
    """
    # regexp_count gives int; a text of over 2^31 characters can't be in a row
    sized = settle(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    sources = settle(ranked(settle(sized.groupBy("source").agg(F.sum("size").alias("n")), "sums")).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int"))), "sources")
    whole = sources.agg(F.sum("n")).first()[0] or 0
    part = max(LEAST_SHARD, whole // MAX_SHARDS)
    sources = sources.withColumn("target", F.least(F.col("n") * float(times), F.col("weight") * level(sources, times))).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("n") / part)).cast("int"))
    known = sources.select(F.col("source").alias("_source"), F.col("i").alias("_i"), F.col("n").alias("source_size"), "target", "parts")
    dealt = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("parts")).cast("int"))
    shards = settle(dealt.groupBy(F.col("_i").alias("i"), F.col("_shard").alias("shard")).agg(F.sum("size").alias("words")), "shards")
    most = shards.groupBy(F.col("i").alias("of")).agg(F.sum(times * F.ceil(F.col("words") / block)).alias("most"))
    given = settle(quotas(settle(sources.join(most, F.col("i") == F.col("of")).select("i", "target", "most"), "votes"), round(whole / block)), "quotas")
    chosen = settle(shapes(shards.join(given.select(F.col("i").alias("of"), "quota"), F.col("i") == F.col("of")), block, seed, times), "shapes")
    w = Window.partitionBy("_i", "_shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size")
    placed = dealt.withColumn("first", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(chosen, (F.col("_i") == F.col("_ci")) & (F.col("_shard") == F.col("_ck")), "left")
    once_more = F.expr(f"""
        CASE WHEN size = 0 OR _extra = 0 THEN 0L ELSE
        aggregate(sequence(first DIV {block}, (first + size - 1) DIV {block}), 0L, (n, b) -> n + IF((b * _a + _c) % _blocks < _extra,
            least(first + size, (b + 1) * {block}) - greatest(first, b * {block}), 0L)) END""")
    taken = F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(F.col("_full") * F.col("size") + once_more)
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "first", F.struct(F.lit(block).cast("long").alias("block"), "_blocks", "_full", "_extra", "_a", "_c").alias("shape"))


def cut(text: str, first: int, block: int, blocks: int, full: int, extra: int, a: int, c: int) -> list[str]:
    """The texts that the mix takes of a document: the whole as often as all of its blocks are taken, then the words of the blocks taken once more."""
    import re

    spans = [m.span() for m in re.finditer(WORD, text)]
    out = [text] * full
    runs: list[list[int]] = []
    for b in range(first // block, (first + len(spans) - 1) // block + 1) if spans else ():
        if (b * a + c) % blocks < extra:
            at, end = max(first, b * block) - first, min(first + len(spans), (b + 1) * block) - first
            if runs and runs[-1][1] == at:
                runs[-1][1] = end
            else:
                runs.append([at, end])
    if runs == [[0, len(spans)]]:
        out.append(text)
    elif runs:
        out.append("\n".join(text[spans[i][0] : spans[j - 1][1]] for i, j in runs))
    return out


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, with all their columns: a row for each text of ``cut``.

    A text cut to some of its blocks has their words, and n_chars, where there is
    such a column, is the length of the new text.  Rows are matched by doc_id; of
    rows with the same doc_id, each is taken as the first of its size is.
    """
    own = {k: spare(docs, k) for k in ("own_id", "own_size", "own_source", "first", "shape")}
    took = mix(docs, **how).select(*[F.col(c).alias(own[k]) for c, k in (("doc_id", "own_id"), ("size", "own_size"), ("source", "own_source"), ("first", "first"), ("shape", "shape"))])
    took = took.where(F.col(own["own_size"]) > 0).dropDuplicates([own[k] for k in ("own_id", "own_size", "own_source")])
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    joined = docs.join(took, F.col("doc_id").eqNullSafe(F.col(own["own_id"])) & (words == F.col(own["own_size"])) & F.col("source").eqNullSafe(F.col(own["own_source"]))).select(*docs.columns, own["first"], own["shape"])
    names = docs.columns

    def make():
        def rows(cols):
            out = {k: [] for k in names}
            for i, (text, first, shape) in enumerate(zip(cols["text"], cols[own["first"]], cols[own["shape"]], strict=True)):
                for t in cut(text, first, *shape.values()):
                    for k in names:
                        out[k].append(t if k == "text" else len(t) if k == "n_chars" else cols[k][i])
            return out

        return rows

    return map_rows(joined, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
