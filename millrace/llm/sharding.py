"""Sharding by a k-d tree over metadata, split at weighted medians.

A node splits along its widest dimension at the size-weighted quantile that
leaves each side its share of the shards, until each leaf is one shard; the shards
are as many as the target bytes need.  The dimensions are the length, source and
lang, scaled to QUANT steps, with a hash of the text below them, and a hash of the
row below that, so that ties split too.  The quantiles are found by sums over bins,
refined where the quantile falls; a pass serves all nodes of a level, and the driver
gets BINS sums a node at most.  Over MOST shards the tree's upper part deals the
rows into groups, which are tables of their own, and each is sharded on.

The law is ``bytes``: shards hold nearly equally many.  Equal texts have the source
and lang of the first of them as their place, so they share a shard, unless
together they have over WHOLE_GROUP of a shard's bytes; then they are split, so that
no group makes a shard larger.  Nulls: a null text has no bytes, and equals the empty
one; other nulls are a value below all others.  Repeated rows are equal texts.  A very
long text is a row that can't be split, so it may make its shard larger.  Empty
tables give no rows; columns other than doc_id, text, source and lang are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, numbered, settle, spread

QUANT = 20
TIE = 63 - QUANT
#: Bits of the tie that tell rows of equal texts apart.
ROW = 10
BINS = 1024
PASSES = 12
#: Equal texts with at most this share of a shard's bytes are never split.
WHOLE_GROUP = 0.02
#: The tree is an expression, so a pass deals rows into so many places at most.
MOST = 1024
DIMENSIONS = ("length", "source", "lang")


@dataclass
class Node:
    shards: int
    first: int
    dim: int = -1
    at: int = 0
    below: Node | None = None
    above: Node | None = None
    number: int = -1
    search: dict = field(default_factory=dict)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, crc, k0..k2): sizes, and a key of QUANT and TIE bits for each dimension."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    text = F.coalesce("text", F.lit(""))
    rows = settle(docs.select("doc_id", size.alias("size"), F.crc32(text).alias("crc"), F.xxhash64(text).alias("hash"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang")]), "sizes")
    first = rows.groupBy(F.col("hash").alias("of")).agg(F.min(F.struct("source", "lang")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # written, so that the join is between plain shuffles, which adaptive execution can split
    rows = rows.join(settle(first.select("of", "first"), "groups"), F.col("hash") == F.col("of"), "left")
    place = lambda c: F.when(F.col("of").isNull(), F.col(c)).otherwise(F.col(f"first.{c}"))
    steps = (1 << QUANT) - 1
    scaled = [F.least(F.log2(F.col("size").cast("double")) / 40, F.lit(1.0)) * steps, *[F.coalesce(F.crc32(place(c)) % steps + 1, F.lit(0)) for c in ("source", "lang")]]
    tie = F.shiftleft(F.shiftrightunsigned("hash", 64 - TIE + ROW), ROW) + F.shiftrightunsigned(F.xxhash64("doc_id", "crc"), 64 - ROW)
    return rows.select("doc_id", "size", "crc", *[(F.shiftleft(s.cast("long"), TIE) + tie).alias(f"k{i}") for i, s in enumerate(scaled)])


def _place(node: Node, leaf) -> Column:
    """The tree as an expression; ``leaf`` gives a node's value."""
    if node.below is None:
        return F.lit(leaf(node))
    return F.when(F.col(f"k{node.dim}") <= node.at, _place(node.below, leaf)).otherwise(_place(node.above, leaf))


def _pick(values: list, of: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), of + 1)


def grow(rows: DataFrame, shards: int, first: int = 0, most: int = 1) -> Node:
    """The k-d tree over keyed rows, down to leaves of at most ``most`` of the ``shards``."""
    root = Node(shards, first)
    level = [root]
    while level := [n for n in level if n.shards > most]:
        for i, n in enumerate(level):
            n.number = i
        numbers = {id(n): n.number for n in level}
        inside = rows.withColumn("_n", _place(root, lambda n: numbers.get(id(n), -1))).where("_n >= 0")
        ends = {r["_n"]: r for r in inside.groupBy("_n").agg(F.sum("size").alias("size"), *[f(f"k{d}").alias(f"{at}{d}") for d in range(len(DIMENSIONS)) for f, at in ((F.min, "lo"), (F.max, "hi"))]).collect()}
        for n in level:
            n.below, n.above = None, None
            if n.number in ends:
                r = ends[n.number]
                n.dim = max(range(len(DIMENSIONS)), key=lambda d: ((r[f"hi{d}"] >> TIE) - (r[f"lo{d}"] >> TIE), -d))
                n.search = {"lo": r[f"lo{n.dim}"], "hi": r[f"hi{n.dim}"], "under": 0, "size": r["size"], "goal": r["size"] * (n.shards // 2) / n.shards, "unit": 1 << ROW}
            else:  # no rows: its leaves stay empty
                n.dim, n.at, n.search = 0, -1, {}
        for _ in range(PASSES):
            todo = [n for n in level if n.search]
            if not todo:
                break
            lo, width, dim = ([f(n) for n in level] for f in (lambda n: n.search.get("lo", 1), _width, lambda n: n.dim))
            key = F.element_at(F.array(*[F.col(f"k{d}") for d in range(len(DIMENSIONS))]), _pick(dim, F.col("_n")) + 1)
            hi = [n.search.get("hi", 0) for n in level]
            binned = inside.select("_n", "size", key.alias("k")).where((F.col("k") >= _pick(lo, F.col("_n"))) & (F.col("k") <= _pick(hi, F.col("_n"))))
            binned = binned.groupBy("_n", F.expr("(k - element_at(array({}), _n + 1)) DIV element_at(array({}), _n + 1)".format(",".join(f"{x}L" for x in lo), ",".join(f"{x}L" for x in width))).alias("bin"))
            sums: dict[int, list] = {}
            for r in binned.agg(F.sum("size").alias("size"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect():
                sums.setdefault(r["_n"], []).append((r["bin"], r["size"], r["lo"], r["hi"]))
            for n in todo:
                s, last = n.search, None
                for _, size, a, b in sorted(sums[n.number]):
                    if s["under"] + size >= s["goal"] or b == s["hi"]:
                        break
                    s["under"] += size
                    last = b
                one = a >> ROW == b >> ROW
                if one and s["unit"] > 1 and a < b and size > WHOLE_GROUP * s["size"] / n.shards:
                    s["lo"], s["hi"], s["unit"] = a, b, 1  # equal texts of too many bytes: split among them
                elif a == b or one and s["unit"] > 1 or size <= s["size"] / 20_000 / n.shards:
                    before = a - 1 if last is None else last
                    n.at = b if s["goal"] - s["under"] > size / 2 else before
                    n.search = {}
                else:
                    s["lo"], s["hi"] = a, b
        for n in level:
            if n.search:  # a quantile within fewer keys than the passes tell apart
                n.at, n.search = n.search["hi"], {}
            n.below, n.above = Node(n.shards // 2, n.first), Node(n.shards - n.shards // 2, n.first + n.shards // 2)
        level = [x for n in level for x in (n.below, n.above)]
    return root


def _width(n: Node) -> int:
    """The keys of a bin: whole groups of equal texts, unless one of them is split."""
    unit = n.search.get("unit", 1)
    return ((n.search.get("hi", 0) - n.search.get("lo", 0)) // unit // BINS + 1) * unit


def leaves(node: Node) -> list[Node]:
    return [node] if node.below is None else leaves(node.below) + leaves(node.above)


def placed(rows: DataFrame, shards: int, first: int = 0) -> list[DataFrame]:
    """Keyed rows with their ``shard``, from ``first`` on, in as many frames as there are groups."""
    if shards <= MOST:
        root = grow(rows, shards, first)
        return [rows.select("doc_id", "size", "crc", _place(root, lambda n: n.first).cast("int").alias("shard"))]
    root = grow(rows, shards, first, -(-shards // MOST))
    numbers = {id(n): i for i, n in enumerate(leaves(root))}
    groups = spread(rows.withColumn("leaf", _place(root, lambda n: numbers[id(n)])), "leaf", "leaves")
    return [df for n in leaves(root) for df in placed(groups.where(F.col("leaf") == numbers[id(n)]).drop("leaf"), n.shards, n.first)]


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, rows_a_task: int = 100_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of (doc_id, text, source, lang).

    ``target_bytes`` gives the number of shards if ``shards`` doesn't.  Only the
    narrow table of keys is written and shuffled, never the texts.
    """
    rows = settle(_keyed(docs), "keys")
    whole = rows.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    if shards is None:
        shards = max(1, -(-(whole["size"] or 0) // target_bytes))
    dealt = reduce(DataFrame.union, placed(rows, shards))
    slots = numbered(dealt, "shard", ["doc_id", "crc", "size"], max(1, whole["n"] // shards // rows_a_task))
    return slots.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), 24)
