"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (its lines, cut after the ends of sentences) are hashed, and
each distinct digest is added to one cell in each of three tables: a cell holds
how many digests it got, and the exclusive or of them and of their checks.  The
sketches of two versions subtract cell by cell, which leaves only the digests
that differ; a cell with one digest gives it up, which is taken from its other
cells, and so on.  If digests are left that no cell gives up, the pair is sketched
again, larger and with other hashes, until all are recovered.

A fingerprint is a sketch that has been peeled by itself, so whoever holds two of
them can recover both texts' digests, sketch them at one size, subtract and peel, and
has the likeness: the shared digests over all.  It reads ``cells.seed;`` and then
``cell.count.digests.checks;`` for each cell that isn't empty, numbered over the
three tables, digests and checks in hexadecimal.

Everything is DataFrame expressions.  Peeling goes table by table, where a digest
is in one cell only, so no digest is taken twice; a step is a generator and a sum
by cell over rows that lie together already, and nothing shuffles between steps.

Nulls and texts without a letter or mark have no paragraphs; two such texts are
alike (1).  The document after a row is the next by descending doc_id, after the
last the first, where null ids come last and rows with equal ids follow each
other by a hash of their texts; a single row is its own next.  Equal texts have
equal fingerprints, as their sizes and seeds depend on the text alone.  A very long
text has more cells, which are rows as any others.  Empty tables give no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, settle

#: Least cells of a table, cells for each digest, and rounds of peeling before a pair is sketched again at twice the size.
LEAST = 16
LOAD = 0.6
ROUNDS = 4
#: Rows that are ordered together, and the most bounds of runs in a row of the table that is broadcast, which has as many rows.
RUN_ROWS = 2000
FAN = 1000
#: Digests, a pair's and its sides' each counted, whose cells a task sums.
TASK_DIGESTS = 300_000

PARAGRAPH = r"\n+|(?<=[.!?])\x20+"


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs."""
    parts = F.filter(F.split(text, PARAGRAPH), lambda p: F.length(F.trim(p)) > 0)
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def place(table: int, seed: int | str, key: str) -> str:
    """The cell of a digest in one of the tables of ``size`` cells, numbered over all three."""
    return f"(3 * pmod(xxhash64({key}, 3 * {seed} + {table}), size) + {table})"


def check(key: str) -> str:
    return f"(xxhash64({key}, 'check') & 4294967295L)"


def cells_for(n: str, seed: int | str) -> str:
    return f"(greatest({LEAST}L, CAST(ceil({LOAD}D * ({n})) AS BIGINT)) * shiftleft(1L, {seed}))"


def literal(x: int) -> str:
    return f"CAST('{x}' AS BIGINT)"


def found(ends: str, bounds: str, most: int) -> Column:
    """The place of the first bound that isn't below the id, by bisection."""
    steps = [1 << k for k in reversed(range(most.bit_length()))]
    return F.expr(f"aggregate(array({','.join(map(str, steps))}), 0, (p, s) -> IF(p + s <= {bounds} AND get({ends}, p + s - 1) < id, p + s, p))")


def quantiles(n: int) -> Column:
    """Ids of (n - 1) approximate quantiles and the largest id, distinct and in order."""
    largest = F.array(F.max("id"))
    if n < 2:
        return largest
    return F.array_sort(F.array_distinct(F.concat(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n + 1000), largest)))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, run, extra, id, tie): each row with the next row's text; rows with ``extra`` are their run's next.

    Rows are dealt into runs of ids between quantiles of all ids, which are ids
    themselves, in two levels; the row at a run's upper end is also sent to the run
    above, as the next of its last row.  So each run is ordered by itself, and there
    are runs in proportion to the rows, up to FAN * FAN.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.expr(literal(-(1 << 63)))).alias("id"))
    runs = max(1, rows.count() // RUN_ROWS)
    wide = min(FAN, int(runs**0.5) + 1)
    tops = [x for x in rows.agg(quantiles(wide).alias("tops")).first()["tops"] or () if x is not None] or [0]  # at most FAN ids
    coarse = rows.withColumn("part", found(f"array({','.join(map(literal, tops))})", str(len(tops)), wide))
    # written, as a rerun might find other quantiles
    lower = coarse.groupBy(F.col("part").alias("of")).agg(quantiles(min(FAN, -(-runs // wide))).alias("ends"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # over FAN rows
    lower = settle(lower.withColumn("base", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).cast("int")).withColumn("all", F.sum(F.size("ends")).over(Window.partitionBy()).cast("int")), "runs")
    # at most FAN rows of FAN bounds, 8 MB
    dealt = coarse.join(F.broadcast(lower), F.col("part") == F.col("of")).withColumn("at", found("ends", "size(ends)", FAN)).withColumn("tie", F.xxhash64("text"))
    own = "named_struct('run', base + at, 'extra', 0)"
    dealt = dealt.withColumn("to", F.explode(F.expr(f"IF(get(ends, at) = id, array({own}, named_struct('run', (base + at + 1) % all, 'extra', 1)), array({own}))")))
    dealt = dealt.select("doc_id", "text", "id", "tie", "to.run", "to.extra")
    return dealt.withColumn("next_text", F.lead("text").over(ordered()))


def ordered():
    return Window.partitionBy("run").orderBy("extra", F.desc("id"), "tie")


def _summed(rows: DataFrame) -> DataFrame:
    """One row for each cell of a pair, without empty cells."""
    sums = rows.groupBy("row", "pair", "cell").agg(F.max("size").alias("size"), F.sum("c").alias("c"), F.expr("bit_xor(k)").alias("k"), F.expr("bit_xor(h)").alias("h"))
    return sums.where("c <> 0 OR k <> 0 OR h <> 0")


def cells(sides: DataFrame, seed: int | str) -> DataFrame:
    """(row, pair, cell, size, c, k, h): the cells of (row, pair, size, c, ds), the digests ``ds`` added ``c`` times."""
    each = sides.select("*", F.explode("ds").alias("k")).drop("ds")
    made = ", ".join(f"named_struct('cell', {place(t, seed, 'k')}, 'c', c, 'k', k, 'h', {check('k')})" for t in range(3))
    return _summed(each.selectExpr("row", "pair", "size", f"inline(array({made}))"))


def differences(pairs: DataFrame, seed: int) -> DataFrame:
    """(row, pair, added, removed, left): how many digests peeling recovers of (row, pair, size, a, b), and the cells it can't clear.

    ``size`` is the number of cells of a table; the rows of a pair must lie together,
    as after repartition("row").
    """
    one = "named_struct('c', 1L, 'ds', a), named_struct('c', -1L, 'ds', b)"
    now = cells(pairs.selectExpr("row", "pair", "size", f"inline(array({one}))"), seed)
    for step in range(3 * ROUNDS):
        t = step % 3
        pure = f"cell >= 0 AND cell % 3 = {t} AND abs(c) = 1 AND h = {check('k')} AND cell = {place(t, seed, 'k')}"
        others = ", ".join(f"named_struct('cell', {place(o, seed, 'k')}, 'c', -c, 'k', k, 'h', h)" for o in range(3) if o != t)
        taken = "named_struct('cell', IF(c > 0, -1L, -2L), 'c', 1L, 'k', 0L, 'h', 0L)"
        now = _summed(now.selectExpr("row", "pair", "size", f"inline(IF({pure}, array({others}, {taken}), array(named_struct('cell', cell, 'c', c, 'k', k, 'h', h))))"))
    took = lambda cell: F.sum(F.when(F.col("cell") == cell, F.col("c")).otherwise(0))
    return now.groupBy("row", "pair").agg(took(-1).alias("added"), took(-2).alias("removed"), F.sum(F.when(F.col("cell") >= 0, 1).otherwise(0)).alias("left"))


def peeled(rows: DataFrame, pairs: list[tuple[str, str]], tasks: int) -> DataFrame:
    """(row, added_0, seed_0, ...): for each pair of digest columns the digests of the first that the second lacks, and the seed whose sketch peels.

    ``rows`` must be a written table with a unique ``row``.  A pair that can't be
    peeled is sketched again at twice the size.  A pair without a digest has nulls.
    """
    both = rows.repartition(tasks, "row")  # the arrays shuffle once, not once for each pair
    each = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).alias("a"), F.col(b).alias("b")) for i, (a, b) in enumerate(pairs)])
    both = both.select("row", F.explode(each).alias("p")).select("row", "p.pair", "p.a", "p.b")
    results, seed, todo = [], 0, both
    while True:
        done = settle(differences(todo.selectExpr("row", "pair", f"{cells_for('size(a) + size(b)', seed)} AS size", "a", "b"), seed), "differences", heavy=not seed)
        results.append(done.where("left = 0").select("row", "pair", "added", F.lit(seed).alias("seed")))
        left = done.where("left > 0").select(F.col("row").alias("_row"), F.col("pair").alias("_pair"))
        if left.isEmpty():
            break
        todo = rows.join(left.select(F.col("_row").alias("row")).distinct(), "row", "left_semi").select("row", F.explode(each).alias("p")).select("row", "p.pair", "p.a", "p.b")
        todo = todo.join(left, (F.col("row") == F.col("_row")) & (F.col("pair") == F.col("_pair")), "left_semi").repartition("row")
        seed += 1
    all_ = results[0]
    for r in results[1:]:
        all_ = all_.union(r)
    return all_.groupBy("row").agg(*[F.max(F.when(F.col("pair") == i, F.col(c))).alias(f"{c}_{i}") for i in range(len(pairs)) for c in ("added", "seed")])


def likeness(i: int, a: str, b: str) -> str:
    """Shared digests over all digests of two columns, from what the peeling of pair ``i`` recovered."""
    # a pair without a row has no difference left, or no digests
    shared = f"({a} - coalesce(added_{i}, 0))"
    return f"CASE WHEN {a} + {b} = 0 THEN 1.0D ELSE CAST({shared} AS DOUBLE) / ({a} + {b} - {shared}) END"


def prints(rows: DataFrame, seeds: DataFrame, columns: list[str], tasks: int) -> DataFrame:
    """(row, print_0, ...): the sketches of digest columns as text, with the seeds that peel them; rows without a digest are left out."""
    both = rows.join(seeds.select("row", *[f"seed_{i}" for i in range(len(columns))]), "row").repartition(tasks, "row")
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("pair"), F.coalesce(f"seed_{i}", F.lit(0)).alias("seed"), F.col(c).alias("ds")) for i, c in enumerate(columns)]))
    sides = both.select("row", sides.alias("s")).select("row", F.col("s.pair").alias("pair"), F.expr(f"named_struct('seed', s.seed, 'cells', {cells_for('size(s.ds)', 's.seed')})").alias("shape"), F.col("s.ds").alias("ds"))
    sides = sides.selectExpr("row", "pair", "shape.cells AS size", "shape.seed AS seed", "1L AS c", "ds")
    made = cells(sides, "seed")
    listed = made.groupBy("row", "pair").agg(F.array_sort(F.collect_list(F.struct("cell", "c", "k", "h"))).alias("cells"))
    text = F.array_join(F.transform("cells", lambda x: F.concat_ws(".", x["cell"], x["c"], F.lower(F.hex(x["k"])), F.lower(F.hex(x["h"])))), ";")
    return listed.groupBy("row").agg(*[F.max(F.when(F.col("pair") == i, text)).alias(f"print_{i}") for i in range(len(columns))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row of (doc_id, text).

    The texts shuffle once.  The edited text has the last half of its code points
    replaced by the first as many of the next document.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    rows = rows.select("run", "extra", "id", "tie", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edited_own"))
    rows = rows.withColumn("next_own", F.lead("own").over(ordered())).where("extra = 0").drop("run", "extra", "id", "tie")
    table = settle(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("none", F.array().cast("array<long>")), "sketched", heavy=True)
    sizes = {f"n_{c}": F.size(c) for c in ("own", "edited_own", "next_own")}
    whole = table.agg(F.sum(2 * F.size("own") + 2 * F.size("edited_own") + F.size("own") + F.size("next_own"))).first()[0] or 0
    tasks = max(table.sparkSession.sparkContext.defaultParallelism, -(-whole // TASK_DIGESTS))
    done = settle(peeled(table, [("own", "none"), ("edited_own", "none"), ("own", "edited_own"), ("own", "next_own")], tasks), "peeled", heavy=True)
    made = prints(table, done, ["own", "edited_own"], tasks)
    out = table.select("row", "doc_id", "n_chars", "edited_sha256", *[v.alias(k) for k, v in sizes.items()]).join(done, "row", "left").join(made, "row", "left")
    text = lambda i, n: f"concat({cells_for(n, f'coalesce(seed_{i}, 0)')}, '.', coalesce(seed_{i}, 0), ';', coalesce(print_{i}, ''))"
    return out.selectExpr(
        "doc_id", "n_chars", "edited_sha256", f"{text(0, 'n_own')} AS fingerprint", f"{text(1, 'n_edited_own')} AS edited_fingerprint",
        f"{likeness(2, 'n_own', 'n_edited_own')} AS near_edited", f"{likeness(3, 'n_own', 'n_next_own')} AS near_next",
    )


def op4_bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
