"""N-gram Jaccard join with signature trees: all documents linked by similar shingle sets.

A document's set holds its distinct shingles of ``words`` words.  Two documents
link when ``whole * |A & B| >= part * |A | B|``; a document's component is the
smallest doc_id that links reach.  The result is exact:

1.  Equal sets are found by their digests, and only the smallest doc_id of a set
    goes on.
2.  Documents that share a key are candidates, and linked sets share one at least.
    Where a link asks for so much that the keys' parts hold HELD shingles and more,
    keys are equal parts: linked sets of a size differ by so many shingles at most, the
    hash space is dealt into a few more parts than that, and the digests of a set's
    parts, with its class of sizes, are its keys.  Unlike documents that share a passage
    or a line, however long or frequent, have no such key in common.  Small sets, whose
    parts would often be empty, have the combinations of RUN of their first shingles
    by hash.  For lower links, whose parts would hold too little, keys are the first
    shingles, as many as a linked set may lack and one, in an order of rare before
    frequent by a sketch of how many sets hold them; passages that many documents share
    come late in it.  One shingle is little: the more documents, the more unlike ones
    share one, until these chain all into one block.  So a key of few sets only
    makes candidates of those whose sizes and counts of shingles by ranges of the hash
    space allow a link.  The components of the candidates are the blocks, and all links
    are within blocks.
3.  In a block, the sets of each key are a signature tree: its nodes hold OR- and
    AND-combined bitmaps of their sets and their range of sizes.  Node pairs are
    traversed together and pruned when the largest overlap that bitmaps and sizes
    allow is too small, or when all below is connected already; what is left at the
    leaves is compared shingle by shingle.  A block of over BLOCK documents or
    CHUNK_SHINGLES shingles is cut into chunks, and each pair of chunks is a task of
    its own.

Nulls and texts without words have an empty set and link with nothing; rows with
a null doc_id link with nothing either.  Rows with the same doc_id are one
document, which has the links of all its texts.  A text of any length is one set, read
whole.  Empty tables give no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, documents, map_rows, settle, spare, unsettle

PART, WHOLE = 90, 100
WORDS = 3
#: Documents and shingles of a chunk: what a task holds of each of its two chunks.
BLOCK = 1500
CHUNK_SHINGLES = 1_000_000
LEAF, FAN = 8, 4
#: Sets that may lack so many shingles at most have combinations of RUN of their first shingles as keys.
FEW = 4
RUN = 4
#: Shingles that the parts of a set hold on average, for keys to be parts.
HELD = 6
#: Sets of a key that are tested pair by pair, and those of one batch that are; more are linked through the first.
PAIRED, PAIRED_HERE = 16, 4
#: Shingles in a range of a set's counts, at most on average, and ranges at least.
COUNTED, RANGES = 8, 32
#: Cells of the sketch of frequencies, the slices it is summed in, and the tasks' slices that are summed at once.
CELL_BITS = 23
SLICES = 64
SUMMED, LEVELS = 64, 3

K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * K[3]
    h = (h ^ (h >> np.uint64(33))) * K[4]
    return h ^ (h >> np.uint64(33))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted; of the whole sequence if it has fewer words."""
    own = (text or b"").lower().split()
    n = len(own)
    h = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, n)
    if not n:
        return h
    size = min(words, n)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out = scrambled(out * K[0] + h[k : n - size + 1 + k])
    return np.unique(out)


@cache
def least(c: int, part: int, whole: int) -> int:
    """The least size of a class; linked sets are in the same class or in neighbouring ones."""
    return 1 if not c else max(least(c - 1, part, whole) + 1, -(-whole * least(c - 1, part, whole) // part))


@cache
def size_class(n: int, part: int, whole: int) -> int:
    c = 0
    while least(c + 1, part, whole) <= n:
        c += 1
    return c


@cache
def dealing(c: int, part: int, whole: int) -> tuple[np.ndarray, int]:
    """The edges of the parts that sets of class ``c`` and the next are dealt into, and how many of a set's parts may be empty.

    Two linked sets of these sizes differ by ``most`` shingles, so they agree in all
    but so many parts; those that they agree in aren't all empty if fewer are.
    """
    a = least(c + 1, part, whole) - 1
    b = min(least(c + 2, part, whole) - 1, whole * a // part)
    most = (whole - part) * (a + b) // (whole + part)
    for n in range(most + 1, 2 * most + 3):
        each = least(c, part, whole) / n
        none = n * math.exp(-each)
        if n - most - 1 >= none + 5 * math.sqrt(none * (1 - (1 + each) * math.exp(-each))):
            break
    return np.array([(i << 64) // n for i in range(1, n)], np.uint64), n - most - 1


@cache
def choices(n: int, run: int) -> np.ndarray:
    return np.array(list(combinations(range(n), run)), np.int64)


def held(part: int, whole: int) -> float:
    """Shingles in a part of a set, if there are as many parts as linked sets differ by shingles."""
    return (whole + part) / (2 * max(whole - part, 1e-9))


def first_keys(own: np.ndarray, steps: np.ndarray, part: int, whole: int) -> np.ndarray:
    """The first shingles of a set by their frequency, each with the set's class of sizes and with the next."""
    n = len(own)
    if not n:
        return own
    first = n - -(-n * part // whole) + 1
    rank = (steps[cells(own)].astype(np.uint64) << np.uint64(58)) | (own >> np.uint64(6))
    kept = own[np.argpartition(rank, first - 1)[:first]]
    c = size_class(n, part, whole)
    return np.concatenate([scrambled(kept ^ np.uint64(int(K[2]) * (c + k) % (1 << 64))) for k in (1, 2)])


def cells(own: np.ndarray) -> np.ndarray:
    """Where shingles are counted in the sketch."""
    return (own * K[1] >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def keys(own: np.ndarray, part: int = PART, whole: int = WHOLE, steps: np.ndarray | None = None) -> np.ndarray:
    """The keys of a set: of any two linked sets, at least one is shared. With the sketch's ``steps``, its first shingles; else its parts."""
    if steps is not None:
        return first_keys(own, steps, part, whole)
    n = len(own)
    if not n:
        return own
    out = []
    lacks = lambda n: n - -(-n * part // whole)
    if lacks(-(-n * part // whole)) <= FEW:  # it, or a smaller set that it links with, is small
        # the first shingles of two linked sets' intersection are among the first of both
        for run in range(min(RUN, -(-n * part // whole)), min(RUN, n) + 1):
            first = own[choices(min(n, lacks(n) + run), run)]
            out.append(scrambled(first.sum(1) + np.uint64(int(K[2]) * run % (1 << 64))))
    if lacks(n) > FEW:
        sums = np.concatenate([own[:1] * np.uint64(0), np.cumsum(own)])
        c = size_class(n, part, whole)
        for slot in (c, c - 1):
            edges, empty = dealing(slot, part, whole)
            at = np.concatenate([[0], np.searchsorted(own, edges), [n]])
            made = scrambled(sums[at[1:]] - sums[at[:-1]] + np.arange(len(at) - 1, dtype=np.uint64) * K[0] ^ np.uint64(int(K[1]) * slot % (1 << 64)))
            full = at[1:] > at[:-1]
            out.append(made[full] if len(made) - full.sum() <= empty else made)
    return np.unique(np.concatenate(out))


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def range_counts(own: np.ndarray) -> bytes:
    """How many shingles of a set are in each of equal ranges of the hash space, 255 at most: a power of two of them, by its size."""
    bits = max(RANGES.bit_length() - 1, (max(len(own) - 1, 0) // COUNTED).bit_length())
    return np.minimum(np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def may_link(n: int, m: int, one: bytes | None, two: bytes | None, part: int, whole: int) -> bool:
    """If sets of ``n`` and ``m`` shingles with these counts may link; they differ by what their counts differ by at least."""
    if one is None or two is None:
        return True
    a, b = np.frombuffer(one, np.uint8).astype(np.int64), np.frombuffer(two, np.uint8).astype(np.int64)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = np.minimum(a[::2] + a[1::2], 255)
    most = n + m - max(int(np.abs(a - b).sum()), abs(n - m))  # twice the intersection
    return most * (part + whole) >= 2 * part * (n + m)


def set_rows(docs: DataFrame, words: int, counted: bool = False) -> DataFrame:
    """(doc_id, n_shingles, set_id, counts): the size of each row's set, its digest and, if ``counted``, its counts by ranges."""

    def make():
        def rows(cols):
            found = [shingles(t, words) for t in cols["text"]]
            counts = [range_counts(x) if counted and len(x) else None for x in found]
            return {"doc_id": cols["doc_id"], "n_shingles": [len(x) for x in found], "set_id": [digest(x) if len(x) else None for x in found], "counts": counts}

        return rows

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_shingles long, set_id binary, counts binary", binary=("text",))


def frequency_steps(docs: DataFrame, words: int) -> np.ndarray:
    """For each cell of the sketch, twice the logarithm of how many sets hold its shingles: a byte each, whatever the input.

    A task counts up to 255 in a cell, and gives its counts in compressed slices; SUMMED
    tasks' slices are added at once, and then as many sums, LEVELS times.
    """
    size = (1 << CELL_BITS) // SLICES

    def make():
        from pyspark import TaskContext

        counts = np.zeros(1 << CELL_BITS, np.uint8)

        def rows(cols):
            for t in cols["text"]:
                at = cells(shingles(t, words))
                counts[at] += counts[at] < 255
            return {"slice": [], "task": [], "counts": []}

        def close():
            made = [zlib.compress(x.astype(np.uint32).tobytes(), 1) for x in np.split(counts, SLICES)]
            return {"slice": list(range(SLICES)), "task": [TaskContext.get().partitionId()] * SLICES, "counts": made}

        rows.close = close
        return rows

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint64)
        for c in table["counts"]:
            total += np.frombuffer(zlib.decompress(c.as_py()), np.uint32)
        whole = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pa.table({"slice": table["slice"][:1], "task": table["task"][:1], "counts": pa.array([zlib.compress(whole.tobytes(), 1)], pa.binary())})

    schema = "slice int, task int, counts binary"
    now = map_rows(docs.select("text"), make, schema, binary=("text",))
    for _ in range(LEVELS):
        now = now.withColumn("task", F.expr(f"CAST(task DIV {SUMMED} AS INT)")).groupBy("slice", "task").applyInArrow(add, schema)
    total = np.zeros(1 << CELL_BITS, np.uint64)
    for r in now.collect():  # a row for each slice, and more only beyond SUMMED ** LEVELS tasks
        total[r["slice"] * size : (r["slice"] + 1) * size] += np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return np.minimum(2 * np.log2(np.maximum(total, 1)), 63).astype(np.uint8)


def key_rows(docs: DataFrame, words: int, part: int, whole: int, steps) -> DataFrame:
    """(key, node, many): the keys of each set, once in a task, with the first doc_id that has it.

    Where many sets of a batch share a key, its first node stands for the others, and
    each of them has a key with it alone; so a key that any number of documents hold has
    a few rows for each batch at most.  ``steps``: the broadcast sketch, or None, with
    which any two are many.
    """
    few = PAIRED_HERE if steps else 1

    def make():
        seen: set[bytes] = set()

        def rows(cols):
            key, node = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for i, t in zip(cols["doc_id"], cols["text"], strict=True):
                own = shingles(t, words)
                of = digest(own)
                if of in seen:
                    # the same set has given its keys, with a doc_id that equal sets link to
                    continue
                if len(seen) > 1_000_000:  # forgetting only gives some keys again
                    seen.clear()
                seen.add(of)
                key.append(keys(own, part, whole, steps and steps.value))
                node.append(np.full(len(key[-1]), i, np.int64))
            key, node = np.concatenate(key), np.concatenate(node)
            order = np.argsort(key, kind="stable")
            key, node = key[order], node[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
            of = np.cumsum(first) - 1
            many = (np.bincount(of) > few)[of]
            heads = node[first][of]
            pairs = np.unique(np.stack([node[~first & many], heads[~first & many]]), axis=1)
            own = scrambled(pairs[0].view(np.uint64) * K[0] + scrambled(pairs[1].view(np.uint64)))
            kept = first | ~many
            return {"key": np.concatenate([key[kept], own, own]).view(np.int64), "node": np.concatenate([node[kept], *pairs]), "many": np.concatenate([many[kept], np.ones(2 * len(own), bool)])}

        return rows

    return map_rows(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), make, "key long, node long, many boolean", binary=("text",))


def candidate_pairs(rows: DataFrame, known: DataFrame, part: int, whole: int, paired: int = PAIRED) -> DataFrame:
    """(a, b): of the sets of a key, those that may link; each with the first where they are over ``paired``, or many in a batch.

    ``known``: (doc_id, n_shingles, set_id, counts) of the sets.  Documents with several are not tested.
    """
    key = Window.partitionBy("key")
    shared = rows.withColumns({"head": F.min("node").over(key), "last": F.max("node").over(key), "many": F.max("many").over(key), "rows": F.count(F.lit(1)).over(key)}).where("head <> last")
    shared = settle(shared.withColumn("many", F.expr(f"many OR rows > {paired}")).select("key", "node", "head", "many"), "shared", heavy=True)
    few = shared.where("NOT many").groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("nodes")).select("nodes").distinct()
    pair = few.select("nodes", F.posexplode("nodes").alias("i", "a")).select("a", F.explode(F.expr("slice(nodes, i + 2, size(nodes))")).alias("b")).distinct()
    one = known.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.min("n_shingles").alias("n"), F.min("counts").alias("counts"))
    one = settle(one.select("doc_id", "n", F.when(F.col("lo") == F.col("hi"), F.col("counts")).alias("counts")), "counts")
    # the same joins at every size: the pairs grow with the input, so they are never broadcast
    left = pair.hint("merge").join(one.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("of_a")), "a")
    both = left.hint("merge").join(one.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("of_b")), "b")

    def make():
        def rows(cols):
            found = [(a, b) for a, b, *x in zip(*(cols[k] for k in ("a", "b", "n_a", "n_b", "of_a", "of_b")), strict=True) if may_link(*x, part, whole)]
            return {"a": [a for a, _ in found], "b": [b for _, b in found]}

        return rows

    tested = map_rows(both.select("a", "b", "n_a", "n_b", "of_a", "of_b"), make, "a long, b long")
    return tested.union(shared.where("many AND node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))


class Tree:
    """Signature trees over sets, and the links that a dual traversal finds."""

    def __init__(self, sets: list[np.ndarray], part: int = PART, whole: int = WHOLE) -> None:
        self.sets, self.part, self.whole = sets, part, whole
        self.parent = list(range(len(sets)))
        usual = sorted(map(len, sets))[len(sets) // 2] if sets else 1
        self.bits = max(9, min(12, (4 * usual).bit_length()))
        self.maps = [self.bitmap(s) for s in sets]
        self.unlike: set[tuple[int, int]] = set()

    def bitmap(self, s: np.ndarray) -> int:
        b = np.zeros(1 << self.bits, bool)
        b[(s >> np.uint64(64 - self.bits)).astype(np.int64)] = True
        return int.from_bytes(np.packbits(b).tobytes(), "big")

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def build(self, of: list[int]) -> dict | None:
        """A tree of the sets ``of``; those that begin alike are near each other."""
        order = sorted(of, key=lambda i: (*self.sets[i][:3].tolist(), len(self.sets[i])))
        level = [self.node(order[i : i + LEAF], None) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self.node(None, level[i : i + FAN]) for i in range(0, len(level), FAN)]
        return level[0] if level else None

    def node(self, members: list[int] | None, below: list[dict] | None) -> dict:
        parts = [(self.maps[i], self.maps[i], len(self.sets[i]), len(self.sets[i])) for i in members] if members else [(x["any"], x["all"], x["lo"], x["hi"]) for x in below]
        any_, all_ = parts[0][:2]
        for a, b, *_ in parts[1:]:
            any_ |= a
            all_ &= b
        return {"any": any_, "all": all_, "lo": min(p[2] for p in parts), "hi": max(p[3] for p in parts), "members": members, "below": below, "one": None}

    def one(self, x: dict) -> int | None:
        """A member of a node all of whose members are connected already."""
        if x["one"] is None:
            first = [m if x["members"] else self.one(m) for m in x["members"] or x["below"]]
            if None not in first and len({self.find(i) for i in first}) == 1:
                x["one"] = first[0]
        return x["one"]

    def possible(self, a: tuple[int, int, int, int], b: tuple[int, int, int, int]) -> bool:
        """If sets below two nodes, as (any, all, lo, hi), may link."""
        if a[3] * self.whole < b[2] * self.part or b[3] * self.whole < a[2] * self.part:
            return False
        most = min(a[3] - (a[1] & ~b[0]).bit_count(), b[3] - (b[1] & ~a[0]).bit_count())
        return most * (self.part + self.whole) >= self.part * (a[2] + b[2])

    def link(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a == b or (i, j) in self.unlike:
            return
        if self.possible((self.maps[i], self.maps[i], len(self.sets[i]), len(self.sets[i])), (self.maps[j], self.maps[j], len(self.sets[j]), len(self.sets[j]))):
            both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
            if self.whole * both >= self.part * (len(self.sets[i]) + len(self.sets[j]) - both):
                self.parent[max(a, b)] = min(a, b)
            else:
                self.unlike.add((i, j))

    def traverse(self, u: dict | None, v: dict | None) -> None:
        todo = [(u, v)] if u and v else []
        while todo:
            u, v = todo.pop()
            a, b = self.one(u), self.one(v)
            if a is not None and b is not None and self.find(a) == self.find(b):
                continue
            if u is not v and not self.possible((u["any"], u["all"], u["lo"], u["hi"]), (v["any"], v["all"], v["lo"], v["hi"])):
                continue
            if u["members"] and v["members"]:
                for x, i in enumerate(u["members"]):
                    for j in v["members"][x + 1 :] if u is v else v["members"]:
                        self.link(i, j)
            elif u is v:
                below = u["below"]
                todo += [(below[x], below[y]) for x in range(len(below)) for y in range(x + 1, len(below))]
                todo += [(x, x) for x in below]  # first, as the last ones in
            elif u["members"]:
                todo += [(u, x) for x in v["below"]]
            else:
                todo += [(x, v) for x in u["below"]]


def linked(ids: list[int], sets: list[np.ndarray], chunks: list[int] | None = None, part: int = PART, whole: int = WHOLE, steps: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(doc_id, smallest doc_id it is connected to) of sets: all links among them or, with two chunks, those between them.

    Linked sets share a key, so each key's sets are a tree; what an earlier key has
    connected is pruned.
    """
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    side = [chunks[i] for i in order] if chunks else [0] * len(ids)
    low = min(side, default=0)
    one = len(set(side)) < 2
    tree = Tree(sets, part, whole)
    first: dict[bytes, int] = {}
    by: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        # equal sets of both chunks stand for themselves, as each is compared with the other chunk
        at = first.setdefault(s.tobytes(), i)
        tree.parent[i] = at
        if at == i or side[at] != side[i]:
            for k in keys(s, part, whole, steps).tolist():
                by.setdefault(k, []).append(i)
    for own in sorted((x for x in by.values() if len(x) > 1), key=len, reverse=True):
        root = tree.find(own[0])
        if all(tree.find(i) == root for i in own):
            continue
        if one:
            whole_tree = tree.build(own)
            tree.traverse(whole_tree, whole_tree)
        else:
            tree.traverse(tree.build([i for i in own if side[i] == low]), tree.build([i for i in own if side[i] != low]))
    return [(ids[i], ids[r]) for i in range(len(ids)) if (r := tree.find(i)) != i]


def verified(texts: DataFrame, words: int, part: int, whole: int, steps) -> DataFrame:
    """(a, b): the links within each (root, low, high) of rows that lie sorted by it."""

    def make():
        state: dict = {"at": None, "sets": {}}

        def flush(out):
            held = state["sets"]
            if len(held) > 1:
                links = linked([i for i, _ in held], [x for x, _ in held.values()], [c for _, c in held.values()], part, whole, steps and steps.value)
                out["a"] += [a for a, _ in links]
                out["b"] += [b for _, b in links]
            state["sets"] = {}

        def rows(cols):
            out = {"a": [], "b": []}
            for root, low, high, chunk, i, t in zip(*(cols[k] for k in ("root", "low", "high", "chunk", "doc_id", "text")), strict=True):
                if state["at"] != (root, low, high):
                    flush(out)
                    state["at"] = (root, low, high)
                own = shingles(t, words)
                state["sets"].setdefault((i, digest(own)), (own, chunk))
            return out

        def close():
            out = {"a": [], "b": []}
            flush(out)
            return out

        rows.close = close
        return rows

    return map_rows(texts, make, "a long, b long", binary=("text",))


def similar(docs: DataFrame, words: int = WORDS, part: int = PART, whole: int = WHOLE, block: int = BLOCK, shingles_a_chunk: int = CHUNK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of (doc_id, text).

    The texts shuffle once, and only those of candidates shuffle again, a row for
    each distinct set and chunk pair; the widest shuffle beside them is the keys'.
    Every step that a later one reads twice is a written table.
    """
    steps = None if held(part, whole) >= HELD else docs.sparkSession.sparkContext.broadcast(frequency_steps(docs, words))
    sets = settle(set_rows(docs, words, steps is not None), "sets")
    known = sets.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    # written, so that the join is between plain shuffles, which adaptive execution can split
    smallest = settle(known.groupBy("set_id").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("most")).where("b < most").select(F.col("set_id").alias("own"), "b"), "smallest")
    equal = settle(known.join(smallest, F.col("set_id") == F.col("own")).where("doc_id > b").groupBy(F.col("doc_id").alias("a")).agg(F.min("b").alias("b")), "equal")
    # batches have combined their rows, so a key has one for each batch at most
    rows = key_rows(docs, words, part, whole, steps)
    if steps:
        shared = candidate_pairs(rows, known, part, whole)
    else:
        shared = rows.withColumn("head", F.min("node").over(Window.partitionBy("key"))).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    candidates = components(shared)
    sizes = sets.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("i")).agg(F.max("n_shingles").alias("n"))
    # of equal sets the smallest doc_id stands for all; documents with several texts stand for themselves as well
    several = known.groupBy(F.col("doc_id").alias("s")).agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).where("lo <> hi").select("s")
    one = candidates.join(equal, F.col("node") == F.col("a"), "left").join(several, F.col("node") == F.col("s"), "left")
    one = one.select("root", F.explode(F.when(F.col("b").isNull(), F.array("node")).when(F.col("s").isNotNull(), F.array("node", "b")).otherwise(F.array("b"))).alias("node")).distinct()
    blocks = settle(one.join(sizes, F.col("node") == F.col("i")).select("root", "node", "n"), "blocks", heavy=True)
    # large blocks are cut into chunks, and documents meet in each pair of chunks
    chunks = blocks.groupBy(F.col("root").alias("r")).agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / shingles_a_chunk)).cast("int").alias("chunks"), F.count(F.lit(1)).alias("members")).where("members > 1")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = blocks.join(chunks, F.col("root") == F.col("r")).select("root", "node", own.alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select("root", "node", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    # the same join at every size: the candidates grow with the input, so they are never broadcast
    texts = docs.select("doc_id", "text").join(dealt.hint("merge"), F.col("doc_id") == F.col("node")).select("root", "low", "high", "chunk", "doc_id", "text")
    near = verified(texts.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high"), words, part, whole, steps)
    found = components(near.union(equal))
    unsettle(blocks)
    joined = sets.join(found, F.col("doc_id") == F.col("node"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that a smaller doc_id is connected to.

    Of rows with the same doc_id the one with the first text stays; rows with a null doc_id all stay.
    """
    found = settle(similar(docs, words, part, whole), "found")
    gone = spare(docs, "gone")
    least = found.where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    left = docs.join(least.hint("merge"), F.col("doc_id") == F.col(gone), "left_anti")
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        return left
    place = spare(docs, "place")
    one = left.where("doc_id IS NOT NULL").withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(place) == 1).drop(place)
    return one.union(left.where("doc_id IS NULL"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(documents(spark, sf_dir))
