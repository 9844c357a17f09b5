"""Bloom lookup sketches, compact windows, signature trees."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from made import words
from pyspark.sql import functions as F

from millrace.llm import bloom_lookup, compact_windows, signature_tree


def paragraphs(text):
    return {p for p in re.split(bloom_lookup.PARAGRAPH, text) if p.strip(" ")}


def alike(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def spark_hash(key, more):
    """Spark's xxhash64 of a long and of an int or a text."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    return xxhash.xxh64_intdigest(more.encode() if isinstance(more, str) else struct.pack("<i", more), first)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def peel(sketch, size, seed):
    """The digests of a sketch, {cell: [count, digests, checks]}, by count: {digest: 1 or -1}."""
    sketch, out = {k: list(v) for k, v in sketch.items()}, {}
    todo = list(sketch)
    while todo:
        c, k, h = sketch.get(at := todo.pop(), (0, 0, 0))
        if abs(c) != 1 or spark_hash(signed(k), "check") & 0xFFFFFFFF != h:
            continue
        out[k] = c
        for t in range(3):
            x = sketch.setdefault(cell(signed(k), t, size, seed), [0, 0, 0])
            x[0], x[1], x[2] = x[0] - c, x[1] ^ k, x[2] ^ h
            todo.append(cell(signed(k), t, size, seed))
    assert not any(map(any, sketch.values())), "cells are left"
    return out


def cell(key, table, size, seed):
    return 3 * (signed(spark_hash(key, 3 * seed + table)) % size) + table


def read_print(text):
    """(cells of a table, seed, {cell: [count, digests, checks]}) of a fingerprint."""
    shape, *cells = text.split(";")
    size, seed = map(int, shape.split("."))
    parts = [c.split(".") for c in cells if c]
    return size, seed, {int(a): [int(c), int(k, 16), int(h, 16)] for a, c, k, h in parts}


def sketched(keys, size, seed):
    out = defaultdict(lambda: [0, 0, 0])
    for k in keys:
        for t in range(3):
            x = out[cell(signed(k), t, size, seed)]
            x[0], x[1], x[2] = x[0] + 1, x[1] ^ k, x[2] ^ spark_hash(signed(k), "check") & 0xFFFFFFFF
    return out


def likeness_of(one, two):
    """The likeness of two fingerprints from these alone: peeled, sketched at one size, subtracted and peeled."""
    a, b = (peel(s, size, seed) for size, seed, s in map(read_print, (one, two)))
    size, seed = 2 * (len(a) + len(b)) + 16, 0
    while True:
        left, right = sketched(a, size, seed), sketched(b, size, seed)
        try:
            rest = peel({k: [left[k][0] - right[k][0], left[k][1] ^ right[k][1], left[k][2] ^ right[k][2]] for k in {*left, *right}}, size, seed)
            break
        except AssertionError:
            size, seed = 2 * size, seed + 1
    shared = len(a) - sum(c > 0 for c in rest.values())
    return shared / (len(a) + len(b) - shared) if a or b else 1.0


def check_fingerprints(got, rows):
    """``rows``: (doc_id, text) by descending doc_id."""
    prints = defaultdict(set)
    for k, (i, text) in enumerate(rows):
        j, after = rows[(k + 1) % len(rows)]
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        r = got[i]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(paragraphs(text), paragraphs(edited)))
        assert r["near_next"] == pytest.approx(alike(paragraphs(text), paragraphs(after)))
        if n < 30_000:  # plain peeling is slow
            assert r["near_edited"] == pytest.approx(likeness_of(r["fingerprint"], r["edited_fingerprint"]))
            assert r["near_next"] == pytest.approx(likeness_of(r["fingerprint"], got[j]["fingerprint"]))
        prints[text].add(r["fingerprint"])
        prints[edited].add(r["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


@pytest.mark.parametrize(("run", "fan"), [(2000, 1000), (7, 1000), (3, 3)])
def test_fingerprints_of_a_table(spark, table, monkeypatch, run, fan):
    """The runs of rows and the bounds of their numbers make no difference."""
    monkeypatch.setattr(bloom_lookup, "RUN_ROWS", run)
    monkeypatch.setattr(bloom_lookup, "FAN", fan)
    at, rows = table
    got = {r["doc_id"]: r for r in bloom_lookup.op4_bloom_lookup(spark, at).collect()}
    check_fingerprints(got, [(i, t or "") for i, t, *_ in reversed(rows)])


def test_sketches_are_tried_again(spark, monkeypatch):
    """With one cell a table nothing peels at first; each attempt doubles the size."""
    monkeypatch.setattr(bloom_lookup, "LEAST", 1)
    monkeypatch.setattr(bloom_lookup, "LOAD", 0.05)
    monkeypatch.setattr(bloom_lookup, "ROUNDS", 2)
    rows = [(i, list(range(i * 10, i * 10 + 3 + i)), list(range(i * 10 + 2, i * 10 + 4))) for i in range(12)]
    df = spark.createDataFrame(rows, "row long, a array<long>, b array<long>")
    got = {r["row"]: r for r in bloom_lookup.peeled(df, [("a", "b")], 2).collect()}
    assert {i: r["added_0"] for i, r in got.items()} == {i: len(set(a) - set(b)) for i, a, b in rows} and max(r["seed_0"] for r in got.values()) > 1


def test_fingerprint_edges(spark, docs, empty):
    got = bloom_lookup.fingerprints(docs).collect()
    assert len(got) == docs.count()
    assert bloom_lookup.fingerprints(empty).count() == 0
    one = bloom_lookup.fingerprints(spark.createDataFrame([(7, "ab. cd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"ab.ab.").hexdigest() and one["near_next"] == 1.0
    none = spark.createDataFrame([(None, "a b"), (3, None), (3, "c"), (3, "c")], "doc_id long, text string")
    assert sorted(r["n_chars"] for r in bloom_lookup.fingerprints(none).collect()) == [0, 1, 1, 3]


def test_no_python_in_fingerprints(spark, table):
    plan = bloom_lookup.fingerprints(spark.read.parquet(f"{table[0]}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


@pytest.mark.parametrize("seed", range(4))
def test_compact_windows_hold_every_subsequence(seed):
    """Each subsequence of at least the least width is in the one window whose centre is its first smallest value."""
    values = np.random.default_rng(seed).integers(0, 30, 60).astype(np.uint64) << np.uint64(40)
    made = {c: (a, b) for a, c, b in zip(*(x.tolist() for x in compact_windows.compact_windows(values, 8)), strict=True)}
    for i in range(60):
        for j in range(i + 7, 60):
            c = i + int(values[i : j + 1].argmin())
            assert made[c][0] <= i and j <= made[c][1]
    for c, (i, j) in made.items():
        assert j - i >= 7 and c == i + int(values[i : j + 1].argmin())
        assert (not i or values[i - 1] <= values[c]) and (j == 59 or values[j + 1] < values[c])


def plain_repeats(texts, n):
    """Starts of each document's runs of ``n`` words that stand in another document."""
    by = defaultdict(set)
    own = {i: (t or "").encode().lower().split() for i, t in texts}
    for i, w in own.items():
        for k in range(len(w) - n + 1):
            by[tuple(w[k : k + n])].add(i)
    return {i: {k for k in range(len(w) - n + 1) if len(by[tuple(w[k : k + n])]) > 1} for i, w in own.items()}


def test_planted_passages(spark):
    """Passages of over 50 words in many documents are found in each, to the word, and nothing else is."""
    pick = random.Random(0)
    passages = [words(51 + k, 1000 + k) for k in range(12)]
    texts, planted = [], {}
    for i in range(120):
        first = words(pick.randrange(0, 90), i)
        parts = [first]
        if i % 3:
            parts += [passages[i % 12], words(pick.randrange(0, 90), 500 + i)]
            planted[i] = (len(first.split()), len(first.split()) + 51 + i % 12)
        texts.append((i, " ".join(parts)))
    got = compact_windows.repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(7)).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in got} == {(i, *p) for i, p in planted.items()}
    assert all(r["other_doc_id"] != r["doc_id"] and r["other_doc_id"] % 12 == r["doc_id"] % 12 for r in got)


@pytest.mark.parametrize("every", [20, 30])
def test_near_passages_are_recalled(spark, every):
    """Passages of 150 words with one word in so many changed: at least 0.9 of those that have 0.8 of their shingles in common, by brute force, are found."""
    pick = random.Random(every)
    texts, near = [], set()
    for g in range(150):
        own = words(150, 7000 + g).split()
        other = [w if pick.randrange(every) else f"new{pick.randrange(10**6)}" for w in own]
        a, b = ({tuple(x[k : k + 5]) for k in range(146)} for x in (own, other))
        if alike(a, b) >= 0.8:
            near |= {2 * g, 2 * g + 1}
        texts += [(2 * g + k, " ".join([words(pick.randrange(200), 20_000 + 2 * g + k), *x, words(pick.randrange(200), 30_000 + 2 * g + k)])) for k, x in enumerate((own, other))]
    pick.shuffle(texts)
    got = {r["doc_id"] for r in compact_windows.repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert len(near) >= 20 and len(near & got) >= 0.9 * len(near)


def test_long_texts_of_one_word():
    """A repeated word gives one interval a hash function, in time in proportion to the text."""
    import time

    own = compact_windows.tokens(compact_windows.word_hashes([b"spam"] * 1_000_000))
    began = time.perf_counter()
    signature, low, high = compact_windows.text_windows(own, 46, compact_windows.HASHES)
    assert len(signature) == compact_windows.HASHES and set(low) == {0} and set(high) == {len(own) - 1}
    assert compact_windows.passages(own, own) == [(0, 1_000_000, 0, 1_000_000)]
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize(("n", "changed"), [(80, [40]), (60, [30]), (100, [33, 66]), (50, [24]), (51, [1])])
def test_edited_passages(spark, n, changed):
    """Passages with changed words are found whole if their Jaccard, by brute force, is at least 0.8."""
    first = words(n, 3000 + n).split()
    second = [f"new{k}" if k in changed else w for k, w in enumerate(first)]
    a, b = ({tuple(x[k : k + 5]) for k in range(n - 4)} for x in (first, second))
    assert alike(a, b) >= 0.8
    texts = [(i, " ".join([words(70, 4000 + i), *x, words(70, 5000 + i)])) for i, x in enumerate(([" ".join(first)], [" ".join(second)], []))]
    got = {(r["doc_id"], r["start_word"], r["end_word"], r["other_doc_id"]) for r in compact_windows.repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    start = 70 + (2 if changed == [1] else 0)
    assert got == {(0, start, 70 + n, 1), (1, start, 70 + n, 0)}


def test_dissimilar_passages_are_no_repeats(spark):
    """A 50-word passage with two changed words far apart shares runs, but not 0.8 of its shingles."""
    first = words(50, 1).split()
    second = [f"new{k}" if k in (16, 33) else w for k, w in enumerate(first)]
    texts = [(i, " ".join([words(60, 10 + i), *x, words(60, 20 + i)])) for i, x in enumerate((first, second))]
    assert compact_windows.repeats(spark.createDataFrame(texts, "doc_id long, text string")).count() == 0


def likest(a, b):
    """Least and highest word of each passage of ``a`` with a mate in ``b``, from all pairs of spans of 50 words and their sets of shingles."""
    one, two = ([tuple(x[k : k + 5]) for k in range(len(x) - 4)] for x in (a, b))
    common = set(one) & set(two)
    out = set()
    for i in range(len(one) - 45):
        own = set(one[i : i + 46])
        if 10 * len(own & common) >= 8 * len(own):
            for j in range(len(two) - 45):
                if alike(own, set(two[j : j + 46])) >= 0.8:
                    out |= {i + k for k, g in enumerate(one[i : i + 46]) if g in common}
                    break
    return out


def test_every_near_passage_of_a_table(spark, table):
    """Each shared shingle of each 50-word passage with a near-duplicate, by brute force, is in a row's span, and each row's span is near one of its partner's."""
    at, rows = table
    own = {i: (t or "").encode().lower().split() for i, t, *_ in rows if len((t or "").split()) < 700}
    got = compact_windows.repeats(spark.read.parquet(f"{at}/documents.parquet").where(F.col("doc_id").isin(*own))).collect()
    by = defaultdict(set)
    for i, w in own.items():
        for k in range(len(w) - 4):
            by[tuple(w[k : k + 5])].add(i)
    both = defaultdict(int)
    for ids in by.values():
        for i in ids:
            for j in ids - {i}:
                both[i, j] += 1
    covered = defaultdict(set)
    for r in got:
        covered[r["doc_id"]] |= set(range(r["start_word"], r["end_word"] - 4))
        assert both[r["doc_id"], r["other_doc_id"]] >= 37
    for (i, j), n in both.items():
        if n >= 37:
            assert likest(own[i], own[j]) <= covered[i], (i, j)


def test_each_partner_has_its_row(spark):
    """Overlapping passages shared with different documents stay apart."""
    own = words(200, 61).split()
    texts = [(1, [*own[:100], *words(60, 62).split()]), (5, own), (9, [*words(60, 63).split(), *own[60:]])]
    got = {tuple(r) for r in compact_windows.repeats(spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")).collect() if r["doc_id"] == 5}
    assert got == {(5, 0, 100, 1), (5, 60, 200, 9)}


def test_repeated_runs_are_covered_whole(spark, table):
    """Every word of a run of 51 words that repeats verbatim is in a row's span."""
    rows = [(i, t) for i, t, *_ in table[1]]
    rows += [(100_000 + i, " ".join([words(70, 70 + i), words(51, 69), words(70, 80 + i)])) for i in range(2)]
    covered = defaultdict(set)
    for r in compact_windows.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        covered[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    for i, starts in plain_repeats(rows, 51).items():
        assert all(set(range(k, k + 51)) <= covered[i] for k in starts), i


def test_repeat_edges(docs, empty):
    got = compact_windows.repeats(docs).collect()
    assert {1, 2, 3, -5, 9, 10} == {r["doc_id"] for r in got}
    assert compact_windows.repeats(empty).count() == 0


def plain_sets(texts, n):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def plain_components(sets, part, whole=100):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            by[g].add(i)
    for i, s in sets.items():
        for j in set().union(*(by[g] for g in s)) if s else ():
            both = len(s & sets[j])
            if i < j and whole * both >= part * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_join_of_a_table(spark):
    at = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in signature_tree.op10_jaccard_join(spark, at).collect()}
    sets = plain_sets(texts, 3)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(sets, 90)


def edited(text, changes, pick):
    w = text.split()
    for _ in range(changes if w else 0):
        k = pick.randrange(len(w))
        w[k : k + pick.randrange(2)] = [f"new{pick.randrange(9999)}"] * pick.randrange(3)
        w = w or ["left"]
    return " ".join(w)


@pytest.mark.parametrize(("part", "n", "block"), [(80, 5, 1500), (90, 3, 5), (50, 2, 1500)])
def test_join_near_the_threshold(spark, part, n, block):
    """Groups of edited copies with likenesses on both sides of the threshold, small sets and chunked blocks."""
    pick = random.Random(part)
    texts = []
    for g in range(14):
        first = words(pick.choice([1, 2, 4, 9, 12, 30, 60, 150]), g)
        texts += [first] + [edited(first, pick.randrange(0, 6), pick) for _ in range(8)] + [first] * (g % 3)
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    got = {r["doc_id"]: r["component_id"] for r in signature_tree.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n, part, 100, block).collect()}
    assert got == plain_components(plain_sets(rows, n), part)


@pytest.mark.parametrize("ordered", [False, True])
@pytest.mark.parametrize("part", [50, 80, 90, 95])
def test_linked_sets_share_a_key(part, ordered):
    pick = np.random.default_rng(part)
    steps = pick.integers(0, 64, 1 << signature_tree.CELL_BITS).astype(np.uint8) if ordered else None
    for size in [*range(1, 60), 200, 700]:
        a = np.unique(pick.integers(0, 1 << 64, size, np.uint64))
        for gone in range(0, size + 1):
            for new in range(0, size + 1, max(1, size // 7)):
                if 100 * (size - gone) < part * (size + new) or not gone + new:
                    continue
                b = np.unique(np.concatenate([pick.permutation(a)[gone:], pick.integers(0, 1 << 64, new, np.uint64)]))
                assert np.intersect1d(signature_tree.keys(a, part, 100, steps), signature_tree.keys(b, part, 100, steps)).size


@pytest.mark.parametrize("part", [50, 80])
def test_counts_by_ranges_lose_no_link(part):
    """Linked sets may link by their counts, of one or of two numbers of ranges; most unlike ones that share a shingle may not."""
    pick = np.random.default_rng(part)
    unlike = 0
    for size in [*range(1, 60), 250, 256, 257, 300, 5000]:
        a = np.unique(pick.integers(0, 1 << 64, size, np.uint64))
        may = lambda b: signature_tree.may_link(len(a), len(b), signature_tree.range_counts(a), signature_tree.range_counts(b), part, 100)  # noqa: B023, E731
        for gone in range(0, size + 1, max(1, size // 50)):
            for new in range(0, size + 1, max(1, size // 7)):
                b = np.unique(np.concatenate([pick.permutation(a)[gone:], pick.integers(0, 1 << 64, new, np.uint64)]))
                if len(b) and 100 * (size - gone) >= part * (size + new):
                    assert may(b)
        unlike += may(np.unique(np.concatenate([a[:1], pick.integers(0, 1 << 64, size, np.uint64)])))
    assert unlike <= 12
    crowded = np.arange(1000, dtype=np.uint64)  # more than 255 in a range
    assert signature_tree.may_link(1000, 900, signature_tree.range_counts(crowded), signature_tree.range_counts(crowded[:900]), part, 100)


def test_unlike_documents_are_not_chained_into_a_block(spark, monkeypatch):
    """Documents of passages that each stand in one other document, too: all of their shingles are shared, and none of them link."""
    n, shifts = 120, (1, 5, 11, 17, 31)
    shared = lambda i, s: words(30, f"{i % n} {s}")
    texts = [" ".join(shared(k, s) for s in shifts for k in (i, i - s)) for i in range(n)]
    texts += [texts[0] + " and more", texts[3] + " or less"]
    blocks, settle = [], signature_tree.settle

    def kept(df, name, heavy=False):
        out = settle(df, name, heavy)
        if name == "blocks":
            blocks.extend(r["m"] for r in out.groupBy("root").agg(F.count(F.lit(1)).alias("m")).collect())
        return out

    monkeypatch.setattr(signature_tree, "settle", kept)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in signature_tree.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80, 100).collect()}
    assert got == plain_components(plain_sets(rows, 5), 80) and got[n] == 0 and got[n + 1] == 3
    assert max(blocks) < 10


def test_frequencies_are_summed_in_a_tree(spark, monkeypatch):
    """However many tasks count and however few are summed at once."""
    df = spark.createDataFrame([(i, f"common words here {i}") for i in range(200)], "doc_id long, text string")
    one = signature_tree.frequency_steps(df.coalesce(1), 3)
    monkeypatch.setattr(signature_tree, "SUMMED", 2)
    assert (signature_tree.frequency_steps(df.repartition(9), 3) == one).all() and one.max() == int(2 * np.log2(200))


def test_join_edges(docs, empty):
    got = [tuple(r) for r in signature_tree.similar(docs).collect()]
    at = {i: (n, c) for i, n, c in got}
    assert len(got) == docs.count() and at[1][1] == at[2][1] == at[3][1] == at[-5][1] == -5 and at[None][1] is None
    assert [at[i] for i in (4, 5, 6, 7, 8)] == [(0, 4), (0, 5), (0, 6), (1, 7), (1, 8)] and at[13] == (198, 13)
    assert signature_tree.similar(empty).count() == 0
    kept = signature_tree.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-5, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16] and ids.count(None) == 1
    assert signature_tree.one_of_each(empty).count() == 0
