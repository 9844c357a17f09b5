"""Sharding, mixing, packing."""

from __future__ import annotations

import heapq
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from test_text_matching import signed

from millrace.llm import mixing, packing, sharding
from millrace.llm.common import tokenizer_path


def test_shards_of_a_table(spark, table):
    at, rows = table
    got = {r["doc_id"]: r for r in sharding.op2_sharding(spark, at).collect()}
    assert len(got) == len(rows)
    sums, slots = defaultdict(int), defaultdict(list)
    for i, text, *_ in rows:
        r, raw = got[i], (text or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sums) <= set(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest = max(r["size"] for r in got.values())
    assert max(sums.values()) - min(sums[k] if k in sums else 0 for k in range(24)) <= 2 * largest


def test_shards_near_equal_with_a_hot_source(spark):
    pick = random.Random(1)
    rows = [(i, "x" * pick.randrange(1, 200), "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 7}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sums = [r[0] for r in sharding.shard(df, 24).groupBy("shard").agg({"size": "sum"}).select("sum(size)").collect()]
    assert len(sums) == 24 and max(sums) / min(sums) < 1.05
    assert sharding.shard(df, target_bytes=200_000).select("shard").distinct().count() == -(-sum(sums) // 200_000)
    again = sharding.shard(df.repartition(5), 24).select("doc_id", "shard", "slot")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sharding.shard(df, 24).select("doc_id", "shard", "slot").collect()))


def plain_tree(rows, shards, first=0):
    """{row: shard} of (row, size, keys): by recursion, each split at the weighted median of the widest dimension."""
    if shards == 1 or not rows:
        return {r[0]: first for r in rows}
    width = lambda d: (max(r[2][d] for r in rows) >> sharding.TIE) - (min(r[2][d] for r in rows) >> sharding.TIE)
    dim = max(range(3), key=lambda d: (width(d), -d))
    whole = sum(r[1] for r in rows)
    goal, under = whole * (shards // 2) / shards, 0
    groups = defaultdict(list)
    for r in rows:
        groups[r[2][dim] >> sharding.ROW].append(r)
    order = [groups[k] for k in sorted(groups)]
    parts = []
    for g in order:
        # equal texts of too many bytes are split row by row, others are never
        if sum(r[1] for r in g) > sharding.WHOLE_GROUP * whole / shards and len({r[2][dim] for r in g}) > 1:
            by = defaultdict(list)
            for r in g:
                by[r[2][dim]].append(r)
            parts.append([by[k] for k in sorted(by)])
        else:
            parts.append([g])
    flat = [x for p in parts for x in p]
    low = 0
    for k, x in enumerate(flat):
        n = sum(r[1] for r in x)
        if under + n >= goal or k == len(flat) - 1:
            low = k + (goal - under > n / 2)
            break
        under += n
    below, above = ([r for x in xs for r in x] for xs in (flat[:low], flat[low:]))
    return plain_tree(below, shards // 2, first) | plain_tree(above, shards - shards // 2, first + shards // 2)


@pytest.mark.parametrize(("most", "shards"), [(1024, 24), (4, 24), (2, 40)])
def test_shards_equal_the_plain_tree(spark, table, monkeypatch, most, shards):
    """In one tree, and in groups that are sharded on."""
    monkeypatch.setattr(sharding, "MOST", most)
    at, rows = table
    docs = spark.read.parquet(f"{at}/documents.parquet")
    keyed = [(r["doc_id"], r["size"], (r["k0"], r["k1"], r["k2"])) for r in sharding._keyed(docs).collect()]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards).collect()}
    assert got == plain_tree(keyed, shards)
    texts = defaultdict(set)
    sums = defaultdict(int)
    for i, t, *_ in rows:
        texts[t or ""].add(got[i])
        sums[t or ""] += len((t or "").encode()) + 8
    whole = sum(sums.values())
    assert all(len(x) == 1 for t, x in texts.items() if sums[t] < sharding.WHOLE_GROUP * whole / shards / 2)


def test_shard_edges(docs, empty):
    got = sharding.shard(docs, 24, rows_a_task=1).collect()
    assert len(got) == docs.count() and next(r for r in got if r["doc_id"] == 4)["size"] == 8
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.shard(empty, 24).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_sainte_lague_equals_the_plain_one(seed):
    pick = random.Random(seed)
    votes = [pick.choice([0, 1, 5, 5, 90.5, 1000]) for _ in range(9)] if seed % 2 else [pick.random() * 100 for _ in range(9)]
    seats, caps = pick.randrange(60), [pick.randrange(40) for _ in votes]
    for limit in (None, caps):
        given = [0] * 9
        queue = [(-v, i) for i, v in enumerate(votes) if v > 0 and (limit is None or limit[i] > 0)]
        heapq.heapify(queue)
        for _ in range(seats):
            if not queue:
                break
            _, i = heapq.heappop(queue)
            given[i] += 1
            if limit is None or given[i] < limit[i]:
                heapq.heappush(queue, (-votes[i] / (2 * given[i] + 1), i))
        if len(set(votes)) == len(votes):
            assert mixing.sainte_lague(votes, seats, limit) == given
        assert sum(mixing.sainte_lague(votes, seats, limit)) == sum(given)


def plain_targets(sizes, weights=(5, 2, 1), times=3):
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        whole = sum(weights[i % len(weights)] for i in open_)
        over = [i for i in sorted(open_) if left * weights[i % len(weights)] / whole > times * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i % len(weights)] / whole
            break
        for i in over:
            out[i] = float(times * sizes[i])
        open_ -= set(over)
        left = float(sum(sizes)) - sum(out)
    return out


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 99], [0, 0], [7], [3, 900, 2, 1, 0, 50, 10_000, 20]])
def test_targets_stop_and_share_again(spark, sizes, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 3)
    rows = [(i, "w " * n, f"s{i:02}" if i + 1 < len(sizes) else None) for i, n in enumerate(sizes)]
    got = {r["doc_id"]: r["target"] for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=4).collect()}
    assert [got[i] for i in range(len(sizes))] == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("seed", range(4))
def test_quotas_of_sources_equal_the_plain_ones(spark, seed):
    pick = random.Random(seed)
    votes = [(i, float(pick.choice([0, 1, 5, 5, 90.5, 1000])), pick.randrange(40)) for i in range(60)]
    seats = pick.randrange(600)
    got = {r["i"]: r["quota"] for r in mixing.quotas(spark.createDataFrame(votes, "i long, target double, most long").repartition(3), seats).collect()}
    given = [0] * len(votes)
    queue = [(-v, i) for i, v, most in votes if v > 0 and most]
    heapq.heapify(queue)
    for _ in range(seats):
        if queue:
            _, i = heapq.heappop(queue)
            given[i] += 1
            if given[i] < votes[i][2]:
                heapq.heappush(queue, (-votes[i][1] / (2 * given[i] + 1), i))
    assert [got[i] for i in range(len(votes))] == given


def plain_mix(rows, block=64, seed=8):
    """{doc_id: words taken}: whole tables in lists, by the same seeded order and plan of a source's shards."""
    sizes = {i: len((t or "").encode().split()) for i, t, _ in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    own = [[i for i, _, s in rows if s == name] for name in names]
    sums = [sum(sizes[i] for i in ids) for ids in own]
    part = max(mixing.LEAST_SHARD, sum(sums) // mixing.MAX_SHARDS)
    place = lambda i, first: signed(xxhash.xxh64_intdigest(struct.pack("<q", i), xxhash.xxh64_intdigest(struct.pack("<i", first), 42)))
    dealt = []
    for ids, n in zip(own, sums, strict=True):
        parts = max(1, -(-n // part))
        shards = defaultdict(list)
        for i in ids:
            shards[place(i, seed) % parts].append(i)
        dealt.append(shards)
    most = [3 * sum(-(-sum(sizes[i] for i in ids) // block) for ids in shards.values()) for shards in dealt]
    goal = plain_targets(sums)
    seats = mixing.sainte_lague(goal, round(sum(sums) / block), most)
    taken = {}
    for at, (shards, quota) in enumerate(zip(dealt, seats, strict=True)):
        keys = sorted(shards)
        for k, n, full, extra, a, c in mixing.shape([(k, sum(sizes[i] for i in shards[k])) for k in keys], quota, block, seed, at):
            word = 0
            for i in sorted(shards[k], key=lambda i: (place(i, seed + 1), i)):
                taken[i] = sum(full + ((w // block * a + c) % n < extra) for w in range(word, word + sizes[i]))
                word += sizes[i]
    return {i: taken.get(i, 0) for i, *_ in rows}, dict(zip(names, goal, strict=True))


@pytest.mark.parametrize("least", [1 << 16, 2000])
def test_words_taken_equal_the_plain_ones(spark, table, monkeypatch, least):
    monkeypatch.setattr(mixing, "LEAST_SHARD", least)
    at, rows = table
    got = {r["doc_id"]: r for r in mixing.op8_mixing(spark, at).collect()}
    taken, goal = plain_mix([(i, t, s) for i, t, _, s in rows])
    assert {i: r["taken"] for i, r in got.items()} == taken
    assert all(got[i]["target"] == pytest.approx(goal[s]) for i, _, _, s in rows)


def test_mix_of_a_table(spark):
    at = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{at}/documents.parquet")
    got = {r["doc_id"]: r for r in mixing.op8_mixing(spark, at).collect()}
    rows = df.select("doc_id", "text", "source").collect()
    assert len(got) == len(rows)
    sums, took = defaultdict(int), defaultdict(int)
    for r in rows:
        n = len((r["text"] or "").encode().split())
        assert got[r["doc_id"]]["size"] == n and 0 <= got[r["doc_id"]]["taken"] <= 3 * n
        sums[r["source"]] += n
        took[r["source"]] += got[r["doc_id"]]["taken"]
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    goals = dict(zip(names, plain_targets([sums[s] for s in names]), strict=True))
    for r in rows:
        assert got[r["doc_id"]]["source_size"] == sums[r["source"]] and got[r["doc_id"]]["target"] == pytest.approx(goals[r["source"]])
    assert all(took[s] == pytest.approx(goals[s], rel=0.01) for s in names)
    assert {i: r["taken"] for i, r in got.items()} == {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(7)).collect()}


def test_mixed_documents_hold_what_was_taken(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect()}
    made = defaultdict(int)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    for r in out.collect():
        made[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    assert {i: n for i, n in taken.items() if n} == dict(made)


def test_many_shards_and_edges(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_SHARD", 1000)
    rows = [(i, "w " * (i % 40), f"s{i % 3}" if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, block=16).collect()
    took, goal = defaultdict(int), {}
    for r in got:
        took[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(took[s] == pytest.approx(goal[s], rel=0.05) for s in goal)
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert got[4]["size"] == got[4]["taken"] == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def check_packs(got, docs, capacity=4096):
    """Every id in one piece, gapless offsets, nothing over the capacity; the share of the windows that is filled."""
    whole = packing.Words(tokenizer_path("word_bpe_49k.json"))
    want = defaultdict(int)
    for i, text in docs:
        want[i, whole.whole((text or "").encode()) + np.array([2], "<u4").tobytes()] += 1
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for (i, ids), times in want.items():
        own = [r for r in pieces[i] if r["doc_tokens"] == len(ids) // 4]
        assert sum(r["length"] for r in own) >= times * len(ids) // 4
        for r in own:
            if times == 1:
                assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])])
        assert sorted({r["start"] for r in own})[0] == 0
    assert sum(r["length"] for r in got) == sum(len(ids) // 4 * k for (_, ids), k in want.items())
    return sum(r["length"] for r in got) / (capacity * len(windows))


def test_packing_of_a_table(spark, table):
    at, rows = table
    assert check_packs(packing.op6_packing(spark, at).collect(), [(i, t) for i, t, *_ in rows]) > 0.95


@pytest.mark.parametrize("parts", [2, 211])
def test_windows_are_full_however_the_table_is_split(spark, parts):
    """The same windows at any number of partitions, nearly full, and no document torn that fits a window."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
    got = packing.pack(docs).collect()
    assert sum(r["length"] for r in got) >= 0.98 * 4096 * len({r["sequence_id"] for r in got})
    assert all(r["length"] == r["doc_tokens"] for r in got if r["doc_tokens"] <= 4096)
    assert hash(tuple(sorted(map(tuple, got)))) == hash(tuple(sorted(map(tuple, packing.pack(docs.repartition(5)).collect()))))


def test_documents_of_over_half_a_window_are_cut(spark):
    rows = [(i, "word " * 2500) for i in range(200)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert check_packs(got, rows) > 0.97


def test_packing_edges(docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_packs(packing.pack(docs).collect(), rows)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_differencing(seed):
    pick = random.Random(seed)
    lengths = [pick.randrange(1, 600) for _ in range(pick.randrange(1, 80))]
    made = packing.windows(lengths, 600)
    assert sorted(i for own in made for i in own) == list(range(len(lengths))) and all(sum(lengths[i] for i in own) <= 600 for own in made)
    many = [pick.randrange(1, 50) for _ in range(200)]
    sums = [sum(many[i] for i in own) for own in packing.differencing(many, 8)]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2


@pytest.mark.parametrize("text", ["", "<|endoftext|> a", "<|ENDOFTEXT|>", "K İ Iİ don't DON'T x\u0085y\x1cz", "a.. .b é., É; ſſ ŉ× ß ẞ Ÿ Ĳ", "don's. 't 12. á. ́a", "日本語。 word, WORD! ǅ"])
def test_words_are_what_the_tokenizer_gives(text):
    words = packing.Words(tokenizer_path("word_bpe_49k.json"))
    for _ in range(2):
        assert words.ids([text.encode(), b"word. word"])[0] == words.whole(text.encode())
