"""Language model scoring by subword lattice likelihood.

The vocabulary is an existing subword vocabulary with its scores; every way to
split a text into its pieces counts.  A text's words are spelled with a leading
space; a word's probability is the sum over all segmentations of the product of
its pieces' probabilities, by a forward recursion in log space, and a text's is
the product over its words and one end.  Bytes are pieces too, so any text can be
split.  The pieces' probabilities start from the vocabulary's scores (ranks, so
weight 1 / (1 + rank)) and are re-estimated by expected counts over all words of
the training texts; the scores stay in as a prior.

Words are counted over all training texts.  The words of highest counts, at most
HEAD of them and of LONG bytes each, are looked up from a broadcast table; others
join by key.

Null and empty texts are an end alone.  Without training texts, base scores are
0 and pieces keep the vocabulary's weights.  Repeated rows are scored each.  A very
long text or word is scored whole.  Empty tables give no rows; columns other than
doc_id, text and held_out are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, settle, tokenizer_path

#: The end of a text, as no word is empty.
STOP = b""
HEAD = 100_000
ROUNDS = 4
#: Training words' worth of the vocabulary's own weights.
PRIOR = 1000.0
#: Longer words go through a recursion of their own, one at a time.
LONG = 48
#: Words whose counts or lattices are held at once.
HELD = 400_000
CHUNK = 4096
#: Words whose scores a Python worker remembers for all of its tasks.
REMEMBERED = 800_000
#: Words whose lattices are summed together.
TOGETHER = 60_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Slots of the table that pieces are looked up in, as a power of two.
SLOT_BITS = 19


class Pieces:
    """The vocabulary: pieces as bytes, a space for a word's begin, with their weights."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weight: dict[bytes, float] = {}
        n = model.get_piece_size()
        for i in range(n):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
                continue
            piece, score = model.id_to_piece(i).replace("▁", " ").encode(), model.get_score(i)
            # as texts are split at white space, pieces hold a space only in front
            if score > -1e8 and b" " not in piece[1:]:
                weight[piece.lower()] = weight.get(piece.lower(), 0.0) + 1 / (1 - score)
        for b in range(256):
            weight.setdefault(bytes([b]), 0.0)
            weight[bytes([b])] += 1 / (1 + n)
        self.pieces = sorted(weight, key=lambda p: (len(p), p))
        self.at = {p: i for i, p in enumerate(self.pieces)}
        total = sum(weight.values())
        self.prior = np.array([weight[p] / total for p in self.pieces])
        self.longest = len(self.pieces[-1])
        self.sizes = sorted({len(p) for p in self.pieces})
        self.hashes = np.empty(len(self.pieces), np.uint64)
        for size in self.sizes:
            own = [i for i, p in enumerate(self.pieces) if len(p) == size]
            self.hashes[own] = hashed(np.array([list(self.pieces[i]) for i in own], np.uint8))[:, -1]
        self.bytes = np.array([self.at[bytes([b])] for b in range(256)])
        # a piece lies in the slot of its hash in the first table where that is free: nearly all in the first, the rest in small ones
        self.slots: list[tuple[np.ndarray, np.uint64]] = []
        left, bits = np.arange(len(self.pieces)), SLOT_BITS
        while len(left):
            shift = np.uint64(64 - bits - 7 * len(self.slots))
            table = np.full(1 << bits, -1, np.int32)
            at = slot(self.hashes[left], shift, table)
            table[at[::-1]] = left[::-1]
            self.slots.append((table, shift))
            left, bits = left[table[at] != left], SLOT_BITS - 6

    def find(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, pieces) of the hashes that are those of pieces."""
        found = []
        for table, shift in self.slots:
            piece = table[slot(s, shift, table)]
            rows = np.flatnonzero(piece >= 0)
            piece = piece[rows]
            same = self.hashes[piece] == s[rows]
            found.append((rows[same], piece[same]))
        if len(found) == 1 or not any(len(rows) for rows, _ in found[1:]):
            return found[0]
        return np.concatenate([r for r, _ in found]), np.concatenate([p for _, p in found])


def slot(h: np.ndarray, shift: np.uint64, table: np.ndarray) -> np.ndarray:
    return (h * SPREAD >> shift & np.uint64(len(table) - 1)).astype(np.int64)


def hashed(x: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of the rows of bytes."""
    out = np.zeros((len(x), x.shape[1] + 1), np.uint64)
    for k in range(x.shape[1]):
        out[:, k + 1] = out[:, k] * BASE + x[:, k] + np.uint64(1)
    return out


def by_length(words: list[bytes]):
    """(places, matrix) of words of equal length, with their leading space, in chunks; longer ones are left out."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) <= LONG:
            groups.setdefault(len(w), []).append(i)
    for n, own in groups.items():
        for at in range(0, len(own), CHUNK):
            part = own[at : at + CHUNK]
            yield np.array(part), np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8).reshape(len(part), n + 1)


def edges(vocabulary: Pieces, x: np.ndarray):
    """(end, starts, rows, pieces) for each place: where the bytes before it, from a start on, are a piece of two or more."""
    h = hashed(x).T
    power = np.array([pow(int(BASE), k, 1 << 64) for k in range(x.shape[1] + 1)], np.uint64)
    longer = np.array(vocabulary.sizes[1:])
    for end in range(1, x.shape[1] + 1):
        start = end - longer[longer <= end]
        at, pieces = vocabulary.find((h[end] - h[start] * power[end - start, None]).ravel())
        yield end, start[at // len(x)], at % len(x), pieces


def log_probabilities(vocabulary: Pieces, logs: np.ndarray, words: list[bytes], counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
    """The log probability of each word over all segmentations.

    With ``counts``, how often pieces are used in expectation is added to ``expected``.
    """
    out = np.zeros(len(words))
    for own, x in by_length(words):
        n = x.shape[1]
        byte = logs[vocabulary.bytes[x]].T  # the way by single bytes is always there, so sums are taken relative to it
        alpha = np.zeros((n + 1, len(x)))
        kept = []
        for end, starts, rows, pieces in edges(vocabulary, x):
            ref = alpha[end - 1] + byte[end - 1]
            alpha[end] = ref + np.log1p(np.bincount(rows, np.exp(alpha[starts, rows] + logs[pieces] - ref[rows]), len(x)))
            kept.append((starts, rows, pieces, np.full(len(rows), end)))
        out[own] = alpha[n]
        if counts is not None:
            starts, rows, pieces, ends = (np.concatenate(v) for v in zip(*kept, strict=True))
            order = np.argsort(starts, kind="stable")
            rows, pieces, ends = rows[order], pieces[order], ends[order]
            first = np.searchsorted(starts[order], np.arange(n + 1))
            beta = np.zeros((n + 1, len(x)))
            weight = counts[own]
            used: list[tuple[np.ndarray, np.ndarray]] = []
            for start in range(n - 1, -1, -1):
                ref = byte[start] + beta[start + 1]
                used.append((vocabulary.bytes[x[:, start]], np.exp(alpha[start] + ref - alpha[n]) * weight))
                r, p, e = (v[first[start] : first[start + 1]] for v in (rows, pieces, ends))
                on = logs[p] + beta[e, r]
                beta[start] = ref + np.log1p(np.bincount(r, np.exp(on - ref[r]), len(x)))
                used.append((p, np.exp(alpha[start, r] + on - alpha[n, r]) * weight[r]))
            expected += np.bincount(*(np.concatenate(v) for v in zip(*used, strict=True)), len(logs))
    for i, w in enumerate(words):
        if len(w) > LONG:
            out[i] = _long(vocabulary, logs, b" " + w, None if counts is None else counts[i], expected)
    return out


def _long(vocabulary: Pieces, logs: np.ndarray, word: bytes, count: float | None, expected: np.ndarray | None) -> float:
    """The same for one word; its time is in proportion to its length."""
    at, longest, n = vocabulary.at, vocabulary.longest, len(word)
    alpha = [0.0] + [-math.inf] * n
    for end in range(1, n + 1):
        terms = [alpha[s] + logs[i] for s in range(max(0, end - longest), end) if (i := at.get(word[s:end])) is not None]
        top = max(terms)
        alpha[end] = top + math.log(sum(math.exp(t - top) for t in terms))
    if count is not None:
        beta = [-math.inf] * n + [0.0]
        for s in range(n - 1, -1, -1):
            found = [(i, logs[i] + beta[e]) for e in range(s + 1, min(n, s + longest) + 1) if (i := at.get(word[s:e])) is not None]
            top = max(t for _, t in found)
            beta[s] = top + math.log(sum(math.exp(t - top) for _, t in found))
            for i, t in found:
                expected[i] += math.exp(alpha[s] + t - alpha[n]) * count
    return alpha[n]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word, and the end, stands in the texts."""

    def make():
        held: Counter = Counter()

        def flush():
            out = {"word": list(held.keys()), "n": list(held.values())}
            held.clear()
            return out

        def rows(cols):
            for t in cols["text"]:
                held.update((t or b"").lower().split())
            held[STOP] += len(cols["text"])
            return flush() if len(held) > HELD else {"word": [], "n": []}

        rows.close = flush
        return rows

    return map_rows(docs.select("text"), make, "word binary, n long", binary=("text",)).groupBy("word").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, vocabulary: Pieces, path: str | None, ends: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces, and of the end, from the counts of all words.

    A round sums a row for each piece from each task: the vocabulary bounds what comes to the driver.
    """
    spark = counts.sparkSession
    stop = 0.5
    p = vocabulary.prior
    for _ in range(rounds):
        logs = spark.sparkContext.broadcast(np.log(p * (1 - stop)))

        def make(logs=logs):
            own = _pieces(path)
            expected = np.zeros(len(own.pieces))
            held: tuple[list, list] = ([], [])  # many words at once, so that there are many of each length

            def add():
                log_probabilities(own, logs.value, held[0], np.array(held[1], float), expected)
                held[0].clear()
                held[1].clear()

            def rows(cols):
                held[0].extend(cols["word"])
                held[1].extend(cols["n"])
                if len(held[0]) >= TOGETHER:
                    add()
                return {"piece": [], "n": []}

            def close():
                add()
                i = np.flatnonzero(expected)
                return {"piece": i.astype(np.int32), "n": expected[i]}

            rows.close = close
            return rows

        found = map_rows(counts.where(F.length("word") > 0), make, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        seen = np.zeros(len(p))
        seen[found["piece"].to_numpy()] = found["n"].to_numpy()
        total = seen.sum()
        p = (seen + PRIOR * vocabulary.prior) / (total + PRIOR)
        stop = (ends + 1) / (total + ends + PRIOR + 1)
    return np.log(p * (1 - stop)), math.log(stop)


_loaded: dict[str, Pieces] = {}
_remembered: dict = {}


def _pieces(path: str | None) -> Pieces:
    """The vocabulary, once in each Python worker."""
    at = tokenizer_path("piece_bpe_32k.model", path)
    if at not in _loaded:
        _loaded[at] = Pieces(at)
    return _loaded[at]


def score(docs: DataFrame, held_out: str = "held_out", path: str | None = None, head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of (doc_id, text, held_out).

    The texts are read twice, to count and to score, and never shuffle.
    """
    spark = docs.sparkSession
    vocabulary = _pieces(path)
    counts = settle(word_counts(docs.where(~F.col(held_out))), "counts")
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    n, v, ends = whole["n"] or 0, whole["v"], whole["ends"] or 0
    logs, stop = fit(counts, vocabulary, path, ends)
    # the least step of counts above which there are at most ``head`` words
    step, short = F.floor(F.log2("n") * 16), F.length("word") <= LONG
    room, least = head, math.inf
    for r in sorted(counts.where(short).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect(), key=lambda r: -r["step"]):
        if (room := room - r["k"]) < 0:
            break
        least = r["step"]
    frequent = counts.where((step >= least) & short).toArrow() if least < math.inf else None
    words = frequent["word"].to_pylist() if frequent else []
    own = log_probabilities(vocabulary, logs, words)
    known = {w: (c, x) for w, c, x in zip(words, frequent["n"].to_pylist() if frequent else [], own.tolist(), strict=True)}
    model = spark.sparkContext.broadcast((logs, known))
    unit = 0.1 * (v + 1)

    def make():
        from pyspark import TaskContext

        logs, known = model.value
        known = {w: (math.log10((c + 0.1) / (n + unit)), x / math.log(10)) for w, (c, x) in known.items()}
        own = _pieces(path)
        if _remembered.get("model") is not model:  # the same object for all of a worker's tasks
            _remembered.update(model=model, lattice={})
        lattice = _remembered["lattice"]
        state = {"row": TaskContext.get().partitionId() << 33}
        at_end = math.log10((ends + 0.1) / (n + unit))

        def rows(cols):
            held_words = [Counter((t or b"").lower().split()) for t in cols["text"]]
            rare = list(set().union(*held_words).difference(known, lattice))
            if len(lattice) + len(rare) > REMEMBERED:
                lattice.clear()
                rare = list(set().union(*held_words).difference(known))
            lattice.update(zip(rare, (log_probabilities(own, logs, rare) / math.log(10)).tolist(), strict=True))
            texts: dict[str, list] = {k: [] for k in ("row", "tokens", "known", "base", "score")}
            later: tuple[list, list, list] = ([], [], [])
            for words in held_words:
                state["row"] += 1
                base, total, seen = at_end, stop / math.log(10), int(ends > 0)
                for w, c in words.items():
                    if (scores := known.get(w)) is not None:
                        base += c * scores[0]
                        total += c * scores[1]
                        seen += c
                    else:
                        total += c * lattice[w]
                        later[0].append(state["row"])
                        later[1].append(w)
                        later[2].append(c)
                for k, x in zip(texts, (state["row"], words.total() + 1, seen, base, total), strict=True):
                    texts[k].append(x)
            # a row for each text, then one for each of its words that joins later
            none, more = [None] * len(held_words), [None] * len(later[0])
            out = {k: v + more for k, v in texts.items()} | {"doc_id": cols["doc_id"] + more, "held_out": cols[held_out] + more, "word": none + later[1], "times": none + later[2]}
            return out | {"row": texts["row"] + later[0]}

        return rows

    found = settle(map_rows(docs.select("doc_id", held_out, "text"), make, "row long, doc_id long, held_out boolean, tokens long, known long, base double, score double, word binary, times long", binary=("text",)), "scored")
    rare = found.where("word IS NOT NULL").select("row", "word", "times")
    others = counts.where((step < least) | ~short) if least < math.inf else counts
    c = F.coalesce("n", F.lit(0))
    joined = rare.join(others.where(F.length("word") > 0).withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    more = joined.groupBy("row").agg(F.sum(F.col("times") * F.log10((c + 0.1) / (n + unit))).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("seen")).withColumnRenamed("row", "_row")
    rows = found.where("word IS NULL").join(more, F.col("row") == F.col("_row"), "left")
    return rows.select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return score(documents(spark, sf_dir).select("doc_id", "text", held.alias("held_out")))
