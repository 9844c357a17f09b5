"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenised, and those of over a window are cut after each whole window;
what is left, a whole document or a long one's end, is a piece.  All pieces of
the table are dealt by hash into groups of about GROUP windows, and a group is
divided into as many near-equal windows as its tokens need; the number of windows
rises by one as long as any is over the capacity.  Differencing starts with each
piece as a partial division (itself and empty windows), and always merges the two
with the largest imbalance, the largest window of one with the smallest of the other.
A group whose windows would be less than FILL full, as documents of somewhat over
half a window are, has its longest pieces cut into chunks of CHUNK ids.

Texts are read once and never shuffle; what does is a narrow row for each piece, by
hash, so no key can be hot, and the result is the same however the table is split.

Null and empty texts are a piece of one id, the end.  A text of any length is cut
into windows and one piece.  Pieces of equal length go by doc_id, place and checksum,
and repeated rows are packed each; equal ones may swap places.  Empty tables give
no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
import math
import string
import sys
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, settle, tokenizer_path

CAPACITY = 4096
END = 2
#: Windows that are divided together, and how full they should be.
GROUP = 256
FILL = 0.97
#: Ids of a chunk that a piece may be cut into.
CHUNK = 512
#: Words whose ids are kept, in each Python worker for all of its tasks.
WORDS = 900_000

OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are packed on machines with little-endian 32-bit integers")


#: ASCII marks; a run of them after a word's letters is a run of its own to the tokenizer.
MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: Letters that are in normal form by themselves, and have one letter as their lower case.
LATIN = frozenset(string.ascii_letters) | {chr(c) for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7, 0x130)}
#: What the pieces of the vocabulary that end a run are marked with.
RUN_END = "</w>"


class Words:
    """Ids of texts as little-endian 32-bit integers, by words between ASCII white space.

    The tokenizer lower-cases and never joins characters across white space, so a
    text's ids are those of its lower-cased words one after another, and most words
    have been seen before.  A run of letters is encoded by itself, and so are the
    marks after it, so a word is found with any marks; Latin letters need no normal
    form and go to the tokenizer without the steps that do nothing for them, all new
    runs at once, as each ends with a piece that says so.  Texts that hold a special
    token's string are encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # ASCII letters stand for themselves among the bytes
        self.letters, self.ascii = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.letters.normalizer = self.ascii.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(RUN_END)]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks: dict[bytes, bytes] = {}
        self.known: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        split = [t.lower().split() for t in texts]
        if len(self.known) > WORDS:
            self.known.clear()
            self.marks.clear()
        self.learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [self.whole(t) if b"<|" in t and any(s in t.lower() for s in self.special) else b"".join(map(get, words)) for t, words in zip(texts, split, strict=True)]

    def learn(self, words: set[bytes]) -> None:
        """Ids of new words: letters, or letters with marks after them, by runs; others by the whole tokenizer."""
        known, marks = self.known, self.marks
        plain = [w for w in words if w.isalpha()]  # ASCII letters alone
        later: list[tuple[bytes, bytes, bytes]] = []  # words, their letters in lower case, and the marks after them
        other: list[bytes] = []
        for w in words.difference(plain):
            run = w.rstrip(MARKS)
            after = w[len(run) :]
            if after and after not in marks:
                marks[after] = self.whole(after)
            if not run:
                known[w] = marks[after]
            elif run.isalpha():
                later.append((w, run, after))
            elif run.isascii():
                other.append(w)
            else:
                letters = run.decode()
                if letters.isalpha() and LATIN.issuperset(letters):
                    later.append((w, letters.lower().encode(), after))
                else:
                    other.append(w)
        self.runs(self.ascii, plain)
        new = {r for _, r, _ in later}.difference(known)
        self.runs(self.ascii, [r for r in new if r.isascii()])
        self.runs(self.letters, [r for r in new if not r.isascii()])
        for w, run, after in later:
            known[w] = known[run] + marks[after] if after else known[run]
        for w, e in zip(other, self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False), strict=True):
            known[w] = array("I", e.ids).tobytes()

    def runs(self, tokenizer, runs: list[bytes]) -> None:
        """Ids of runs of letters in lower case, all at once; a run is done where a piece ends one."""
        if not runs:
            return
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        raw, at = ids.tobytes(), 0
        for r, end in zip(runs, ends, strict=True):
            self.known[r] = raw[at:end]
            at = end

    def whole(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()


_words: dict[str, Words] = {}


def words_of(path: str | None) -> Words:
    """The tokenizer with the words it knows, once in each Python worker."""
    at = tokenizer_path("word_bpe_49k.json", path)
    if at not in _words:
        _words[at] = Words(at)
    return _words[at]


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """The places of ``lengths`` in each of so many near-equal windows."""
    # A partial division: its windows that hold something, largest first, as (sum, what is in it); what is in it is a place or a pair of such.
    heap = [(-n, i, [(n, i)]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # the largest of one and the smallest of the other, empty windows first: what meets is the ends of both
        x, y = min(len(a), windows - len(b)), min(len(b), windows - len(a))
        merged = a[:x] + b[:y] + [(m + n, (p, q)) for (m, p), (n, q) in zip(a[x:], reversed(b[y:]), strict=True)]
        merged.sort(key=lambda w: -w[0])
        count += 1
        heapq.heappush(heap, ((merged[-1][0] if len(merged) == windows else 0) - merged[0][0], count, merged))
    out = []
    for _, tree in heap[0][2] if heap else []:
        own, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            elif x is not None:
                own.append(x)
        out.append(sorted(own))
    return out


def windows(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; their number rises while one is over it, by what its excess over the mean asks for, a sixty-fourth at most."""
    total = sum(lengths)
    n = -(-total // capacity)
    while n:
        found = differencing(lengths, n)
        most = max(sum(lengths[i] for i in own) for own in found)
        if most <= capacity:
            return [own for own in found if own]
        room = capacity - (most - total / n)
        n = min(max(n + 1, math.ceil(total / room) if room > 0 else 0), n + max(1, n // 64))
    return []


def divided(pieces: list[tuple], capacity: int, fill: float, chunk: int) -> list[list[tuple]]:
    """Windows of (doc_id, start, length, crc, doc_tokens, chunk crcs): with whole pieces if they are ``fill`` full, else with the longest cut."""
    total, share = sum(p[2] for p in pieces), 16
    best: list[list[tuple]] = []
    while True:
        found = [[pieces[i] for i in own] for own in windows([p[2] for p in pieces], capacity)]
        if not best or len(found) < len(best):
            best = found
        if total >= fill * capacity * len(best) or len(best) * capacity - total < capacity or not share:
            return best
        # the longest, a sixteenth of the windows at first, twice as many each time, and then all
        many = len(best) // share + 1 if share > 1 else len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: -pieces[i][2])
        cut = {i for i in order[:many] if pieces[i][2] > chunk}
        pieces = [q for i, p in enumerate(pieces) for q in (chunks(p, chunk) if i in cut else [p])]
        share //= 2


def chunks(p: tuple, chunk: int) -> list[tuple]:
    """A piece's chunks as pieces."""
    doc, start, length, _, whole, crcs = p
    return [(doc, start + k * chunk, min(chunk, length - k * chunk), c, whole, [c]) for k, c in enumerate(crcs)]


def pieces(docs: DataFrame, path: str | None, end: int, capacity: int, chunk: int) -> DataFrame:
    """(doc_id, start, length, crc, doc_tokens, crcs): whole windows, and what is left of each row; crcs are those of its chunks."""
    closing = array("I", [end]).tobytes()
    names = ["doc_id", "start", "length", "crc", "doc_tokens", "crcs"]

    def make():
        words = words_of(path)

        def rows(cols):
            out = {k: [] for k in names}
            if cols["text"]:
                for i, ids in zip(cols["doc_id"], words.ids([t or b"" for t in cols["text"]]), strict=True):
                    ids += closing
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        own = memoryview(ids)[4 * start : 4 * (start + capacity)]
                        crcs = [zlib.crc32(own[k : k + 4 * chunk]) for k in range(0, len(own), 4 * chunk)] if len(own) < 4 * capacity else []
                        for k, v in zip(names, (i, start, len(own) // 4, crcs[0] if len(crcs) == 1 else zlib.crc32(own), n, crcs), strict=True):
                            out[k].append(v)
            return out

        return rows

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, start long, length long, crc long, doc_tokens long, crcs array<long>", binary=("text",))


def pack(docs: DataFrame, path: str | None = None, end: int = END, capacity: int = CAPACITY, group: int = GROUP, fill: float = FILL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece of (doc_id, text).

    ``path``: a tokenizers file.  A sequence's number holds the number of its group.
    """
    cut = settle(pieces(docs, path, end, capacity, chunk), "pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (group * capacity)))
    names = [x.split()[0] for x in OUT.split(", ")]

    def make():
        state = {"group": None, "next": 0, "pieces": []}

        def add(out, window):
            offset = 0
            for p in window:
                for k, v in zip(names, (*p[:5], state["next"], offset), strict=True):
                    out[k].append(v)
                offset += p[2]
            state["next"] += 1

        def flush(out):
            if state["pieces"]:
                for window in divided(state["pieces"], capacity, fill, chunk):
                    add(out, window)
            state["pieces"] = []

        def rows(cols):
            out = {k: [] for k in names}
            for g, *p in zip(*(cols[k] for k in ("group", "doc_id", "start", "length", "crc", "doc_tokens", "crcs")), strict=True):
                if g != state["group"]:
                    flush(out)
                    state["group"], state["next"] = g, g << 32
                if p[2] == capacity:
                    add(out, [p])
                else:
                    state["pieces"].append(tuple(p))
            return out

        def close():
            out = {k: [] for k in names}
            flush(out)
            return out

        rows.close = close
        return rows

    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "crc"), F.lit(groups)))
    return map_rows(dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "crc"), make, OUT)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
