"""Secret scans: patterns, and a token-efficiency test for random strings.

A subword vocabulary learned from prose spends few tokens on what people write
and many on random characters, so the characters a token covers tell the two
apart.  A run of key characters is random if it has at most ``RATIO`` characters
a token, unless it is a digest of a known length, a number, or an identifier: words
and short numbers, joined by marks or changes of case, whose words the vocabulary
proves, with over ``WORDS_RATIO`` characters a token in lower case.  Parts of a run
between marks and windows of it are tested too.  A run with other marks within, as
passwords have, is random if it mixes cases, digits and marks throughout and has at
most ``STRONG_RATIO`` characters a token.

Nulls and empty texts have no spans.  Repeated rows are scanned each by itself, and
equal texts have equal spans.  Of kinds that begin at one place, the base ones come
first, in their order.  Runs are encoded in pieces of ``RUN`` characters, so the time
stays in proportion to the text however long a run is; all of the text is read.
Empty tables give no rows; columns other than doc_id and text are carried by
``without_secrets`` alone, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import documents, map_rows, tokenizer_path

# The patterns of the base rules, with the least lengths asked for.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Runs of characters that keys are written in, and runs that may hold other marks as well.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
STRONG = re.compile(r"[A-Za-z0-9!#$%&*+./:=?@^_~-]{16,}")
#: Digests by their number of hexadecimal digits, and UUIDs.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})\Z", re.I)
#: Identifiers: words and short numbers joined by the usual marks, or by changes of case.
IDENTIFIER = re.compile(r"[+/_=-]*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*\Z")
CAMEL = re.compile(r"[A-Za-z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*[0-9]{0,4}\Z")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RUN = 256
RATIO = 2.2
#: An identifier's words have more characters a token, in lower case.
WORDS_RATIO = 2.0
STRONG_RATIO = 1.8
#: Of a strong run's neighbouring characters, the least share that are of different kinds.
CHANGES = 0.5
#: A run of letters alone is a key from so many on, as there are long words that a vocabulary spells in many pieces.
LETTERS = 20
#: What parts a run, and the width and step of the windows that are tested in longer parts.
MARKS = re.compile(r"[+/_=-]+")
WINDOW = 16
STEP = 4

KINDS = ("assign", "access", "hex", "random")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base rules, by start and kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def counter(tokens) -> Callable[[str], int]:
    """Tokens of a string of any length, by pieces of RUN characters."""
    return lambda s: sum(tokens(s[i : i + RUN]) for i in range(0, len(s), RUN))


def is_known(run: str, tokens) -> bool:
    """Digests and numbers, and identifiers that the vocabulary proves, which look random but aren't secrets."""
    if run.isdigit() or DIGEST.match(run):
        return True
    if not IDENTIFIER.match(run) and not CAMEL.match(run):
        return False
    words = [w.lower() for w in WORD.findall(run) if len(w) > 2]
    return sum(map(len, words)) > WORDS_RATIO * sum(map(counter(tokens), words)) if words else len(run) < WINDOW


def is_random(run: str, tokens, ratio: float) -> bool:
    """The token-efficiency test."""
    if run.isalpha() and len(run) < LETTERS:
        return False
    if run.isalpha() and (run.islower() or run.isupper()):
        return len(run) <= min(ratio, WORDS_RATIO) * counter(tokens)(run.lower())
    return not is_known(run, tokens) and len(run) <= ratio * counter(tokens)(run)


def is_strong(run: str, tokens) -> bool:
    """If a run mixes cases, digits and marks as a password does; addresses and paths have words between their marks."""
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "." for c in run]
    if len(set(kinds)) < 4 or sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) < CHANGES * (len(run) - 1):
        return False
    return len(run) <= STRONG_RATIO * counter(tokens)(run)


def random_spans(text: str, tokens, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Spans of the token-efficiency test; ``tokens`` counts a string's tokens.

    A run that isn't random as a whole is tested by its parts between marks, and
    windows of the run, so that words next to a key don't hide it.
    """
    out: list[tuple[int, int, int]] = []
    strong = []
    for m in STRONG.finditer(text):
        # a sentence's end is no part of a key
        run = m.group().rstrip(".:?")
        if len(run) >= WINDOW and is_strong(run, tokens):
            strong.append((m.start(), m.start() + len(run), 3))
    for m in CANDIDATE.finditer(text):
        run, at = m.group(), m.start()
        if is_random(run, tokens, ratio):
            out.append((at, m.end(), 3))
            continue
        if DIGEST.match(run) or run.isdigit():
            continue
        found, begin = [], 0
        for mark in [*MARKS.finditer(run), None]:
            end = mark.start() if mark else len(run)
            if end - begin >= WINDOW and is_random(run[begin:end], tokens, ratio):
                found.append((begin, end))
            begin = mark.end() if mark else end
        if not is_known(run, tokens) or not IDENTIFIER.match(run) and not CAMEL.match(run):
            last = len(run) - WINDOW
            for k in sorted({*range(0, last + 1, STEP), last}):
                # dates, versions and other short parts between marks are no key
                mixed = any(len(x) >= WINDOW // 2 and not is_known(x, tokens) for x in MARKS.split(run[k : k + WINDOW]))
                if mixed and not any(a < k + WINDOW and k < b for a, b in found) and is_random(run[k : k + WINDOW], tokens, ratio):
                    found.append((k, k + WINDOW))
        # a window's key goes on to the marks round it
        for a, b in sorted(found):
            a = max((x.end() for x in MARKS.finditer(run, 0, a + 1) if x.end() <= a), default=0)
            b = next((x.start() for x in MARKS.finditer(run, b)), len(run))
            if out and at + a <= out[-1][1] and out[-1][0] >= at:
                out[-1] = (out[-1][0], max(out[-1][1], at + b), 3)
            else:
                out.append((at + a, at + b, 3))
    return sorted([*strong, *(x for x in out if not any(a < x[1] and x[0] < b for a, b, _ in strong))])


def encoder(path: str):
    """tiktoken over a file of ranks; special strings are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def spelled(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, ratio: float = RATIO, path: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of each row of (doc_id, text).

    ``path``: a file of ranks for tiktoken.  Spans are ``kind:start:end`` in code
    points, end exclusive, by start and then in the order of KINDS.
    """

    def make():
        # a rank file is opened by each Python worker, from its own installed package
        enc = encoder(tokenizer_path("byte_bpe_50k.tiktoken", path))
        tokens = lambda s: len(enc.encode_ordinary(s))

        def scan(rows):
            out = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")}
            for i, text in zip(rows["doc_id"], rows["text"], strict=True):
                text = text or ""
                base = base_spans(text)
                more = random_spans(text, tokens, ratio)
                kinds = [k for _, _, k in base]
                for k, v in zip(out, (i, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(sorted([*base, *more], key=lambda x: (x[0], x[2]))), len(more)), strict=True):
                    out[k].append(v)
            return out

        return scan

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redacted(text: str, spans: str, mark: str = "[secret]") -> str:
    """``text`` with its spans, merged where they overlap, replaced."""
    out, at = [], 0
    for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",")):
        if b > at:
            if a >= at:
                out += [text[at:a], mark]
            at = b
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, ratio: float = RATIO, path: str | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, with every span in a text replaced.

    n_chars, where there is such a column, is the length of the new text.
    """

    def make():
        enc = encoder(tokenizer_path("byte_bpe_50k.tiktoken", path))
        tokens = lambda s: len(enc.encode_ordinary(s))

        def rows(cols):
            cols = dict(cols)
            lengths = list(cols["n_chars"]) if "n_chars" in cols else None
            texts = []
            for i, text in enumerate(cols["text"]):
                if spans := spelled([*base_spans(text or ""), *random_spans(text or "", tokens, ratio)]):
                    text = redacted(text, spans)
                    if lengths:
                        lengths[i] = len(text)
                texts.append(text)
            return cols | {"text": texts} | ({"n_chars": lengths} if lengths else {})

        return rows

    return map_rows(docs, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
