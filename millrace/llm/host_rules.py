"""Quality rules by host: rule failures of a host's documents decide about the host.

Each document is measured and held against RULES.  The failures of each rule are
summed by host, and a host's failure rate is shrunk towards all hosts' with a beta
prior fitted to the hosts' rates by moments, so a host of a few documents isn't
condemned by one of them.  A host is rejected if the shrunk rate of any rule is
over ``limit``; a document is kept if it passes the base rules and its host isn't
rejected.

Nulls in the text count as an empty text, which fails; a null host is a host of
its own.  Repeated rows count each.  A very long text is measured whole.  A rate equal
to the limit doesn't reject.  Empty tables give no rows; other columns are carried by
``kept_documents`` alone, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, settle, spare

SPACE = b" \t\n\r\x0b\x0c"
FOLLOWING = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rules by name, on the columns of STATS: true where a document fails.  The first two are the base.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "3 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)",
}
BASE = ("few_words", "repeats")
LIMIT = 0.5
#: The prior counts as so many documents at least, however much the hosts differ, so that no host falls with a single one.
LEAST_PRIOR = 5.0


def repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three found at least twice, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:  # three numbers no longer fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """STATS of a text, and its number of lines with a word."""
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(words), len(text.translate(None, SPACE + FOLLOWING)), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated(words), len(lines)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with STATS and n_lines of its text."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def make():
        def rows(cols):
            out = {k: cols[k] for k in keep}
            found = [measure(t) for t in cols["text"]]
            return out | {k: [x[i] for x in found] for i, k in enumerate((*STATS, "n_lines"))}

        return rows

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keep] + [f"{k} long" for k in (*STATS, "n_lines")])
    return map_rows(docs.select(*dict.fromkeys([*keep, "text"])), make, schema, binary=("text",))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no base rule fails."""

    def make():
        def rows(cols):
            good = []
            for t in cols["text"]:
                n = len((t or b"").split())
                good.append(n >= 50 and 100 * repeated(t.split()) <= 50 * n)
            return {k: [x for x, ok in zip(v, good, strict=True) if ok] for k, v in cols.items()}

        return rows

    return map_rows(docs, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), binary=("text",))


def host_verdicts(stats: DataFrame, host: str, rules: dict[str, str] = RULES, limit: float = LIMIT) -> DataFrame:
    """(host, host_docs, host_rate, host_rejected): the largest shrunk failure rate of each host.

    Counts are summed before they shuffle, so a host of a third of all rows is a
    row from each task.  The driver gets two numbers for each rule.
    """
    counts = stats.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("host_docs"), *[F.sum(F.expr(f"CAST({rule} AS INT)")).alias(name) for name, rule in rules.items()])
    counts = settle(counts, "hosts")
    moments = counts.agg(*[f(F.col(name) / F.col("host_docs")).alias(f"{name}_{at}") for name in rules for at, f in (("mean", F.avg), ("var", F.var_pop))], F.avg(1 / F.col("host_docs")).alias("noise")).first()
    shrunk = []
    for name in rules:
        mean = moments[f"{name}_mean"] or 0.0
        # what the rates differ by beyond the chance of a sample of each host
        between = max((moments[f"{name}_var"] or 0.0) - mean * (1 - mean) * (moments["noise"] or 0.0), 1e-6)
        strength = max(mean * (1 - mean) / between - 1, LEAST_PRIOR)
        shrunk.append((F.col(name) + mean * strength) / (F.col("host_docs") + strength))
    rate = F.greatest(*shrunk) if len(shrunk) > 1 else shrunk[0]
    return counts.select("host", "host_docs", rate.alias("host_rate"), (rate > limit).alias("host_rejected"))


def failed(rules: tuple[str, ...] = BASE) -> Column:
    return F.expr(" OR ".join(f"({RULES[r]})" for r in rules))


def host_rules(docs: DataFrame, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """(doc_id, STATS, base_failed, host_rate, host_rejected, kept) of each row.

    One pass over the texts; its narrow result is written, summed by host and
    joined with the hosts.
    """
    stats = settle(measured(docs, ["doc_id", host]), "measured")
    hosts = host_verdicts(stats, host, limit=limit).withColumnRenamed("host", "_host")
    joined = stats.join(hosts, F.col(host).eqNullSafe(F.col("_host")))
    base = failed()
    return joined.select("doc_id", *STATS, base.alias("base_failed"), "host_rate", "host_rejected", (~base & ~F.col("host_rejected")).alias("kept"))


def kept_documents(docs: DataFrame, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``host_rules`` keeps.

    The texts don't shuffle unless the rejected hosts outgrow a broadcast.
    """
    stats = settle(measured(docs, [host]), "measured")
    rejected = spare(docs, "rejected")
    bad = host_verdicts(stats, host, limit=limit).where("host_rejected").select(F.col("host").alias(rejected))
    return passing(docs).join(bad, F.col(host).eqNullSafe(F.col(rejected)), "left_anti")


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(documents(spark, sf_dir)).drop("host_rate")
