"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts of all labelled rows by language and bucket; a matrix
of log probabilities, languages x BUCKETS floats, is broadcast, and texts are scored
in batches: their sparse counts of buckets times the matrix.  A matrix holds MAX_LANGS
languages at most; more of them are scored by one matrix after another, and the
best of all wins.

A null text or one without a letter is ``und`` with score 0; so is every text
where there was nothing to learn from.  Equal scores go to the language first in
code point order.  Repeated rows count each.  A very long text is scored whole, in
parts of BATCH characters.  Empty tables give no rows; other columns than the named
ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, settle, spare

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: The languages of a matrix, which bounds it to 256 MB.
MAX_LANGS = 2000
SMOOTH = 0.5
#: Characters that are hashed at once, texts that are counted at once, and the cells of the matrix that are gathered at once.
BATCH = 400_000
COUNTED = 64
GATHERED = 1 << 22


def letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def batches(texts: list[str]):
    """(first, end, buckets, starts): runs of texts of about BATCH characters, with the n-gram buckets of all and where each text's begin.

    Texts are lower-cased and stand between spaces, so no n-gram joins two of them.
    """
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < BATCH):
            size += len(texts[end])
            end += 1
        own = [f" {t.lower()} " for t in texts[at:end]]
        code = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        starts = np.concatenate([[0], np.cumsum([len(t) for t in own])])
        grams = np.zeros((len(ORDERS), len(code)), np.uint16)
        h = np.zeros(len(code), np.uint64)
        for k in range(max(ORDERS)):
            h = (h ^ np.concatenate([code[k:], np.full(k, 32, np.uint64)])) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if k + 1 in ORDERS:
                grams[ORDERS.index(k + 1)] = h & np.uint64(BUCKETS - 1)
        yield at, end, grams, starts
        at = end


def train(docs: DataFrame, lang: str = "lang") -> Model:
    """What all labelled rows have: n-gram counts by language and bucket, the number of texts in the last bucket."""
    rows = docs.select("text", F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")

    def make():
        sums: dict[str, np.ndarray] = {}

        def flush():
            out = {"lang": [], "bucket": [], "n": []}
            for name, v in sums.items():
                i = np.flatnonzero(v)
                out["lang"] += [name] * len(i)
                out["bucket"] += i.tolist()
                out["n"] += v[i].tolist()
            sums.clear()
            return out

        def count(cols):
            by: dict[str, list[str]] = {}
            for name, text in zip(cols["lang"], cols["text"], strict=True):
                by.setdefault(name, []).append(text)
            for name, texts in by.items():
                v = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                v[BUCKETS] += len(texts)
                for _, _, grams, _ in batches(texts):
                    v[:BUCKETS] += np.bincount(grams.ravel(), minlength=BUCKETS)
            return flush() if len(sums) > 64 else {"lang": [], "bucket": [], "n": []}

        count.close = flush
        return count

    counts = settle(map_rows(rows, make, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    langs = [(r["lang"], r["n"]) for r in counts.where(F.col("bucket") == BUCKETS).select("lang", "n").orderBy("lang").collect()]
    return Model(counts, langs)


@dataclass
class Model:
    """Counts of n-grams, and the languages in code point order with their numbers of texts."""

    counts: DataFrame
    langs: list[tuple[str, int]]

    def matrices(self, most: int = MAX_LANGS) -> Iterator[tuple[list[str], np.ndarray]]:
        """For each ``most`` languages their names, and log probabilities [bucket, language], the prior in the last row."""
        texts = sum(n for _, n in self.langs)
        for at in range(0, len(self.langs), most):
            names = [x for x, _ in self.langs[at : at + most]]
            own = self.counts.where(F.col("lang").between(names[0], names[-1])).toArrow()
            matrix = np.zeros((BUCKETS + 1, len(names)))
            place = {x: i for i, x in enumerate(names)}
            which = np.array([place[x] for x in own["lang"].to_pylist()], np.int64)
            np.add.at(matrix, (own["bucket"].to_numpy(), which), own["n"].to_numpy())
            logs = np.empty_like(matrix, np.float32)
            logs[:BUCKETS] = np.log((matrix[:BUCKETS] + SMOOTH) / (matrix[:BUCKETS].sum(0) + SMOOTH * BUCKETS))
            logs[BUCKETS] = np.log(matrix[BUCKETS] / texts)
            yield names, logs


def counted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, buckets, counts): the sparse counts of texts' n-grams; a text's may come in several."""
    for at, end, grams, starts in batches(texts):
        for i in range(at, end, COUNTED):
            j = min(end, i + COUNTED)
            own = grams[:, starts[i - at] : starts[j - at]].astype(np.int64)
            own += np.repeat(np.arange(j - i) * BUCKETS, np.diff(starts[i - at : j - at + 1]))
            n = np.bincount(own.ravel(), minlength=(j - i) * BUCKETS)
            found = np.flatnonzero(n)
            yield i + found // BUCKETS, found % BUCKETS, n[found]


def scored(texts: list[str], logs: np.ndarray) -> np.ndarray:
    """The log probability of each text and language."""
    total = np.tile(logs[BUCKETS].astype(float), (len(texts), 1))
    step = max(1, GATHERED // logs.shape[1])
    for text, bucket, n in counted(texts):
        for k in range(0, len(text), step):
            of, b = text[k : k + step], bucket[k : k + step]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            total[of[first]] += np.add.reduceat(logs[b] * n[k : k + step, None].astype(np.float64), first)
    return total


def predict(docs: DataFrame, model: Model, keep: list[str], most: int = MAX_LANGS) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred and score, the posterior probability."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    best = spare(docs, "best")
    out = docs.select(*dict.fromkeys([*keep, "text"])).withColumns({"lang_pred": F.lit("und"), best: F.lit(None).cast("double"), "score": F.lit(None).cast("double")})
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in dict.fromkeys([*keep, "text"])] + [f"lang_pred string, {best} double, score double"])
    for names, logs in model.matrices(most):
        held = docs.sparkSession.sparkContext.broadcast((names, logs))

        def make(held=held):
            names, logs = held.value

            def rows(cols):
                own = [i for i, t in enumerate(cols["text"]) if letters(t)]
                total = scored([cols["text"][i] for i in own], logs)
                for i, x, k in zip(own, total, total.argmax(1), strict=True):
                    # score holds the logarithm of all probabilities' sum until the end
                    before = cols["score"][i]
                    every = float(np.logaddexp.reduce(x))
                    cols["score"][i] = every if before is None else float(np.logaddexp(before, every))
                    if cols[best][i] is None or x[k] > cols[best][i]:
                        cols["lang_pred"][i], cols[best][i] = names[k], float(x[k])
                return cols

            return rows

        out = map_rows(out, make, schema)
    return out.select(*keep, "lang_pred", F.when(F.col(best).isNull(), 0.0).otherwise(F.least(F.exp(F.col(best) - F.col("score")), F.lit(1.0))).alias("score"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"))
    model = train(docs.where("NOT coalesce(held_out, false)"))
    return predict(docs, model, ["doc_id", "held_out"]).select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "lang_pred", "score")
