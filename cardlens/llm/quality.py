"""Quality rules: counts of whole texts, and the likelihood of their hashed n-grams under trusted texts and under all."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches, durable
from cardlens.llm.phrases import FACTOR, SPREAD, distinct_rows

BUCKETS = 1 << 14
#: How many junk documents kept weigh as much as one trusted document lost.
CAUTION = 100.0
#: N-grams of no evidence that a score is averaged with, so that a short text isn't judged by a few.
PRIOR = 20
STEP = 0.002  # of scores, where thresholds may lie
REMEMBERED = 400_000  # tokens whose hashes a task keeps
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
TOKEN = re.compile(r"\w+|[^\w\s]+")
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that come twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(known) == len(words):
        return 0
    columns = [ids[i : i + n] for i in range(WINDOW)]
    first, count, of = distinct_rows(columns, len(known), inverse=True)
    begins = np.flatnonzero(count[of] > 1)
    marked = np.zeros(len(words) + 1, np.int64)
    np.add.at(marked, begins, 1)
    np.add.at(marked, begins + WINDOW, -1)
    return int((np.cumsum(marked) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text; words end at ASCII white space only."""
    raw = text.encode()
    words = raw.split()
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


class Hashed:
    """Buckets of a text's single tokens and pairs of tokens. Tokens are runs of word characters or of others, lower-cased."""

    def __init__(self, buckets: int):
        self.buckets, self.seen = np.uint64(buckets), {}

    def of(self, text: str) -> np.ndarray:
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        tokens = TOKEN.findall(text.lower())
        h = np.empty(len(tokens), np.uint64)
        for i, t in enumerate(tokens):
            x = seen.get(t)
            if x is None:
                x = seen[t] = xxhash.xxh64_intdigest(t)
            h[i] = x
        pairs = ((h[:-1] * FACTOR) ^ h[1:]) * SPREAD
        return (np.concatenate([h, pairs ^ (pairs >> np.uint64(32))]) % self.buckets).astype(np.int64)


def labelled(labels: DataFrame) -> DataFrame:
    """(_id, good, fit): all labelled ids but those with differing labels. A third of them, by a hash, sets the threshold, the
    others the trusted counts."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi")
    h = F.xxhash64(F.col("doc_id"), F.lit(13))
    return known.select(F.col("doc_id").alias("_id"), (F.col("lo") == 1).alias("good"), (F.pmod(h, F.lit(3)) > 0).alias("fit"))


def with_trust(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(text, trusted) of rows (doc_id, text): whether the id is one of ids (_id), which may be many. Both sides meet by id in
    one shuffle; rows without an id stay where they are."""
    known = rows.where("doc_id is not null").join(ids.withColumn("trusted", F.lit(True)).hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), "left")
    return known.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")).unionByName(rows.where("doc_id is null").select("text", F.lit(False).alias("trusted")))


def bucket_counts(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(all, trusted) occurrences of each bucket in rows (text, trusted), added up in the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total, good = Hashed(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, trusted in zip(batch["text"], batch["trusted"].to_pylist()):
                n = np.bincount(hashed.of(text.as_py()), minlength=buckets)
                total += n
                if trusted:
                    good += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at]), pa.array(good[at])], ["bucket", "total", "good"])

    table = rows.mapInArrow(count, "bucket int, total long, good long").groupBy("bucket").agg(F.sum("total").alias("total"), F.sum("good").alias("good")).toArrow()
    out = np.zeros((2, buckets), np.int64)
    at = table["bucket"].to_numpy()
    out[0, at], out[1, at] = table["total"].to_numpy(), table["good"].to_numpy()
    return out[0], out[1]


def log_ratios(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Of each bucket's likelihood under the trusted multinomial and under the one of all texts, one added to each count."""
    n = len(total)
    return np.log((good + 1) / (good.sum() + n)) - np.log((total + 1) / (total.sum() + n))


def scored(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """rows with base counts and score, the sum of the log-ratios of the text's n-grams over their number and PRIOR."""
    held = rows.sparkSession.sparkContext.broadcast(weights)
    others = [c for c in rows.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = held.value
        hashed = Hashed(len(weight))
        for batch in batches:
            counts, scores = [], []
            for item in batch["text"]:
                text = item.as_py()
                counts.append(base_counts(text))
                grams = hashed.of(text)
                scores.append(float(weight[grams].sum()) / (len(grams) + PRIOR))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *columns, pa.array(scores, pa.float64())], [*others, *COUNTS, "score"])

    kinds = ", ".join(f"{c} {k}" for c, k in rows.dtypes if c != "text")
    return rows.mapInArrow(score, f"{kinds}, {', '.join(f'{c} long' for c in COUNTS)}, score double")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def threshold(scores: DataFrame, caution: float = CAUTION) -> float:
    """The score from which documents are kept: among multiples of STEP, the one that loses least of the labelled rows (good,
    score), a share of the trusted lost weighing `caution` times a share of the junk kept; ties to the middle of the lowest gap.
    Without trusted or junk rows nothing is held against a document. A histogram of scores comes to the driver."""
    steps = scores.groupBy(F.floor(F.col("score") / STEP).cast("long").alias("step")).agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")).orderBy("step").collect()
    goods, bads = sum(r["good"] for r in steps), sum(r["bad"] for r in steps)
    if not goods or not bads:
        return float("-inf")
    best, lost, caught = (0.0, float("-inf")), 0, 0
    for i, r in enumerate(steps):
        lost, caught = lost + r["good"], caught + r["bad"]
        gain = caught / bads - caution * lost / goods
        after = steps[i + 1]["step"] if i + 1 < len(steps) else r["step"] + 1
        if gain > best[0]:
            best = (gain, (r["step"] + 1 + after) / 2 * STEP)
    return best[1]


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, caution: float = CAUTION) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) of every whole text.

    The trusted multinomial is of all labelled documents of quality 1 that aren't kept back, the raw one of all documents.
    A document is kept unless the base rules fail it or its score lies below the threshold, which depends on the labelled
    rows only through their histogram; nothing is drawn at random. Null texts are empty (so they fail); null ids and repeated
    rows are judged like others; without labels the base rules decide alone. Columns of docs besides doc_id and text aren't
    read. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    marks = durable(labelled(labels), "labelled")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    weights = log_ratios(*bucket_counts(with_trust(rows, marks.where("good and fit").select("_id")), buckets))
    found = durable(scored(rows, weights), "quality")
    cut = threshold(found.select("doc_id", "score").join(marks.where("not fit"), F.col("doc_id") == F.col("_id")).select("good", "score"), caution)
    failed: Column = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return found.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= F.lit(cut))).alias("kept"), "score")
