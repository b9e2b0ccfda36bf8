"""Toxicity by a support vector machine on a gapped subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import functools
import itertools
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from cardlens.llm.common import bound_batches, empty_if_null, whole_row

DECAY = 0.8  # what each skipped character of a subsequence costs
SPAN = 7  # characters that a subsequence may reach over
WINDOW = 24  # longer words are looked at in windows of so many characters, half overlapping
LETTERS = 64  # classes of characters
HASHED = 1 << 20  # places for subsequences of four
TRIPLES = LETTERS**3
LONGEST = 24  # words in a sentence; longer ones are looked at in parts
MARGIN = 0.3  # a word counts by how far its value lies above this
LEAST_PRIOR = 0.3
SENTENCE_END = re.compile(r"[.!?]\W*$")
EDGES = ".,;:!?\"'()[]{}<>|*#%&$-_~"


@functools.cache
def subsequences(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of all subsequences of three and of four of n characters within SPAN, and their decays."""
    out = []
    for p in (3, 4):
        places = [(s, *(s + g for g in c)) for s in range(n) for c in itertools.combinations(range(1, SPAN), p - 1) if s + c[-1] < n]
        at = np.array(places, np.int64).reshape(-1, p)
        out.append((at, DECAY ** (at[:, -1] - at[:, 0] - (p - 1))))
    return out


def padded(word: str) -> str:
    return f"^{word}$"


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length: the key of each of their subsequences (words x subsequences), and the decays."""
    points = np.frombuffer("".join(map(padded, words)).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
    code = np.where((points >= 97) & (points <= 122), points - 96, np.where(points < 97, 27 + points % 10, 37 + points % 27)).astype(np.uint32)
    keys, decays = [], []
    for at, decay in subsequences(code.shape[1]):
        key = np.zeros((len(code), len(at)), np.uint32)
        for column in at.T:
            key = key * np.uint32(LETTERS) + code[:, column]
        if at.shape[1] == 4:
            key = np.uint32(TRIPLES) + (key * np.uint32(2654435761) >> np.uint32(12))
        keys.append(key)
        decays.append(decay)
    return np.concatenate(keys, 1), np.concatenate(decays)


def norms(keys: np.ndarray, decays: np.ndarray) -> np.ndarray:
    """The root of the kernel of each word with itself: equal subsequences add up."""
    order = np.argsort(keys, axis=1)
    sorted_keys, running = np.take_along_axis(keys, order, 1), np.cumsum(decays[order], axis=1)
    last = np.ones(keys.shape, bool)
    last[:, :-1] = sorted_keys[:, 1:] != sorted_keys[:, :-1]
    row, column = np.nonzero(last)
    upto = running[row, column]
    before = np.where(np.r_[True, row[1:] != row[:-1]], 0.0, np.r_[0.0, upto[:-1]])
    return np.sqrt(np.bincount(row, (upto - before) ** 2, minlength=len(keys)))


def by_length(words: Sequence[str], part: int = 1024) -> Iterator[np.ndarray]:
    """Positions of words of three characters or more, in parts of one length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths[lengths >= 3]):
        of_length = np.flatnonzero(lengths == n)
        yield from (of_length[i : i + part] for i in range(0, len(of_length), part))


def windows(word: str) -> list[str]:
    """What is looked at of a word: windows of it, and, if other characters stand between its letters, the letters alone."""
    found = [word] if len(word) <= WINDOW else [word[at : at + WINDOW] for at in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    if not word.isalpha() and 3 <= len(bare := "".join(c for c in word if c.isalpha())) <= WINDOW:
        found.append(bare)
    return found


def kernel(a: str, b: str) -> float:
    """The normalised kernel of two words: common subsequences of three and four characters, gaps decayed."""
    sides = []
    for word in (a, b):
        keys, decays = features([word])
        sides.append(Counter())
        for k, d in zip(keys[0].tolist(), decays.tolist(), strict=True):
            sides[-1][k] += d
    norm = np.sqrt(sum(v * v for v in sides[0].values()) * sum(v * v for v in sides[1].values()))
    return float(sum(v * sides[1][k] for k, v in sides[0].items()) / norm) if norm else 0.0


class Sparse:
    """Normalised features of words, as flat arrays (word, key, value)."""

    def __init__(self, words: Sequence[str]):
        row, key, value = [], [], []
        for at in by_length(words):
            keys, decays = features([words[i] for i in at])
            norm = norms(keys, decays)
            row.append(np.repeat(at, keys.shape[1]))
            key.append(keys.ravel())
            value.append((decays[None, :] / norm[:, None]).ravel())
        self.words = len(words)
        self.row, self.key, self.value = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((row, np.int64), (key, np.uint32), (value, float)))

    def of(self, i: int) -> np.ndarray:
        """The features of one word over all keys."""
        own = self.row == i
        return np.bincount(self.key[own], self.value[own], minlength=TRIPLES + HASHED)

    def times(self, dense: np.ndarray) -> np.ndarray:
        """The kernel of each word with the dense features."""
        return np.bincount(self.row, self.value * dense[self.key], minlength=self.words)


def choose_landmarks(words: Sequence[str], weight: np.ndarray, most: int) -> list[int]:
    """Pivoted Cholesky steps: each takes the word of which, by weight, the landmarks so far explain least. So every
    family of alike words that tells something gets landmarks of its own, in any language."""
    sparse = Sparse(words)
    left = np.ones(len(words))
    explained = np.zeros((len(words), min(most, len(words))))
    chosen: list[int] = []
    for m in range(explained.shape[1]):
        j = int(np.argmax(left * weight))
        if left[j] * weight[j] <= 1e-9:
            break
        step = sparse.times(sparse.of(j)) - explained[:, :m] @ explained[j, :m]
        explained[:, m] = step / np.sqrt(left[j])
        left = np.maximum(left - explained[:, m] ** 2, 0)
        chosen.append(j)
        left[chosen] = 0
    return chosen


@dataclass
class Model:
    """The machine on Nystroem features of words. These are linear in the subsequences, so it is kept as one weight per
    subsequence that a landmark has; a word's value is the sum of its own over its norm, plus bias."""

    landmarks: list[str]
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    link: np.ndarray  # of the best sentence and the density, and a constant

    def scorer(self) -> Scorer:
        return Scorer(self)


NOTHING_LEARNED = Model([], np.empty(0, np.uint32), np.empty(0), -1.0, np.array([0.0, 0.0, -8.0]))


class Scorer:
    """Scores whole texts, a batch at a time."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.zeros(TRIPLES + HASHED, np.float32)
        self.table[model.keys] = model.weights

    def word_values(self, words: Sequence[str]) -> np.ndarray:
        """By how far each word's value lies above MARGIN; 0 if it doesn't. A longer word has that of its best window."""
        out = np.zeros(len(words))
        if not len(self.model.keys):
            return out
        looked_at = [windows(w) for w in words]
        cut = [w for own in looked_at for w in own]
        value = np.zeros(len(cut))
        least = MARGIN - self.model.bias
        for at in by_length(cut):
            keys, decays = features([cut[i] for i in at])
            raw = self.table[keys] @ decays
            # the norm is at least the root of the decays' squares: most words can be left without it
            some = np.flatnonzero(raw > least * np.sqrt((decays**2).sum()))
            if len(some):
                value[at[some]] = np.maximum(raw[some] / norms(keys[some], decays) - least, 0)
        np.maximum.at(out, np.repeat(np.arange(len(words)), list(map(len, looked_at))), value)
        return out

    def measures(self, texts: pa.Array) -> np.ndarray:
        """(texts, 2): the sum of values in the best sentence, and the sum of all over the root of the count of words."""
        tokens = pc.utf8_split_whitespace(pc.utf8_lower(pc.utf8_trim_whitespace(texts)))
        sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = tokens.flatten()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        coded = flat.dictionary_encode()
        raw, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        words = pc.utf8_trim(raw, EDGES).to_pylist()
        value = self.word_values(words)[at]
        ends = np.array([bool(SENTENCE_END.search(r)) for r in raw.to_pylist()], bool)[at]
        text = np.repeat(np.arange(len(sizes)), sizes)
        self.add_spaced(np.array([len(w) for w in words], np.int64)[at] == 1, text, at, words, value)
        # a unit: at most LONGEST words of one sentence of one text
        first = np.ones(len(at), bool)
        first[1:] = ends[:-1] | (text[1:] != text[:-1])
        start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        unit = np.cumsum((np.arange(len(at)) - start) % LONGEST == 0) - 1
        best = np.zeros(len(sizes))
        if len(at):
            np.maximum.at(best, text[np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])], np.bincount(unit, value))
        return np.stack([best, np.bincount(text, value, minlength=len(sizes)) / np.sqrt(sizes + 50)], 1)

    def add_spaced(self, single: np.ndarray, text: np.ndarray, at: np.ndarray, words: Sequence[str], value: np.ndarray) -> None:
        """Runs of three or more single characters count as one word."""
        new = np.ones(len(single), bool)
        new[1:] = ~single[:-1] | ~single[1:] | (text[1:] != text[:-1])
        begin = np.flatnonzero(new & single)
        end = np.r_[np.flatnonzero(new), len(single)][np.searchsorted(np.flatnonzero(new), begin) + 1] if len(begin) else begin
        runs = [(b, e) for b, e in zip(begin.tolist(), end.tolist(), strict=True) if e - b >= 3]
        if runs:
            value[[b for b, _ in runs]] = self.word_values(["".join(words[i] for i in at[b:e]) for b, e in runs])

    def scores(self, texts: Iterable[str] | pa.Array) -> np.ndarray:
        """The probability of class 1 of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        link = self.model.link
        return 1 / (1 + np.exp(-np.clip(self.measures(texts) @ link[:-1] + link[-1], -30, 30)))


def words_of(text: str) -> set[str]:
    return {part for raw in text.lower().split() for part in windows(raw.strip(EDGES)) if len(part) >= 3}


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows to learn from, once per doc_id: of differing labels the larger one counts."""
    return labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(toxic, doc_id, text) of at most per_class labelled ids of each class, by a hash of the id, in one partition and in
    that order; held-out ids (crc32 mod 5 = 0) never."""
    chosen = None
    for y in (0, 1):
        part = training_labels(labels).where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_if_null("text").alias("text"))
    texts = rows.join(F.broadcast(chosen.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
    return texts.select("toxic", "doc_id", "text").repartition(1).sortWithinPartitions("toxic", F.xxhash64("doc_id"), "doc_id", "text")


def that_fit(rows: Iterable[tuple[int, int, str]], per_class: int, max_chars: int) -> list[tuple[str, int]]:
    """(text, toxic) of whole texts, in the order given, while per_class texts and max_chars characters of their class are
    not exceeded; a text that doesn't fit is passed over, and a repeated row counts once."""
    size, number, before, taken = [0, 0], [0, 0], None, []
    for row in rows:
        y, _, text = row
        if row != before and number[y] < per_class and size[y] + len(text) <= max_chars:
            size[y] += len(text)
            number[y] += 1
            taken.append((text, y))
        before = row
    return taken


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def fit_svm(x: np.ndarray, positive: np.ndarray, negative: np.ndarray, c: float, rounds: int = 40) -> np.ndarray:
    """Squared-hinge linear machine by Newton steps. Each row is met with label 1 and with label -1, by the two weights.
    The last weight is the bias."""
    w = np.zeros(x.shape[1] + 1)
    for _ in range(rounds):
        value = x @ w[:-1] + w[-1]
        active = np.where(value < 1, positive, 0.0), np.where(value > -1, negative, 0.0)
        both, signed = active[0] + active[1], active[0] - active[1]
        left = np.diag(np.r_[np.ones(x.shape[1]), 1e-6])
        right = np.zeros(len(w))
        for at in range(0, len(x), 8192):
            part = np.hstack([x[at : at + 8192], np.ones((len(x[at : at + 8192]), 1))]).astype(float)
            left += 2 * c * (part.T * both[at : at + 8192]) @ part
            right += 2 * c * part.T @ signed[at : at + 8192]
        new = np.linalg.solve(left, right)
        done = np.abs(new - w).max() < 1e-4
        w = new
        if done:
            break
    return w


def train(sample: list[tuple[str, int]], landmarks: int = 500, most_words: int = 40_000, candidates: int = 4000, c: float = 30_000.0, prior: float | None = None) -> Model:
    """Fit on labelled texts.

    The words of a labelled text's sentences are the instances: a word is met as positive by the share of class 1's
    texts that have it and as negative by its share of the others, so a word of both kinds of texts ends near zero.
    Landmarks are chosen among the words whose shares differ most, by what they tell and what the ones before leave
    unexplained. most_words and candidates bound the vocabulary. Without both classes every score is the same.
    """
    n1 = sum(y for _, y in sample)
    n0 = len(sample) - n1
    if not n1 or not n0:
        return NOTHING_LEARNED
    seen = {0: Counter(), 1: Counter()}
    for text, y in sample:
        seen[y].update(words_of(text))
    total = seen[0] + seen[1]
    vocabulary = sorted((w for w, n in total.items() if n >= 2), key=lambda w: (-total[w], w))[:most_words]
    if not vocabulary:
        return NOTHING_LEARNED
    share1, share0 = (np.array([seen[y][w] for w in vocabulary]) / n for y, n in ((1, n1), (0, n0)))
    strength = np.abs(share1 - share0) / np.sqrt((share1 + share0 + 1 / len(sample)) / min(n1, n0))
    telling = np.argsort(-strength, kind="stable")[:candidates]
    picked = [vocabulary[telling[j]] for j in choose_landmarks([vocabulary[i] for i in telling], strength[telling] ** 2, landmarks)]
    sparse = Sparse(picked)
    keys, column = np.unique(sparse.key, return_inverse=True)
    own = np.zeros((len(picked), len(keys)), np.float32)
    np.add.at(own, (sparse.row, column), sparse.value)
    values, vectors = np.linalg.eigh((own @ own.T).astype(float))
    kept = values > 1e-6
    to_map = own.T @ (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float32)  # subsequences to Nystroem features
    del own, sparse
    place = np.zeros(TRIPLES + HASHED, np.int64)
    place[keys] = np.arange(1, len(keys) + 1)
    rows = np.vstack([np.zeros((1, to_map.shape[1]), np.float32), to_map])
    maps = np.zeros((len(vocabulary), to_map.shape[1]), np.float32)
    for at in by_length(vocabulary):
        own_keys, decays = features([vocabulary[i] for i in at])
        where = place[own_keys]
        value = np.zeros((len(at), to_map.shape[1]), np.float32)
        for t in range(where.shape[1]):
            some = np.flatnonzero(where[:, t])
            value[some] += np.float32(decays[t]) * rows[where[some, t]]
        maps[at] = value / norms(own_keys, decays)[:, None].astype(np.float32)
    if not (share1.sum() and share0.sum()):
        return NOTHING_LEARNED
    w = fit_svm(maps, share1 / share1.sum(), share0 / share0.sum(), c)
    model = Model(picked, keys, (to_map @ w[:-1]).astype(np.float32), float(w[-1]), np.zeros(3))
    scorer = model.scorer()
    measured = np.vstack([scorer.measures(pa.array([t for t, _ in sample[i : i + 64]], pa.string())) for i in range(0, len(sample), 64)])
    model.link = platt(measured, np.array([y for _, y in sample], float), prior or n1 / len(sample))
    return model


def platt(measures: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Logistic link from measures to a probability, where the share of class 1 is prior; weights are never negative."""
    x = np.hstack([measures, np.ones((len(measures), 1))])
    weight = np.where(y > 0, prior / y.sum(), (1 - prior) / (len(y) - y.sum())) * len(y)
    used = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x[:, used] @ w[used], -30, 30)))
            g = x[:, used].T @ (weight * (p - y)) + 1e-2 * w[used]
            h = (x[:, used].T * (weight * p * (1 - p))) @ x[:, used] + 1e-2 * np.eye(used.sum())
            w[used] -= np.clip(np.linalg.solve(h, g), -2, 2)
        wrong = (w < 0) & (np.arange(len(w)) < len(w) - 1)
        if not wrong.any():
            return w
        used &= ~wrong


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Only the text is an input of the score.

    Null texts count as empty and score like texts without any known word. A null doc_id is not held out.
    """
    bound_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            got = scorer.scores(batch.column(1))
            others = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64()), *others], ["doc_id", "score", *keep])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("_scored"), *keep)
    scored = rows.mapInArrow(score, StructType([StructField("doc_id", LongType()), StructField("score", DoubleType()), *(rows.schema[k] for k in keep)]))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *keep)


def drop_toxic_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that the model doesn't reject, with all their columns, whatever their names."""
    rows = docs.select("doc_id", "text", whole_row(docs).alias("_whole"))
    return score_documents(rows, model, keep=("_whole",)).where("predicted = 0").select("_whole.*")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, max_chars: int = 20_000_000, landmarks: int = 500) -> Model:
    """Fit on a bounded sample: per_class texts and max_chars characters of either class (the two documented bounds).

    One task holds the sample and trains; only the model comes to the driver. The link takes class 1 for as frequent as
    in the labels, and at least for LEAST_PRIOR. An empty labels table and one of a single class teach nothing.
    """
    bound_batches(docs.sparkSession)
    share = training_labels(labels).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = min(max(share or 0.0, LEAST_PRIOR), 0.99)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        model = train(that_fit(rows, per_class, max_chars), landmarks, prior=prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    learned = labelled_texts(docs, labels, per_class).mapInArrow(learn, "model binary").first()
    return pickle.loads(learned["model"]) if learned else NOTHING_LEARNED
