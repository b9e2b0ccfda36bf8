"""Phrase collocations by Toivonen's method: a sample proposes, one pass over all texts counts proposals and their border."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import SALTS, bound_batches, durable

LONGEST = 5
#: Share of documents in the sample, and how far below its expectation a proposal's count there may lie, in deviations.
SAMPLE, SLACK = 0.1, 2.2
#: Membership filters have at least this many bits a key, up to MOST_BITS (32 MB). A fuller filter lets more phrases be
#: counted than needed; it never loses one.
BITS_A_KEY, MOST_BITS = 16, 1 << 28
FLUSH = 1_000_000  # occurrences that a task adds up before it sends their sums on
CHUNK = 2 << 20  # bytes of text cut into words at a time, to the end of a piece

MARK = b"\xff"  # between pieces; in no UTF-8 text
SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", MARK * 10 + b" ")
FACTOR, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
Filters = dict[int, np.ndarray]


Tokens = tuple[list[bytes], np.ndarray]


def chunks_of_tokens(texts: list[str | None]) -> Iterator[Tokens]:
    """(distinct words, the place among them of each word in order), with a MARK between pieces; chunks end with a piece."""
    blob = MARK.join([(t or "").encode() for t in texts]).lower().translate(SEPARATORS)
    start = 0
    while start < len(blob):
        end = blob.find(MARK, start + CHUNK)
        end = len(blob) if end < 0 else end
        spaced = blob[start:end].replace(MARK, b" \xff ")
        start = end + 1
        tokens = pc.split_pattern(pa.array([spaced], pa.binary()), b" ").values.dictionary_encode()
        words, at = tokens.dictionary.to_pylist(), tokens.indices.to_numpy()
        if b"" in words:  # between spaces
            at = at[at != words.index(b"")]
        if len(at):
            yield words, at


def by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """The tokens of a task's texts by language, which are held until they make a chunk: a word is looked at once a chunk."""
    held: dict[str, list] = {}
    size: dict[str, int] = {}

    def tokens(langs: list[str]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang in langs:
            size.pop(lang)
            for words, at in chunks_of_tokens(held.pop(lang)):
                yield lang, words, at

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text or "")
        yield from tokens([lang for lang, n in size.items() if n >= CHUNK])
        if sum(size.values()) >= 2 * CHUNK:
            yield from tokens(list(size))
    yield from tokens(list(size))


def filters_of(keys: DataFrame) -> Filters:
    """For each k of the keys (k, h) a filter: a power of two of bits, two set for each key. Made by Spark; at most MOST_BITS
    a filter come back."""
    sizes = {}
    for k, n in keys.groupBy("k").count().collect():
        sizes[k] = 1 << 12
        while sizes[k] < min(n * BITS_A_KEY, MOST_BITS):
            sizes[k] *= 2
    if not sizes:
        return {}
    last = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, n - 1)])[F.col("k")].cast("long")
    places = keys.select("k", F.explode(F.array(F.col("h").bitwiseAND(last), F.shiftrightunsigned("h", 32).bitwiseAND(last))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = places.groupBy("k", F.shiftright("at", 6).alias("i")).agg(F.bit_or(bit).alias("w")).toArrow()
    level, at, word = (words[c].to_numpy() for c in ("k", "i", "w"))
    out = {}
    for k, n in sizes.items():
        bits = np.zeros(n // 64, np.int64)
        bits[at[level == k]] = word[level == k]
        out[k] = bits.view(np.uint64)
    return out


def test_bits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    size = np.uint64(len(bits) * 64 - 1)
    low, high = h & size, (h >> np.uint64(32)) & size

    def at(place: np.ndarray) -> np.ndarray:
        return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)

    return (at(low) & at(high)).astype(bool)


def narrowed(mask: np.ndarray, bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """The places of the mask whose hash the filter holds."""
    out = np.zeros(len(mask), bool)
    if bits is not None:
        at = np.flatnonzero(mask)
        out[at] = test_bits(bits, h[at])
    return out


class Grams:
    """Hashes of the phrases that begin at each word of a chunk. A phrase's hash follows from its words' and its language.
    Nothing is kept from chunk to chunk: a word's hash is made again as fast as it would be looked up."""

    @staticmethod
    def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
        seed = xxhash.xxh32_intdigest(lang.encode())
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))

    def hashes(self, lang: str, words: list[bytes], at: np.ndarray, longest: int = LONGEST) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(hash, inside one piece) of the phrases of 1, 2, ... longest words at each place."""
        h = self.word_hashes(lang, words)[at]
        inside = at != (words.index(MARK) if MARK in words else -1)
        all_h, all_inside = [h], [inside]
        for k in range(1, longest):
            mixed = (all_h[-1][:-1] * FACTOR) ^ h[k:]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * SPREAD
            all_h.append(mixed ^ (mixed >> np.uint64(32)))
            all_inside.append(all_inside[-1][:-1] & inside[k:])
        return all_h, all_inside


def extensible(h: list[np.ndarray], inside: list[np.ndarray], passes: list[Filters]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """For k from 2 up, the places of phrases of k words that the last of the passes counts, and that those before have counted.

    A pass counts phrases both of whose parts of k - 1 words its filters hold. In passes after the first, a part also counts
    as held if this pass is the first to count it: it then has a border failure within, and may turn out frequent. So all
    longer phrases over a failure are counted in the same pass.
    """
    known = {k: np.zeros(len(inside[k - 1]), bool) for k in range(2, len(h) + 1)}
    now = known
    for number, filters in enumerate(passes):
        known = {k: known[k] | now[k] for k in known}
        member = narrowed(inside[0], filters.get(1), h[0])
        now = {}
        for k in known:
            now[k] = member[:-1] & member[1:] & inside[k - 1]
            member = narrowed(now[k], filters.get(k), h[k - 1])
            if number:
                member |= now[k] & ~known[k]
    return now, known


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, added up in the tasks; word is null in the rows of whole languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, at in by_lang(batches):
            rows = [(w.decode(), c) for w, c in zip(words, np.bincount(at, minlength=len(words)).tolist()) if c and w != MARK]
            total = sum(c for _, c in rows)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(rows) + 1)), pa.array([*(w for w, _ in rows), None], pa.string()), pa.array([*(c for _, c in rows), total], pa.int64())], ["lang", "word", "n"])

    return docs.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def hash_counts(docs: DataFrame, levels: tuple[int, ...], passes: list[Filters]) -> DataFrame:
    """(k, h, n): occurrences, by their hash, of the phrases of k words in `levels` that the last pass counts and none before."""
    held = docs.sparkSession.sparkContext.broadcast(passes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, filters = Grams(), held.value
        kept: dict[int, list[np.ndarray]] = {k: [] for k in levels}

        def sums() -> Iterator[pa.RecordBatch]:
            for k, parts in kept.items():
                if parts:
                    h, n = np.unique(np.concatenate(parts), return_counts=True)
                    parts.clear()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)), pa.array(n)], ["k", "h", "n"])

        for lang, words, at in by_lang(batches):
            h, inside = grams.hashes(lang, words, at, max(levels))
            wanted, known = extensible(h, inside, filters)
            for k in levels:
                take = wanted[k] & ~known[k]
                if take.any():
                    kept[k].append(h[k - 1][take])
            if sum(len(p) for parts in kept.values() for p in parts) >= FLUSH:
                yield from sums()
        yield from sums()

    return docs.mapInArrow(count, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, wanted: Filters) -> DataFrame:
    """(lang, phrase, n) of the phrases whose hash the filters hold, counted by their words, so that hashes that fall together
    don't matter."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, filters = Grams(), held.value
        for lang, words, at in by_lang(batches):
            h, inside = grams.hashes(lang, words, at)
            at = at.astype(np.int64)
            names, counts = [], []
            for k in range(2, LONGEST + 1):
                place = np.flatnonzero(narrowed(inside[k - 1], filters.get(k), h[k - 1]))
                if len(place):
                    first, n = distinct_rows([at[place + j] for j in range(k)], len(words))
                    begins = [list(map(words.__getitem__, at[place[first] + j].tolist())) for j in range(k)]
                    names += [b" ".join(t).decode() for t in zip(*begins)]
                    counts.append(n)
            if names:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array(names), pa.array(np.concatenate(counts))], ["lang", "phrase", "n"])

    return docs.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def distinct_rows(columns: list[np.ndarray], kinds: int, inverse: bool = False) -> tuple[np.ndarray, ...]:
    """(first place, count) of each distinct row of columns of numbers below `kinds`; with `inverse`, also each row's number
    among the distinct ones."""
    code, size = columns[0], kinds
    for c in columns[1:]:
        if size * kinds >= 1 << 62:
            _, code = np.unique(code, return_inverse=True)
            size = int(code.max()) + 1
        code, size = code * kinds + c, size * kinds
    if inverse:
        _, first, of, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        return first, n, of
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return first, n


def frequent_phrases(docs: DataFrame, least: int, sample: float = SAMPLE, slack: float = SLACK, passes: list | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases (lang, phrase, n) of 2 to LONGEST words, words (lang, phrase, n), totals (lang, n)) with counts of `least` or more,
    exact over the rows (lang, text) of docs, which also have doc_id.

    1. All words are counted. 2. A sample of documents is mined level by level under a lowered threshold. 3. One pass over
    all documents counts the phrases that the sample proposes and those of the negative border: not proposed, but all their
    parts are. 4. Frequent border phrases are failures: they join the proposals, and a pass counts every phrase that this
    opens, with all longer ones over it, so that nothing is left uncounted. 5. Passes count by 64-bit hashes; phrases that
    may be frequent are counted by their words. `passes` gets the failures of each pass: of the last, all opened already.
    """
    bound_batches(docs.sparkSession)
    words = durable(word_counts(docs).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = words.where("word is null").select("lang", F.col("n").alias("n"))
    frequent_words = words.where("word is not null").select("lang", F.col("word").alias("phrase"), "n")
    filters = filters_of(word_keys(frequent_words))
    expected = least * sample
    enough = max(2, int(expected - slack * expected**0.5)) if sample < 1 else least
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(sample * 1_000_000))
    proposed = docs.sparkSession.createDataFrame([], "k int, h long")
    for k in range(2, LONGEST):  # nothing is longer than proposals of LONGEST words would be
        level = durable(hash_counts(some, (k,), [filters]).where(F.col("n") >= enough).select("k", "h"), f"sample{k}")
        filters |= filters_of(level)
        proposed = proposed.unionByName(level)
    levels = tuple(range(2, LONGEST + 1))
    counted = durable(hash_counts(docs, levels, [filters]).where(F.col("n") >= least), "counted")
    failures = durable(counted.where(F.col("k") < LONGEST).select("k", "h").join(proposed, ["k", "h"], "left_anti"), "failures")
    found = [failures.count()]
    if found[0]:
        again = [filters, {1: filters[1], **filters_of(proposed.unionByName(failures))}]
        more = durable(hash_counts(docs, levels[1:], again).where(F.col("n") >= least), "counted")
        found.append(more.where(F.col("k") < LONGEST).count())
        counted = counted.unionByName(more)
    if passes is not None:
        passes.extend(found)
    phrases = durable(phrase_counts(docs, filters_of(counted.select("k", "h"))).where(F.col("n") >= least), "phrases")
    return phrases, frequent_words, totals


def word_keys(words: DataFrame) -> DataFrame:
    """(k, h) of the words, as the tasks make it."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [xxhash.xxh64_intdigest(w.encode(), xxhash.xxh32_intdigest(lang.encode())) for lang, w in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), 1, np.int32)), pa.array(np.array(h, np.uint64).view(np.int64))], ["k", "h"])

    return words.select("lang", "phrase").mapInArrow(keys, "k int, h long")


def cut(words: Column, start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, share: int = 100, **sampling) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to 5 words.

    a is the phrase's count in all texts (least or more), n its language's words. Of the cuts into two parts with counts l and
    r, the one with the lowest score floor(1000 a n / (l r)) counts, ties to the shortest first part. A phrase inside a longer
    one that comes at least share % as often is dropped. Null texts are empty, a null lang is `und`; repeated rows count each
    time; columns besides doc_id, lang and text are not read. The first `top` by score, a, then phrase are returned.
    """
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    phrases, words, totals = frequent_phrases(rows, least, **sampling)
    split = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    size = F.size("w")
    counts = phrases.unionByName(words)
    cuts = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", cut(F.col("w"), 1, F.col("k")).alias("left"), cut(F.col("w"), F.col("k") + 1, size - F.col("k")).alias("right")
    )
    big = lambda c: F.col(c).cast("decimal(20,0)")
    scored = (
        cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
        .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
        .join(totals, "lang")
        .withColumn("score", F.call_function("div", (big("a") * big("n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"), (big("l") * big("r")).cast("decimal(38,0)")))
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("best")).select("lang", "phrase", "best.*")
    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("w", i, m), " ")))
    )
    inside = split.where(size > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # a language's phrases are cut down by salts first, so that its last task ranks at most SALTS * top of them
    dealt = kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
