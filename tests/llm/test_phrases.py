"""Phrase collocations against plain counts."""

import collections
import random
import re
import tracemalloc

import pytest

from cardlens.llm import phrases

DOCS = "doc_id long, text string, lang string, rank long, k int"
POOL = "a b c d e A B".split()


def plain(rows, least, top, share=100):
    """The contract, count by count."""
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    best = collections.defaultdict(list)
    held = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= least}
    for (lang, p), a in held.items():
        if any(q != p and lq == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (lq, q), b in held.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        best[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, held in best.items() for i, (s, a, p, l, r) in enumerate(sorted(held)[:top]))


@pytest.mark.parametrize("sample", [0.1, 0.5, 1.0])
def test_collocations_are_the_plain_ones(spark, sample):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(POOL) + rng.choice([" "] * 12 + ["\t ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(0, 60))), rng.choice(["en", "fr", None]), 1, 2) for i in range(120)]
    rows += [(None, "x y z x y z", None, 1, 2)] * 30 + [(5, None, "en", 1, 2), (6, "", "", 1, 2), (7, "\u00e9\u00c9 \U0001f600 q " * 40, "en", 1, 2)]
    passes = []
    got = phrases.collocations(spark.createDataFrame(rows, DOCS).repartition(5), least=25, top=40, sample=sample, passes=passes)
    assert sorted(map(tuple, got.collect())) == plain(rows, 25, 40)
    assert passes[0] == 0 if sample == 1.0 else passes


def test_border_failures_are_made_up_for(spark):
    """A passage that the sample can't see is counted at all lengths."""
    rows = [(i, "one two three four five six", "en", 0, 0) for i in range(300)]
    frame = spark.createDataFrame(rows, DOCS)
    passes = []
    got = phrases.collocations(frame, sample=0.000001, passes=passes).collect()
    assert sorted(r["phrase"] for r in got) == ["one two three four five", "two three four five six"] and passes[0] == 5


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, 0, 0)], DOCS)).count() == 0
    assert phrases.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_words_of_earlier_chunks_are_not_kept():
    """Hashes of 300,000 words leave nothing behind, and the same words give the same hashes."""
    grams, before = phrases.Grams(), None
    tracemalloc.start()
    for chunk in range(30):
        words = [b"w%d" % i for i in range(chunk * 10_000, (chunk + 1) * 10_000)]
        h = grams.word_hashes("en", words)
        assert h[7] == phrases.xxhash.xxh64_intdigest(words[7], phrases.xxhash.xxh32_intdigest(b"en"))
        del words, h
        before = before or tracemalloc.get_traced_memory()[0]
    grown = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert grown < 1_000_000
