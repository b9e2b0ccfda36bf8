"""Quality rules against plain counts and a plain likelihood ratio."""

import collections
import math
import random
import re

import pytest

from cardlens.llm import quality

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, good int, n_words int, h string"
LABELS = "doc_id long, quality int, toxic int"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated)


def test_base_counts():
    rng = random.Random(5)
    texts = ["", " \n\t", "a\x0bb\x0cc\u00a0d\x1ce", "x " * 500, "a b c d e\na b c d e\n\n", "\u00e9 | # \U0001f600\n" * 3, "one two three four five six"]
    texts += ["".join(rng.choice(["a", "bb", "c"]) + rng.choice(" \n\t ") for _ in range(rng.randrange(80))) for _ in range(60)]
    texts += [" ".join(f"w{rng.randrange(20_000)}" for _ in range(30_000)) + " a b c d e f a b c d e"]
    for text in texts:
        assert quality.base_counts(text) == plain_counts(text), text[:80]


def test_judge_is_the_plain_ratio(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.judge(docs.repartition(6), labels).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    marks = {r["_id"]: r for r in quality.labelled(labels).collect()}
    assert sorted(got) == sorted(texts) and len(marks) == labels.count()
    hashed, total, good = quality.Hashed(quality.BUCKETS), collections.Counter(), collections.Counter()
    grams = {i: hashed.of(t).tolist() for i, t in texts.items()}
    for i, own in grams.items():
        total.update(own)
        if i in marks and marks[i]["good"] and marks[i]["fit"]:
            good.update(own)
    nt, ng, b = sum(total.values()), sum(good.values()), quality.BUCKETS
    for i, own in grams.items():
        score = sum(math.log((good[x] + 1) / (ng + b)) - math.log((total[x] + 1) / (nt + b)) for x in own) / (len(own) + quality.PRIOR)
        assert got[i]["score"] == pytest.approx(score, abs=1e-9)
        n = plain_counts(texts[i])
        assert tuple(got[i][c] for c in quality.COUNTS) == n
        assert got[i]["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
    kept = [r["score"] for r in got.values() if r["kept"]]
    lost = [r["score"] for r in got.values() if not r["kept"] and not r["base_failed"]]
    assert max(lost) < min(kept)  # one threshold for all
    held = [(marks[i]["good"], r) for i, r in got.items() if i in marks and not r["base_failed"] and not marks[i]["fit"]]
    assert sum(r["kept"] for g, r in held if g) == sum(g for g, _ in held)  # no clean one is lost
    assert sum(not r["kept"] for g, r in held if not g) >= 0.8 * sum(not g for g, _ in held)


def test_threshold_lies_in_the_gap(spark):
    frame = spark.createDataFrame([(True, 0.1 * i) for i in range(10)] + [(False, -1.0 - 0.1 * i) for i in range(5)], "good boolean, score double")
    assert -1.0 < quality.threshold(frame) < 0.0
    assert quality.threshold(frame.where("good")) == quality.threshold(frame.where("not good")) == float("-inf")
    mixed = spark.createDataFrame([(i % 2 == 0, i * 0.01) for i in range(100)], "good boolean, score double")
    assert quality.threshold(mixed) == float("-inf")  # no junk is worth so many trusted ones


def test_all_labelled_rows_count(spark):
    """Also beyond the 200,000 of the least hashes, and with ids that come twice or are null."""
    labels = spark.range(300_000).selectExpr("id AS doc_id", "CAST(id % 5 > 0 AS INT) AS quality", "0 AS toxic")
    marks = quality.labelled(labels)
    assert marks.count() == 300_000 and 0.3 < marks.where("not fit").count() / 300_000 < 0.36
    rows = spark.createDataFrame([(i % 6 if i % 7 else None, f"t{i}") for i in range(60)], "doc_id long, text string")
    got = {r["text"]: r["trusted"] for r in quality.with_trust(rows, spark.createDataFrame([(1,), (4,)], "_id long")).collect()}
    assert got == {f"t{i}": bool(i % 7) and i % 6 in (1, 4) for i in range(60)}


def test_odd_rows(spark):
    rows = [(1, None, 1, 2, "h"), (None, "a text of ten words or more than that, it should be", 1, 2, "h"), (2, "", 1, 2, "h"), (3, "x" * 300_000, 1, 2, "h"), (4, "same " * 30, 1, 2, "h"), (4, "same " * 30, 1, 2, "h")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 0), (2, 1, None), (99, 0, 0)], LABELS)
    for marks in (labels, labels.limit(0)):
        got = {(r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in quality.judge(docs, marks).collect()}
        assert got == {(1, 0, True, False), (None, 12, False, True), (2, 0, True, False), (3, 1, True, False), (4, 30, True, False)}
    assert quality.judge(docs, labels).count() == 6 and quality.judge(docs.limit(0), labels).count() == 0
