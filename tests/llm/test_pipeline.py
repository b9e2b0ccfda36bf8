"""The stages against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from cardlens.llm import mixing, neardup, packing, toxicity
from cardlens.llm import pipeline as corpus_pipeline
from cardlens.llm.common import durable

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_near_copies_leave_one(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    texts = []
    for _ in range(30):
        own = rng.choices(words, k=200)
        texts.append(" ".join(own))
        for edits in (0, 1, 3):
            copy = list(own)
            for _ in range(edits):
                copy[rng.randrange(200)] = "edit"
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choices(words, k=100) + words[:40]) for _ in range(50)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [shingles(t) for t in texts]
    kept = sorted(r.doc_id for r in neardup.drop_near_duplicates(frame).collect())
    left = [i for i in range(len(texts)) if not any(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 for j in range(i))]
    assert kept == left


def test_near_copies_at_the_border(spark):
    """Pairs just above and just below the similarity are told apart exactly."""
    rng = random.Random(7)
    texts, want = [], []
    for i in range(120):
        # n shingles each, 5 words of an end changed at a time: Jaccard (n - d) / (n + d)
        own = [f"w{rng.randrange(10**9)}" for _ in range(204)]
        d = 21 + i % 3  # of 200: 0.810, 0.802, 0.794
        texts += [" ".join(own), " ".join(own[:-d] + [f"w{rng.randrange(10**9)}" for _ in range(d)])]
        want += [2 * i, 2 * i if (200 - d) / (200 + d) >= 0.8 else 2 * i + 1]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.kept_id for r in neardup.near_groups(frame).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_repeated_lines_do_not_hide_copies(spark):
    """Texts of the same distinct shingles, whose lines are repeated differently often, are near copies."""
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        lines = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(40)) for _ in range(12)]
        for _ in range(2):
            often = rng.sample(range(12), 2)
            texts.append(" ".join(" ".join([line] * (200 if i in often else 2)) for i, line in enumerate(lines)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.kept_id for r in neardup.near_groups(frame).collect()}

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    for i in range(0, len(texts), 2):
        x, y = shingles(texts[i]), shingles(texts[i + 1])
        assert len(x & y) / len(x | y) >= 0.8 and got[i + 1] == i


def test_stages_keep_columns_and_take_effect(spark, docs):
    toxic = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert toxic.schema == docs.schema and 0 < docs.count() - toxic.count() < 0.2 * docs.count()
    masked = corpus_pipeline.mask_personal_data(spark, docs, SF)
    assert masked.schema.simpleString() == docs.schema.simpleString() and masked.count() == docs.count()
    assert masked.where(F.col("text").rlike(r"@mail\d+\.example\.com")).count() == 0 < docs.where(F.col("text").rlike(r"@mail\d+\.example\.com")).count()
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.schema == docs.schema and mixed.distinct().exceptAll(docs).count() == 0 == docs.exceptAll(mixed).count()


CLASHING = "_whole _id _hash _spans _new _kept _n _d _row _file _part _number _metadata _to _salt _rank score predicted held_out _scored code h bands sketch kept_id slot place block base learned".split()


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "no id"), (2, ""), (2, "two rows of one id"), (3, "call a.b@c.de now " + "y " * 9000), (4, "call a.b@c.de now " + "y " * 9000)]])
def test_stages_bear_odd_rows_and_clashing_names(spark, rows):
    frame = spark.createDataFrame([(i, t, "en", None if i == 2 else "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.withColumns({c: F.lit(7) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, frame, SF)
        if name == "packing":
            assert got.groupBy("doc_id", "start").count().count() >= len({i for i, _ in rows})
        else:
            assert got.dtypes == frame.dtypes and got.distinct().count() == len(rows) - (2 if rows and name == "near_duplicates" else 0), name
            assert got.where("_metadata <> 7 or score <> 7").count() == 0


def test_sequences_follow_the_mix(spark, docs):
    mixed = durable(mixing.mix(docs, mixing.counted_weights(docs, power=0.5), end="rest"), "mixed")
    place = {r.doc_id: i for i, r in enumerate(packing.with_place(mixed).orderBy("_part", "_file", "_row").select("doc_id").collect())}
    got = corpus_pipeline.pack(spark, mixed, SF).toPandas()
    first = got.assign(at=got.doc_id.map(place)).groupby("sequence_id").at.min()
    assert first.is_monotonic_increasing and sorted(first.index) == list(range(len(first)))
    plain = packing.pack_documents(docs).toPandas()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, got[columns].values)) == sorted(map(tuple, plain[columns].values))
    assert got.sequence_id.nunique() == plain.sequence_id.nunique()
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 1024


def test_run_packs_what_stages_keep(spark, docs):
    got = corpus_pipeline.run(spark, SF)
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score_documents(docs, model).where("predicted = 0").collect()}
    kept = {r.kept_id for r in neardup.near_groups(docs.where(F.col("doc_id").isin(clean))).collect()}
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == kept
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
