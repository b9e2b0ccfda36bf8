"""Histories of very large keys go over segments of time with the same results."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.functions import windows
from cardlens.operators import history, segments, training
from cardlens.plans.features import build_features
from cardlens.plans.fixtures import Payments

SF = "/root/testdata/sf0.001"


def rounded(df, key="transaction_id"):
    return {r[key]: r for r in df.select(*[F.round(c, 5).alias(c) if t == "double" else c for c, t in df.dtypes]).collect()}


def test_segments_of_hot_keys_add_up(spark):
    p = Payments(spark, SF)
    # some amounts that stay equal for long: no spread, no score
    tx = p.tx.withColumn("amount_usd", F.when(F.col("card_id") % 3 == 0, 20.1).otherwise(F.col("amount_usd")))
    whole = build_features(tx, p.users, p.cards, p.merchants)
    split = build_features(tx, p.users, p.cards, p.merchants, hot_rows=8, segment_rows=60)
    assert history.hot_keys(tx, ("card_id",), 8)["card_id"].count() > 0 and not history.hot_keys(tx, ("card_id", "user_id"))
    assert split.schema.simpleString() == whole.schema.simpleString()
    assert rounded(split) == rounded(whole)


@pytest.fixture(scope="module")
def busy(spark):
    """One card has a third of all rows, all of one day; times and amounts repeat, some are null."""
    rng = random.Random(6)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        at = 1_700_000_000_000_000 + (rng.randrange(86_400) * 1_000_000 if hot else rng.randrange(40 * 86_400) * 1_000_000)
        rows.append((i, 1 if hot else 2 + i % 50, None if i % 97 == 0 else at, None if i % 31 == 0 else round(rng.random() * 90, 2), rng.choice(["declined", "approved", None]), rng.choice([1, 2, 3, 4, None])))
    frame = spark.createDataFrame(rows, "id long, card_id long, at long, amount_usd double, status string, merchant_id long")
    return frame.select("id", "card_id", F.timestamp_micros("at").alias("created_at"), "amount_usd", "status", "merchant_id").cache()


def test_a_busy_day_of_one_key(spark, busy):
    whole = history.with_field(busy, "card_id", history.CARD_FIELDS)
    split = history.with_field(busy, "card_id", history.CARD_FIELDS, hot_rows=200, segment_rows=25)
    assert rounded(split, "id") == rounded(whole, "id")
    timed = segments.timed(busy)
    cut = segments.in_ranges(timed, "_at", segments.splits_of(timed, 25), "_seg").where("card_id = 1")
    sizes = sorted(r["count"] for r in cut.groupBy("_seg").count().collect())
    assert len(sizes) >= 10 and sizes[-1] <= 25 * 2  # no segment of the hot key holds much more than its share


def test_running_totals_before(spark, busy):
    prior = windows.by_time("card_id").rowsBetween(Window.unboundedPreceding, -1)
    x = F.col("amount_usd")
    want = {r.id: tuple(r) for r in busy.select("id", F.count(x).over(prior).alias("n"), F.coalesce(F.sum(x).over(prior), F.lit(0.0)).alias("total"), F.avg(x).over(prior).alias("mean")).collect()}
    for size in (30, 10_000):
        got = history.running_prior(busy, "card_id", "amount_usd", size).select("id", "n", "total", "mean").collect()
        assert len(got) == len(want) and all(tuple(r) == pytest.approx(want[r.id], abs=1e-8) for r in got)


@pytest.mark.parametrize("size", [30, 10_000])
def test_distinct_values_of_a_span(spark, busy, size):
    """Against a set for each row."""
    timed = segments.timed(busy.where("created_at is not null"))
    got = segments.distinct_in_span(timed, "card_id", "merchant_id", 3_600_000_000, "kinds", segments.splits_of(timed, size))
    want = timed.select("id", F.expr("size(collect_set(merchant_id) OVER (PARTITION BY card_id ORDER BY _at RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW))").alias("kinds"))
    assert {r.id: r.kinds for r in got.collect()} == {r.id: r.kinds for r in want.collect()}


@pytest.mark.parametrize("size", [30, 10_000])
def test_asof_of_a_busy_key(spark, busy, size):
    """Against every earlier row of the key; keys and times may be null on both sides."""
    right = busy.where("id % 4 <> 1").select(F.when(F.col("id") % 50 > 0, F.col("card_id")).alias("k"), F.col("created_at").alias("rt"), "amount_usd", F.col("id").alias("rid"))
    left = busy.where("id % 2 = 1").select("id", F.when(F.col("id") % 40 > 0, F.col("card_id")).alias("k"), F.col("created_at").alias("t")).unionByName(busy.where("id % 6 = 0").select((F.col("id") + 5000).alias("id"), F.col("card_id").alias("k"), F.col("created_at").alias("t")))
    got = segments.asof(left, right, ["k"], "t", "rt", ["amount_usd", "rid"], tie="rid", tolerance="10 days", segment_rows=size)
    pairs = left.alias("l").join(right.alias("r"), (F.col("l.k") == F.col("r.k")) & (F.col("r.rt") <= F.col("l.t")))
    best = pairs.groupBy("l.id").agg(F.max_by(F.struct("r.rid", "r.rt", "l.t"), F.struct("r.rt", F.col("r.rid").cast("string"))).alias("b")).where("b.rt >= b.t - INTERVAL 10 DAYS")
    want = {r.id: r.b.rid for r in best.collect()}
    assert {r.id: r.rid for r in got.collect()} == {r.id: want.get(r.id) for r in left.collect()}


def test_versions_valid_at_a_time(spark, busy):
    rows = [(k, v, 1_700_000_000 + v * 20_000, None if v == 5 else 1_700_000_000 + v * 20_000 + (20_000 if v != 2 else 5_000)) for k in range(1, 9) for v in range(6)]
    dim = spark.createDataFrame(rows, "card_id long, version int, f long, t long").select("card_id", "version", F.timestamp_seconds("f").alias("valid_from"), F.timestamp_seconds("t").alias("valid_to"))
    got = {r.id: r.version for r in training.scd2_asof(busy, dim, "card_id", "created_at", segment_rows=40).collect()}
    inside = (F.col("created_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("created_at") < F.col("valid_to")))
    want = {r.id: r.version for r in busy.alias("b").join(dim.alias("d"), (F.col("b.card_id") == F.col("d.card_id")) & inside, "left").select("id", "version").collect()}
    assert got == want


def test_medians_of_gaps(spark, busy):
    """Against Spark's percentile over each row's frame."""
    rows = busy.where("created_at is not null")
    gaps = rows.withColumn("g", windows.gap_seconds("card_id"))
    want = gaps.select("id", F.round(windows.trailing("percentile(g, 0.5)", "card_id", "1 hours"), 6).alias("m"))
    assert {r.id: r.gap_median for r in history.gap_median(rows, "card_id", "1 hour", 40).collect()} == {r.id: r.m for r in want.collect()}
    assert history.gap_median(busy, "card_id").count() == 900


def test_small_blocks_share_batches_and_agree_with_the_tree(monkeypatch):
    names = ["_hash", "_key", "_block", "_at", "_gap", "_copy", "id"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in ([1] * 5000, ["k"] * 5000, range(5000), range(5000), [1.5] * 5000, [0] * 5000, range(5000))], names)
    out = list(history.medians_of(iter([batch]), 10, pa.int64()))
    assert len(out) == 1 and out[0].num_rows == 5000 and set(out[0]["gap_median"].to_pylist()) == {1.5}
    rng = random.Random(3)
    for _ in range(50):
        times = sorted(rng.randrange(1000) for _ in range(rng.randrange(1, 200)))
        rows = [(t, rng.choice([None, float(rng.randrange(20))]), rng.randrange(2), i) for i, t in enumerate(times)]
        few = history.block_medians(rows, 100)
        monkeypatch.setattr(history, "FEW_ROWS", 0)
        assert few == history.block_medians(rows, 100)
        monkeypatch.undo()


def test_a_block_of_many_rows_takes_no_frame_each():
    rng = random.Random(1)
    rows = [(i * 10, rng.random(), 0, i) for i in range(60_000)]
    out = history.block_medians(rows, 300_000)
    assert len(out) == 60_000
    for i in rng.sample(range(60_000), 30):
        held = sorted(r[1] for r in rows if rows[i][0] - 300_000 <= r[0] <= rows[i][0])
        assert out[i][1] == (held[(len(held) - 1) // 2] + held[len(held) // 2]) / 2
