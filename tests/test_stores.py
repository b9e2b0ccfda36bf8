"""Writers, keyed inserts, models and contracts."""

import pytest

from pyspark.sql import functions as F

from cardlens import schemas
from cardlens.operators import joins, model, monitor, ordered, segments, sketches, training
from cardlens.plans.fixtures import Payments
from cardlens.plans.registry import CONTRACT
from cardlens.sources import slices, tables

SF = "/root/testdata/sf0.001"


def test_insert_if_absent_twice(spark, tmp_path):
    batch = Payments(spark, SF).tx.limit(50)
    path = f"file://{tmp_path}/tx"
    assert tables.insert_if_absent(batch, path, "id", ["created_at"]) == 50
    assert tables.insert_if_absent(batch, path, "id", ["created_at"]) == 0
    assert spark.read.parquet(path).count() == 50


def test_an_id_under_two_dates_is_stored_once(spark, tmp_path):
    path = f"file://{tmp_path}/dated"
    rows = lambda *r: spark.createDataFrame(list(r), "id string, at int, date string")
    assert tables.insert_if_absent(rows(("a", 1, "d1"), ("b", 2, "d1"), ("b", 1, "d2")), path, "id", ["at"], "date") == 2
    assert tables.insert_if_absent(rows(("a", 9, "d3"), ("c", 9, "d3")), path, "id", ["at"], "date") == 1
    assert sorted((r.id, r.at, r.date) for r in spark.read.parquet(path).collect()) == [("a", 1, "d1"), ("b", 1, "d2"), ("c", 9, "d3")]


def test_slices_and_snapshots(spark, tmp_path):
    p = Payments(spark, SF)
    path = f"file://{tmp_path}/f"
    feats = p.features().withColumn("day", F.to_date("created_at"))
    tables.bulk_load(feats, path, "day")
    part = p.features("2024-01-10", "2024-01-12").withColumn("day", F.to_date("created_at"))
    tables.overwrite_slice(part, path, "day")
    back = spark.read.parquet(path).select(feats.columns)
    assert back.count() == feats.count() == 1000
    assert tables.digest(back.drop("day")) == tables.digest(feats.drop("day"))
    version = tables.write_snapshot(feats.drop("day"), f"file://{tmp_path}/s")
    assert tables.write_snapshot(feats.drop("day").repartition(3), f"file://{tmp_path}/s") == version


def test_incremental_equals_full(spark):
    p = Payments(spark, SF)
    full = joins.time_slice(p.features(), "created_at", "2024-01-10", "2024-01-12")
    part = p.features("2024-01-10", "2024-01-12")
    columns = [F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in part.dtypes]
    assert part.select(columns).exceptAll(full.select(columns)).count() == 0 and part.count() == full.count()


def test_contract_round_trip(spark, tmp_path):
    tables.write_contract(spark, CONTRACT, f"file://{tmp_path}/c")
    assert tables.load_contract(spark, f"file://{tmp_path}/c") == CONTRACT


def test_train_score_save(spark, tmp_path):
    p = Payments(spark, SF)
    frame = training.training_frame(p.features(), p.labels)
    train, val = ordered.split_by_time(frame, "event_timestamp", "transaction_id")
    contract = {"columns": ["amount_usd", "channel", "card_amount_zscore"], "encoders": {"channel": {"mobile_app": 0, "pos": 1, "web": 2}}}
    fitted = model.train_classifier(train, val, contract, rounds=3, depth=3)
    scored = model.score_batch(val, fitted, contract, ("transaction_id", "label"))
    assert training.evaluate(scored, "label", "fraud_score", "transaction_id").first()["roc_auc"] > 0.7
    version = model.save_bundle(fitted, contract, {"auc": 1.0}, f"file://{tmp_path}/m", spark)
    again, kept, metrics = model.load_bundle(f"file://{tmp_path}/m", version, spark)
    assert kept == contract and metrics == {"auc": 1.0}
    same = model.score_batch(val, again, contract, ("transaction_id", "label"))
    assert same.exceptAll(scored).count() == 0
    assert len(model.top_features(fitted, contract, 2)) == 2


def test_asof_tolerance_and_ties(spark):
    left = spark.createDataFrame([(1, 10), (1, 3), (2, 5)], "k int, t int").select("k", F.timestamp_seconds("t").alias("t"))
    right = spark.createDataFrame([(1, 2, "a", 1), (1, 2, "b", 2), (1, 9, "c", 3)], "k int, t int, v string, tie int").select("k", F.timestamp_seconds("t").alias("rt"), "v", "tie")
    got = segments.asof(left, right, ["k"], "t", "rt", ["v"], tie="tie").select(F.unix_seconds("t"), "v").collect()
    assert sorted(map(tuple, got), key=str) == [(10, "c"), (3, "b"), (5, None)]
    near = segments.asof(left, right, ["k"], "t", "rt", ["v"], tie="tie", tolerance="0 seconds").select("v").collect()
    assert {r.v for r in near} == {None}


def test_two_phases_and_recalibration(spark):
    """The second fit takes all rows and a tenth more rounds; a recalibrated score keeps its order and nears the rate."""
    p = Payments(spark, SF)
    frame = training.training_frame(p.features(), p.labels)
    train, val = ordered.split_by_time(frame, "event_timestamp", "transaction_id")
    contract = {"columns": ["amount_usd", "channel"], "encoders": {"channel": {"mobile_app": 0, "pos": 1, "web": 2}}}
    fitted = model.two_phase_fit(train, val, contract, rounds=4, depth=2)
    assert 1 <= fitted.stages[-1].getNumTrees <= 5
    scored = model.score_batch(val, fitted, contract, ("transaction_id", "label")).withColumn("fraud_score", F.col("fraud_score") / 3)
    linked = model.platt(scored, "label", "fraud_score")
    assert linked.coefficients[0] > 0
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    got = linked.transform(VectorAssembler(inputCols=["fraud_score"], outputCol="x").transform(scored)).select(F.avg(vector_to_array("probability")[1]), F.avg("label")).first()
    assert abs(got[0] - got[1]) < 0.01


def test_jdbc_insert_if_absent(spark):
    """Into the database that comes with Spark: a batch that comes again adds nothing."""
    url = "jdbc:derby:memory:cards;create=true"
    rows = spark.createDataFrame([("a'1", 1.0), ("b", 2.0), ("b", 3.0)], "id string, amount double")
    rows.limit(0).write.format("jdbc").options(url=url, dbtable="tx", createTableColumnTypes="id VARCHAR(64)").mode("append").save()
    assert tables.insert_if_absent_jdbc(rows, url, "tx", "id", ["amount"]) == 2
    assert tables.insert_if_absent_jdbc(rows.union(spark.createDataFrame([("c", 4.0)], rows.schema)), url, "tx", "id", ["amount"]) == 1
    numbered = spark.range(10).withColumn("x", F.lit(1))
    numbered.write.format("jdbc").options(url=url, dbtable="n").save()
    back = tables.scan_jdbc(spark, url, "n", "id", 0, 10, 3)
    assert back.rdd.getNumPartitions() == 3 and back.count() == 10


def test_percentiles_of_many_ranges(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 101 / 7).alias("x"))
    want = {r.g: (r.a, r.b) for r in rows.groupBy("g").agg(F.percentile("x", 0.5).alias("a"), F.percentile("x", 0.99).alias("b")).collect()}
    got = {r.g: (r.a, r.b) for r in ordered.exact_percentiles(rows, "x", {"a": 0.5, "b": 0.99}, ("g",), range_rows=40).collect()}
    assert set(got) == set(want) and all(abs(x - y) < 1e-9 for g in want for x, y in zip(want[g], got[g], strict=True))


def test_precision_among_ties(spark):
    rows = spark.createDataFrame([(i, 0.5 if i < 60 else i / 1000, int(i % 3 == 0)) for i in range(100)], "t int, s double, y int")
    for frac in (0.01, 0.3, 0.99):
        k = max(1, int(100 * frac))
        want = sum(r.y for r in sorted(rows.collect(), key=lambda r: (-r.s, r.t))[:k]) / k
        assert abs(training.precision_at_k(rows, "y", "s", frac, "t").first()[0] - want) < 1e-6
    assert training.precision_at_k(rows.where("false"), "y", "s", 0.1, "t").first()[0] is None


def test_rounds_are_chosen_by_average_precision(spark):
    """The prefixes' precisions are those of models of that many trees, and the choice is that of a search over them."""
    p = Payments(spark, SF)
    frame = training.training_frame(p.features(), p.labels)
    train, val = ordered.split_by_time(frame, "event_timestamp", "transaction_id")
    contract = {"columns": ["card_amount_zscore", "channel", "card_tx_seq", "hour"], "encoders": {"channel": {"mobile_app": 0, "pos": 1, "web": 2}}}
    train, val = train.cache(), val.cache()
    rounds = 5
    whole = model.train_classifier(train, None, contract, rounds=rounds, depth=3)
    got = {r.rounds: r.average_precision for r in model.precision_by_rounds(whole, val, contract).collect()}
    want = {}
    for n in range(1, rounds + 1):
        part = model.train_classifier(train, None, contract, rounds=n, depth=3)
        scored = model.score_batch(val, part, contract, ("transaction_id", "label"))
        want[n] = training.average_precision(scored, "label", "fraud_score").first()[0]
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-5 for n in want)
    stopped = model.train_classifier(train, val, contract, rounds=rounds, depth=3, patience=2)
    assert stopped.stages[-1].getNumTrees == model.best_rounds([want[n] for n in sorted(want)], 2)
    assert model.best_rounds([0.1, 0.3, 0.2, 0.3, 0.9], 2) == 2 and model.best_rounds([0.1, 0.3, 0.2, 0.3, 0.9], 3) == 5 and model.best_rounds([None], 2) == 1


def test_readers_never_see_half_a_slice(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/slices"
    rows = lambda *r: spark.createDataFrame(list(r), "id int, x string, day string")
    seen = lambda n=None: sorted(map(tuple, slices.read_slices(spark, path, n).select("id", "x", "day").collect()))
    with pytest.raises(FileNotFoundError):
        slices.read_slices(spark, path)
    assert slices.replace_slices(rows((1, "a", "d1"), (2, "b", "d2")), path, "day") == 1
    old = seen()
    with monkeypatch.context() as m:

        def fail(*_):
            raise RuntimeError("lost between write and switch")

        m.setattr(slices, "_switch", fail)
        with pytest.raises(RuntimeError, match="between write and switch"):
            slices.replace_slices(rows((9, "z", "d1"), (9, "z", "d2")), path, "day")
    assert seen() == old == [(1, "a", "d1"), (2, "b", "d2")]
    assert slices.replace_slices(rows((3, "c", "d2"), (4, "d", "d3")), path, "day") == 2
    assert seen() == [(1, "a", "d1"), (3, "c", "d2"), (4, "d", "d3")] and seen(1) == old
    assert slices.replace_slices(rows((5, "e", "d4")), path, "day", drop=("day=d1",)) == 3 and [r[0] for r in seen()] == [3, 4, 5]
    with pytest.raises(RuntimeError, match="another writer"):
        slices._switch(spark, path, 3, {})


def test_a_version_is_there_whole_or_not(spark, tmp_path):
    path = f"file://{tmp_path}/versions"
    assert slices.write_version(spark.range(5), path, "v1") and not slices.write_version(spark.range(9), path, "v1")
    assert spark.read.parquet(path).where("version = 'v1'").count() == 5


def test_quantile_sketches_keep_their_bound_and_merge(spark):
    rows = spark.range(60_000, numPartitions=6).select((F.col("id") % 3).alias("g"), (F.hash("id") % 10_000).cast("double").alias("x"), (F.col("id") % 7).alias("part"))
    rows = rows.unionByName(spark.createDataFrame([(0, None, 0), (9, None, 0)], "g long, x double, part long"))
    parts = sketches.quantile_sketches(rows, "x", ("g", "part"))
    for made in (sketches.quantile_sketches(rows, "x", ("g",)), sketches.merged(parts, ("g",))):
        for r in sketches.quantiles(made, {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect():
            held = sorted(x.x for x in rows.where((F.col("g") == r.g) & F.col("x").isNotNull()).collect())
            assert r.n == len(held) == 20_000
            for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
                below, until = sum(x < r[name] for x in held), sum(x <= r[name] for x in held)
                error = sketches.rank_error() * 1.5 * len(held)  # the bound holds for 99 % of sketches
                assert below - error <= p * len(held) <= until + error
    shifted = rows.withColumn("x", F.col("x") * 0.8 + 500)
    exact = monitor.psi(rows, shifted, "x").first()[0]
    near = sketches.psi(sketches.quantile_sketches(rows, "x", (), 4000), sketches.quantile_sketches(shifted, "x", (), 4000)).first()[0]
    assert abs(exact - near) < 0.02


def test_quantiles_between_sketches_are_exact(spark):
    """Groups of many more rows than a sketch holds, a null group, one without values, and sketches that mislead."""
    rows = spark.range(50_000, numPartitions=4).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.hash("id") % 20_000).cast("double").alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(1, None), (9, None)], "g long, x double"))
    names = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    made = sketches.quantile_sketches(rows, "x", ("g",))
    held = {}
    for r in rows.collect():
        held.setdefault(r.g, []).append(r.x)
    want = {}
    for g, xs in held.items():
        v = sorted(x for x in xs if x is not None)
        want[g] = (len(xs), *[v[max(1, -(-len(v) * round(p * 100) // 100)) - 1] if v else None for p in names.values()])
    misled = sketches.quantile_sketches(rows.withColumn("x", F.col("x") + 1e6), "x", ("g",))
    for found in (made, misled):
        assert {r.g: tuple(r)[1:] for r in sketches.exact_quantiles(rows, "x", found, ("g",), names).collect()} == want
    near = {r.g: (r.p50, r.p99) for r in sketches.quantiles(made, names).collect()}
    assert any(near[g] != (want[g][2], want[g][3]) for g in near)


def test_sketches_of_a_stream(spark, tmp_path):
    logs = Payments(spark, SF).logs.withColumn("created_at", F.col("created_at").cast("timestamp"))
    logs.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(logs.schema).parquet(f"{tmp_path}/in").withWatermark("created_at", "1 hour")
    sketches.latency_by_version(stream, "1 day").writeStream.format("memory").queryName("sk").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    got = {(r.bucket, r.model_version): r.p50 for r in sketches.quantiles(spark.table("sk"), {"p50": 0.5}).collect()}
    assert got == {(r.bucket, r.model_version): r.p50 for r in sketches.quantiles(sketches.latency_by_version(logs, "1 day"), {"p50": 0.5}).collect()} and len(got) > 30


def test_a_slice_that_is_not_covered_stops_the_job(spark):
    p = Payments(spark, SF)
    monitor.raise_if_uncovered(monitor.check_coverage(p.tx, p.features("2024-01-10", "2024-01-12"), "2024-01-10", "2024-01-12"))
    with pytest.raises(ValueError, match="feature rows"):
        monitor.raise_if_uncovered(monitor.check_coverage(p.tx, p.features("2024-01-10", "2024-01-12"), "2024-01-10", "2024-01-13"))


def test_a_table_is_read_by_its_schema(spark, tmp_path):
    p = Payments(spark, SF)
    p.labels.select(*[F.col(f.name).cast(f.dataType) for f in schemas.schema("labels")], F.lit(1).alias("more")).write.parquet(f"{tmp_path}/labels")
    got = tables.scan_table(spark, f"{tmp_path}/labels", "labels")
    assert "more" not in got.columns and got.schema.simpleString() == schemas.schema("labels").simpleString()
