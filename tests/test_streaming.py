"""Streams: parity of velocity state with the window features, retries, status events, ingest."""

import json
import random
import sys
import time

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cardlens.operators import training
from cardlens.plans.fixtures import Payments
from cardlens.streaming import ingest, velocity

SF = "/root/testdata/sf0.001"
EVENTS = "card_id long, id string, amount double, at long, declined boolean, kind string"


def replay(spark, rows, key, tmp_path, cuts, initial=None):
    """Feed rows in slices of time, one file and micro-batch each; return all output rows."""
    source = f"{tmp_path}/{key}-in"
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        rows.where((F.col("at") >= a) & (F.col("at") < b)).coalesce(1).write.parquet(f"{source}/part={i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    name = f"out_{key}_{abs(hash(str(tmp_path)))}"
    q = velocity.velocity_stream(stream, key, initial).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{key}-ck").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_card_velocity_equals_windows(spark, tmp_path):
    p = Payments(spark, SF)
    rows = velocity.events(p.tx, "card_id")
    lo, hi = rows.agg(F.min("at"), F.max("at")).first()
    step = (hi - lo) // 3 + 1
    got = replay(spark, rows, "card_id", tmp_path, [lo, lo + step, lo + 2 * step, hi + 1]).toPandas().set_index("id").sort_index()
    want = p.features().select(F.col("transaction_id").cast("string").alias("id"), "card_tx_count_1h", "card_tx_count_24h", "card_amount_sum_24h", "card_declines_24h", "card_seconds_since_last_tx", "card_amount_zscore", "card_tx_seq").toPandas().set_index("id").sort_index()
    assert len(got) == len(want) == 1000
    for ours, theirs in (("tx_count_1h", "card_tx_count_1h"), ("tx_count_24h", "card_tx_count_24h"), ("declines_24h", "card_declines_24h"), ("tx_seq", "card_tx_seq")):
        assert (got[ours].astype(int) == want[theirs].astype(int)).all(), ours
    for ours, theirs in (("amount_sum_24h", "card_amount_sum_24h"), ("seconds_since_last_tx", "card_seconds_since_last_tx"), ("amount_zscore", "card_amount_zscore")):
        assert got[ours].isna().equals(want[theirs].isna()), ours
        assert (got[ours] - want[theirs]).abs().max() < 1e-6


def test_seeded_state_goes_on(spark, tmp_path):
    p = Payments(spark, SF)
    ref = "2024-01-15 00:00:00"
    after = p.tx.where(f"created_at > TIMESTAMP '{ref}'")
    rows = velocity.events(after, "user_id")
    lo, hi = rows.agg(F.min("at"), F.max("at")).first()
    got = replay(spark, rows, "user_id", tmp_path, [lo, hi + 1], training.initial_state(p.tx, "user_id", ref)).toPandas().set_index("id").sort_index()
    want = p.features().where(f"created_at > TIMESTAMP '{ref}'").select(F.col("transaction_id").cast("string").alias("id"), "user_tx_count_24h", "user_amount_sum_24h").toPandas().set_index("id").sort_index()
    assert (got["tx_count_24h"].astype(int) == want["user_tx_count_24h"].astype(int)).all()
    assert (got["amount_sum_24h"] - want["user_amount_sum_24h"]).abs().max() < 1e-6


def test_retry_and_status(spark, tmp_path):
    t = 1_700_000_000_000_000
    schema = "card_id long, id string, amount double, at long, declined boolean, kind string"
    rows = [(1, "a", 10.0, t, False, "transaction"), (1, "b", 20.0, t + 1000, False, "transaction"), (1, "b", 20.0, t + 2000, False, "transaction"), (1, "b", 0.0, t + 3000, True, "status"), (1, "c", 5.0, t + 4000, False, "transaction")]
    got = replay(spark, spark.createDataFrame(rows, schema), "card_id", tmp_path, [t, t + 1500, t + 2500, t + 5000]).toPandas()
    b = got[got.id == "b"]
    assert len(b) == 2 and b.tx_seq.nunique() == 1 and b.amount_sum_24h.tolist() == [30.0, 30.0]
    c = got[got.id == "c"].iloc[0]
    assert (c.tx_seq, c.declines_24h, c.amount_sum_24h) == (3, 1, 35.0)


GOOD = '{"request_id":"%s","transaction_id":"%s","user_id":"u","card_id":"c","amount_usd":1.5,"status":"approved","transaction_time":"2024-01-0%dT00:00:00Z","model_version":"v","fraud_score":0.1,"prediction":0}'


def deliver(spark, tmp_path, name, lines):
    """Send lines as a file and let the stream take what is new."""
    where = [f"file://{tmp_path}/{x}" for x in ("tx", "logs", "bad")]
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(lines))
    for q in ingest.ingest(ingest.read_messages(spark, {"format": "text", "path": f"{tmp_path}/in"}), *where, f"{tmp_path}/ck"):
        q.awaitTermination()
    return [spark.read.parquet(w) for w in where]


def test_ingest_stores_an_id_once_and_quarantines(spark, tmp_path):
    lines = [GOOD % ("r1", "t1", 1), GOOD % ("r2", "t2", 2), GOOD % ("r1", "t1", 1), "not json", '{"transaction_id":null}']
    tx, logs, bad = deliver(spark, tmp_path, "1.txt", lines)
    assert tx.count() == logs.count() == bad.count() == 2 and logs.where("latency_ms = 0").count() == 2
    # under other dates; r3 is a new request for a known transaction, a message without a request is told by its content
    bare = GOOD.replace('"request_id":"%s",', "") % ("t5", 5)
    tx, logs, bad = deliver(spark, tmp_path, "2.txt", [GOOD % ("r1", "t1", 7), GOOD % ("r3", "t2", 8), GOOD % ("r4", "t4", 4), bare, bare, "not json"])
    assert {(r.id, str(r.date)) for r in tx.collect()} == {("t1", "2024-01-01"), ("t2", "2024-01-02"), ("t4", "2024-01-04"), ("t5", "2024-01-05")}
    assert sorted(r.transaction_id for r in logs.collect()) == ["t1", "t2", "t2", "t4", "t5"] and tx.count() == 4 and bad.count() == 3
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_a_sink_runs_by_itself(spark, tmp_path):
    """Its table alone is written; the others catch up when they are asked for."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("\n".join([GOOD % ("r1", "t1", 1), GOOD % ("r2", "t1", 2), "not json"]))
    where = [f"file://{tmp_path}/{x}" for x in ("tx", "logs", "bad")]
    for sinks, there in ((("transactions",), 1), (("transactions", "log", "bad"), 3)):
        started = ingest.ingest(ingest.read_messages(spark, {"format": "text", "path": f"{tmp_path}/in"}), *where, f"{tmp_path}/ck", sinks)
        for q in started:
            q.awaitTermination()
        assert len(started) == there == sum((tmp_path / x).exists() for x in ("tx", "logs", "bad"))
    assert [spark.read.parquet(w).count() for w in where] == [1, 2, 1]


def test_a_batch_that_failed_comes_again_without_loss_or_repeats(spark, tmp_path):
    """The commit of a batch is lost after its rows were written."""
    deliver(spark, tmp_path, "1.txt", [GOOD % ("r1", "t1", 1)])
    deliver(spark, tmp_path, "2.txt", [GOOD % ("r2", "t2", 2), GOOD % ("r1", "t1", 3)])
    for table in ("transactions", "log"):
        commits = tmp_path / "ck" / table / "commits"
        last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
        for f in (commits / str(last), commits / f".{last}.crc"):
            f.unlink(missing_ok=True)
    tx, logs, _ = deliver(spark, tmp_path, "3.txt", [GOOD % ("r2", "t2", 5), GOOD % ("r3", "t3", 3)])
    assert sorted(r.id for r in tx.collect()) == sorted(r.transaction_id for r in logs.collect()) == ["t1", "t2", "t3"]


def test_a_published_message_decodes(spark, tmp_path):
    """All 21 keys of a scored message, as it is published, come back from what was sent."""
    message = {
        "request_id": "req-1", "transaction_id": "tx-1", "user_id": "u", "card_id": "c", "merchant_id": "m", "device_id": "d", "amount_usd": 50.5, "currency": "VND", "channel": "web",
        "billing_country_code": "VN", "ip_country_code": "US", "email_purchaser": "a@b.co", "email_recipient": "r@b.co", "status": "approved", "transaction_time": "2026-07-01T13:30:00+00:00",
        "fraud_score": 0.91, "prediction": 1, "latency_ms": 64.2, "model_name": "risk", "model_version": "v_a", "threshold": 0.8,
    }
    path = f"{tmp_path}/in"
    spark.createDataFrame([(json.dumps(message),)], "value string").write.text(path)
    good, bad = ingest.decode(spark.read.text(path))
    row = good.select("*", F.unix_seconds("created_at").alias("at")).first()
    assert bad.count() == 0 and row.at == 1782912600 and {k: row[k] for k in message} == message
    ingest.publish(good, {"format": "text", "path": f"{tmp_path}/out"})
    again = ingest.decode(spark.read.text(f"{tmp_path}/out"))[0]
    assert again.drop("created_at").exceptAll(good.drop("created_at")).count() == 0 and again.count() == 1
    assert ingest.transactions_of(good).first().id == "tx-1" and ingest.logs_of(good).first().transaction_id == "tx-1"


def test_members_leave_after_their_retention(spark, tmp_path):
    """A member of 25 hours ago is no longer in the state; lifetime moments stay."""
    hour, t = velocity.HOUR, 1_700_000_000_000_000
    rows = [(1, "a", 10.0, t, False, "transaction"), (1, "b", 20.0, t + 24 * hour, False, "transaction"), (1, "c", 5.0, t + 26 * hour, False, "transaction"), (1, "a", 10.0, t + 26 * hour + 1, False, "transaction")]
    got = replay(spark, spark.createDataFrame(rows, EVENTS), "card_id", tmp_path, [t, t + 1, t + 25 * hour, t + 26 * hour + 1, t + 27 * hour]).toPandas()
    assert got.tx_count_24h.tolist()[:3] == [1, 2, 2] and got.tx_seq.tolist()[:3] == [1, 2, 3]
    # "a" has left, so its second coming is taken for a new transaction
    assert got.tx_seq.tolist()[3] == 4 and got.amount_sum_24h.tolist()[3] == 35.0


class Held(dict):
    """State variables in memory, with a count of what is read and written."""

    calls = 0

    def exists(self):
        return "value" in self

    def get(self):
        return self["value"]

    def update(self, value):
        self["value"] = value

    def containsKey(self, key):
        Held.calls += 1
        return key in self

    def getValue(self, key):
        Held.calls += 1
        return self[key]

    def updateValue(self, key, value):
        Held.calls += 1
        self[key] = value

    def removeKey(self, key):
        Held.calls += 1
        self.pop(key, None)


def run_batches(batches, retention=25 * velocity.HOUR):
    state, out = (Held(), Held(), Held()), []
    processor = velocity.Velocity("card_id", retention, None)
    for batch in batches:
        past = velocity.History(*state)
        out += processor.features(past, pd.DataFrame(batch, columns=list(velocity.INPUT)).sort_values(["at", "id"], kind="stable"))
        past.store()
    return out, state


def test_late_and_out_of_order_rows_and_statuses():
    """Against a plain list of members, in batches that reach back, with a second state for each of them."""
    rng, t = random.Random(2), 1_700_000_000_000_000
    batches, n = [], 0
    for b in range(30):
        rows = []
        for _ in range(rng.randrange(1, 40)):
            n += 1
            at = t + b * velocity.HOUR + rng.randrange(-30 * velocity.HOUR if rng.random() < 0.1 else -velocity.HOUR, velocity.HOUR)
            rows.append((f"m{n}", round(rng.random() * 100, 2), at, rng.random() < 0.3, "transaction"))
        if batches:
            rows += [(r[0], 0.0, t + b * velocity.HOUR, True, "status") for r in rng.sample(batches[-1], 1) if r[4] == "transaction"]
            rows += [r for r in rng.sample(batches[-1], 1) if r[4] == "transaction"]
        batches.append(rows)
    got, _ = run_batches(batches)
    members, first, newest, total, want = {}, {}, None, [], []
    for batch in batches:
        for m, amount, at, declined, kind in sorted(batch, key=lambda r: (r[2], r[0])):
            if kind == "status":
                if m in members:
                    members[m] = (*members[m][:2], declined)
                continue
            if m in members:
                want.append(first[m])
                continue
            day = [x for x in members.values() if at - velocity.DAY <= x[0] <= at]
            first[m] = (m, 1 + sum(x[0] >= at - velocity.HOUR for x in day), 1 + len(day), amount + sum(x[1] for x in day), sum(x[2] for x in day), len(total) + 1, newest is not None and at < newest)
            want.append(first[m])
            total.append(amount)
            newest = at if newest is None else max(newest, at)
            floor = newest - 25 * velocity.HOUR
            if at >= floor:
                members[m] = (at, amount, declined)
            members = {k: x for k, x in members.items() if (x[0] // velocity.SLICE + 1) * velocity.SLICE > floor}
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g[0], g[1], g[2], g[4], g[7], g[8]) == (w[0], w[1], w[2], w[4], w[5], w[6]) and abs(g[3] - w[3]) < 1e-6


def test_cost_of_a_busy_key_follows_its_rows():
    """100,000 rows of one key within a day: in one batch or in many, steps and state calls grow with the rows."""
    t, span = 1_700_000_000_000_000, 20 * velocity.HOUR
    took = {}
    for n in (25_000, 100_000):
        rows = [(f"m{i}", 1.0, t + i * span // n, False, "transaction") for i in range(n)]
        Held.calls, began = 0, time.process_time()
        out, _ = run_batches([rows])
        took[n] = time.process_time() - began
        assert out[-1][2] == n and Held.calls < 2.1 * n + 2000
    assert took[100_000] < 8 * took[25_000]
    day, state = run_batches([rows])
    Held.calls = 0
    past = velocity.History(*state)
    last = velocity.Velocity("card_id", 25 * velocity.HOUR, None).features(past, pd.DataFrame([("new", 1.0, t + span, False, "transaction")], columns=list(velocity.INPUT)))
    past.store()
    assert last[0][2] == 100_001 and Held.calls < 20  # a row reads no more than the slices its windows begin in


def test_members_that_come_and_go_within_a_batch_never_reach_the_state():
    """Rows a day apart: a key's batches make fewer calls than they have rows, and the state holds the last members only."""
    t, state, n = 1_700_000_000_000_000, (Held(), Held(), Held()), 20
    processor = velocity.Velocity("card_id", 25 * velocity.HOUR, None)
    Held.calls = 0
    for b in range(3):
        rows = [(f"m{b}-{i}", 1.0, t + (b * n + i) * 26 * velocity.HOUR, False, "transaction") for i in range(n)]
        past = velocity.History(*state, n)
        out = processor.features(past, pd.DataFrame(rows, columns=list(velocity.INPUT)))
        past.store()
        assert [r[2] for r in out] == [1] * n and out[-1][7] == (b + 1) * n
    assert Held.calls < n
    assert list(state[2]) == [(f"m2-{n - 1}",)] and len(state[1]) == 1


class HeldValue(Held):
    """A value state; none yet gives None."""

    def get(self):
        Held.calls += 1
        return self["value"] if "value" in self else None

    def update(self, value):
        Held.calls += 1
        self["value"] = value


def packed_processor():
    processor = velocity.PackedVelocity("card_id", "long", 25 * velocity.HOUR, None)
    processor.pack, processor.totals, processor.members, processor.seen = HeldValue(), Held(), Held(), Held()
    return processor


def packed_rows(rows):
    return Row("_group", "card_id", *velocity.INPUT)(0, *map(list, zip(*rows)))


def test_packed_keys_give_what_keys_of_their_own_give():
    """Cards of a group over batches with a busy one, late rows, statuses and retries; members outgrow the pack and leave."""
    rng, t = random.Random(5), 1_700_000_000_000_000
    processor, plain, batches, n = packed_processor(), {}, [], 0
    for b in range(25):
        rows = []
        for card in [1, 2, None, *[7] * (60 if b < 12 else 2)]:
            n += 1
            at = t + (b + 40 * (b > 20)) * velocity.HOUR + rng.randrange(-30 * velocity.HOUR if rng.random() < 0.1 else -velocity.HOUR, velocity.HOUR)
            rows.append((card, f"m{n}", round(rng.random() * 100, 2), at, rng.random() < 0.3, "transaction"))
        if batches:
            rows += [(*r[:4], True, "status") for r in rng.sample(batches[-1], 3)] + rng.sample(batches[-1], 3)
        batches.append(rows)
        got = []
        for out in processor.handleInputRows((0,), iter([packed_rows(rows)]), None):
            got += zip(*out)
        want = []
        for card in dict.fromkeys(r[0] for r in rows):
            state = plain.setdefault(card, (Held(), Held(), Held()))
            past = velocity.History(*state, 10)
            found = velocity.Velocity("card_id", 25 * velocity.HOUR, None).taken(past, sorted((r[1:] for r in rows if r[0] == card), key=lambda r: (r[2], r[0])))
            want += [(card, *f) for f in found]
            past.store()
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:4] == w[:4] and g[5] == w[5] and g[8:] == w[8:] and all(x == y or abs(x - y) < 1e-6 for x, y in zip((g[4], g[6]), (w[4], w[6])))
        if b == 11:
            assert {k[0] for k in processor.seen} == {7} and len(processor.seen) > velocity.MOST_PACKED
    assert {k[1] for k in processor.seen} <= {k[0] for k in plain[7][2]}
    keys = processor._unpacked()
    assert {card: m[0] for card, (m, _) in keys.items()} == {card: state[0]["value"][0] for card, state in plain.items()}
    for card, (_, members) in keys.items():
        assert sorted(m[3] for m in members or ()) == sorted(k[0] for k in plain[card][2]) or members is None


def test_calls_of_the_state_follow_the_groups():
    """A batch of a thousand cards of one group makes as few calls as a batch of ten."""
    t, processor = 1_700_000_000_000_000, packed_processor()
    for b in range(3):
        rows = [(card, f"m{b}-{card}", 1.0, t + b * velocity.HOUR, False, "transaction") for card in range(1000)]
        Held.calls = 0
        (out,) = processor.handleInputRows((0,), iter([packed_rows(rows)]), None)
        assert Held.calls == 2 and out[2] == [1 + bool(b)] * 1000 and out[3] == [1 + b] * 1000


def test_plain_lists_give_what_slices_give(monkeypatch):
    """Cards of a group with late rows, statuses and retries, of one batch and of earlier ones, by plain lists, by slices and by
    both in turn: the same features, held members and moments."""
    found = {}
    for few in (0, 12, 10**6):
        monkeypatch.setattr(velocity, "FEW", few)
        rng, t, processor, found[few], sent = random.Random(9), 1_700_000_000_000_000, packed_processor(), [], []
        for b in range(20):
            rows = []
            for n in range(60):
                at = t + (6 * b + rng.choice((0, 0, 0, -3, -20, -40))) * velocity.HOUR + rng.choice((0, velocity.SLICE, rng.randrange(velocity.HOUR)))
                rows.append((rng.choice((1, 1, 1, 2, 3, 4)), f"m{b}-{n}", rng.randrange(400) / 4, at, rng.random() < 0.3, "transaction"))
            sent += rows
            rows += rng.sample(sent, 20) + [(*r[:4], rng.random() < 0.5, "status") for r in rng.sample(sent, 20)]
            for out in processor.handleInputRows((0,), iter([packed_rows(rows)]), None):
                found[few] += zip(*out)
            held = {k: (m, members and sorted(members)) for k, (m, members) in processor._unpacked().items()}
            found[few] += [held, sorted(processor.seen.items())]
    assert found[0] == found[12] == found[10**6]
    assert processor.seen or any(members for _, members in held.values())


@pytest.mark.parametrize("case", ["declines", "retry", "eviction", "append"])
def test_a_row_of_a_packed_key_costs_few_calls(case):
    """Python calls a row where a batch brings some rows of each of many cards: rows that push others out, statuses, retries."""
    t, processor = 1_700_000_000_000_000, packed_processor()
    batch = lambda b: [(card, f"m{b}-{card}-{i}", 1.0, t + (48 * b + i) * velocity.HOUR, False, "transaction") for card in range(50) for i in range(20)]
    list(processor.handleInputRows((0,), iter([packed_rows(batch(0))]), None))
    rows = {"declines": [(*r[:4], True, "status") for r in batch(0)], "retry": batch(0), "eviction": batch(1), "append": batch(0) + batch(1)}[case]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call" and frame.f_code.co_filename == velocity.__file__

    sys.setprofile(count)
    try:
        list(processor.handleInputRows((0,), iter([packed_rows(rows)]), None))
    finally:
        sys.setprofile(None)
    assert calls < 10 * len(rows)


def test_groups_with_timers_and_seeds(spark, tmp_path):
    """Packed keys and one that has outgrown the pack, of a stream with a watermark, and of one that history has seeded."""
    hour, t = velocity.HOUR, 1_700_000_000_000_000
    rows = [(1, "a", 10.0, t, False, "transaction"), *((3, f"x{i}", 1.0, t + i, False, "transaction") for i in range(100)), (2, "b", 5.0, t + 40 * hour, False, "transaction"), (2, "c", 5.0, t + 41 * hour, False, "transaction"), (2, "d", 5.0, t + 42 * hour, False, "transaction")]
    parts = [spark.createDataFrame(r, EVENTS) for r in (rows[:-3], rows[-3:-2], rows[-2:-1], rows[-1:])]
    out = velocity.replay(parts, lambda s: velocity.velocity_stream(s, "card_id", delay="1 hour", groups=1), f"file://{tmp_path}/v")
    assert sorted(r.id for r in out.collect()) == sorted(r[1] for r in rows)
    state = lambda name: spark.read.format("statestore").option("path", f"file://{tmp_path}/v/state").option("stateVarName", name).load()
    assert sorted(r.id for r in velocity.packed_ids(state("pack"), state("seen"), "card_id").collect()) == ["b", "c", "d"]
    assert {(r.card_id, r.n) for r in velocity.packed_moments(state("pack"), "card_id").collect()} == {(1, 1), (2, 3), (3, 100)}

    p = Payments(spark, SF)
    ref = "2024-01-15 00:00:00"
    later = velocity.events(p.tx.where(f"created_at > TIMESTAMP '{ref}'"), "user_id")
    seeded = training.initial_state(p.tx, "user_id", ref)
    got = velocity.replay([later], lambda s: velocity.velocity_stream(s, "user_id", seeded, groups=3), f"file://{tmp_path}/s").toPandas().set_index("id").sort_index()
    want = p.features().where(f"created_at > TIMESTAMP '{ref}'").select(F.col("transaction_id").cast("string").alias("id"), "user_tx_count_24h", "user_amount_sum_24h").toPandas().set_index("id").sort_index()
    assert (got["tx_count_24h"].astype(int) == want["user_tx_count_24h"].astype(int)).all()
    assert (got["amount_sum_24h"] - want["user_amount_sum_24h"]).abs().max() < 1e-6


def test_timers_evict_members_of_silent_keys(spark, tmp_path):
    hour, t = velocity.HOUR, 1_700_000_000_000_000
    rows = [(1, "a", 10.0, t, False, "transaction"), (2, "b", 5.0, t + 40 * hour, False, "transaction"), (2, "c", 5.0, t + 41 * hour, False, "transaction"), (2, "d", 5.0, t + 42 * hour, False, "transaction")]
    parts = [spark.createDataFrame([r], EVENTS) for r in rows]
    out = velocity.replay(parts, lambda s: velocity.velocity_stream(s, "card_id", delay="1 hour"), f"file://{tmp_path}/v")
    assert sorted(r.id for r in out.collect()) == ["a", "b", "c", "d"]
    state = lambda name: spark.read.format("statestore").option("path", f"file://{tmp_path}/v/state").option("stateVarName", name).load()
    assert sorted(r.id for r in state("seen").select("user_map_key.id").collect()) == ["b", "c", "d"]
    assert {(r.card_id, r.n) for r in state("totals").select("key.card_id", "value.n").collect()} == {(1, 1), (2, 3)}


def test_state_with_a_time_to_live(spark, tmp_path):
    t = 1_700_000_000_000_000
    rows = spark.createDataFrame([(1, "a", 10.0, t, False, "transaction"), (1, "b", 20.0, t + 1, False, "transaction")], EVENTS)
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = velocity.velocity_stream(stream, "card_id", ttl_days=90).writeStream.format("memory").queryName("ttl90").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    try:  # by processing time a stream goes on by itself
        until = time.time() + 60
        while time.time() < until and spark.table("ttl90").count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(r.tx_seq for r in spark.table("ttl90").collect()) == [1, 2]


def test_scoring_stream(spark, tmp_path):
    """Requests are met with the snapshot of served attributes, scored and published; a failing publisher loses nothing."""
    requests = spark.createDataFrame([("r1", "u1", "c1", 900.0), ("r2", "u2", "c2", 5.0)], "request_id string, user_id string, card_id string, amount_usd double")
    requests.coalesce(1).write.parquet(f"{tmp_path}/in")
    snapshot = spark.createDataFrame([("u1", "c1", "Visa")], "user_id string, card_id string, card_brand string")
    predict = lambda df: df.withColumn("fraud_score", F.when(F.col("amount_usd") > 100, 0.9).otherwise(F.lit(float("nan"))))
    seen, fail = [], [True]

    def publish(df, k):
        if fail[0]:
            raise RuntimeError("the sink is down")
        seen.extend(df.collect())

    def start():
        stream = spark.readStream.schema(requests.schema).parquet(f"{tmp_path}/in")
        return ingest.score_stream(stream, lambda: snapshot, ["card_brand"], predict, publish, f"{tmp_path}/ck")

    with pytest.raises(Exception, match="the sink is down"):
        start().awaitTermination()
    fail[0] = False
    start().awaitTermination()
    got = {r.request_id: (r.card_brand, r.cold_start, r.fraud_score, r.prediction, r.threshold) for r in seen}
    assert got == {"r1": ("Visa", False, 0.9, 1, 0.8), "r2": (None, True, None, None, 0.8)}
    scored = spark.createDataFrame(seen)
    ingest.publish(scored.withColumn("transaction_id", F.col("request_id")), {"format": "text", "path": f"{tmp_path}/sent"})
    assert spark.read.text(f"{tmp_path}/sent").count() == 2


def test_stream_to_date_partitions(spark, tmp_path):
    rows = Payments(spark, SF).tx.select("id", "created_at")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for _ in range(2):  # a second run finds nothing new
        ingest.to_partitions(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == rows.count() and back.where("date <> CAST(created_at AS DATE)").count() == 0
    assert len(back.inputFiles()) >= back.select("date").distinct().count() > 10


def test_windowed_counts_drop_late_rows(spark, tmp_path):
    rows = Payments(spark, SF).tx.select("id", "card_id", "amount_usd", "created_at")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    out = velocity.windowed_counts(stream, "card_id", {"1h": "1 hour"})["1h"]
    q = out.writeStream.format("memory").queryName("w1h").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    n = spark.table("w1h").agg(F.sum("n")).first()[0]
    held = rows.where(F.window('created_at', '1 hour').end <= F.lit(rows.agg(F.max('created_at')).first()[0]) - F.expr('INTERVAL 1 HOUR')).count()
    assert n == held


def test_welford(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "k long, x double")
    rows.write.parquet(f"{tmp_path}/in")
    q = velocity.welford_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), "k", "x").writeStream.format("memory").queryName("wf").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.k: (r.n, r["mean"]) for r in spark.table("wf").orderBy("n").collect()}
    assert got[1][0] == 2 and got[1][1] == pytest.approx(2.0)


def test_message_log_polls_and_goes_on_after_a_restart(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.txt").write_bytes(b"m1\nm2\r\n\nm3\nm4")
    (log / "_hidden").write_text("no message\n")
    sizes = []

    def run():
        stream = ingest.read_messages(spark, {"format": "message_log", "path": f"file://{log}", "most": 2})
        q = stream.writeStream.foreachBatch(lambda df, k: sizes.append((k, sorted(r.value for r in df.collect())))).option("checkpointLocation", f"{tmp_path}/ck").start()
        q.processAllAvailable()
        q.stop()

    run()
    assert [x for _, x in sizes if x] == [["m1", "m2"], ["m3", "m4"]]
    (log / "b.txt").write_text("m5\nm6\nm7\n")
    run()  # nothing is read again, nothing is left out
    assert [x for _, x in sizes if x][2:] == [["m5", "m6"], ["m7"]]
    # a batch whose commit was lost is read again between the same offsets
    commits = tmp_path / "ck" / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    for f in (commits / str(last), commits / f".{last}.crc"):
        f.unlink(missing_ok=True)
    before = [x for k, x in sizes if k == last]
    run()
    assert [x for k, x in sizes if k == last] == before * 2


def test_message_log_is_polled_by_executors_over_ranges(spark, tmp_path):
    """Lines across cuts, blank lines and other line ends come once each; the micro-batches don't grow with the messages."""
    from cardlens.sources.message_log import RangeReader

    log = tmp_path / "log"
    log.mkdir()
    want = [f"message {i} " + "\u00e9" * (i % 17) for i in range(500)]
    (log / "a.txt").write_text("\n".join(want[:300]) + "\r\n\n")
    (log / "b.txt").write_text("\n".join(want[300:400]))
    for span in (1, 7, 64, 10_000):
        r = RangeReader({"path": str(log), "most": "9", "span": str(span)})
        batches = [b for p in r.partitions(r.initialOffset(), r.latestOffset()) for b in r.read(p)]
        assert [x for b in batches for x in b["value"].to_pylist()] == want[:400] and max(b.num_rows for b in batches) <= 9
        assert not r.partitions(r.latestOffset(), r.latestOffset())
    sizes = []
    for _ in range(2):
        stream = ingest.read_messages(spark, {"format": "message_log", "path": f"file://{log}", "most": 9, "span": 100})
        q = stream.writeStream.foreachBatch(lambda df, k: sizes.append(sorted(r.value for r in df.collect()))).option("checkpointLocation", f"{tmp_path}/ck").start()
        q.processAllAvailable()
        q.stop()
        (log / "c.txt").write_text("\n".join(want[400:]))
    assert [x for x in sizes if x] == [sorted(want[:400]), sorted(want[400:])]


def test_message_log_offsets(tmp_path):
    from cardlens.sources.message_log import MessageLogReader

    (tmp_path / "1").write_text("a\nb\n")
    (tmp_path / "2").write_text("c\n")
    r = MessageLogReader({"path": str(tmp_path), "most": "2"})
    rows, at = r.read(r.initialOffset())
    assert [x[0] for x in rows] == ["a", "b"] and at == {"file": "1", "at": 4}
    rest, end = r.read(at)
    assert [x[0] for x in rest] == ["c"] and r.read(end)[1] == end and [x[0] for x in r.readBetweenOffsets(r.initialOffset(), end)] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        MessageLogReader({})
