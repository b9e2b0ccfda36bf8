"""Drift, dashboards, model-version comparison, calibration and data quality."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.functions.scalar import drift_band, utc_date, utc_hour_start
from cardlens.operators.joins import time_slice
from cardlens.operators.ordered import cumulative_shares, exact_percentiles


def drift_moments(base: DataFrame, current: DataFrame, column: str) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        x = F.col(column).cast("double")
        return df.where(F.col(column).isNotNull()).agg(
            F.count(F.lit(1)).alias(f"n_{name}"), F.round(F.avg(x), 4).alias(f"mean_{name}"), F.round(F.coalesce(F.stddev_samp(x), F.lit(0.0)), 4).alias(f"std_{name}")
        )

    return side(base, "baseline").crossJoin(side(current, "current"))


def wasserstein(base: DataFrame, current: DataFrame, column: str, transform=F.log1p) -> DataFrame:
    """1-Wasserstein distance of two samples: the area between their cumulative shares, to 6 places. One row."""
    run = cumulative_shares(base, current, column, transform)
    return run.agg(F.round(F.coalesce(F.sum(F.abs(F.col("fa") - F.col("fb")) * (F.col("next") - F.col("v"))), F.lit(0.0)), 6).alias("wasserstein"))


def ks(base: DataFrame, current: DataFrame, column: str) -> DataFrame:
    return cumulative_shares(base, current, column).agg(F.round(F.max(F.abs(F.col("fa") - F.col("fb"))), 6).alias("ks"))


def drift_report(base: DataFrame, current: DataFrame, column: str, threshold: float = 0.1, min_rows: int = 30) -> DataFrame:
    """One row: distance, band, flag (distance >= threshold) and moments. Refuses samples below min_rows."""
    for df in (base, current):
        if df.where(F.col(column).isNotNull()).limit(min_rows).count() < min_rows:
            raise ValueError(f"a sample has fewer than {min_rows} values")
    both = wasserstein(base, current, column).crossJoin(drift_moments(base, current, column))
    return both.select("*", drift_band(F.col("wasserstein")).alias("band"), (F.col("wasserstein") >= threshold).alias("drift_detected"), F.lit(threshold).alias("threshold"))


def psi(base: DataFrame, current: DataFrame, column: str, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index over quantile bins of the base."""
    names = {f"e{i}": i / bins for i in range(1, bins)}
    edges = exact_percentiles(base, column, names).select(F.array(*names).alias("e"))

    def shares(df: DataFrame, name: str) -> DataFrame:
        binned = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(edges)).select(F.size(F.filter("e", lambda c: c < F.col(column))).alias("bin"))
        counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
        return counts.select("bin", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias(name))

    both = shares(base, "p").join(shares(current, "q"), "bin", "full").select(F.greatest(F.coalesce("p", F.lit(0.0)), F.lit(floor)).alias("p"), F.greatest(F.coalesce("q", F.lit(0.0)), F.lit(floor)).alias("q"))
    return both.agg(F.round(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))), 6).alias("psi"))


def kl(base: DataFrame, current: DataFrame, column: str, bins: int = 20, smooth: float = 1.0) -> DataFrame:
    """KL divergence of two histograms of scores in [0, 1], with additive smoothing."""
    at = F.least(F.floor(F.col(column) * bins), F.lit(bins - 1)).cast("int")
    side = lambda df, n: df.where(F.col(column).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias(n))
    all_bins = base.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    both = all_bins.join(side(base, "a"), "bin", "left").join(side(current, "b"), "bin", "left").fillna(0)
    total = both.agg((F.sum("a") + bins * smooth).alias("na"), (F.sum("b") + bins * smooth).alias("nb"))
    p, q = (F.col("a") + smooth) / F.col("na"), (F.col("b") + smooth) / F.col("nb")
    return both.crossJoin(F.broadcast(total)).agg(F.round(F.sum(q * F.log(q / p)), 6).alias("kl"))


# Dashboards.


def daily_requests(logs: DataFrame) -> DataFrame:
    return logs.groupBy(utc_date(F.col("created_at")).alias("day")).agg(F.count(F.lit(1)).alias("requests"))


def percentiles(df: DataFrame, column: str, groups: tuple[str, ...] = (), **names: float) -> DataFrame:
    """Exact percentiles to 6 places."""
    return exact_percentiles(df, column, names, groups).select(*groups, *[F.round(n, 6).alias(n) for n in names])


def latency_percentiles(logs: DataFrame) -> DataFrame:
    return percentiles(logs, "latency_ms", p90=0.9, p95=0.95, p99=0.99)


def review_rate(logs: DataFrame) -> DataFrame:
    return logs.agg(F.coalesce(100.0 * F.sum((F.col("prediction") == 1).cast("double")) / F.nullif(F.count(F.lit(1)).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("review_rate"))


def requests_by_version(logs: DataFrame, span: str = "1 hour") -> DataFrame:
    """Also for streams, behind a watermark."""
    return logs.where("model_version is not null").groupBy(F.window("created_at", span).alias("w"), "model_version").agg(F.count(F.lit(1)).alias("requests")).select(F.col("w.start").alias("bucket"), "model_version", "requests")


def traffic_share(logs: DataFrame) -> DataFrame:
    counts = logs.where("model_version is not null").groupBy("model_version").agg(F.count(F.lit(1)).alias("requests"))
    return counts.select("model_version", "requests", F.round(F.col("requests") / F.sum("requests").over(Window.partitionBy()), 6).alias("share"))


def flags_by_version(logs: DataFrame, span: str = "1 hour") -> DataFrame:
    return logs.where("model_version is not null").groupBy(F.window("created_at", span).alias("w"), "model_version").agg(F.expr("count(*) FILTER (WHERE prediction = 1)").alias("flags")).select(F.col("w.start").alias("bucket"), "model_version", "flags")


def latency_by_version(logs: DataFrame, span: str = "1 hour") -> DataFrame:
    timed = logs.where("model_version is not null").select(F.window("created_at", span)["start"].alias("bucket"), "model_version", "latency_ms")
    return percentiles(timed, "latency_ms", ("bucket", "model_version"), p50=0.5, p99=0.99)


# Reports.


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(F.round(F.avg(F.col("label").cast("double")), 6).alias("rate"))


def separation_stats(tx: DataFrame, labels: DataFrame) -> DataFrame:
    both = tx.join(labels.select(F.col("transaction_id").alias("id"), "label"), "id")
    rate = lambda c: F.round(F.avg(c.cast("double")), 6)
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        rate(~F.col("billing_country_code").eqNullSafe(F.col("ip_country_code"))).alias("geo_mismatch_rate"),
        F.round(F.avg("amount_usd"), 4).alias("mean_amount"),
        rate(F.col("status") == "declined").alias("decline_rate"),
    )


def merchant_tiles(tx: DataFrame, tiles: int = 100) -> DataFrame:
    """(merchant_id, volume, tile) by falling volume. One row per merchant, a small table, goes through one window."""
    volume = tx.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("volume"))
    return volume.withColumn("tile", F.ntile(tiles).over(Window.orderBy(F.desc("volume"), "merchant_id")).cast("int"))


def top_merchant_share(tx: DataFrame, tiles: int = 100) -> DataFrame:
    return merchant_tiles(tx, tiles).agg(F.round(F.sum(F.when(F.col("tile") == 1, F.col("volume")).otherwise(0)) / F.sum("volume"), 6).alias("share"))


def card_hour_burst(tx: DataFrame) -> DataFrame:
    per = tx.groupBy("card_id", utc_hour_start(F.col("created_at")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("max_tx"), F.round(F.avg("n"), 6).alias("mean_tx"))


def card_hour_merchants(tx: DataFrame) -> DataFrame:
    per = tx.select("card_id", utc_hour_start(F.col("created_at")).alias("hour"), "merchant_id").distinct().groupBy("card_id", "hour").agg(F.count("merchant_id").alias("n"))
    return per.agg(F.max("n").alias("max_merchants"))


def device_fanout(tx: DataFrame) -> DataFrame:
    """(device_id, n_users, n_tx); users are made distinct per device before they are counted."""
    pairs = tx.groupBy("device_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("device_id").agg(F.count("user_id").alias("n_users"), F.sum("n").alias("n_tx"))


def topk_devices(tx: DataFrame, k: int = 3) -> DataFrame:
    return device_fanout(tx).orderBy(F.desc("n_users"), F.desc("n_tx"), "device_id").limit(k)


def recipient_fanout(tx: DataFrame) -> DataFrame:
    pairs = tx.where("email_recipient is not null").select("email_recipient", "user_id").distinct()
    return pairs.groupBy("email_recipient").agg(F.count("user_id").alias("n")).agg(F.max("n").alias("max_users"))


def median_amount(tx: DataFrame) -> DataFrame:
    return percentiles(tx, "amount_usd", median=0.5)


def status_label_matrix(tx: DataFrame, labels: DataFrame) -> DataFrame:
    both = tx.select("id", "status").join(labels.select(F.col("transaction_id").alias("id"), "label"), "id")
    n = lambda s, y: F.sum(((F.col("status") == s) & (F.col("label") == y)).cast("long"))
    cells = both.agg(n("approved", 1).alias("approved_fraud"), n("declined", 1).alias("declined_fraud"), n("approved", 0).alias("approved_legit"), n("declined", 0).alias("declined_legit"))
    share = lambda a, b: F.round(F.col(a) / F.nullif((F.col(a) + F.col(b)).cast("double"), F.lit(0.0)), 6)
    return cells.select("*", share("approved_fraud", "declined_fraud").alias("p_approved_fraud"), share("declined_legit", "approved_legit").alias("p_declined_legit"))


# Model versions.


def ab_proxy_metrics(logs: DataFrame) -> DataFrame:
    rate = F.round(F.avg((F.col("prediction") == 1).cast("double")), 6).alias("alert_rate")
    known = logs.where("model_version is not null")
    sums = known.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("fraud_score"), 6).alias("mean_score"), rate, F.round(F.avg("latency_ms"), 6).alias("mean_latency"))
    return sums.join(percentiles(known, "fraud_score", ("model_version",), p50=0.5, p95=0.95), "model_version", "left")


def ab_truth_metrics(logs: DataFrame, labels: DataFrame) -> DataFrame:
    both = logs.join(labels.select("transaction_id", "label"), "transaction_id").where("model_version is not null")
    tp, fp, fn = (F.sum(((F.col("prediction") == p) & (F.col("label") == y)).cast("long")) for p, y in ((1, 1), (1, 0), (0, 1)))
    sums = both.groupBy("model_version").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    share = lambda b: F.round(F.col("tp") / F.nullif((F.col("tp") + F.col(b)).cast("double"), F.lit(0.0)), 6)
    return sums.select("model_version", share("fp").alias("precision"), share("fn").alias("recall"), F.col("fp").alias("false_positives"))


def ab_two_prop_z(logs: DataFrame, a: str, b: str) -> DataFrame:
    """Pooled z of the alert rates of two versions; see two_sided_p for p."""
    is_a, is_b, hit = F.col("model_version") == a, F.col("model_version") == b, F.col("prediction") == 1
    n = lambda c: F.sum(c.cast("double"))
    s = logs.agg(n(is_a).alias("na"), n(is_b).alias("nb"), n(is_a & hit).alias("xa"), n(is_b & hit).alias("xb"))
    pooled = (F.col("xa") + F.col("xb")) / (F.col("na") + F.col("nb"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("na") + 1 / F.col("nb")))
    return s.select(F.round((F.col("xa") / F.col("na") - F.col("xb") / F.col("nb")) / F.nullif(spread, F.lit(0.0)), 6).alias("z"))


def two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def retrain_rule(psi_value: Column, brier_change: Column, precision_change: Column) -> Column:
    """retrain if calibration or ranking got worse; watch if only inputs moved; else keep."""
    return F.when((brier_change > 0.01) | (precision_change < -0.05), "retrain").when(psi_value > 0.2, "watch").otherwise("keep")


def promotion_gate(candidate: Column, champion: Column, brier: Column) -> Column:
    return (candidate >= champion - 0.02) & (brier <= 0.05)


# Quality.


def with_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with `violations`, the names of rules that a row breaks; a rule without an answer is broken."""
    broken = F.array(*[F.when(F.coalesce(ok, F.lit(False)), None).otherwise(name) for name, ok in rules.items()])
    return df.withColumn("violations", F.array_compact(broken))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.size("violations") == 0).drop("violations"), df.where(F.size("violations") > 0)


EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def request_rules(known: list[str] | None = None, extra: str | None = None) -> dict[str, Column]:
    """Rules of a scoring request; `extra` names a column that holds unknown keys, which there must be none of."""
    filled = {f"{c}_empty": F.length(c) > 0 for c in ("request_id", "user_id", "card_id", "merchant_category", "channel", "billing_country_code", "ip_country_code")}
    rules = filled | {
        "risk_level": F.col("merchant_risk_level").between(0, 10),
        "amount": F.col("amount_usd") > 0,
        "email_purchaser": F.col("email_purchaser").rlike(EMAIL),
        "email_recipient": F.col("email_recipient").rlike(EMAIL),
        "created_at": F.try_to_timestamp(F.col("created_at")).isNotNull(),
    }
    return rules | ({"extra_keys": F.col(extra).isNull() | (F.size(extra) == 0)} if extra else {})


def constraint_violations(tx: DataFrame, labels: DataFrame, parents: dict[str, DataFrame], id_pattern: str = "^[0-9a-f]{32}$") -> DataFrame:
    """(rule, violations): ids' form, amounts, labels and one row per foreign key."""
    first = tx.agg(F.sum((~F.col("id").cast("string").rlike(id_pattern)).cast("long")).alias("a"), F.sum((~(F.col("amount_usd") > 0)).cast("long")).alias("b"))
    parts = [first.select(F.lit("id_format").alias("rule"), F.coalesce("a", F.lit(0)).alias("violations")), first.select(F.lit("amount_positive").alias("rule"), F.coalesce("b", F.lit(0)).alias("violations"))]
    parts.append(labels.agg(F.coalesce(F.sum((~F.col("label").isin(0, 1)).cast("long")), F.lit(0)).alias("violations")).select(F.lit("label_binary").alias("rule"), "violations"))
    for column, parent in parents.items():
        lost = tx.where(F.col(column).isNotNull()).join(parent.select(F.col("id").alias(column)), column, "left_anti")
        parts.append(lost.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"fk_{column}").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_source(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Row counts; raises if there are no transactions."""
    if tx.isEmpty():
        raise ValueError("no transactions to build features from")
    return tx.agg(F.count(F.lit(1)).alias("n_transactions")).crossJoin(labels.agg(F.count(F.lit(1)).alias("n_labels")))


def check_coverage(tx: DataFrame, feats: DataFrame, start=None, end=None) -> DataFrame:
    """One row: expected, actual, and how many transactions have no feature row, of [start, end) or of all. Only ids and times
    are read."""
    ids = time_slice(tx.select(F.col("id").alias("transaction_id"), "created_at"), "created_at", start, end)
    made = time_slice(feats.select("transaction_id", "created_at"), "created_at", start, end)
    lost = ids.join(made, "transaction_id", "left_anti").agg(F.count(F.lit(1)).alias("missing"))
    return ids.agg(F.count(F.lit(1)).alias("expected")).crossJoin(made.agg(F.count(F.lit(1)).alias("actual"))).crossJoin(lost)


def raise_if_uncovered(coverage: DataFrame) -> None:
    """Stop a job whose slice isn't covered; see check_coverage."""
    row = coverage.first()
    if row["missing"] or row["expected"] != row["actual"]:
        raise ValueError(f"{row['expected']} transactions, {row['actual']} feature rows, {row['missing']} without one")


def dq_suite(tx: DataFrame, users: DataFrame, feats: DataFrame) -> DataFrame:
    """(check_name, value, passed): duplicates, range, nulls and references in one pass a table."""
    one = tx.agg(
        (F.count(F.lit(1)) - F.count_distinct("id")).cast("double").alias("duplicate_ids"),
        F.avg((F.col("amount_usd") > 0).cast("double")).alias("amount_in_range"),
        F.avg(F.col("ip_country_code").isNull().cast("double")).alias("null_ip_country"),
    )
    held = tx.join(users.select(F.col("id").alias("user_id"), F.lit(1).alias("_here")), "user_id", "left").agg(F.avg(F.col("_here").isNotNull().cast("double")).alias("fk_user"))
    nulls = feats.agg(F.avg(F.col("log_amount").isNull().cast("double")).alias("null_feature"))
    row = one.crossJoin(held).crossJoin(nulls)
    stack = row.selectExpr("stack(5, 'duplicate_ids', duplicate_ids, 'amount_in_range', amount_in_range, 'null_ip_country', null_ip_country, 'fk_user', fk_user, 'null_feature', null_feature) AS (check_name, value)")
    passed = F.expr("CASE check_name WHEN 'duplicate_ids' THEN value = 0 WHEN 'amount_in_range' THEN value >= 1 WHEN 'null_ip_country' THEN value <= 0.08 WHEN 'fk_user' THEN value >= 0.995 ELSE value <= 0.01 END")
    return stack.select("check_name", F.round("value", 6).alias("value"), passed.alias("passed"))
