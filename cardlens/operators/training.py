"""Training frames: encoders, splits, ranking metrics, and statistics from the design notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.functions.scalar import encode_categorical, null_nonfinite, to_number, utc_date
from cardlens.operators.joins import first_rows, spine
from cardlens.operators.ordered import RANGE_ROWS
from cardlens.operators.segments import asof
from cardlens.operators.ordered import exact_percentiles, ordered_prefix

MOST_CATEGORIES = 10_000


def model_columns(df: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def fit_encoders(df: DataFrame, columns: list[str]) -> dict[str, dict[str, int]]:
    """Codes 0..n-1 of each column's distinct texts in order, nulls as "missing". A column may have MOST_CATEGORIES."""
    out = {}
    kinds = dict(df.dtypes)
    for c in columns:
        text = F.initcap(F.col(c).cast("string")) if kinds[c] == "boolean" else F.col(c).cast("string")
        values = [r[0] for r in df.select(F.coalesce(text, F.lit("missing")).alias("v")).distinct().orderBy("v").limit(MOST_CATEGORIES + 1).collect()]
        if len(values) > MOST_CATEGORIES:
            raise ValueError(f"{c} has over {MOST_CATEGORIES} categories")
        out[c] = {v: i for i, v in enumerate(sorted(values))}
    return out


def encoder_table(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of one column, as fit_encoders makes it."""
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit("missing")).alias("value")).distinct()
    return values.withColumn("code", (F.dense_rank().over(Window.orderBy("value")) - 1).cast("int"))


def build_model_vector(df: DataFrame, contract: dict, keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` and the contract's ordered columns as doubles: categories by their codes, numbers as finite doubles.

    Columns that the frame lacks are null; others are left out.
    """
    kinds = dict(df.dtypes)
    encoders = contract.get("encoders", {})

    def one(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("double").alias(name)
        if name in encoders:
            return encode_categorical(F.col(name), encoders[name], kinds[name]).alias(name)
        return to_number(F.col(name)).alias(name) if kinds[name] in ("string", "boolean") else null_nonfinite(F.col(name).cast("double")).alias(name)

    return df.select(*keep, *[one(c) for c in contract["columns"]])


def impute_for_model(df: DataFrame, columns: list[str], sentinel: float = -999.0) -> DataFrame:
    """Null as a sentinel and a <column>_missing flag, as vectors hold no nulls."""
    return df.select(*[c for c in df.columns if c not in columns], *[F.coalesce(F.col(c), F.lit(sentinel)).alias(c) for c in columns], *[F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in columns])


def dedupe_by_id(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return first_rows(df, [key], order)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in a fixed pseudo-random order of their keys; each partition gives its own first n."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def training_frame(feats: DataFrame, labels: DataFrame, start=None, end=None, point_in_time: bool = False) -> DataFrame:
    """Labelled feature rows of the window, with event_timestamp; by id, or by the latest row of (user, card) in time."""
    s = spine(feats, labels, start, end)
    columns = [c for c in feats.columns if c not in ("transaction_id", "user_id", "card_id", "created_at")]
    if point_in_time:
        joined = asof(s, feats, ["user_id", "card_id"], "event_timestamp", "created_at", columns, tie="transaction_id")
    else:
        joined = s.join(feats.select("transaction_id", *columns), "transaction_id")
    return dedupe_by_id(joined, "transaction_id", ["event_timestamp"])


def score_levels(df: DataFrame, label: str, score: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """(groups, s, p, n, p_before, n_before): positives and negatives at and below each score."""
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    levels = rows.groupBy(*groups, F.col(score).cast("double").alias("s")).agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.sum((F.col(label) != 1).cast("long")).alias("n"))
    return ordered_prefix(levels, "s", ["p", "n"], groups)


def average_precisions(df: DataFrame, label: str, score: str, group: str) -> DataFrame:
    """(group, average_precision) of each group's scores, from one run over counts of scores; null without positives."""
    run = score_levels(df, label, score, (group,))
    total = run.groupBy(group).agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    above_p, above = F.col("tp") - F.col("p_before"), F.col("tp") + F.col("tn") - F.col("p_before") - F.col("n_before")
    gain = F.col("p") / F.nullif(F.col("tp").cast("double"), F.lit(0.0)) * above_p / above
    return run.join(total, group).groupBy(group).agg(F.sum(gain).alias("average_precision"))


def ranking(df: DataFrame, label: str, score: str, tie: str | None = None, fractions: dict[str, float] | None = None) -> DataFrame:
    """One row: roc_auc (ties count half; null without both classes), average_precision (sum over falling thresholds of the
    gain in recall times the precision), n, positives, and for each name the share of positives among the
    max(1, int(n * fraction)) highest scores, ties by `tie`.

    Everything comes from counts per score, run up range by range; only rows of the one score at a cut are ranked.
    """
    run = score_levels(df, label, score)
    total = run.agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    p, n, tp, tn = (F.col(c) for c in ("p", "n", "tp", "tn"))
    rows = run.crossJoin(F.broadcast(total))
    above_p, above_n = tp - F.col("p_before"), tn - F.col("n_before")  # at this score and above
    won = F.sum(p.cast("double") * (F.col("n_before") + n / 2))
    gain = p / F.nullif(tp.cast("double"), F.lit(0.0)) * above_p / (above_p + above_n)
    out = [
        F.round(won / F.nullif(F.max(tp).cast("double") * F.max(tn), F.lit(0.0)), 6).alias("roc_auc"),
        F.round(F.sum(gain), 6).alias("average_precision"),
        F.coalesce(F.max(tp + tn), F.lit(0)).alias("n"),
        F.coalesce(F.max(tp), F.lit(0)).alias("positives"),
    ]
    for name, fraction in (fractions or {}).items():
        k = F.greatest(F.lit(1), F.floor((tp + tn) * F.lit(fraction))).cast("long")
        higher = above_p + above_n - p - n
        cut = (higher < k) & (k <= above_p + above_n)
        out += [
            F.max(k).alias(f"_k_{name}"),
            F.max(F.when(cut, F.col("s"))).alias(f"_cut_{name}"),
            F.max(F.when(cut, k - higher)).alias(f"_left_{name}"),
            F.coalesce(F.sum(F.when(above_p + above_n < k, p)), F.lit(0)).alias(f"_higher_{name}"),
        ]
    one = rows.agg(*out)
    if not fractions:
        return one
    held = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(F.col(score).cast("double").alias("_s"), (F.col(label) == 1).alias("_y"), F.col(tie).alias("_tie"))
    cuts = [F.col(f"_cut_{name}") for name in fractions]
    at_cut = held.join(F.broadcast(one.select([f"_{c}_{name}" for name in fractions for c in ("cut", "left")])), F.col("_s").isin(*cuts))
    ranked = at_cut.withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy("_tie")))
    tied = ranked.agg(*[F.coalesce(F.sum(((F.col("_s") == F.col(f"_cut_{name}")) & (F.col("_r") <= F.col(f"_left_{name}")) & F.col("_y")).cast("long")), F.lit(0)).alias(f"_tied_{name}") for name in fractions])
    both = one.crossJoin(F.broadcast(tied))
    return both.select("roc_auc", "average_precision", "n", "positives", *[F.round((F.col(f"_higher_{name}") + F.col(f"_tied_{name}")) / F.col(f"_k_{name}"), 6).alias(name) for name in fractions])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking(df, label, score).select("average_precision")


def precision_at_k(df: DataFrame, label: str, score: str, k_frac: float, tie: str) -> DataFrame:
    """Share of positives among the max(1, int(n k_frac)) highest scores."""
    return ranking(df, label, score, tie, {"precision_at_k": k_frac}).select("precision_at_k")


def evaluate(df: DataFrame, label: str, score: str, tie: str) -> DataFrame:
    return ranking(df, label, score, tie, {"p_at_1pct": 0.01, "p_at_05pct": 0.005})


def class_balance(df: DataFrame, label: str) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col(label) == 1).cast("long")), F.lit(0)).alias("positives"))
    return n.select("n", "positives", F.round((F.col("n") - F.col("positives")) / F.greatest(F.lit(1), F.col("positives")), 6).alias("scale_pos_weight"))


def spine_stats(s: DataFrame) -> DataFrame:
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("positives"), F.round(F.avg(F.col("label").cast("double")), 6).alias("rate"))


# State for the streams, from history.


def card_moments(tx: DataFrame) -> DataFrame:
    x = F.col("amount_usd").cast("double")
    return tx.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.max("created_at").alias("last_at"))


def user_last_seen(tx: DataFrame) -> DataFrame:
    return tx.groupBy("user_id").agg(F.max("created_at").alias("last_at"))


def recent_members(tx: DataFrame, key: str, ref, hours: int = 25, slices: tuple[str, ...] = ()) -> DataFrame:
    """(key, members, n_declines) of the last hours before ref, members in time order; a row for each of `slices`, if given."""
    recent = tx.where((F.col("created_at") >= F.lit(ref).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("created_at") <= F.lit(ref).cast("timestamp")))
    member = F.struct(F.unix_micros("created_at").alias("at"), F.col("id").cast("string").alias("id"), F.col("amount_usd").cast("double").alias("amount"), (F.col("status") == "declined").alias("declined"))
    return recent.groupBy(key, *slices).agg(F.sort_array(F.collect_list(member)).alias("members"), F.sum((F.col("status") == "declined").cast("long")).alias("n_declines"))


def initial_state(tx: DataFrame, key: str, ref, hours: int = 25) -> DataFrame:
    """State up to ref to seed velocity_stream: a row of lifetime moments for each key (members null), and its members of the
    last hours, a row for each slice of five minutes."""
    past = tx.where(F.col("created_at") <= F.lit(ref).cast("timestamp"))
    x = F.col("amount_usd").cast("double")
    moments = past.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.max(F.unix_micros("created_at")).alias("last_us"))
    recent = past.withColumn("_slice", F.floor(F.unix_micros("created_at") / 300_000_000))
    members = recent_members(recent, key, ref, hours, ("_slice",)).select(key, "members")
    return moments.unionByName(members, allowMissingColumns=True)


# Design notes.


def scd2_merge(dim: DataFrame, changes: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """All versions (key, attributes, valid_from, valid_to, is_current) of a dimension after a batch of changes."""
    cols = [key, *attributes, "valid_from"]
    w = Window.partitionBy(key).orderBy("valid_from")
    rows = dim.select(*cols).unionByName(changes.select(*cols)).dropDuplicates([key, "valid_from"])
    now = F.struct(*attributes)
    rows = rows.withColumn("_prev", F.lag(now).over(w)).where(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(now)).drop("_prev")
    return rows.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("is_current", F.col("valid_to").isNull())


def scd2_asof(fact: DataFrame, dim: DataFrame, key: str, ts: str, segment_rows: int = RANGE_ROWS) -> DataFrame:
    """fact with the columns of the version of its key that is valid at ts; null where none is. Versions of a key begin at
    different times, so the last one begun is the one, if it hasn't ended."""
    others = [c for c in dim.columns if c != key]
    out = asof(fact, dim, [key], ts, "valid_from", others, segment_rows=segment_rows)
    valid = F.col("valid_to").isNull() | (F.col(ts) < F.col("valid_to"))
    return out.select(*fact.columns, *[F.when(valid, F.col(c)).alias(c) for c in others])


def uid_stats(df: DataFrame, uid: str, target: str) -> DataFrame:
    """df with mean, deviation and count of the target per uid; aggregated and joined back."""
    x = F.col(target).cast("double")
    stats = df.groupBy(uid).agg(F.round(F.avg(x), 6).alias(f"{uid}_{target}_mean"), F.round(F.stddev_samp(x), 6).alias(f"{uid}_{target}_std"), F.count(F.lit(1)).alias(f"{uid}_freq"))
    return df.join(stats, uid)


def frequency_encode(df: DataFrame, column: str, train: DataFrame) -> DataFrame:
    counts = train.groupBy(column).agg(F.count(F.lit(1)).alias(f"{column}_freq"))
    return df.join(counts, column, "left").withColumn(f"{column}_freq", F.coalesce(f"{column}_freq", F.lit(1)))


def label_contract(tx: DataFrame, labels: DataFrame, as_of, days: int = 60) -> DataFrame:
    """(id, status): fraud if labelled 1 within `days`, holdout if later, immature if too recent to tell, else legit."""
    joined = tx.select("id", "created_at").join(labels.select(F.col("transaction_id").alias("id"), "label", F.col("created_at").alias("labelled_at")), "id", "left")
    late = F.col("labelled_at") > F.col("created_at") + F.expr(f"INTERVAL {days} DAYS")
    mature = F.col("created_at") <= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
    return joined.select("id", F.when((F.col("label") == 1) & ~late, "fraud").when((F.col("label") == 1) & late, "holdout").when(~mature, "immature").otherwise("legit").alias("outcome"))


def dynamic_cutoff(tx: DataFrame, labels: DataFrame, least: float = 60.0) -> DataFrame:
    """max(least, 95th percentile of the report delay in days)."""
    both = tx.select("id", "created_at").join(labels.select(F.col("transaction_id").alias("id"), F.col("created_at").alias("labelled_at")), "id")
    delay = (F.unix_micros("labelled_at") - F.unix_micros("created_at")) / 86_400e6
    return exact_percentiles(both.select(delay.alias("d")), "d", {"q": 0.95}).select(F.greatest(F.lit(least), F.col("q")).alias("cutoff_days"))


def gapped_split(df: DataFrame, ts: str, train_end, val_end, gap_days: int) -> DataFrame:
    """df with split: train up to train_end, val and test each after a gap; null inside gaps."""
    te, ve, gap = F.lit(train_end).cast("timestamp"), F.lit(val_end).cast("timestamp"), F.expr(f"INTERVAL {gap_days} DAYS")
    return df.withColumn("split", F.when(F.col(ts) < te, "train").when((F.col(ts) >= te + gap) & (F.col(ts) < ve), "val").when(F.col(ts) >= ve + gap, "test"))


def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.agg(F.round(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))), 6).alias("brier"))


def reliability(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 6).alias("mean_score"), F.round(F.avg(F.col(label).cast("double")), 6).alias("observed"))


def tune_thresholds(df: DataFrame, label: str, score: str, fpr: float = 0.005, step_up: float = 0.08) -> DataFrame:
    """Thresholds that at most fpr and fpr + step_up of the legitimate scores lie above."""
    found = exact_percentiles(df.where(F.col(label) == 0), score, {"high": 1 - fpr, "step_up": 1 - fpr - step_up})
    return found.select(F.round("high", 6).alias("high"), F.round("step_up", 6).alias("step_up"))


def chargeback_rate(tx: DataFrame, labels: DataFrame, key: str = "merchant_id", days: int = 30, mature_by=None) -> DataFrame:
    """Per day and key: share of label 1 among the key's transactions of the trailing days whose label was in by then."""
    both = tx.select("id", key, utc_date(F.col("created_at")).alias("day")).join(labels.select(F.col("transaction_id").alias("id"), "label", F.col("created_at").alias("labelled_at")), "id")
    if mature_by is not None:
        both = both.where(F.col("labelled_at") <= F.lit(mature_by).cast("timestamp"))
    daily = both.groupBy(key, "day").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("bad"))
    frame = f"OVER (PARTITION BY {key} ORDER BY day RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"
    return daily.select(key, "day", F.round(F.expr(f"sum(bad) {frame}") / F.expr(f"sum(n) {frame}").cast("double"), 6).alias("rate"))


def daily_precision_at_k(df: DataFrame, ts: str, label: str, score: str, tie: str, k_frac: float = 0.01) -> DataFrame:
    day = df.withColumn("day", utc_date(F.col(ts)))
    ranked = day.withColumn("_r", F.row_number().over(Window.partitionBy("day").orderBy(F.desc(score), tie))).withColumn("_k", F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(Window.partitionBy("day")) * k_frac)))
    return ranked.where("_r <= _k").groupBy("day").agg(F.round(F.avg((F.col(label) == 1).cast("double")), 6).alias("precision"))


def daily_kpi(tx: DataFrame) -> DataFrame:
    return tx.groupBy(utc_date(F.col("created_at")).alias("day")).agg(F.count(F.lit(1)).alias("n_tx"), F.round(F.sum("amount_usd"), 4).alias("volume"), F.round(F.avg((F.col("status") == "declined").cast("double")), 6).alias("decline_rate"))


def merchant_leaderboard(tx: DataFrame, labels: DataFrame, k: int = 10) -> DataFrame:
    both = tx.select("id", "merchant_id", "amount_usd").join(labels.select(F.col("transaction_id").alias("id"), "label"), "id", "left")
    per = both.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_tx"), F.round(F.sum("amount_usd"), 4).alias("volume"), F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("frauds"))
    return per.orderBy(F.desc("n_tx"), "merchant_id").limit(k)
