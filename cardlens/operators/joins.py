"""Joins, snapshots and keyed inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def join_star(tx: DataFrame, users: DataFrame, cards: DataFrame, merchants: DataFrame) -> DataFrame:
    """Transactions with attributes of their user, card and merchant; dangling keys drop out, see quality.missing_keys."""
    u = users.select(F.col("id").alias("user_id"), F.col("created_at").alias("account_created_at"), F.col("country_code").alias("user_country"), "customer_segment", "kyc_level", "email_verified")
    c = cards.select(F.col("id").alias("card_id"), F.col("created_at").alias("card_created_at"), F.col("brand").alias("card_brand"), F.col("type").alias("card_type"), "is_virtual")
    m = merchants.select(F.col("id").alias("merchant_id"), F.col("category").alias("merchant_category"), F.col("risk_level").alias("merchant_risk_level"))
    return tx.join(u, "user_id").join(c, "card_id").join(m, "merchant_id")


def time_slice(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with start <= ts < end; either bound may be left out."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    return df.where(F.col(ts) < F.lit(end).cast("timestamp")) if end is not None else df


def trailing(df: DataFrame, ts: str, ref, interval: str) -> DataFrame:
    """Rows of the last `interval` before the reference time."""
    return df.where(F.col(ts) >= F.lit(ref).cast("timestamp") - F.expr(f"INTERVAL {interval}"))


def semi_active_history(tx: DataFrame, start, end) -> DataFrame:
    """The whole history of every card and of every user with a transaction in the slice, each row once. The table is read
    once, and the slice's keys twice."""
    active = time_slice(tx, "created_at", start, end)
    marked = tx
    for key in ("card_id", "user_id"):
        marked = marked.join(active.select(F.col(key).alias(f"_{key}")).where(F.col(f"_{key}").isNotNull()).distinct(), F.col(key) == F.col(f"_{key}"), "left")
    return marked.where(F.col("_card_id").isNotNull() | F.col("_user_id").isNotNull()).select(tx.columns)


def latest_snapshot(feats: DataFrame, keys: list[str], columns: list[str], until=None, previous: DataFrame | None = None, order: tuple[str, ...] = ("created_at", "computed_at")) -> DataFrame:
    """The newest row per key up to `until`, merged with an earlier snapshot."""
    rows = feats if until is None else feats.where(F.col(order[0]) <= F.lit(until).cast("timestamp"))
    wanted = [*keys, *columns, *order]
    rows = rows.select(*wanted)
    if previous is not None:
        rows = rows.unionByName(previous.select(*wanted))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns, *order), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def lookup(requests: DataFrame, snapshot: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Requests with the served columns of their keys, null where there are none."""
    return requests.join(snapshot.select(*keys, *columns), keys, "left")


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`, then by all columns. Rows are compared before they are shuffled."""
    columns = [c for c in df.columns if c not in keys]
    row = F.struct(*columns)
    first = F.min_by(row, F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order], row))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c) for c in df.columns])


def new_rows(batch: DataFrame, existing: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Rows of the batch to insert: one per key (the first by `order`), none whose key exists."""
    first = first_rows(batch, [key], order) if order else batch
    return first.join(existing.select(key).distinct(), key, "left_anti").select(batch.columns)


def without_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """What stays after the rows marked by a prefix are deleted."""
    return df.where(~F.col(column).cast("string").startswith(prefix) | F.col(column).isNull())


def spine(feats: DataFrame, labels: DataFrame, start=None, end=None) -> DataFrame:
    """(transaction_id, user_id, card_id, event_timestamp, label) of labelled transactions in the window."""
    inside = time_slice(feats, "created_at", start, end)
    rows = inside.select("transaction_id", "user_id", "card_id", F.col("created_at").alias("event_timestamp"))
    return rows.join(labels.where("label is not null").select("transaction_id", F.col("label").cast("byte").alias("label")), "transaction_id")


def missing_keys(tx: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """(reference, id) of references without a parent row."""
    parts = [
        tx.where(F.col(c).isNotNull()).join(p.select(F.col("id").alias(c)), c, "left_anti").select(F.lit(c).alias("reference"), F.col(c).cast("string").alias("id")).distinct() for c, p in parents.items()
    ]
    return reduce(DataFrame.unionByName, parts)
