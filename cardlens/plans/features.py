"""The point-in-time feature build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens import schemas
from cardlens.functions import scalar
from cardlens.operators import history
from cardlens.operators.joins import join_star, semi_active_history, time_slice
from cardlens.operators.ordered import RANGE_ROWS


def build_features(
    tx: DataFrame, users: DataFrame, cards: DataFrame, merchants: DataFrame, start=None, end=None, hot_rows: int = history.HOT_ROWS, segment_rows: int = RANGE_ROWS
) -> DataFrame:
    """The 39 feature columns of each transaction of [start, end), or of all; no feature looks past its transaction.

    For a slice, only cards and users active in it are read back in full, and the slice is cut after the windows. The
    card's frames share one shuffle and sort, the user's another. Cards and users of hot_rows transactions or more go
    over segments of about segment_rows rows instead, see history.
    """
    scope = tx if start is None and end is None else semi_active_history(tx, start, end)
    scope = scope.withColumn("amount_usd", F.col("amount_usd").cast("double"))
    ctx = join_star(scope, users, cards, merchants)
    t, c = F.col("created_at"), F.col
    # a table of fewer rows has no such key, and its rows are counted without reading columns
    hot = history.hot_keys(scope, ("card_id", "user_id"), hot_rows) if tx.count() >= hot_rows else {}
    rows = history.with_history(ctx, "card_id", history.CARD_FIELDS, hot.get("card_id"), segment_rows)
    rows = history.with_history(rows, "user_id", history.USER_FIELDS, hot.get("user_id"), segment_rows)
    rows = time_slice(rows, "created_at", start, end)
    full = rows.select(
        "*",
        c("id").alias("transaction_id"),
        scalar.log_amount(c("amount_usd")).alias("log_amount"),
        scalar.hour_utc(t).alias("hour"),
        scalar.weekday(t).alias("weekday"),
        scalar.is_night(t).alias("is_night"),
        scalar.age_days(t, c("account_created_at")).alias("account_age_days"),
        scalar.age_days(t, c("card_created_at")).alias("card_age_days"),
        scalar.differs(c("billing_country_code"), c("ip_country_code")).alias("geo_mismatch"),
        scalar.differs(c("ip_country_code"), c("user_country")).alias("foreign_ip"),
        scalar.recipient_differs(c("email_recipient"), c("email_purchaser")).alias("recipient_differs"),
        scalar.is_declined(c("status")).alias("is_declined"),
    )
    return full.select(*schemas.FEATURE_COLUMNS)
