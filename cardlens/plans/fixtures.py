"""The payment tables, derived from the tables at hand. The SQL is the same for Spark and for the oracle."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cardlens.plans.features import build_features

VIEWS = {
    "f_users": """SELECT c_custkey AS id, 'u' || CAST(c_custkey AS STRING) || '@mail.test' AS email, CAST(c_nationkey AS INT) AS country_code,
  c_mktsegment AS customer_segment, CAST(c_custkey % 3 AS INT) AS kyc_level, c_acctbal > 0 AS email_verified,
  TIMESTAMP '2023-01-01 00:00:00' + CAST(c_custkey % 300 AS INT) * INTERVAL '1' DAY AS created_at FROM {customer}""",
    "f_cards": """SELECT c_custkey * 10 + k AS id, c_custkey AS user_id,
  CASE WHEN (c_custkey + k) % 3 = 0 THEN 'Visa' WHEN (c_custkey + k) % 3 = 1 THEN 'Mastercard' ELSE 'Amex' END AS brand,
  CASE WHEN (c_custkey + k) % 2 = 0 THEN 'credit' ELSE 'debit' END AS type, (c_custkey + k) % 11 = 0 AS is_virtual,
  TIMESTAMP '2023-11-01 06:30:00' + CAST((c_custkey + k) % 50 AS INT) * INTERVAL '1' DAY AS created_at
  FROM {customer} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) j""",
    "f_merchants": """SELECT s_suppkey AS id, s_name AS name, 'cat' || CAST(s_nationkey % 13 AS STRING) AS category,
  CAST(s_nationkey AS INT) AS country_code, CAST(s_suppkey % 3 + 1 AS INT) AS risk_level FROM {supplier}""",
    "f_tx": """SELECT event_id AS id, user_id, user_id * 10 + event_id % 2 AS card_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 10 AS merchant_id,
  event_id % 37 AS device_id, value AS amount_usd, CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN 'mobile_app' ELSE 'pos' END AS channel,
  CAST(user_id % 25 AS INT) AS billing_country_code,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 9 = 0 THEN CAST(event_id % 25 AS INT) ELSE CAST(user_id % 25 AS INT) END AS ip_country_code,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE 'u' || CAST(user_id AS STRING) || '@mail.test' END AS email_purchaser,
  CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'u' || CAST(user_id AS STRING) || '@mail.test' ELSE 'r' || CAST(event_id % 50 AS STRING) || '@mail.test' END AS email_recipient,
  CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status, CAST(ts AS TIMESTAMP) AS created_at FROM {events}""",
    "f_labels": """SELECT event_id AS transaction_id, CASE WHEN value > 120 OR event_id % 211 = 0 THEN 1 ELSE 0 END AS label,
  CASE WHEN event_id % 7 = 0 THEN 'manual_review' ELSE 'rule_engine' END AS label_source,
  CAST(ts AS TIMESTAMP) + CAST(event_id % 5 + 1 AS INT) * INTERVAL '1' DAY AS created_at
  FROM {events} WHERE ts < TIMESTAMP '2024-01-28 00:00:00' AND event_id % 10 <> 3""",
    "f_logs": """SELECT event_id AS transaction_id, CASE WHEN event_id % 5 = 0 THEN 'v_b' ELSE 'v_a' END AS model_version, value / (value + 30) AS fraud_score,
  CASE WHEN value / (value + 30) >= 0.8 THEN 1 ELSE 0 END AS prediction, CAST(0.8 AS DOUBLE) AS threshold, 20 + value / 4 AS latency_ms, CAST(ts AS TIMESTAMP) AS created_at FROM {events}""",
}
BASE_TABLES = ("customer", "supplier", "events")

#: The oracle of the feature build finds a row's past by joining each transaction with those of its card and user up to it,
#: not by windows as the build does.
PAST = """SELECT now.id, {columns} FROM f_tx now JOIN f_tx old ON old.{key} = now.{key} AND old.created_at <= now.created_at GROUP BY now.id, now.created_at, now.amount_usd"""
WITHIN = "FILTER (WHERE old.created_at >= now.created_at - INTERVAL {0} HOUR)"
OTHERS = "FILTER (WHERE old.created_at >= now.created_at - INTERVAL 24 HOUR AND old.id <> now.id AND old.status = 'declined')"
EARLIER = "FILTER (WHERE old.created_at < now.created_at OR old.id < now.id)"
GAP = f"date_diff('microsecond', max(old.created_at) {EARLIER}, now.created_at) / 1000000.0"
CARD_PAST = PAST.format(
    key="card_id",
    columns=f"""count(*) {WITHIN.format(1)} AS n_1h, count(*) {WITHIN.format(24)} AS n_24h, sum(old.amount_usd) {WITHIN.format(24)} AS sum_24h, count(*) {OTHERS} AS declines,
  {GAP} AS gap, (now.amount_usd - avg(old.amount_usd) {EARLIER}) / nullif(stddev_samp(old.amount_usd) {EARLIER}, 0) AS z, 1 + count(*) {EARLIER} AS seq""",
)
USER_PAST = PAST.format(key="user_id", columns=f"count(*) {WITHIN.format(24)} AS n_24h, sum(old.amount_usd) {WITHIN.format(24)} AS sum_24h, {GAP} AS gap")
FEATS = f"""SELECT f_tx.id AS transaction_id, f_tx.created_at, f_tx.user_id, f_tx.card_id, f_tx.merchant_id, f_tx.device_id, f_tx.amount_usd, ln(1 + f_tx.amount_usd) AS log_amount,
  CAST(date_part('hour', f_tx.created_at) AS INT) AS hour, CAST((date_part('dow', f_tx.created_at) + 6) % 7 AS INT) AS weekday,
  CASE WHEN date_part('hour', f_tx.created_at) IN (0, 1, 2, 3, 4, 5, 23) THEN 1 ELSE 0 END AS is_night, f_tx.channel, f_cards.brand AS card_brand, f_cards.type AS card_type, f_cards.is_virtual,
  f_users.customer_segment, f_users.kyc_level, f_users.email_verified, f_merchants.category AS merchant_category, f_merchants.risk_level AS merchant_risk_level,
  f_users.country_code AS user_country, f_users.created_at AS account_created_at, f_cards.created_at AS card_created_at,
  CAST(floor(date_diff('microsecond', f_users.created_at, f_tx.created_at) / (24 * 3600 * 1000000.0)) AS INT) AS account_age_days,
  CAST(floor(date_diff('microsecond', f_cards.created_at, f_tx.created_at) / (24 * 3600 * 1000000.0)) AS INT) AS card_age_days,
  CASE WHEN billing_country_code = ip_country_code THEN 0 ELSE 1 END AS geo_mismatch, CASE WHEN ip_country_code = f_users.country_code THEN 0 ELSE 1 END AS foreign_ip,
  CASE WHEN email_recipient = email_purchaser OR email_recipient IS NULL THEN 0 ELSE 1 END AS recipient_differs, CASE f_tx.status WHEN 'declined' THEN 1 ELSE 0 END AS is_declined,
  CAST(of_card.n_1h AS INT) AS card_tx_count_1h, CAST(of_card.n_24h AS INT) AS card_tx_count_24h, of_card.sum_24h AS card_amount_sum_24h, of_card.gap AS card_seconds_since_last_tx,
  of_card.z AS card_amount_zscore, CAST(of_card.seq AS INT) AS card_tx_seq, CAST(of_card.declines AS INT) AS card_declines_24h,
  CAST(of_user.n_24h AS INT) AS user_tx_count_24h, of_user.sum_24h AS user_amount_sum_24h, of_user.gap AS user_seconds_since_last_tx
  FROM f_tx, f_users, f_cards, f_merchants, ({CARD_PAST}) of_card, ({USER_PAST}) of_user
  WHERE f_users.id = f_tx.user_id AND f_cards.id = f_tx.card_id AND f_merchants.id = f_tx.merchant_id AND of_card.id = f_tx.id AND of_user.id = f_tx.id"""


def oracle(body: str) -> str:
    """The oracle's SQL: the views (and feats) as common tables before the body, which may add more with 'WITH'."""
    names = {t: t for t in BASE_TABLES}
    tables = ", ".join(f"{name} AS ({sql.format(**names)})" for name, sql in VIEWS.items())
    tables += f", feats AS ({FEATS})"
    body = body.strip()
    return f"WITH {tables}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {tables} {body}"


class Payments:
    """The payment tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _view(self, name: str) -> DataFrame:
        sql = VIEWS[name]
        return self.spark.sql(sql, **{t: self.raw(t) for t in BASE_TABLES if f"{{{t}}}" in sql})

    @cached_property
    def users(self) -> DataFrame:
        return self._view("f_users")

    @cached_property
    def cards(self) -> DataFrame:
        return self._view("f_cards")

    @cached_property
    def merchants(self) -> DataFrame:
        return self._view("f_merchants")

    @cached_property
    def tx(self) -> DataFrame:
        return self._view("f_tx")

    @cached_property
    def labels(self) -> DataFrame:
        return self._view("f_labels")

    @cached_property
    def logs(self) -> DataFrame:
        return self._view("f_logs")

    def features(self, start=None, end=None) -> DataFrame:
        return build_features(self.tx, self.users, self.cards, self.merchants, start, end)
