"""Schemas of the source tables and the fixed column orders."""

from __future__ import annotations

from pyspark.sql import types as T



DDL = {
    "users": "id string, email string, country_code string, customer_segment string, kyc_level short, email_verified boolean, created_at timestamp",
    "cards": "id string, user_id string, issuer_code string, country_code string, brand string, type string, bin_code string, is_virtual boolean, created_at timestamp",
    "merchants": "id string, name string, category string, country_code string, risk_level short, created_at timestamp",
    "devices": "id string, fingerprint string, device_type string, os string, browser string, screen_resolution string, created_at timestamp",
    "transactions": "id string, user_id string, card_id string, merchant_id string, device_id string, amount_usd decimal(14,2), currency string, channel string, "
    "billing_country_code string, ip_country_code string, email_purchaser string, email_recipient string, status string, created_at timestamp",
    "labels": "transaction_id string, label short, label_source string, created_at timestamp",
    "logs": "transaction_id string, model_name string, model_version string, fraud_score double, prediction int, threshold double, latency_ms double, created_at timestamp",
}
#: The stored columns of a feature row, in order.
FEATURE_COLUMNS = (
    "transaction_id created_at user_id card_id merchant_id device_id amount_usd log_amount hour weekday is_night channel card_brand card_type is_virtual "
    "customer_segment kyc_level email_verified merchant_category merchant_risk_level user_country account_created_at card_created_at account_age_days card_age_days "
    "geo_mismatch foreign_ip recipient_differs is_declined card_tx_count_1h card_tx_count_24h card_amount_sum_24h card_seconds_since_last_tx card_amount_zscore "
    "card_tx_seq card_declines_24h user_tx_count_24h user_amount_sum_24h user_seconds_since_last_tx"
).split()
#: Columns of a training frame that no model sees.
NON_FEATURES = ("transaction_id", "user_id", "card_id", "merchant_id", "device_id", "created_at", "event_timestamp", "account_created_at", "card_created_at", "is_declined", "label")
#: Slow attributes served per (user, card).
SNAPSHOT_COLUMNS = ("card_brand", "card_type", "is_virtual", "card_created_at", "customer_segment", "kyc_level", "email_verified", "user_country", "account_created_at")
#: Keys of the message that is published for a scored transaction, besides the request's own.
REQUEST = (
    "request_id string, user_id string, card_id string, merchant_category string, merchant_risk_level int, amount_usd double, channel string, billing_country_code string, "
    "ip_country_code string, email_purchaser string, email_recipient string, created_at string"
)
MESSAGE = (
    "request_id string, transaction_id string, user_id string, card_id string, merchant_id string, device_id string, amount_usd double, currency string, channel string, "
    "billing_country_code string, ip_country_code string, email_purchaser string, email_recipient string, status string, transaction_time string, fraud_score double, "
    "prediction int, latency_ms double, model_name string, model_version string, threshold double"
)


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])
