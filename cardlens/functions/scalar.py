"""Row-wise features, encoders and rules as Column factories."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000


def log_amount(amount: Column) -> Column:
    return F.log1p(amount)


def utc_date(ts: Column) -> Column:
    """The day in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(DAY_US)).cast("int"))


def utc_hour_start(ts: Column) -> Column:
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(HOUR_US)))


def hour_utc(ts: Column) -> Column:
    """Hour of the day in UTC, whatever the session's time zone."""
    return F.floor(F.pmod(F.unix_micros(ts), F.lit(DAY_US)) / F.lit(HOUR_US)).cast("int")


def weekday(ts: Column) -> Column:
    """In UTC; Monday is 0, and the first day of the epoch was a Thursday."""
    return F.pmod(F.floor(F.unix_micros(ts) / F.lit(DAY_US)) + 3, F.lit(7)).cast("int")


def is_night(ts: Column) -> Column:
    return ((hour_utc(ts) < 6) | (hour_utc(ts) >= 23)).cast("int")


def age_days(ts: Column, since: Column) -> Column:
    """Whole days of 86,400 s between two instants, rounded down."""
    return F.floor((F.unix_micros(ts) - F.unix_micros(since)) / F.lit(DAY_US)).cast("int")


def differs(a: Column, b: Column) -> Column:
    """1 if a and b are distinct, nulls being equal to nulls only."""
    return (~a.eqNullSafe(b)).cast("int")


def recipient_differs(recipient: Column, purchaser: Column) -> Column:
    return (recipient.isNotNull() & ~recipient.eqNullSafe(purchaser)).cast("int")


def is_declined(status: Column) -> Column:
    return F.coalesce(status == "declined", F.lit(False)).cast("int")


def to_number(value: Column) -> Column:
    """A finite double, or null for blanks, text that is no plain number, NaN and infinities. Booleans are 1 and 0."""
    text = F.trim(value.cast("string"))
    plain = text.rlike(r"^[+-]?(?:\d[\d_]*\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$")
    number = F.when(F.lower(text).isin("true", "false"), (F.lower(text) == "true").cast("double")).when(plain, text.try_cast("double"))
    return null_nonfinite(number)


def null_nonfinite(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def as_label(value: Column, kind: str) -> Column:
    """A category as the text that encoders are keyed by; booleans are True and False."""
    return F.initcap(value.cast("string")) if kind == "boolean" else value.cast("string")


def encode_categorical(value: Column, mapping: Mapping[str, int], kind: str = "string", missing: int | None = None) -> Column:
    """The value's code as a double; null (or `missing`) for nulls and values not in the mapping. Case counts."""
    if not mapping:
        return F.lit(missing).cast("double")
    codes = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    code = F.try_element_at(codes, as_label(value, kind)).cast("double")
    return code if missing is None else F.coalesce(code, F.lit(float(missing)))


def decide(score: Column, threshold: float = 0.8) -> Column:
    """1 if the score reaches the threshold."""
    return (score >= F.lit(threshold)).cast("int")


def parse_iso_utc(text: Column) -> Column:
    return F.try_to_timestamp(text)


def localize(text: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """An ISO text as an instant: without an offset it is local time of the zone."""
    aware = text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
    return F.when(aware, F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(text), zone))


def drift_band(distance: Column) -> Column:
    return F.when(distance < 0.1, "no_drift").when(distance < 0.25, "moderate_drift").otherwise("significant_drift")


def zscore(x: Column, n: Column, total: Column, squares: Column) -> Column:
    """(x - mean) / sample deviation from count, sum and sum of squares; null below two values, or with no more spread than rounding
    leaves (a 10^12th of the squares)."""
    n, total, squares = (c.cast("double") for c in (n, total, squares))
    variance = F.when(n >= 2, (squares - total * total / F.nullif(n, F.lit(0.0))) / F.nullif(n - 1, F.lit(0.0)))
    return F.when(variance > squares * 1e-12, (x - total / F.nullif(n, F.lit(0.0))) / F.sqrt(variance))


def cold_pair(columns: list[str]) -> Column:
    """True if none of the served columns is there."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])


# From design notes.


def amount_cents(amount: Column) -> Column:
    return F.round(amount - F.floor(amount), 6)


def is_weekend(ts: Column) -> Column:
    return (weekday(ts) >= 5).cast("int")


def is_late(arrived: Column, happened: Column, seconds: int = 60) -> Column:
    return (F.unix_micros(arrived) - F.unix_micros(happened) > seconds * 1_000_000).cast("int")


def clean_email_domain(email: Column, placeholders: tuple[str, ...] = ("example.com", "none.com", "anonymous.com")) -> Column:
    domain = F.lower(F.substring_index(email, "@", -1))
    return F.when(domain.isin(*placeholders), None).otherwise(domain)


def identity_parts(info: Column) -> dict[str, Column]:
    """Browser family, system family, first number and screen area of a device's free text."""
    low = F.lower(info)
    family = F.when(low.rlike("chrome"), "chrome").when(low.rlike("firefox"), "firefox").when(low.rlike("safari"), "safari").otherwise("other")
    system = F.when(low.rlike("windows"), "windows").when(low.rlike("ios|mac"), "apple").when(low.rlike("android"), "android").otherwise("other")
    number = F.regexp_extract(info, r"([0-9]+)", 1).try_cast("int")
    area = F.regexp_extract(info, r"([0-9]+)x([0-9]+)", 1).try_cast("long") * F.regexp_extract(info, r"([0-9]+)x([0-9]+)", 2).try_cast("long")
    return {"browser": family, "os": system, "version": number, "screen_area": area}


def uid_keys(parts: list[Column]) -> list[Column]:
    """Nested pseudo-user keys: of the first part, the first two, and so on."""
    return [F.concat_ws("|", *[p.cast("string") for p in parts[: k + 1]]) for k in range(len(parts))]


def uid_hash(*parts: Column) -> Column:
    """A 60-bit key: the first 15 hex digits of the MD5 of the joined parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def pseudonym(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def traffic_arm(key: Column, share: int = 20) -> Column:
    """Arm b for `share` of 100 hash slots."""
    slot = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(slot < share, "b").otherwise("a")


def three_way(score: Column, high: float, step_up: float) -> Column:
    return F.when(score >= high, "decline").when(score >= step_up, "step_up").otherwise("approve")


def cold_start_decision(score: Column, cold: Column, high: float) -> Column:
    """A pair without history is approved below the high threshold."""
    return F.when(cold & (score < high), "approve").otherwise(three_way(score, high, high / 2))
