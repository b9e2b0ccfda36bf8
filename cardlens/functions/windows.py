"""Window features. Trailing frames are by time, both ends included; ordered frames break ties by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def by_time(key: str, ts: str = "created_at", tie: str = "id") -> WindowSpec:
    return Window.partitionBy(key).orderBy(ts, tie)


def trailing(what: str, key: str, span: str, ts: str = "created_at") -> Column:
    """An aggregate over the last `span` (such as '24 hours') of a key, the row and its peers included."""
    return F.expr(f"{what} OVER (PARTITION BY {key} ORDER BY {ts} RANGE BETWEEN INTERVAL {span} PRECEDING AND CURRENT ROW)")


def trailing_count(key: str, span: str, ts: str = "created_at") -> Column:
    return trailing("count(*)", key, span, ts).cast("int")


def trailing_sum(value: str, key: str, span: str, ts: str = "created_at") -> Column:
    return trailing(f"sum({value})", key, span, ts)


def gap_seconds(key: str, ts: str = "created_at", tie: str = "id") -> Column:
    return (F.unix_micros(ts) - F.lag(F.unix_micros(ts)).over(by_time(key, ts, tie))) / 1e6


def prior_zscore(value: str, key: str, ts: str = "created_at", tie: str = "id") -> Column:
    """Against mean and sample deviation of the rows strictly before; null if these are undefined or without spread."""
    prior = by_time(key, ts, tie).rowsBetween(Window.unboundedPreceding, -1)
    return (F.col(value) - F.avg(value).over(prior)) / F.nullif(F.stddev_samp(value).over(prior), F.lit(0.0))


def sequence(key: str, ts: str = "created_at", tie: str = "id") -> Column:
    return F.row_number().over(by_time(key, ts, tie)).cast("int")


def trailing_declines(key: str, span: str, ts: str = "created_at", status: str = "status") -> Column:
    own = f"CASE WHEN {status} = 'declined' THEN 1 ELSE 0 END"
    return F.greatest(trailing(f"sum({own})", key, span, ts) - F.expr(own), F.lit(0)).cast("int")


def multi_window(rows: DataFrame, key: str, spans: dict[str, str], value: str = "amount_usd") -> DataFrame:
    """rows with n_, sum_ and max_ of each named span, in one sort."""
    wanted = {"n": "count(*)", "sum": f"sum({value})", "max": f"max({value})"}
    return rows.select("*", *[(trailing(f, key, span).cast("int") if what == "n" else trailing(f, key, span)).alias(f"{what}_{name}") for name, span in spans.items() for what, f in wanted.items()])
