"""Features of a transaction from its key's history, for keys of any size."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from cardlens.functions import scalar, windows
from cardlens.operators import segments
from cardlens.operators.ordered import RANGE_ROWS

#: Keys with so many rows go over segments of time.
HOT_ROWS = 5_000_000
#: Blocks of gaps up to this size go without a tree.
FEW_ROWS = 256
OUT_ROWS = 10_000
MICROS = {"1 hour": 3_600_000_000, "24 hours": 86_400_000_000}

CARD_FIELDS = {
    "card_tx_count_1h": ("count", "1 hour"),
    "card_tx_count_24h": ("count", "24 hours"),
    "card_amount_sum_24h": ("sum", "24 hours"),
    "card_seconds_since_last_tx": ("gap", ""),
    "card_amount_zscore": ("zscore", ""),
    "card_tx_seq": ("sequence", ""),
    "card_declines_24h": ("declines", "24 hours"),
}
USER_FIELDS = {"user_tx_count_24h": ("count", "24 hours"), "user_amount_sum_24h": ("sum", "24 hours"), "user_seconds_since_last_tx": ("gap", "")}


def trailing_field(kind: str, span: str, by: str) -> Column:
    if kind == "count":
        return windows.trailing_count(by, span)
    return windows.trailing_sum("amount_usd", by, span) if kind == "sum" else windows.trailing_declines(by, span)


def plain_field(kind: str, span: str, key: str) -> Column:
    if kind == "gap":
        return windows.gap_seconds(key)
    if kind == "zscore":
        return windows.prior_zscore("amount_usd", key)
    return windows.sequence(key) if kind == "sequence" else trailing_field(kind, span, key)


def hot_keys(rows: DataFrame, keys: tuple[str, ...], hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """For each key column that has any: (_hot, _base), its values with hot_rows rows or more and their least amount.

    One pass counts all key columns; what comes to the driver is at most len(keys) * rows / hot_rows values.
    """
    kinds = dict(rows.dtypes)
    pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys])).alias("k"), F.col("amount_usd").cast("double").alias("amount"))
    counts = pairs.groupBy("k.kind", "k.value").agg(F.count(F.lit(1)).alias("n"), F.min("amount").alias("base"))
    found = counts.where((F.col("n") >= hot_rows) & F.col("value").isNotNull()).collect()
    out = {}
    for k in keys:
        held = [(r["value"], r["base"] or 0.0) for r in found if r["kind"] == k]
        if held:
            out[k] = rows.sparkSession.createDataFrame(held, "_hot string, _base double").withColumn("_hot", F.col("_hot").cast(kinds[k]))
    return out


def with_field(tx: DataFrame, key: str, fields: dict[str, tuple[str, str]], hot_rows: int = HOT_ROWS, segment_rows: int = RANGE_ROWS) -> DataFrame:
    """(id, fields) of transactions from one key's history."""
    rows = tx.select("id", key, "created_at", F.col("amount_usd").cast("double").alias("amount_usd"), "status")
    return with_history(rows, key, fields, hot_keys(rows, (key,), hot_rows).get(key), segment_rows).select("id", *fields)


def with_history(rows: DataFrame, key: str, fields: dict[str, tuple[str, str]], hot: DataFrame | None = None, segment_rows: int = RANGE_ROWS) -> DataFrame:
    """rows (id, created_at, amount_usd, status, key, ...) with the fields; hot keys go over segments of time.

    Without hot keys all fields share one shuffle and sort.
    """
    usual = {name: plain_field(kind, span, key) for name, (kind, span) in fields.items()}
    if hot is None:
        return rows.select("*", *[c.alias(name) for name, c in usual.items()])
    few = rows.join(hot, F.col(key) == F.col("_hot"), "left_anti").select("*", *[c.alias(name) for name, c in usual.items()])
    many = rows.join(hot, F.col(key) == F.col("_hot")).drop("_hot")
    return few.unionByName(by_segments(many, key, fields, segment_rows).select(few.columns))


def by_segments(rows: DataFrame, key: str, fields: dict[str, tuple[str, str]], segment_rows: int = RANGE_ROWS) -> DataFrame:
    """The fields of rows with _base, a value that amounts are counted from, by running totals over segments: any number of
    tasks a key and day. Sums of trailing frames are exact to ten places."""
    timed = segments.timed(rows)
    declined = F.when(F.col("status") == "declined", 1).otherwise(0)
    value = {"count": F.lit(1).cast("long"), "sum": F.col("amount_usd").cast(segments.EXACT), "declines": declined.cast("long")}
    trailing = {name: (MICROS[span], value[kind]) for name, (kind, span) in fields.items() if span}
    amount = F.col("_row.amount_usd") - F.col("_row._base")
    before = {
        "_rows": F.lit(1).cast("long"),
        "_n": F.when(amount.isNotNull(), 1).otherwise(0).cast("long"),
        "_s": amount,
        "_q": amount * amount,
    }
    splits = segments.splits_of(timed, segment_rows)
    run = segments.frames(timed, [key], ["id"], trailing, before, splits)
    n, s, q = (F.coalesce(F.col(c), F.lit(0)) for c in ("_n", "_s", "_q"))
    moments = scalar.zscore(F.col("amount_usd") - F.col("_base"), n, s, q)
    out = {
        "count": lambda c: F.col(c).cast("int"),
        "sum": lambda c: F.col(c).cast("double"),
        "declines": lambda c: F.greatest(F.col(c) - declined, F.lit(0)).cast("int"),
        "zscore": lambda c: moments,
        "sequence": lambda c: (F.coalesce("_rows", F.lit(0)) + 1).cast("int"),
        "gap": lambda c: F.col("_gap"),
    }
    if any(kind == "gap" for kind, _ in fields.values()):
        run = with_gap(run, key, splits)
    return run.select(*rows.columns, *[out[kind](name).alias(name) for name, (kind, _) in fields.items()])


def with_gap(rows: DataFrame, key: str, splits: list[float]) -> DataFrame:
    """rows with _gap, the seconds since the key's row before: the one before in the segment, or the last of earlier ones."""
    cut = segments.in_ranges(rows, "_at", splits, "_seg")
    own = cut.withColumn("_lag", F.lag("_at").over(Window.partitionBy(key, "_seg").orderBy("_at", "id")))
    last = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(key, "_seg").agg(F.max("_at").alias("_last")).select(key, "_seg", F.max("_last").over(last).alias("_before"))
    known = F.when(F.coalesce("_lag", "_before") > segments.NO_TIME, F.coalesce("_lag", "_before"))
    gap = F.when(F.col("_at") > segments.NO_TIME, (F.col("_at") - known) / 1e6)
    return segments.joined(own, carried, [key]).withColumn("_gap", gap)


def running_prior(rows: DataFrame, key: str, value: str, segment_rows: int = RANGE_ROWS) -> DataFrame:
    """rows (id, created_at, ...) with n, total and mean of the values of the key's rows before, over segments of time."""
    timed = segments.timed(rows)
    sums = {"n": F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("long"), "total": F.col(value).cast("double")}
    out = segments.running(timed, [key], ["id"], sums, {}, segments.splits_of(timed, segment_rows)).drop("_at")
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "mean": F.col("total") / F.nullif(F.col("n"), F.lit(0)), "total": F.coalesce("total", F.lit(0.0))})


def gap_median(tx: DataFrame, key: str, span: str = "1 hour", segment_rows: int = RANGE_ROWS) -> DataFrame:
    """(id, gap_median): the median of the seconds between a key's transactions over the trailing span, rows of the same time
    included; null where the span has none. An even number of them has the mean of the two in the middle.

    A key is split by blocks of one span, and a block sees a copy of the one before. In a block,
    counts of the gaps' ranks in a binary tree take up rows as they come and give them back as they leave; a row costs the
    logarithm of the block's rows. Blocks of few rows keep their gaps in a sorted list. Blocks share batches of results.
    """
    width = MICROS[span]
    timed = segments.timed(tx.select("id", key, "created_at"))
    gaps = with_gap(timed, key, segments.splits_of(timed, segment_rows))
    block = F.floor(F.col("_at") / width).cast("long")
    copies = gaps.select("id", key, "_at", "_gap", F.explode(F.array(F.lit(0), F.lit(1))).alias("_copy")).withColumn("_block", block + F.col("_copy"))
    placed = copies.select(F.xxhash64(key).alias("_hash"), F.col(key).cast("string").alias("_key"), "_block", "_at", "_gap", "_copy", "id").repartition("_key", "_block").sortWithinPartitions("_hash", "_key", "_block", "_at")

    kind = to_arrow_type(tx.schema["id"].dataType)
    return placed.mapInArrow(lambda batches: medians_of(batches, width, kind), f"id {dict(tx.dtypes)['id']}, gap_median double").select("id", F.round("gap_median", 6).alias("gap_median"))


def medians_of(batches: Iterator[pa.RecordBatch], width: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(id, gap_median) of rows in order of block and time, OUT_ROWS or a block's a batch."""
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("_hash", "_key", "_block", "_at", "_gap", "_copy", "id"))))
    told = lambda out: pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], kind), pa.array([m for _, m in out], pa.float64())], ["id", "gap_median"])
    out = []
    for _, held in groupby(rows, lambda r: r[:3]):
        out += block_medians([r[3:] for r in held], width)
        if len(out) >= OUT_ROWS:
            yield told(out)
            out = []
    if out:
        yield told(out)


def block_medians(rows: list[tuple], width: int) -> list[tuple]:
    """(id, median) of the rows (at, gap, copy, id), in order of at, that are no copies."""
    if len(rows) <= FEW_ROWS:
        return sorted_medians(rows, width)
    values = np.array([np.nan if g is None else g for _, g, _, _ in rows])
    kinds, ranks = np.unique(values[~np.isnan(values)], return_inverse=True)
    rank = np.full(len(rows), -1)
    rank[~np.isnan(values)] = ranks
    tree, top = [0] * (len(kinds) + 1), 1 << max(0, len(kinds).bit_length() - 1)
    held = 0

    def change(r: int, by: int) -> None:
        r += 1
        while r < len(tree):
            tree[r] += by
            r += r & -r

    def smallest(k: int) -> float:
        """The k-th smallest value held, from 0."""
        at, step = 0, top
        while step:
            if at + step < len(tree) and tree[at + step] <= k:
                at += step
                k -= tree[at]
            step >>= 1
        return float(kinds[at])

    out, left, i = [], 0, 0
    while i < len(rows):
        now, j = rows[i][0], i
        while j < len(rows) and rows[j][0] == now:
            if rank[j] >= 0:
                change(int(rank[j]), 1)
                held += 1
            j += 1
        while rows[left][0] < now - width:
            if rank[left] >= 0:
                change(int(rank[left]), -1)
                held -= 1
            left += 1
        wanted = [r[3] for r in rows[i:j] if not r[2]]
        if wanted:
            median = (smallest((held - 1) // 2) + smallest(held // 2)) / 2 if held else None
            out += [(r, median) for r in wanted]
        i = j
    return out


def sorted_medians(rows: list[tuple], width: int) -> list[tuple]:
    """block_medians for few rows."""
    out, held, left, i = [], [], 0, 0
    while i < len(rows):
        now, j = rows[i][0], i
        while j < len(rows) and rows[j][0] == now:
            if rows[j][1] is not None and rows[j][1] == rows[j][1]:
                insort(held, rows[j][1])
            j += 1
        while rows[left][0] < now - width:
            if rows[left][1] is not None and rows[left][1] == rows[left][1]:
                del held[bisect_left(held, rows[left][1])]
            left += 1
        n = len(held)
        median = (held[(n - 1) // 2] + held[n // 2]) / 2 if n else None
        out += [(r[3], median) for r in rows[i:j] if not r[2]]
        i = j
    return out
